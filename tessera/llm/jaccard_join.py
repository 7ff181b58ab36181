"""N-gram Jaccard join by prefix trees.

Documents link when their sets of word shingles have a Jaccard similarity of
``PERCENT`` or more.  Equal sets are one class from the start.

1. Linked sets of size n miss at most k = n - ceil(n * PERCENT / 100) shingles of
   each other.  Of every set the shingles in the lowest ``RANGE`` of all
   hashes are dealt by shingle; a task passes on one row per shingle.  A set
   with more than k of them that no other set has is out.  The others deal the rest of their
   shingles in the same way among themselves, which leaves few.
2. The shingles that these share with one another are ordered by frequency, rarest first, then
   hash.  With u unshared ones, linked sets have a common shingle among their first
   k - u + 1 in this order.  Sets that have one of these in common are joined to one of them, so a
   group costs its size, not its pairs; connected components of these joins hold all links.
   (Sets with k shingles in the range or fewer, short ones mostly, meet among themselves by their k + 1 lowest shingles.)
3. The sets of a component meet in one task.  If there are
   more than ``BLOCK_SETS`` sets or ``BLOCK_SHINGLES`` shingles, they are dealt to blocks, and all meet those of one block, the pivots:
   near copies of one text are connected after that, at a cost in proportion to their number.  Sets in the main part of the component, that with most sets,
   have no more to do with one another; only the rest meets it and itself, block by block.  A block's sets, ordered most
   common shingle first, are a compressed trie.  Sets traverse it one
   by one with a running overlap that all sets below share; a subtree is left as soon as the
   shingles that remain on either side cannot reach the threshold, or when all its sets are connected with
   the traversing one already.  The exact test decides.
4. The links, a spanning forest per task, give the final components.

Defined cases: null, empty and blank texts have no shingles and link with
nothing, each is its own component; with fewer than ``WORDS`` words the whole sequence is the one shingle; rows that
repeat are of one class; null ids count as no id: they join groups, whose smallest non-null id is the component (null if there is
none); an empty table gives an empty result; other columns pass through ``jaccard_dedup`` under any name.
Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.components import components
from tessera.llm.rolling import U, mixed, scramble

WORDS = 5
PERCENT = 75
RANGE = 10  # percent of the hashes beyond 100 - PERCENT
BLOCK_SETS = 2_048
BLOCK_SHINGLES = 1 << 20
MAX_BROADCAST_SETS = 500_000  # rows of four numbers; more are joined by shuffle
PIECE = 1 << 20  # bytes hashed at a time
OUT_ROWS = 1 << 16

# fixed values: ASCII white space, and A-Z to a-z
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def word_hashes(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, hash) of the words of a byte array, A-Z lower-cased, piece by piece."""
    begins, found, at = [], [], 0
    while at < len(t):
        end = min(len(t), at + PIECE)
        while end < len(t) and not SPACES[t[end]]:  # a word stays in one piece
            step = np.flatnonzero(SPACES[t[end:end + PIECE]])
            end += int(step[0]) if len(step) else min(PIECE, len(t) - end)
        part = LOWERED[t[at:end]]
        inside = np.concatenate([[False], ~SPACES[part], [False]])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        lo, hi = edge[::2], edge[1::2]
        begins.append(lo + at)
        found.append(mixed(part, lo, hi))
        at = end
    return (np.concatenate(begins), np.concatenate(found)) if begins else (np.zeros(0, np.int64), np.zeros(0, U))


def shingles(u: np.ndarray, n: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of n words, or of the whole shorter sequence."""
    if not len(u):
        return np.zeros(0, U)
    k = min(n, len(u))
    m = len(u) - k + 1
    s = u[:m] + U(k)  # shorter sequences have hashes of their own
    for i in range(1, k):
        s = s * U(0x9E3779B97F4A7C15) + u[i:i + m]
        s ^= s >> U(31)
    return np.unique(scramble(s))


def _sets(texts: pa.Array) -> list[np.ndarray]:
    """Shingle sets of a column of UTF-8 bytes."""
    out = []
    for x in texts:
        t = np.frombuffer(x.as_buffer(), np.uint8) if x.is_valid else np.zeros(0, np.uint8)
        out.append(shingles(word_hashes(t)[1]))
    return out


def digest(s: np.ndarray) -> int | None:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True) if len(s) else None


def missing(n: int, percent: int) -> int:
    """How many shingles a linked set may lack of a set of n."""
    return n + (-n * percent) // 100


def range_end(percent: int, share: int) -> np.uint64:
    return U(((1 << 64) - 1) // 100 * min(100, 100 - percent + share))


def _low_shingles(batches: Iterator[pa.RecordBatch], percent: int, share: int) -> Iterator[pa.RecordBatch]:
    """Per document its set's size, digest, and lowest shingles; ``low`` those in the range, ``weak`` for sets with too few there."""
    limit = range_end(percent, share)
    for b in batches:
        for i in range(0, b.num_rows, 1000):
            part = b.slice(i, 1000)
            sets = _sets(part.column("text"))
            low = [s[:np.searchsorted(s, limit)] for s in sets]
            lack = [missing(len(s), percent) for s in sets]
            yield pa.record_batch({
                "id": part.column("id"), "key": part.column("key"), "n": pa.array([len(s) for s in sets], pa.int64()),
                "digest": pa.array([digest(s) for s in sets], pa.int64()), "q": pa.array([len(x) for x in low], pa.int64()),
                "k": pa.array(lack, pa.int64()), "low": pa.array([x.tobytes() for x in low], pa.binary()),
                "weak": pa.array([s[:k + 1].view(np.int64) if len(x) <= k else [] for s, x, k in zip(sets, low, lack)],
                                 pa.list_(pa.int64()))})


def _high_shingles(batches: Iterator[pa.RecordBatch], percent: int, share: int) -> Iterator[pa.RecordBatch]:
    """The shingles beyond the range."""
    limit = range_end(percent, share)
    for b in batches:
        for i in range(0, b.num_rows, 1000):
            part = b.slice(i, 1000)
            high = [s[np.searchsorted(s, limit):].tobytes() for s in _sets(part.column("text"))]
            yield pa.record_batch({"digest": part.column("digest"), "low": pa.array(high, pa.binary())})


# a row of the deal: the only set of its task with the shingle; the first of several; one of them, known to be shared
SINGLE, FIRST, SHARED = 0, 1, 2


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (route, s, digest, kind): one per shingle and batch, dealt by shingle; the others are spread."""
    for b in batches:
        _, at = np.unique(b.column("digest").to_numpy(), return_index=True)
        b = b.take(pa.array(at))
        parts = [np.frombuffer(x.as_buffer(), np.int64) for x in b.column("low")]
        s = np.concatenate(parts)
        d = np.repeat(b.column("digest").to_numpy(), [len(p) for p in parts])
        order = np.argsort(s, kind="stable")
        s, d = s[order], d[order]
        first = np.append(True, s[1:] != s[:-1])[:len(s)]
        several = np.bincount(np.cumsum(first) - 1, minlength=1)[np.cumsum(first) - 1] > 1 if len(s) else first
        again = np.flatnonzero(several)
        route = np.append(s[first], (s[again] ^ scramble(d[again].view(U)).view(np.int64)))
        digests = np.append(d[first], d[again])
        kind = np.append(np.where(several[first], FIRST, SINGLE), np.full(len(again), SHARED)).astype(np.int32)
        by_set = np.argsort(digests, kind="stable")  # rows of a set follow one another, which compresses well
        out = pa.record_batch({"route": pa.array(route[by_set]), "s": pa.array(np.append(s[first], s[again])[by_set]),
                               "digest": pa.array(digests[by_set]), "kind": pa.array(kind[by_set])})
        for i in range(0, out.num_rows, OUT_ROWS):
            yield out.slice(i, OUT_ROWS)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by route to (digest, s) of shingles that two sets or more have; keeps one row of the last shingle."""
    last = root = None
    kind_of_root, several = SINGLE, False
    for b in batches:
        if not b.num_rows:
            continue
        kind = b.column("kind").to_numpy()
        s, d = b.column("s").to_numpy(), b.column("digest").to_numpy()
        out_s, out_d = [s[kind == SHARED]], [d[kind == SHARED]]
        s, d, kind = s[kind != SHARED], d[kind != SHARED], kind[kind != SHARED]
        if len(s):
            new = np.append(s[0] != last, s[1:] != s[:-1])
            starts = np.flatnonzero(new) if new[0] else np.append(0, np.flatnonzero(new))
            group = np.searchsorted(starts, np.arange(len(s)), "right") - 1
            roots = d[starts]
            if not new[0]:
                roots[0] = root
            many = np.bincount(group, (d != roots[group]) | (kind == FIRST)) > 0
            if not new[0]:
                many[0] |= several
                if many[0] and not several and kind_of_root == SINGLE:  # held back until a second set came
                    out_s.append(s[:1])
                    out_d.append(np.array([root]))
            emit = many[group] & (kind == SINGLE)
            out_s.append(s[emit])
            out_d.append(d[emit])
            kind_of_root = kind_of_root if not new[0] and len(starts) == 1 else int(kind[starts[-1]])
            last, root, several = s[-1], roots[-1], bool(many[-1])
        x, y = np.concatenate(out_d), np.concatenate(out_s)
        if len(x):
            yield pa.record_batch({"digest": pa.array(x, pa.int64()), "s": pa.array(y, pa.int64())})


def _found_shared(low: DataFrame) -> DataFrame:
    """(digest, s) of the shingles in ``low`` that another set has too."""
    return (low.mapInArrow(_deal, "route long, s long, digest long, kind int")
            .repartition("route").sortWithinPartitions("route", "s").mapInArrow(_shared, "digest long, s long"))


def _with_texts(rows: DataFrame, near: DataFrame) -> DataFrame:
    """``near`` (id, key and more) with the texts; broadcast up to MAX_BROADCAST_SETS rows, else joined by shuffle."""
    near = near.withColumnsRenamed({"id": "r_id", "key": "r_key"})
    if near.count() <= MAX_BROADCAST_SETS:
        near = F.broadcast(near)
    return rows.join(near, F.col("id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key")))


def _stars(rows: DataFrame) -> DataFrame:
    """Edges (a, b) from every digest of a shingle to the smallest one."""
    root = rows.groupBy("s").agg(F.min("digest").alias("b")).withColumnRenamed("s", "r_s")
    return rows.join(root, F.col("s") == F.col("r_s")).where("digest <> b").select(F.col("digest").alias("a"), "b").distinct()


# the trie ------------------------------------------------------------------------

class Node:
    """An edge of shingles; the sets of the subtree are the sorted ones from lo to hi."""
    __slots__ = ("edge", "children", "lo", "hi", "ends", "least", "most")


class Trie:
    def __init__(self, sets: list[np.ndarray]):
        """sets: increasing ranks; sorted so that subtrees are ranges."""
        self.order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u4").tobytes())
        self.sets = [sets[i] for i in self.order]
        self.size = np.array([len(s) for s in self.sets])
        self.root = self._build()

    def _build(self) -> Node:
        root = None
        todo = [(0, len(self.sets), 0, None)]
        while todo:
            lo, hi, depth, parent = todo.pop()
            node = Node()
            node.lo, node.hi, node.children = lo, hi, []
            a, b = self.sets[lo], self.sets[hi - 1]
            if parent is None:
                end = 0
            else:
                n = min(len(a), len(b))
                differ = np.flatnonzero(a[depth:n] != b[depth:n])
                end = depth + int(differ[0]) if len(differ) else n
            node.edge = a[depth:end]
            node.ends = lo
            while node.ends < hi and len(self.sets[node.ends]) == end:
                node.ends += 1
            node.least, node.most = int(self.size[lo:hi].min()), int(self.size[lo:hi].max())
            at = node.ends
            while at < hi:
                token, stop = self.sets[at][end], at + 1
                while stop < hi and self.sets[stop][end] == token:
                    stop += 1
                todo.append((at, stop, end, node))
                at = stop
            if parent is None:
                root = node
            else:
                parent.children.append(node)
        return root

    def traverse(self, s: np.ndarray, member: np.ndarray, labels: np.ndarray, label: int, after: int, percent: int):
        """Linked sets of other labels, one at a time; the caller merges the labels and goes on.

        ``member`` marks the ranks of s; ``after``: sets up to this place are not asked for."""
        n, more = len(s), 100 + percent
        stack = [(self.root, 0, 0)]
        while stack:
            node, overlap, seen = stack.pop()
            if node.hi <= after or 100 * node.most < percent * n or 100 * n < percent * node.least:
                continue
            if (labels[node.lo:node.hi] == labels[label]).all():
                continue
            alive = True
            for i in range(0, len(node.edge), 128):
                part = node.edge[i:i + 128]
                overlap += int(np.count_nonzero(member[part]))
                seen += len(part)
                # a set of m shingles below can still reach overlap + m - seen, and overlap + the rest of s
                rest = n - int(np.searchsorted(s, part[-1], "right"))
                if more * (overlap + node.most - seen) < percent * (n + node.most) \
                        or more * (overlap + rest) < percent * (n + max(node.least, seen)):
                    alive = False
                    break
            if not alive:
                continue
            if node.ends > node.lo and more * overlap >= percent * (n + seen):
                for i in range(max(node.lo, after), node.ends):
                    if labels[i] != labels[label]:
                        yield i
            stack.extend((c, overlap, seen) for c in node.children)


def links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``left``, or between ``left`` and ``right`` (places continue in right)."""
    every = left + (right or [])
    values, rank, count = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    order = np.argsort(-count, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    ranked = [np.sort(p) for p in np.split(place[rank], np.cumsum([len(s) for s in every])[:-1])]
    trie = Trie(ranked[:len(left)])
    # labels: trie order first, then the sets of the right side
    labels = np.arange(len(every))
    name = trie.order + list(range(len(left), len(every)))
    member = np.zeros(len(values), bool)
    out = []
    for i in range(len(left), len(every)) if right is not None else range(len(left)):
        s = ranked[i] if right is not None else trie.sets[i]
        member[s] = True
        for j in trie.traverse(s, member, labels, i, 0 if right is not None else i + 1, percent):
            if labels[i] != labels[j]:
                out.append((name[i], name[j]))
                labels[labels == labels[j]] = labels[i]
        member[s] = False
    return out


def _join_blocks(group: pa.Table, percent: int) -> pa.Table:
    """Links among the left sets of a group if it is alone, else between its left and its right sets."""
    left, alone = np.asarray(group.column("left")), group.column("alone")[0].as_py()
    sets = [np.frombuffer(x.as_buffer(), U) for x in group.column("set")]
    names = group.column("digest").to_pylist()
    in_left, in_right = np.flatnonzero(left).tolist(), np.flatnonzero(~left).tolist()
    found = links([sets[k] for k in in_left], None if alone else [sets[k] for k in in_right], percent) \
        if in_left and (alone or in_right) else []
    at = in_left + in_right
    edges = [(names[at[x]], names[at[y]]) for x, y in found]
    whole = group.column("blocks")[0].as_py() == 1  # then its components are final: every set with the smallest of them
    if whole:
        up: dict[int, int] = {}

        def top(x):
            while up.setdefault(x, x) != x:
                x = up[x]
            return x
        for x, y in edges:
            x, y = top(x), top(y)
            up[max(x, y)] = min(x, y)
        edges = [(x, top(x)) for x in list(up)]
    a, b = zip(*edges) if edges else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "final": pa.array([whole] * len(edges), pa.bool_())})


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, 500):
            part = b.slice(i, 500)
            yield pa.record_batch({**{c: part.column(c) for c in ("digest", "label", "blocks", "main", "rests")},
                                   "set": pa.array([s.tobytes() for s in _sets(part.column("text"))], pa.binary())})


def _blocks(block_sets: int) -> Column:
    """Blocks for sets of a group, from their number and their shingles."""
    return F.greatest(F.ceil(F.count("*") / block_sets), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")


def _joined(rows: DataFrame, near: DataFrame, meetings, percent: int) -> DataFrame:
    """(a, b, final): the links found where the sets of ``near`` meet."""
    texts = _with_texts(rows, near.select("id", "key", "digest", "label", "blocks", "main", "rests"))
    sets = texts.select("digest", "label", "blocks", "main", "rests", "text").mapInArrow(
        _set_rows, "digest long, label long, blocks int, main boolean, rests int, set binary")
    met = sets.select("label", "digest", "set", "blocks", F.explode(meetings()).alias("m")).select(
        "label", "digest", "set", "blocks", "m.*")
    return met.groupBy("label", "i", "j").applyInArrow(lambda g: _join_blocks(g, percent), "a long, b long, final boolean")


def _meeting(i, j, left, alone) -> Column:
    return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), left.alias("left"), alone.alias("alone"))


def _first_meetings() -> Column:
    """Every set of a component meets its pivots, those of block 0; there is no more to do if it has one block."""
    block, zero = F.pmod(F.xxhash64("digest"), F.col("blocks")), F.lit(0)
    all_blocks = F.sequence(zero, F.col("blocks") - 1)
    return F.when(block == 0, F.transform(all_blocks, lambda x: _meeting(zero, x, F.lit(True), x == 0))) \
        .otherwise(F.array(_meeting(zero, block, F.lit(False), F.lit(False))))


def _rest_meetings() -> Column:
    """Sets outside their component's main part meet it (but for the pivots) and one another, block by block."""
    block, mine = F.pmod(F.xxhash64("digest"), F.col("blocks")), F.pmod(F.xxhash64(F.lit("rest"), "digest"), F.col("rests"))
    rests = F.sequence(F.lit(0), F.col("rests") - 1)
    yes, no = F.lit(True), F.lit(False)
    with_main = F.transform(F.sequence(F.lit(1), F.col("blocks") - 1), lambda x: _meeting(mine, x, yes, no))
    with_rest = F.transform(rests, lambda r: _meeting(F.least(r, mine), -1 - F.greatest(r, mine), mine <= r, r == mine))
    main = F.when(block > 0, F.transform(rests, lambda r: _meeting(r, block, no, no))).otherwise(F.slice(with_main, 1, 0))
    return F.when(F.col("main"), main).otherwise(F.concat(with_main, with_rest))


def _with_rest(large: DataFrame, labels: DataFrame, block_sets: int) -> DataFrame:
    """The sets of large components with main (connected with most of the others by now) and the blocks that the rest fills.

    Components without a rest are left out."""
    now = large.join(labels.withColumnRenamed("label", "l_now"), F.col("digest") == F.col("node"), "left") \
        .withColumn("l_now", F.coalesce("l_now", "digest"))
    top = now.groupBy("label", "l_now").count().groupBy(F.col("label").alias("t_label")) \
        .agg(F.max(F.struct("count", "l_now"))["l_now"].alias("top"))
    parted = now.join(top, F.col("label") == F.col("t_label")).withColumn("main", F.col("l_now") == F.col("top"))
    rests = parted.where("not main").groupBy(F.col("label").alias("r_label")).agg(_blocks(block_sets).alias("r_blocks"))
    return parted.join(rests, F.col("label") == F.col("r_label")).select(
        "digest", "id", "key", "n", "label", "blocks", "main", F.col("r_blocks").alias("rests"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                       share: int = RANGE, block_sets: int = BLOCK_SETS) -> DataFrame:
    """(id, key, n, group, component): key is a hash of id and text; n the set's size; group is null for empty sets."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(id_col, text_col).alias("key"),
                       F.col(text_col).cast("binary").alias("text"))
    sets = written(rows.mapInArrow(lambda it: _low_shingles(it, percent, share),
                                   "id long, key long, n long, digest long, q long, k long, low binary, weak array<long>"), "low")
    some = sets.where("digest is not null")
    classes = some.groupBy("digest").agg(F.min(F.struct("id", "key")).alias("rep"), F.min("id").alias("least"),
                                         *[F.first(c).alias(c) for c in ("n", "q", "k")])
    shared = written(_found_shared(some.where("q > 0").select("digest", "low")), "shared")
    in_range = shared.groupBy(F.col("digest").alias("f_digest")).agg(F.count_distinct("s").alias("found"))
    left = written(classes.join(in_range, F.col("digest") == F.col("f_digest")).where("found >= q - k")
                   .select("digest", "rep.id", "rep.key", "n", "k"), "left")
    high = _found_shared(_with_texts(rows, left).select("digest", "text")
                         .mapInArrow(lambda it: _high_shingles(it, percent, share), "digest long, low binary"))
    # of the shingles in the range only those that two of the remaining sets have
    low = shared.join(left.select("digest"), "digest", "left_semi").select("digest", "s").distinct()
    every = written(low.unionAll(high.distinct()), "every")
    often = every.groupBy(F.col("s").alias("o_s")).agg(F.count("*").alias("often")).where("often > 1")
    ranked = (every.join(often, F.col("s") == F.col("o_s")).groupBy(F.col("digest").alias("f_digest"))
              .agg(F.sort_array(F.collect_list(F.struct("often", "s"))).alias("found")))
    free = F.col("k") - F.col("n") + F.size("found")
    first = (left.join(ranked, F.col("digest") == F.col("f_digest")).where(free >= 0)
             .select("digest", F.explode(F.slice("found", F.lit(1), (free + 1).cast("int"))).alias("x")).select("digest", "x.s"))
    weak = some.where("size(weak) > 0").select("digest", F.explode("weak").alias("s")).distinct()
    joined = components(_stars(first).unionAll(_stars(weak)))

    near = written(classes.join(joined, F.col("digest") == F.col("node")).select("digest", "label", "rep.id", "rep.key", "n"), "near")
    blocks = near.groupBy(F.col("label").alias("b_label")).agg(_blocks(block_sets).alias("blocks"))
    near = written(near.join(blocks, F.col("label") == F.col("b_label")).drop("b_label")
                   .withColumns({"main": F.lit(True), "rests": F.lit(0)}), "blocks")
    found = written(_joined(rows, near, _first_meetings, percent), "links")
    linked = found.where("final").select(F.col("a").alias("node"), F.col("b").alias("label"))
    large = near.where("blocks > 1")
    if not large.isEmpty():
        first_links = found.where("not final").select("a", "b")
        rest = written(_with_rest(large, components(first_links), block_sets), "rest")
        more = written(_joined(rows, rest, _rest_meetings, percent).select("a", "b"), "links")
        linked = linked.unionAll(components(first_links.unionAll(more)))

    named = classes.join(linked, F.col("digest") == F.col("node"), "left").select(
        "digest", "least", F.coalesce("label", "digest").alias("label"))
    smallest = named.groupBy(F.col("label").alias("s_label")).agg(F.min("least").alias("component"))
    of_class = written(named.join(smallest, F.col("label") == F.col("s_label")).select(
        F.col("digest").alias("c_digest"), F.col("label").alias("group"), "component"), "classes")
    return sets.join(of_class, F.col("digest") == F.col("c_digest"), "left").select(
        "id", "key", "n", "group", F.when(F.col("group").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"))


def jaccard_report(docs: DataFrame, **how) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id."""
    return jaccard_components(docs, **how).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                                                  F.col("component").alias("component_id"))


def jaccard_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One document of each component, that with its smallest id, with all columns.

    Ids that are null come last, ties go to the smaller text hash, of rows that
    repeat id and text one stays.  Documents without shingles all stay.
    """
    got = jaccard_components(docs, id_col, text_col, **how)
    first = (got.where("n > 0").groupBy("group").agg(F.min(F.struct(F.col("id").isNull(), "id", "key")).alias("x"))
             .select("x.id", "x.key", F.lit(False).alias("every")))
    keep = first.unionByName(got.where("n = 0").select("id", "key", F.lit(True).alias("every")).distinct())
    # no nulls in the join's keys, so that the window below has its partitioning; the hash tells null from 0
    keep = keep.select(F.coalesce("id", F.lit(0)).alias("k_id"), F.col("key").alias("k_key"), "every")
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("id"),
                       F.xxhash64(id_col, text_col).alias("key"))
    kept = rows.join(keep, (F.col("id") == F.col("k_id")) & (F.col("key") == F.col("k_key")))
    nth = F.row_number().over(Window.partitionBy("id", "key").orderBy("every"))
    return kept.withColumn("nth", nth).where("every or nth = 1").select("row.*")
