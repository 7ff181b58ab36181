"""Cross-tokenizer alignment: how the tokens of two tokenizers overlap, and which pairs belong together.

Every text is encoded by both tokenizers, A on a space and the text, B on
the text (it adds the space itself).  Where both give back the same bytes, tokens are
byte ranges: an A and a B token are linked where their ranges overlap, and the
offsets at which tokens of both end cut the text into groups.

Pairs are counted by inverted bitmaps:

1. ``_postings``: the task that reads a text numbers it (chunk, low 16 bits) and
   holds the links of a run of texts as sorted (pair, document) keys.  A run becomes one
   container for each pair and plane: the plane of presence, and planes of the bits of
   multiplicity - 1.  Containers list their documents in 16 bits each; from 4,096
   documents on they are bitmaps of 8 KB.  A chunk takes several runs, so a task's memory does not grow with it.
2. ``_merged``: containers of one pair, chunk and plane are OR-ed; popcounts of the plane
   of presence are document counts, those of all planes times their weight link counts.
   A key is at most 8 KB, and a pair that every document holds is dealt out by chunk.
3. Counts are summed by pair, and the highest count of each B id is found (both map-side first).
4. The postings take the scores back: every container is joined with its pair's count and
   dealt to its chunk, where weights are added up at the documents that it lists.

Documents and pairs never pass through the driver.  The numbering is part of
a written table, so a lost executor cannot change it between the steps.

Defined cases: a text that is null, empty or not given back by A or B has no tokens
(zeros, groups ''); rows that repeat are counted and returned each; null ids are kept; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.bpe import codec
from tessera.llm.common import WRITTEN, drop_written, written

CHUNK = 1 << 16  # documents of a chunk at most: their numbers fill 16 bits
RUN_LINKS = 1 << 22  # links that a task holds before it writes containers
CHUNK_LINKS = 1 << 26  # links after which a chunk ends
SHARES = 8  # tasks among which the pairs of a chunk are dealt when scores return
DENSE = 1 << 12  # documents from which a container is a bitmap: half a chunk's bitmap in 16-bit numbers
BITMAP_BYTES = CHUNK // 8
SLICE_BYTES = 2 << 20  # text encoded at once
SPACE = "▁"

COUNTED = ["n_a", "n_b", "n_groups", "n_links"]
DOCUMENT = ["chunk", "low", "doc_id", *COUNTED, "groups"]  # groups: as text, or its digest
CONTAINER = ["chunk", "a", "b", "plane", "docs"]
FIELDS = pa.schema([("chunk", pa.int64()), ("low", pa.int32()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in COUNTED],
                    ("groups", pa.string()), ("a", pa.int32()), ("b", pa.int32()), ("plane", pa.int8()), ("docs", pa.binary())])
SCHEMA = ("chunk long, low int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
          "a int, b int, plane byte, docs binary")


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the text forms of ids in groups."""

    def __init__(self, byte_file: str, piece_file: str):
        self.bpe = codec(byte_file)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        n = self.pieces.get_piece_size()
        self.b_tokens = [bytes([int(p[1:-1], 16)]) if self.pieces.is_byte(i) else p.replace(SPACE, " ").encode()
                         for i, p in ((i, self.pieces.id_to_piece(i)) for i in range(n))]
        self.b_size = np.array([len(t) for t in self.b_tokens], np.int64)
        self.n_b = n
        # what stands behind an id: a comma, or where its group's side ends a bar (A) or a semicolon (B)
        self.forms = np.array([f"{i}{c}" for i in range(len(self.bpe.tokens)) for c in ",|"]
                              + [f"{i}{c}" for i in range(n) for c in ",;"], object)

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids by A and B, empty for both where a text is not given back by one of them."""
        a = [self.bpe.bpe.encode_ordinary(" " + t) if t else [] for t in texts]
        b = self.pieces.encode(texts, num_threads=1)
        for i, t in enumerate(texts):
            whole = b" " + t.encode()
            if not t or b"".join(map(self.b_tokens.__getitem__, b[i])) != whole \
                    or b"".join(map(self.bpe.tokens.__getitem__, a[i])) != whole:
                a[i], b[i] = [], []
        return a, b

    def align(self, texts: list[str], digest: bool) -> tuple[dict[str, list], np.ndarray, np.ndarray]:
        """(columns of the documents, pair of every link, place of its text in ``texts``)."""
        ids_a, ids_b = self.encode(texts)
        n_a, n_b = np.array([len(x) for x in ids_a], np.int64), np.array([len(x) for x in ids_b], np.int64)
        a = np.fromiter(chain.from_iterable(ids_a), np.int64, int(n_a.sum()))
        b = np.fromiter(chain.from_iterable(ids_b), np.int64, int(n_b.sum()))
        # texts one behind the other: both tokenizers give the same bytes, so their ranges share one line
        end_a, end_b = np.cumsum(self.bpe.size[a]), np.cumsum(self.b_size[b])
        start_a, start_b = end_a - self.bpe.size[a], end_b - self.b_size[b]
        first = np.searchsorted(end_b, start_a, "right")
        links = np.searchsorted(start_b, end_a, "left") - first
        before = np.cumsum(links) - links
        at_b = np.arange(int(links.sum())) + np.repeat(first - before, links)
        text_of_a = np.repeat(np.arange(len(texts)), n_a)
        pair = np.repeat(a, links) * self.n_b + b[at_b]
        where = np.repeat(text_of_a, links)

        last_a, last_b = _ends_in(end_a, end_b), _ends_in(end_b, end_a)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        stop_a, stop_b = np.flatnonzero(last_a) + 1, np.concatenate([[0], np.flatnonzero(last_b) + 1])
        code = np.empty(len(a) + len(b), np.int64)
        code[np.arange(len(a)) + stop_b[group_a]] = 2 * a + last_a
        code[np.arange(len(b)) + stop_a[group_b]] = 2 * (len(self.bpe.tokens) + b) + last_b
        forms, at, groups = self.forms[code], 0, []
        for n in (n_a + n_b).tolist():
            g = "".join(forms[at:at + n])[:-1]
            groups.append(hashlib.sha256(g.encode()).hexdigest() if digest and g else g)
            at += n
        per_text = lambda x: np.bincount(text_of_a, x, len(texts)).astype(np.int64)  # noqa: E731  exact: far below 2^53
        return ({"n_a": n_a, "n_b": n_b, "n_groups": per_text(last_a), "n_links": per_text(links), "groups": groups},
                pair, where)


def _ends_in(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which of the sorted offsets x are among the sorted offsets y."""
    return y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x if len(y) else np.zeros(len(x), bool)


@cache
def aligner(byte_file: str, piece_file: str) -> Aligner:
    return Aligner(byte_file, piece_file)


# containers -------------------------------------------------------------------------

def _binary(sizes: np.ndarray, data: np.ndarray) -> pa.Array:
    """A binary column from the sizes of its values and their bytes, one behind the other."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _packed(starts: np.ndarray, low: np.ndarray) -> pa.Array:
    """Containers of the sorted document numbers ``low``, one from each of ``starts`` on."""
    n = np.diff(np.append(starts, len(low)))
    dense = np.flatnonzero(n >= DENSE)
    if not len(dense):
        return _binary(2 * n, low.astype("<u2").view(np.uint8))
    sizes, parts, at = 2 * n, [], 0
    for k in dense.tolist():
        parts.append(low[at:starts[k]].astype("<u2").view(np.uint8))
        bits = np.zeros(CHUNK, np.uint8)
        bits[low[starts[k]:starts[k] + n[k]]] = 1
        parts.append(np.packbits(bits, bitorder="little"))
        sizes[k], at = BITMAP_BYTES, starts[k] + n[k]
    parts.append(low[at:].astype("<u2").view(np.uint8))
    return _binary(sizes, np.concatenate(parts))


def unpacked(docs: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """(documents in each container, their numbers one behind the other)."""
    offsets = np.frombuffer(docs.buffers()[1], np.int32)[docs.offset:docs.offset + len(docs) + 1].astype(np.int64)
    data = np.frombuffer(docs.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    dense = np.flatnonzero(sizes == BITMAP_BYTES)
    if not len(dense):
        return sizes // 2, np.ascontiguousarray(data).view("<u2").astype(np.int64)
    n, parts, at = sizes // 2, [], 0
    for k in dense.tolist():
        parts.append(np.ascontiguousarray(data[at:offsets[k]]).view("<u2"))
        parts.append(np.flatnonzero(np.unpackbits(data[offsets[k]:offsets[k + 1]], bitorder="little")))
        n[k], at = len(parts[-1]), offsets[k + 1]
    parts.append(np.ascontiguousarray(data[at:]).view("<u2"))
    return n, np.concatenate([p.astype(np.int64) for p in parts])


def popcount(docs: Column) -> Column:
    """Documents of a container."""
    n = F.octet_length(docs)
    return F.when(n == BITMAP_BYTES, F.bitmap_count(docs)).otherwise(n / 2).cast("long")


def weight(plane: Column) -> Column:
    """What a document in this plane counts: 1 in the plane of presence (-1), 2^k in plane k of multiplicity - 1."""
    return F.when(plane < 0, F.lit(1)).otherwise(F.call_function("shiftleft", F.lit(1), plane.cast("int"))).cast("long")


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.record_batch([pa.nulls(n, f.type) if f.name not in columns else columns[f.name]
                            if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type) for f in FIELDS],
                           schema=FIELDS)


def _containers(chunk: int, keys: list[np.ndarray], n_b: int) -> Iterator[pa.RecordBatch]:
    """The containers of a run from the keys (pair, low bits of the document) of its links."""
    if not sum(map(len, keys)):
        return
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    planes, more, k = [(-1, key)], count - 1, 0
    while (more >> k).any():
        planes.append((k, key[(more >> k) & 1 == 1]))
        k += 1
    for plane, key in planes:
        pair, low = key >> 16, key & (CHUNK - 1)
        starts = np.append(np.flatnonzero(np.diff(pair, prepend=-1)), len(key))
        for s in range(0, len(starts) - 1, 1 << 16):
            part = starts[s:s + (1 << 16) + 1]
            one = pair[part[:-1]]
            yield _rows(chunk=np.full(len(one), chunk), a=one // n_b, b=one % n_b, plane=np.full(len(one), plane, np.int8),
                        docs=_packed(part[:-1] - part[0], low[part[0]:part[-1]]))


def _postings(batches: Iterator[pa.RecordBatch], byte_file: str, piece_file: str, run_links: int,
              chunk_docs: int) -> Iterator[pa.RecordBatch]:
    """A row for each document, and the containers of its pairs."""
    al = aligner(byte_file, piece_file)
    chunk = TaskContext.get().partitionId() << 31
    low = in_chunk = held = 0
    keys: list[np.ndarray] = []
    for b in batches:
        sizes = np.maximum(b.column("size").to_numpy(), 1)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES, prepend=-1)).tolist() + [b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            while lo < hi:
                part = b.slice(lo, min(hi - lo, chunk_docs - low))
                columns, pair, where = al.align(part.column("text").to_pylist(), True)
                yield _rows(chunk=np.full(part.num_rows, chunk), low=np.arange(low, low + part.num_rows), doc_id=part.column("id"),
                            **columns)
                keys.append(pair << 16 | (where + low))
                held, low, lo = held + len(pair), low + part.num_rows, lo + part.num_rows
                if held >= run_links or low == chunk_docs:
                    yield from _containers(chunk, keys, al.n_b)
                    in_chunk, held, keys = in_chunk + held, 0, []
                if low == chunk_docs or in_chunk >= CHUNK_LINKS:
                    chunk, low, in_chunk = chunk + 1, 0, 0
    yield from _containers(chunk, keys, al.n_b)


def _or(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers of one pair, chunk and plane, which follow one another, become one."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b] if held is None else [held, b]).combine_chunks()
        same = np.ones(t.num_rows, bool)
        for c in CONTAINER[:-1]:
            x = t.column(c).to_numpy()
            same[1:] &= x[1:] == x[:-1]
        if not t.num_rows:
            continue
        same[0] = False
        starts = np.flatnonzero(~same)
        yield from _unions(t.slice(0, starts[-1]), starts)
        held = t.slice(starts[-1]).combine_chunks().to_batches()[0]
    if held is not None:
        yield from _unions(pa.Table.from_batches([held]), np.array([0, held.num_rows]))


def _unions(t: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One container for the rows between each two of ``starts``."""
    n = np.diff(starts)
    if not len(n):
        return
    alone = t.take(starts[:-1][n == 1])
    yield from alone.to_batches()
    several = np.flatnonzero(n > 1)
    if not len(several):
        return
    rows = np.flatnonzero(np.repeat(n > 1, n))
    counts, low = unpacked(t.column("docs").take(rows).combine_chunks())
    group = np.repeat(np.repeat(np.arange(len(several)), n[several]), counts)
    key = np.unique(group << 16 | low)
    docs = _packed(np.flatnonzero(np.diff(key >> 16, prepend=-1)), key & (CHUNK - 1))
    first = t.take(starts[:-1][several])
    yield from first.set_column(first.schema.get_field_index("docs"), first.schema.field("docs"), docs).to_batches()


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, low, count_sum, n_best) from containers that carry their pair's scores; a chunk's rows follow one another."""
    chunk, sums, best = None, None, None

    def out():
        low = np.flatnonzero(sums)
        return pa.record_batch({"chunk": np.full(len(low), chunk), "low": low.astype(np.int32),
                                "count_sum": sums[low], "n_best": best[low]})
    for b in batches:
        if not b.num_rows:
            continue
        chunks, gain, top = (b.column(c).to_numpy() for c in ("chunk", "gain", "top"))
        counts, low = unpacked(b.column("docs"))
        after = np.cumsum(counts)
        cuts = np.append(np.flatnonzero(np.diff(chunks, prepend=chunks[0] - 1)), len(chunks))
        for lo, hi in zip(cuts, cuts[1:]):
            if chunks[lo] != chunk:
                if chunk is not None:
                    yield out()
                chunk, sums, best = int(chunks[lo]), np.zeros(CHUNK, np.int64), np.zeros(CHUNK, np.int64)
            at = low[after[lo] - counts[lo]:after[hi - 1]]
            np.add.at(sums, at, np.repeat(gain[lo:hi], counts[lo:hi]))
            np.add.at(best, at, np.repeat(top[lo:hi], counts[lo:hi]))
    if chunk is not None:
        yield out()


# operators ------------------------------------------------------------------------------

def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.octet_length(text).alias("size"))


def alignments(docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, groups (``a1,a2|b1;a3|b2,b3``); no shuffle."""
    def run(batches):
        al = aligner(byte_file, piece_file)
        for b in batches:
            cuts = np.flatnonzero(np.diff(np.cumsum(np.maximum(b.column("size").to_numpy(), 1)) // SLICE_BYTES, prepend=-1))
            for lo, hi in zip(cuts, [*cuts[1:], b.num_rows]):
                part = b.slice(lo, hi - lo)
                columns = al.align(part.column("text").to_pylist(), False)[0]
                yield pa.record_batch({"doc_id": part.column("id"), **columns})
    return _base(docs, id_col, text_col).mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string")


def inverted_bitmaps(docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text",
                     run_links: int = RUN_LINKS, chunk_docs: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(documents, containers): the numbered documents with their counts, and the merged bitmaps of all pairs."""
    before = len(WRITTEN)
    rows = written(_base(docs, id_col, text_col).mapInArrow(
        lambda it: _postings(it, byte_file, piece_file, run_links, chunk_docs), SCHEMA), "postings")
    documents = written(rows.where("low is not null").select(*DOCUMENT), "aligned")
    containers = written(rows.where("a is not null").select(*CONTAINER).repartition("a", "b", "chunk")
                         .sortWithinPartitions("chunk", "a", "b", "plane")
                         .mapInArrow(_or, "chunk long, a int, b int, plane byte, docs binary"), "bitmaps")
    drop_written(docs.sparkSession, WRITTEN[before:before + 1])
    return documents, containers


def pair_counts(containers: DataFrame) -> DataFrame:
    """Per pair of ids: a, b, n_docs, n_links, best (its n_links is the highest of its b, ties included).

    A window of one b holds at most as many rows as A has ids.
    """
    docs = popcount(F.col("docs"))
    counts = containers.groupBy("a", "b").agg(F.sum(F.when(F.col("plane") < 0, docs)).alias("n_docs"),
                                              F.sum(docs * weight(F.col("plane"))).alias("n_links"))
    return counts.withColumn("best", F.col("n_links") == F.max("n_links").over(Window.partitionBy("b")))


def alignment_scores(docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text",
                     run_links: int = RUN_LINKS, chunk_docs: int = CHUNK) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    documents, containers = inverted_bitmaps(docs, byte_file, piece_file, id_col, text_col, run_links, chunk_docs)
    scores = written(pair_counts(containers), "pairs")
    w = weight(F.col("plane"))
    back = (containers.join(scores, ["a", "b"])
            .select("chunk", F.pmod(F.hash("a", "b"), F.lit(SHARES)).alias("share"), (w * F.col("n_links")).alias("gain"),
                    F.when(F.col("best"), w).otherwise(F.lit(0).cast("long")).alias("top"), "docs")
            .repartition("chunk", "share").sortWithinPartitions("chunk").select("chunk", "gain", "top", "docs")
            .mapInArrow(_returned, "chunk long, low int, count_sum long, n_best long"))
    sums = back.groupBy("chunk", "low").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    zero = F.lit(0).cast("long")
    return documents.join(sums, ["chunk", "low"], "left").select(
        "doc_id", *COUNTED, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
        F.col("groups").alias("groups_sha256"))
