"""Suffix-array dedup: remove every byte that lies in a string of ``LENGTH`` bytes found anywhere else too.

1. Every start of a ``LENGTH``-byte string belongs to one anchor, the ``GRAM``-byte
   substring of that string with the smallest hash.  Equal strings have equal anchors at
   equal offsets, so only anchors with the same hash need to be compared.  A row
   per anchor carries its hash, the range of starts it owns and a hash of
   the bytes of that range; a task passes on one row per range text, so a passage that
   fills a third of the corpus costs a row per task, not per copy.
2. The rows are dealt by anchor hash and streamed in sorted order.  Anchors found
   once are done.  Range texts found twice or more are repeated as a whole.  What is left are
   different range texts around one anchor (edges of repeated passages): of these one snippet each goes on.
3. Snippets of the same anchors meet in slabs of about ``SLAB`` bytes.  A slab's suffix
   array is built by two-stage sorting: suffixes smaller than their successors
   are sorted directly, the rest follow by scans over the buckets of first bytes.
   Neighbours whose common prefix reaches ``LENGTH`` are repeated.
   An anchor with more than ``CROWD`` different ranges does not go to one task: its
   starts are counted one by one by digest, with a map-side combine.
4. The repeated starts are collected by document (at most its own) and its bytes cut.

Range texts are compared by two 64-bit hashes, snippets byte by byte.

Defined cases: null and empty text have no bytes; texts under ``LENGTH`` bytes stay;
rows that repeat are copies like any others, so all bytes of long ones go; null
ids are kept (rows are told apart by id and text hash); characters may be cut, so
the kept text is returned as bytes; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written
from tessera.llm.rolling import Hashes, U, scramble

LENGTH = 200
GRAM = 64
PART = 1 << 18  # starts of one text handled at a time
SLAB = 1 << 19
CROWD = 8192
OUT_ROWS = 1 << 16
PLACE = (1 << 20) - 1  # over PART + LENGTH


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(h) - width + 1
    blocks = np.append(h, np.full(-len(h) % width, U(0xFFFFFFFFFFFFFFFF))).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchors(text: bytes, hashes: Hashes, length: int, gram: int) -> Iterator[tuple]:
    """(anchor hash, range hash, first start, last start) arrays of a text, part by part."""
    for at in range(0, len(text) - length + 1, PART):
        t = np.frombuffer(text, np.uint8, min(PART + length - 1, len(text) - at), at)
        c = hashes.prefix(t)
        i = np.arange(len(t) - gram + 1)
        h = hashes.of(c, i, i + gram)
        # the place in the low bits: of equal hashes the last one wins, so that a text of one repeated letter has many anchors
        place = PLACE - (sliding_min(h & ~U(PLACE) | (U(PLACE) - i.astype(U)), length - gram + 1) & U(PLACE)).astype(np.int64)
        cut = np.flatnonzero(place[1:] != place[:-1]) + 1
        lo, hi = np.append(0, cut), np.append(cut, len(place)) - 1
        yield h[place[lo]], hashes.of(c, lo, hi + length) + (hi - lo).astype(U), lo + at, hi + at


def _anchor_rows(batches: Iterator[pa.RecordBatch], length: int, gram: int) -> Iterator[pa.RecordBatch]:
    """One row per anchor.  Within a batch the first of equal ranges has weight 2; the others have weight 0, are
    known to be repeated, and get a hash of their own so that they spread."""
    hashes = Hashes(PART + length + 1)
    for b in batches:
        ids, keys = b.column("id").to_pylist(), b.column("key").to_pylist()
        found = []
        for k, text in enumerate(b.column("text")):
            raw = text.as_buffer()
            for h, g, lo, hi in anchors(raw.to_pybytes() if raw is not None else b"", hashes, length, gram):
                found.append((h, g, lo, hi, np.full(len(h), k)))
        if not found:
            continue
        h, g, lo, hi, doc = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((g, h))
        h, g, lo, hi, doc = h[order], g[order], lo[order], hi[order], doc[order]
        first = np.append(True, (h[1:] != h[:-1]) | (g[1:] != g[:-1]))
        copies = np.diff(np.append(np.flatnonzero(first), len(h)))
        weight = np.zeros(len(h), np.int64)
        weight[first] = np.minimum(copies, 2)
        key = np.array(keys, np.int64)[doc]
        h = np.where(first, h, scramble(key.view(U) ^ lo.astype(U)))
        yield from _slices({"h": pa.array(h.view(np.int64)), "g": pa.array(g.view(np.int64)),
                            "id": pa.array(ids, pa.int64()).take(pa.array(doc)), "key": pa.array(key),
                            "lo": pa.array(lo.astype(np.int64)), "span": pa.array((hi - lo).astype(np.int32)),
                            "w": pa.array(weight.astype(np.int32))})


def _slices(columns: dict) -> Iterator[pa.RecordBatch]:
    b = pa.record_batch(columns)
    for i in range(0, b.num_rows, OUT_ROWS):
        yield b.slice(i, OUT_ROWS)


# what is known of a range of starts
REPEATED, ALONE, SAMPLE, CROWDED = 1, 2, 3, 4


def _judge(batches: Iterator[pa.RecordBatch], crowd: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h, g) to states: REPEATED ranges; ALONE, the only one of its text beside others around the anchor;
    SAMPLE, a REPEATED range's text for comparison; CROWDED, of an anchor with too many different ranges."""
    carry, crowded = None, None
    for b in _with_end(batches):
        if b is not None:
            if b.num_rows == 0:
                continue
            t = pa.Table.from_batches([b] if carry is None else [carry, b]).combine_chunks()
            t = t.to_batches()[0]
            h = t.column("h").to_numpy()
            done = int(np.searchsorted(h, h[-1]))
        else:
            if carry is None:
                return
            t, done = carry, carry.num_rows
            h = t.column("h").to_numpy()
        if done and crowded is not None:  # rows of the crowded anchor come first
            n = int((h[:done] == crowded).sum())
            yield from _crowded(t.slice(0, n))
            t, done, h = t.slice(n), done - n, h[n:]
            crowded = None
        if done:
            yield from _groups(t.slice(0, done), crowd)
        carry = t.slice(done) if b is not None else None
        if carry is not None and carry.num_rows > 16 * crowd:  # one anchor only; its ranges are passed on as they come
            yield from _crowded(carry)
            crowded, carry = int(h[-1]), None


def _with_end(batches):
    yield from batches
    yield None


def _crowded(t: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a crowded anchor, passed on as they come; one that has copies in its batch stands for them and is REPEATED."""
    w = t.column("w").to_numpy()
    yield from _state(t, np.where(w > 0, CROWDED, 0))
    yield from _state(t, np.where(w == 1, 0, REPEATED))


def _groups(t: pa.RecordBatch, crowd: int) -> Iterator[pa.RecordBatch]:
    h, g, w = (t.column(x).to_numpy() for x in ("h", "g", "w"))
    real = w > 0
    new_h = np.append(True, h[1:] != h[:-1])
    new_hg = new_h | np.append(True, g[1:] != g[:-1])
    of_h, of_hg = np.cumsum(new_h) - 1, np.cumsum(new_hg) - 1
    copies = np.bincount(of_hg, w)[of_hg]
    texts = np.bincount(of_h, new_hg & real)[of_h]  # different ranges; a row of weight 0 has a hash of its own
    state = np.where(~real | (copies >= 2), REPEATED, np.where(texts >= 2, ALONE, 0))
    rest = real & (texts > crowd)
    yield from _state(t, np.where(rest & (copies < 2), CROWDED, state))
    extra = real & new_hg & (copies >= 2) & (texts >= 2)
    yield from _state(t, np.where(extra, np.where(rest, CROWDED, SAMPLE), 0))


def _state(t: pa.RecordBatch, state: np.ndarray) -> Iterator[pa.RecordBatch]:
    at = pa.array(np.flatnonzero(state))
    if len(at):
        t = t.take(at)
        yield from _slices({c: t.column(c) for c in ("h", "id", "key", "lo", "span")}
                           | {"state": pa.array(state[state > 0].astype(np.int32))})


# the suffix array ---------------------------------------------------------------

def smaller_than_next(t: np.ndarray) -> np.ndarray:
    """Whether suffix i is smaller than suffix i + 1; the last one is not (the end is smaller than any byte)."""
    n = len(t)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(t[1:].astype(np.int16) - t[:-1])
    step[-1] = -1
    turn = np.flatnonzero(step)  # in a run of equal bytes, what follows the run decides
    return step[turn[np.searchsorted(turn, np.arange(n))]] > 0


def suffix_array(t: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes of ``t`` (bytes from 1 to 255) in order of their first ``depth`` bytes, by two-stage sorting."""
    n = len(t)
    if not n:
        return np.zeros(0, np.int64)
    small = smaller_than_next(t)
    direct = np.flatnonzero(small)
    rows = np.lib.stride_tricks.sliding_window_view(np.append(t, np.zeros(depth, np.uint8)), depth)
    keys = np.ascontiguousarray(rows[direct]).view(f"S{depth}").ravel()
    direct = direct[np.argsort(keys, kind="stable")]
    edges = np.searchsorted(t[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def induce(found: np.ndarray) -> None:
        """Predecessors that are larger than their successors go to the front parts of their buckets, in this order."""
        before = found[found > 0] - 1
        before = before[~small[before]]
        if len(before):
            byte = t[before]
            order = np.argsort(byte, kind="stable")
            before, byte = before[order], byte[order]
            starts = np.append(0, np.flatnonzero(byte[1:] != byte[:-1]) + 1)
            for s, part in zip(starts, np.split(before, starts[1:])):
                waiting[byte[s]].append(part)

    induce(np.array([n]))  # the end, before all others
    for c in range(256):
        for part in waiting[c]:  # grows while it is read
            out.append(part)
            induce(part)
        own = direct[edges[c]:edges[c + 1]]
        if len(own):
            out.append(own)
            induce(own)
    return np.concatenate(out)


def prefix_reaches(t: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the suffixes a[i] and b[i] have a common prefix of ``length`` bytes or more."""
    padded = np.append(t, np.zeros(length + 8, np.uint8))
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
    alive = np.arange(len(a))
    for o in [*range(0, length - 7, 8), length - 8]:
        same = (eight[a[alive] + o] == eight[b[alive] + o]).all(1)
        alive = alive[same]
    out = np.zeros(len(a), bool)
    out[alive] = True
    return out


def repeated_starts(snippets: list[bytes], length: int) -> list[np.ndarray]:
    """Per snippet, which of its strings of ``length`` bytes are found at another start of these snippets."""
    size = np.array([len(s) for s in snippets])
    t = np.frombuffer(b"".join(snippets), np.uint8) + np.uint8(1)  # 0xFF is no byte of UTF-8
    at = np.cumsum(size) - size
    own = np.ones(len(t), bool)
    for k in range(length - 1):
        own[(at + size - 1 - k)[size > k]] = False
    order = suffix_array(t, length)
    order = order[own[order]]
    same = prefix_reaches(t, order[:-1], order[1:], length)
    hit = np.zeros(len(t), bool)
    hit[order[:-1][same]] = True
    hit[order[1:][same]] = True
    return [hit[a:a + max(0, n - length + 1)] for a, n in zip(at, size)]


def _compare(batches: Iterator[pa.RecordBatch], length: int, slab: int) -> Iterator[pa.RecordBatch]:
    """Snippets sorted by anchor to the ranges of repeated starts of the ALONE ones."""
    rows, held = [], 0
    for b in batches:
        for r in zip(*(b.column(c).to_pylist() for c in ("h", "id", "key", "lo", "state", "snippet"))):
            if held > slab and rows[-1][0] != r[0]:
                yield from _slab(rows, length)
                rows, held = [], 0
            rows.append(r)
            held += len(r[5])
    if rows:
        yield from _slab(rows, length)


def _slab(rows: list[tuple], length: int) -> Iterator[pa.RecordBatch]:
    out = []
    for (_, doc, key, lo, state, _), hit in zip(rows, repeated_starts([r[5] for r in rows], length)):
        if state == ALONE and hit.any():
            edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
            out += [(doc, key, lo + int(s), int(e - s - 1)) for s, e in zip(edge[::2], edge[1::2])]
    if out:
        doc, key, lo, span = zip(*out)
        yield from _slices({"id": pa.array(doc, pa.int64()), "key": pa.array(key, pa.int64()),
                            "lo": pa.array(lo, pa.int64()), "span": pa.array(span, pa.int32())})


def _snippets(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, held = [], 0
        for k in range(b.num_rows):
            text, asked = b.column("text")[k].as_buffer(), b.column("asked")[k].as_py()
            for r in asked:
                s = text.slice(r["lo"], r["span"] + length).to_pybytes()
                rows.append((r["h"], b.column("id")[k].as_py(), b.column("key")[k].as_py(), r["lo"], r["state"], s))
                held += len(s)
            if held > 1 << 22 or k == b.num_rows - 1 and rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
                yield pa.record_batch({n: pa.array(v, t) for n, t, v in
                                       zip(("h", "id", "key", "lo", "state", "snippet"), kinds, zip(*rows))})
                rows, held = [], 0


def _starts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """A row for each start of the CROWDED ranges with the digest of its string."""
    for b in batches:
        for doc, key, lo, s in zip(*(b.column(c).to_pylist() for c in ("id", "key", "lo", "snippet"))):
            n = len(s) - length + 1
            yield pa.record_batch({"id": pa.array([doc] * n, pa.int64()), "key": pa.array([key] * n, pa.int64()),
                                   "lo": pa.array(range(lo, lo + n), pa.int64()),
                                   "d": pa.array([hashlib.blake2b(s[i:i + length], digest_size=16).digest() for i in range(n)],
                                                 pa.binary())})


def spans_of(packed: np.ndarray | None, length: int) -> np.ndarray:
    """Merged byte spans (rows: begin, end) covered by ranges of starts packed as lo << 16 | span."""
    if packed is None or not len(packed):
        return np.zeros((0, 2), np.int64)
    p = np.sort(packed)
    lo, hi = p >> 16, (p >> 16) + (p & 0xFFFF) + length
    hi = np.maximum.accumulate(hi)
    cut = np.flatnonzero(lo[1:] > hi[:-1]) + 1
    return np.stack([lo[np.append(0, cut)], hi[np.append(cut, len(lo)) - 1]], 1)


def _remove(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows, held = [], 0
        for k in range(b.num_rows):
            text = b.column("text")[k].as_buffer().to_pybytes()
            packed = b.column("ranges")[k].values
            spans = spans_of(packed.to_numpy() if packed is not None else None, length)
            edges = [0, *spans.ravel().tolist(), len(text)]
            kept = b"".join(text[a:z] for a, z in zip(edges[::2], edges[1::2]))
            rows.append((b.column("id")[k].as_py(), len(text), len(text) - len(kept), len(spans), spans.tolist(), kept))
            held += len(kept)
            if held > 1 << 22 or k == b.num_rows - 1:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int64())), pa.binary())
                yield pa.record_batch({n: pa.array(v, t) for n, t, v in
                                       zip(("doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"), kinds, zip(*rows))})
                rows, held = [], 0


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                 crowd: int = CROWD, slab: int = SLAB) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, spans (begin and end of each removed run), kept (bytes)."""
    if not 8 <= gram < length < 1 << 15:
        raise ValueError("8 <= gram < length < 32768 is needed")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(id_col, text_col).alias("key"),
                       F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    found = rows.where(F.octet_length("text") >= length).mapInArrow(
        lambda it: _anchor_rows(it, length, gram), "h long, g long, id long, key long, lo long, span int, w int")
    judged = written(found.repartition("h").sortWithinPartitions("h", "g").mapInArrow(
        lambda it: _judge(it, crowd), "h long, id long, key long, lo long, span int, state int"), "ranges")

    def with_texts(asked: DataFrame, how: str) -> DataFrame:
        # sorted and merged at every size, so that both joins use one exchange of the texts
        asked = asked.withColumnsRenamed({"id": "a_id", "key": "a_key"}).hint("merge")
        return rows.join(asked, F.col("id").eqNullSafe(F.col("a_id")) & (F.col("key") == F.col("a_key")), how)

    asked = (judged.where(F.col("state") > REPEATED).groupBy("id", "key")
             .agg(F.collect_list(F.struct("h", "lo", "span", "state")).alias("asked")))
    snippets = with_texts(asked, "inner").select("id", "key", "text", "asked").mapInArrow(
        lambda it: _snippets(it, length), "h long, id long, key long, lo long, state int, snippet binary")
    compared = (snippets.where(F.col("state") != CROWDED).repartition("h").sortWithinPartitions("h")
                .mapInArrow(lambda it: _compare(it, length, slab), "id long, key long, lo long, span int"))
    ranges = judged.where(F.col("state") == REPEATED).select("id", "key", "lo", "span").unionByName(compared)
    if not judged.where(F.col("state") == CROWDED).isEmpty():
        starts = snippets.where(F.col("state") == CROWDED).mapInArrow(
            lambda it: _starts(it, length), "id long, key long, lo long, d binary")
        often = starts.groupBy("d").count().where("count > 1").select("d")
        ranges = ranges.unionByName(starts.join(often, "d", "left_semi").select("id", "key", "lo", F.lit(0).alias("span")))
    ranges = (ranges.groupBy("id", "key").agg(F.collect_list(F.shiftleft("lo", 16) + F.col("span")).alias("ranges")))
    return with_texts(ranges, "left").select("id", "text", "ranges").mapInArrow(
        lambda it: _remove(it, length),
        "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<array<long>>, kept binary")


def suffix_dedup_digests(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return suffix_dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
