"""Byte-level BPE encoding and decoding; long texts by tree concatenation.

A text over ``LONG_BYTES`` is cut into leaves by halving.  The leaves are rows
of their own, encoded in parallel by whichever tasks they are dealt to, and
come back by document.  Neighbouring halves are then joined bottom up: around
each cut a window is scanned and encoded again, and it grows until both sides
agree exactly:

* word level: to the left the window starts at a word boundary that the cut
  cannot influence; it is scanned to the right until a boundary of the right
  half is met.  A match of the word pattern depends only on what follows its start, so
  from there on both scans are the same;
* inside one word that spans the cut (long text without any break): windows of
  k tokens on either side are merged again and k doubles until the outermost
  tokens on both sides come out unchanged.  A token sequence is the BPE encoding
  exactly if every neighbouring pair is its own encoding, so the rest holds.

Other texts are encoded whole in the task that reads them.  The vocabulary and
its merge order come from the tokenizer file; special tokens of the file are
matched in the text as its library does.

Defined cases: null text counts as empty (no tokens, empty text); rows that repeat
are encoded alike and all returned; null ids are kept; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed value: the word pattern of byte-level BPE with use_regex
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_BYTES = 1 << 16
LEAF_BYTES = 1 << 14
PIECE_BYTES = 1 << 12  # words above this are encoded by halving too
MARGIN = 12  # bytes: no match looks further than three characters past what it has matched
OUT_BYTES = 4 << 20


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary: itself, or the next from U+0100 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        chars = byte_characters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = spec["model"]["vocab"]
        ranks = {bytes(chars[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        self.tokens = [b""] * (max([*ranks.values(), *self.special.values()]) + 1)
        for t, i in ranks.items():
            self.tokens[i] = t
        for t, i in self.special.items():
            self.tokens[i] = t.encode()
        self.size = np.array([len(t) for t in self.tokens], np.int64)
        self.bpe = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(PATTERN)
        self.splitter = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") \
            if self.special else None

    def segments(self, text: str) -> list[str]:
        """Text between special tokens and the special tokens, in turn."""
        return self.splitter.split(text) if self.splitter else [text]

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for s in self.segments(text):
            if s in self.special:
                ids.append(self.special[s])
            else:
                ids += self.bpe.encode_ordinary(s)
        return ids

    def decode(self, ids) -> str:
        return b"".join(map(self.tokens.__getitem__, ids)).decode("utf-8", "replace")

    # one word -----------------------------------------------------------------
    def piece(self, word: bytes) -> np.ndarray:
        """Tokens of one word, by halving where it is long."""
        if len(word) <= PIECE_BYTES:
            return np.array(self.bpe._encode_single_piece(word), np.int64)
        mid = len(word) // 2
        return self.join_piece(self.piece(word[:mid]), self.piece(word[mid:]))

    def join_piece(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Tokens of one word from those of its halves."""
        k = 8
        while True:
            left, right = a[max(0, len(a) - k):], b[:k]
            whole = b"".join(self.tokens[i] for i in [*left, *right])
            mid = np.array(self.bpe._encode_single_piece(whole), np.int64)
            at_start, at_end = k >= len(a), k >= len(b)
            if len(mid) > 1 and (at_start or mid[0] == left[0]) and (at_end or mid[-1] == right[-1]) or at_start and at_end:
                return np.concatenate([a[:len(a) - len(left)], mid, b[len(right):]])
            k *= 2

    # a leaf and the tree --------------------------------------------------------
    def leaf(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, ends of words in bytes) of a text taken alone."""
        found = [len(m.encode()) for m in self.pattern.findall(text.decode())]
        if max(found, default=0) > PIECE_BYTES:
            ids, at = [], 0
            for n in found:
                ids.append(self.piece(text[at:at + n]))
                at += n
            return np.concatenate(ids), np.cumsum(found)
        return np.array(self.bpe.encode_ordinary(text.decode()), np.int64), np.cumsum(np.array(found, np.int64))

    def join(self, a: tuple, b: tuple) -> tuple:
        """(text, tokens, word ends) of two halves put together."""
        (ta, ia, wa), (tb, ib, wb) = a, b
        if not ta or not tb:
            return b if not ta else a
        cut, text = len(ta), ta + tb
        safe = wa[:np.searchsorted(wa, cut - MARGIN, "right")]
        start = int(safe[-1]) if len(safe) else 0
        ends_b = set(wb.tolist())
        reach = 64
        while True:
            stop = min(len(text), cut + reach)
            while stop < len(text) and text[stop] & 0xC0 == 0x80:
                stop += 1
            at, ends, met = start, [], None
            for m in self.pattern.finditer(text[start:stop].decode()):
                at += len(m[0].encode())
                if stop < len(text) and at > stop - MARGIN:
                    break
                ends.append(at)
                if at >= cut and (at - cut in ends_b or at == cut):
                    met = at
                    break
            if met is not None:
                break
            reach *= 2
        mids, at = [], start
        cum_a, cum_b = np.cumsum(self.size[ia]), np.cumsum(self.size[ib])
        index = lambda cum, n: int(np.searchsorted(cum, n, "right")) if n else 0  # noqa: E731  tokens that end at byte n
        for e in ends:
            if at < cut < e and e - at > PIECE_BYTES and (at == 0 or at in wa) and len(wa) and wa[-1] == cut \
                    and (len(wa) == 1 or wa[-2] == at or at == 0 and len(wa) == 1) and e - cut in ends_b and wb[0] == e - cut:
                mids.append(self.join_piece(ia[index(cum_a, at):], ib[:index(cum_b, e - cut)]))
            else:
                mids.append(self.piece(text[at:e]))
            at = e
        ids = np.concatenate([ia[:index(cum_a, start)], *mids, ib[index(cum_b, met - cut):]])
        return text, ids, np.concatenate([safe, np.array(ends, np.int64), wb[wb > met - cut] + cut])

    def tree(self, leaves: list[tuple]) -> tuple:
        """Neighbours joined in pairs, level by level."""
        while len(leaves) > 1:
            pairs = [self.join(*leaves[i:i + 2]) if i + 1 < len(leaves) else leaves[i] for i in range(0, len(leaves), 2)]
            leaves = pairs
        return leaves[0]


@cache
def codec(path: str) -> Codec:
    return Codec(path)


def halves(text: bytes, size: int) -> list[bytes]:
    """Leaves of at most ``size`` bytes (or one character), cut at the middle again and again."""
    if len(text) <= size:
        return [text]
    mid = len(text) // 2
    while mid < len(text) and text[mid] & 0xC0 == 0x80:
        mid += 1
    if mid == len(text):
        return [text]
    return halves(text[:mid], size) + halves(text[mid:], size)


def packed(ids) -> bytes:
    return np.asarray(ids, "<u4").tobytes()


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    doc, n, ids, decoded = zip(*rows)
    return pa.record_batch({"doc_id": pa.array(doc, pa.int64()), "n_tokens": pa.array(n, pa.int64()),
                            "ids": pa.array(ids, pa.binary()), "decoded": pa.array(decoded, pa.string())})


def _encode_whole(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    c, rows, held = codec(path), [], 0
    for b in batches:
        for doc, text in zip(b.column("id").to_pylist(), b.column("text")):
            ids = c.encode(text.as_py())
            rows.append((doc, len(ids), packed(ids), c.decode(ids)))
            held += 5 * len(ids)
            if held > OUT_BYTES:
                yield _rows(rows)
                rows, held = [], 0
    if rows:
        yield _rows(rows)


LEAF = "id long, key long, seg int, leaf int, special long, text binary, ids binary, ends binary"


def _cut(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """A row for each leaf of each long text, not yet encoded."""
    c = codec(path)
    for b in batches:
        for doc, key, text in zip(b.column("id").to_pylist(), b.column("key").to_pylist(), b.column("text")):
            rows = []
            for s, segment in enumerate(c.segments(text.as_py())):
                if segment in c.special:
                    rows.append((doc, key, s, 0, c.special[segment], b""))
                else:
                    rows += [(doc, key, s, k, None, t) for k, t in enumerate(halves(segment.encode(), LEAF_BYTES))]
            for i in range(0, len(rows), 256):
                yield _leaves([(*r, b"", b"") for r in rows[i:i + 256]])


def _leaves(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    names = ("id", "key", "seg", "leaf", "special", "text", "ids", "ends")
    return pa.record_batch({n: pa.array(v, t) for n, t, v in zip(names, kinds, zip(*rows))})


def _encode_leaves(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    c = codec(path)
    for b in batches:
        for part in (b.slice(i, 256) for i in range(0, b.num_rows, 256)):
            rows = []
            for r in part.to_pylist():
                ids, ends = c.leaf(r["text"]) if r["special"] is None else ([r["special"]], [])
                rows.append((r["id"], r["key"], r["seg"], r["leaf"], r["special"], r["text"], packed(ids),
                             np.asarray(ends, np.int64).tobytes()))
            yield _leaves(rows)


def _assemble(group: pa.Table, path: str) -> pa.Table:
    """One long text from its leaves; a row for each time the document was listed."""
    c, segments, copies = codec(path), {}, 0
    for r in group.to_pylist():
        copies += r["seg"] == 0 and r["leaf"] == 0
        segments.setdefault(r["seg"], {})[r["leaf"]] = r
    out = []
    for s in sorted(segments):
        leaves = [segments[s][k] for k in sorted(segments[s])]
        if leaves[0]["special"] is not None:
            out.append(np.array([leaves[0]["special"]], np.int64))
        else:
            out.append(c.tree([(r["text"], np.frombuffer(r["ids"], "<u4").astype(np.int64),
                                np.frombuffer(r["ends"], np.int64)) for r in leaves])[1])
    ids = np.concatenate(out)
    doc = group.column("id")[0].as_py()
    return pa.Table.from_batches([_rows([(doc, len(ids), packed(ids), c.decode(ids.tolist()))] * copies)])


def bpe_encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                      long_bytes: int = LONG_BYTES) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded text.

    ``path`` is the tokenizer file, readable on every executor.  A long
    document is assembled in one task, which holds what one row holds anyway.
    """
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = "doc_id long, n_tokens long, ids binary, decoded string"
    short = base.where(F.octet_length("text") <= long_bytes).mapInArrow(lambda it: _encode_whole(it, path), schema)
    cut = (base.where(F.octet_length("text") > long_bytes).withColumn("key", F.xxhash64("text"))
           .mapInArrow(lambda it: _cut(it, path), LEAF))
    leaves = cut.repartition("id", "key", "seg", "leaf").mapInArrow(lambda it: _encode_leaves(it, path), LEAF)
    long = leaves.groupBy("id", "key").applyInArrow(lambda g: _assemble(g, path), schema)
    return short.unionAll(long)


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe_encode_decode(docs, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
