"""SentencePiece encoding and decoding for merge-type vocabularies (BPE with byte fallback).

Encoding: spaces become U+2581, one more goes in front, and the text starts as one
symbol for each character.  An agenda holds the neighbouring pairs whose concatenation is a
piece, the highest score first and of equal scores the leftmost; the pair on top is merged
and the pairs that it now forms with its neighbours are put on the agenda, until it is empty.
What is no piece at the end goes out as its UTF-8 bytes.

No merge can reach across two neighbouring characters that no piece holds side by side.  Where that holds for a space after
another character, a text is cut into words, and each has an agenda of its own.  The words of a batch that
the worker does not remember are encoded together: their agendas are the rows of an array of scores, and in every
round each word takes the top of its row.  Long words, and texts of models whose pieces reach across spaces, are cut between such
characters and go through an agenda on a heap, so a very long text costs no more than its parts.

Decoding joins the pieces, U+2581 as a space without the first one; a byte that is no part of
valid UTF-8 becomes U+FFFD.

With ``check`` every Arrow batch is also encoded and decoded by the sentencepiece library, and
``agrees`` tells whether ids and text are the same.

Defined cases: null text counts as empty (begin and end ids only); rows that repeat are encoded
alike and all returned; null ids are kept; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
from array import array
from bisect import bisect_left
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
KNOWN_WORDS = 1 << 19  # words of up to KNOWN_CHARS characters whose ids a worker remembers
KNOWN_CHARS = 48
WIDTHS = (8, 16, 32, KNOWN_CHARS + 1)  # agendas of words up to so many symbols share an array
FOREIGN = 1 << 21  # symbols of characters that are no piece: this and the code point
NEVER = np.iinfo(np.int32).max  # place in the agenda of a pair that is no piece
SLICE_BYTES = 1 << 20  # text encoded at once
OUT_BYTES = 4 << 20


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = lib.get_piece_size()
        pieces = [lib.id_to_piece(i) for i in range(n)]
        self.bytes = {int(pieces[i][1:-1], 16): i for i in range(n) if lib.is_byte(i)}
        self.ids = {p: i for i, p in enumerate(pieces) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i))}
        if any(lib.is_unused(i) for i in self.ids.values()) or len(self.bytes) != 256:
            raise ValueError("the model must have byte fallback and no unused pieces")
        self.score = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.begin, self.end = lib.bos_id(), lib.eos_id()
        # what an id stands for in decoded bytes; control ids for nothing
        self.silent = {i for i in range(n) if lib.is_control(i)}
        self.surface = [b"" if i in self.silent else bytes([int(p[1:-1], 16)]) if lib.is_byte(i)
                        else " ⁇ ".encode() if lib.is_unknown(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        self.spaced = {i for p, i in self.ids.items() if p.startswith(SPACE)}
        self.beside = {two for p in self.ids for two in zip(p, p[1:])}
        # words are cut off by one pattern where no piece holds a space after another character
        self.words = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+") \
            if not any(x[0] != SPACE and x[1] == SPACE for x in self.beside) else None
        self.known: dict[str, bytes] = {}  # ids of words, their first space left out, as little-endian unsigned 32-bit integers
        self.symbol = np.arange(FOREIGN, FOREIGN + 0x110000)
        for p, i in self.ids.items():
            if len(p) == 1:
                self.symbol[ord(p)] = i
        of = lambda p: self.ids.get(p, FOREIGN + ord(p) if len(p) == 1 else None)
        pairs = sorted((a * 2 * FOREIGN + b, i) for p, i in self.ids.items() for k in range(1, len(p))
                       if (a := of(p[:k])) is not None and (b := of(p[k:])) is not None)
        self.pair = np.array([k for k, _ in pairs] + [np.iinfo(np.int64).max])  # the last one stands for no pair
        self.merged = np.array([i for _, i in pairs] + [-1])
        scores = np.array([lib.get_score(i) for i in range(n)])
        self.place = np.append(np.unique(-scores, return_inverse=True)[1][self.merged[:-1]], NEVER).astype(np.int32)

    # encoding ---------------------------------------------------------------------
    def agenda(self, text: str) -> list[str]:
        """Symbols of a text after all merges."""
        symbols, n, score = list(text), len(text), self.score
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = []
        for i in range(n - 1):
            both = symbols[i] + symbols[i + 1]
            if both in score:
                heap.append((-score[both], i, i + 1, both))
        heapq.heapify(heap)
        while heap:
            _, left, right, both = heapq.heappop(heap)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != len(both):
                continue  # one of the two has been merged since
            symbols[left], symbols[right] = both, ""
            after[left] = right = after[right]
            if right >= 0:
                before[right] = left
                new = both + symbols[right]
                if new in score:
                    heapq.heappush(heap, (-score[new], left, right, new))
            if (prior := before[left]) >= 0:
                new = symbols[prior] + both
                if new in score:
                    heapq.heappush(heap, (-score[new], prior, left, new))
        return [s for s in symbols if s]

    def part(self, text: str) -> list[int]:
        """Ids of a text, cut between characters that no piece holds side by side."""
        cuts = [k for k, two in enumerate(zip(text, text[1:]), 1) if two not in self.beside]
        out = []
        for lo, hi in zip([0, *cuts], [*cuts, len(text)]):
            for s in self.agenda(text[lo:hi]):
                i = self.ids.get(s)
                if i is not None:
                    out.append(i)
                else:
                    out += [self.bytes[b] for b in s.encode()]
        return out

    def agendas(self, words: list[str], width: int) -> list[bytes]:
        """Packed ids of words of at most ``width`` characters: the agendas side by side, one pair of each word a round."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        chars = self.symbol[np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4")]
        at = np.arange(width)
        done = np.full((len(words), width + 1), -1)  # symbols; -1 behind the last one
        done[:, :width][at < sizes[:, None]] = chars
        rows, s = np.arange(len(words)), done.copy()
        x = np.full(s.shape, len(self.merged) - 1)  # pair of each symbol with the next
        r, c = np.nonzero(s[:, 1:] >= 0)
        x[r, c] = self.look_up(s[r, c], s[r, c + 1])
        while len(rows):
            top = self.place[x]
            k = top.argmin(1)  # of equal scores the leftmost
            all_rows = np.arange(len(rows))
            live = top[all_rows, k] < NEVER
            if not live.all():
                done[rows[~live]] = s[~live]
                rows, s, x, k = rows[live], s[live], x[live], k[live]
                all_rows = all_rows[:len(rows)]
            if not len(rows):
                break
            s[all_rows, k] = self.merged[x[all_rows, k]]
            behind = at >= k[:, None] + 1
            s[:, :-1][behind], x[:, :-1][behind] = s[:, 1:][behind], x[:, 1:][behind]
            x[all_rows, k] = self.look_up(s[all_rows, k], s[all_rows, k + 1])
            left = np.flatnonzero(k)
            x[left, k[left] - 1] = self.look_up(s[left, k[left] - 1], s[left, k[left]])
        r, c = np.nonzero(done >= 0)
        ids = done[r, c]
        foreign = np.flatnonzero(ids >= FOREIGN)
        if len(foreign):  # their bytes instead
            found = [[self.bytes[b] for b in chr(i - FOREIGN).encode("utf-8", "surrogatepass")] for i in ids[foreign].tolist()]
            n = np.ones(len(ids), np.int64)
            n[foreign] = [len(f) for f in found]
            first, ids, r = np.cumsum(n) - n, np.repeat(ids, n), np.repeat(r, n)
            for f, at_ in zip(found, first[foreign].tolist()):
                ids[at_:at_ + len(f)] = f
        raw = ids.astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(r, minlength=len(words)))).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def look_up(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Places of pairs of symbols in the table of pairs, the last place if there is none."""
        key = a * (2 * FOREIGN) + b
        k = np.searchsorted(self.pair, key)
        return np.where((self.pair[k] == key) & (b >= 0), k, len(self.pair) - 1)

    def split(self, text: str) -> list[str]:
        """Words of a text without the space in front of each (the first one's is added)."""
        if "  " in text or SPACE in text or text[:1] == " " or text[-1:] == " ":
            return [w[1:] for w in self.words.findall(SPACE + text.replace(" ", SPACE))]
        return text.split(" ")

    def learn(self, words: list[str]) -> None:
        """Encode words, those of similar length together."""
        words.sort(key=len)
        sizes = list(map(len, words))
        lo = 0
        for width in WIDTHS:
            hi = bisect_left(sizes, width)
            for k in range(lo, hi, 1 << 15):
                part = words[k:min(hi, k + (1 << 15))]
                self.known.update(zip(part, self.agendas([SPACE + w for w in part], width)))
            lo = hi
        self.known.update((w, packed(self.part(SPACE + w))) for w in words[lo:])

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Packed ids of texts with begin and end."""
        begin, end = packed([self.begin]), packed([self.end])
        if self.words is None:
            return [begin + (packed(self.part(SPACE + t.replace(" ", SPACE))) if t else b"") + end for t in texts]
        split = [self.split(t) if t else [] for t in texts]
        needed = set(chain.from_iterable(split))
        unknown = needed.difference(self.known)
        if len(self.known) + len(unknown) > KNOWN_WORDS:
            self.known.clear()
            unknown = needed
        unknown = list(unknown)
        self.learn(unknown)
        look = self.known.__getitem__
        out = [b"".join([begin, *map(look, words), end]) for words in split]
        for w in reversed(unknown):  # sorted by length: long words are not remembered
            if len(w) <= KNOWN_CHARS:
                break
            del self.known[w]
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a text with begin and end."""
        return np.frombuffer(self.encode_batch([text])[0], "<u4").tolist()

    # decoding ---------------------------------------------------------------------
    def decode(self, ids: list[int]) -> str:
        first = next((i for i in ids if i not in self.silent), None)
        raw = [b"".join(map(self.surface.__getitem__, run)) for run in self.runs(ids)]
        if first in self.spaced:
            raw[0] = raw[0][1:]
        return "".join(map(_utf8, raw))

    def runs(self, ids: list[int]) -> list[list[int]]:
        """The ids between control ids, which part the bytes of a character."""
        inner = ids[ids[:1] == [self.begin]:len(ids) - (ids[-1:] == [self.end])]
        if self.silent.isdisjoint(inner):
            return [inner]
        at = [k for k, i in enumerate(inner) if i in self.silent]
        return [run for lo, hi in zip([-1, *at], [*at, len(inner)]) if (run := inner[lo + 1:hi])] or [[]]


def _utf8(raw: bytes) -> str:
    """UTF-8 decoded, with one U+FFFD for each byte that is no part of a valid character."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[at:at + e.start].decode() + "�")
            at += e.start + 1
    return "".join(out)


def packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _rows(rows: list[tuple], check: bool) -> pa.RecordBatch:
    kinds = {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids": pa.binary(), "decoded": pa.string(), "agrees": pa.bool_()}
    return pa.record_batch({c: pa.array(v, kinds[c]) for c, v in zip(kinds, zip(*rows)) if check or c != "agrees"})


def _run(batches: Iterator[pa.RecordBatch], path: str, check: bool) -> Iterator[pa.RecordBatch]:
    p, rows, held = pieces(path), [], 0
    for b in batches:
        sizes = np.maximum(b.column("size").to_numpy(), 1)
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE_BYTES, prepend=-1)).tolist() + [b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            texts = b.column("text").slice(lo, hi - lo).to_pylist()
            ids = p.encode_batch(texts)
            decoded = [p.decode(array("I", i).tolist()) for i in ids]
            agrees = [None] * len(texts)
            if check:
                theirs = p.library.encode(texts, add_bos=True, add_eos=True, num_threads=1)
                agrees = [x == packed(y) and d == e for x, y, d, e in zip(ids, theirs, decoded, p.library.decode(theirs, num_threads=1))]
            for doc, i, d, a in zip(b.column("id").slice(lo, hi - lo).to_pylist(), ids, decoded, agrees):
                rows.append((doc, len(i) // 4, i, d, a))
                held += len(i) + len(d)
                if held > OUT_BYTES:
                    yield _rows(rows, check)
                    rows, held = [], 0
    if rows:
        yield _rows(rows, check)


def piece_encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (little-endian unsigned 32-bit integers), decoded text, and with ``check`` agrees.

    ``path`` is the model file, readable on every executor.  No shuffle; a text is encoded in the task that reads it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.octet_length(text).alias("size"))
    return base.mapInArrow(lambda it: _run(it, path, check),
                           "doc_id long, n_tokens long, ids binary, decoded string" + (", agrees boolean" if check else ""))


def piece_digests(docs: DataFrame, path: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256, agrees."""
    return piece_encode_decode(docs, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "agrees")
