"""Exact, line, suffix-array and n-gram Jaccard dedup against plain Python."""

import random

import numpy as np
import pytest
from helpers import (CLASHING, awkward, brute_components, brute_lines, brute_removed, docs, in_order, rows_of, sha)
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import components, rolling
from tessera.llm import exact_dedup as E
from tessera.llm import jaccard_join as J
from tessera.llm import line_dedup as L
from tessera.llm import suffix_dedup as S

WORDS = "the quick brown é 日本 fox \n x".split(" ")


def noisy(seed, n=60):
    """Texts with copies, near copies, shared passages and periodic ones."""
    rng = random.Random(seed)
    texts = [" ".join(rng.choices(WORDS + list("abcdefg"), k=rng.randint(0, 60))) for _ in range(n)]
    texts += texts[:10]
    for t in texts[10:30]:
        w = t.split(" ")
        w[rng.randrange(len(w))] = "Zz"
        texts.append(" ".join(w))
    passage = "this passage is in many of the documents of this table"
    texts += [passage + " " + " ".join(rng.choices(WORDS, k=20)) for _ in range(20)]
    return texts + ["a" * 300, "ab" * 200, "\0" * 100, "a b", "A b"]


# exact ------------------------------------------------------------------------

def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out, done = [], set()
    for i, t in rows:
        ids = groups[t or ""]
        owner = max(ids, key=lambda x: (x is not None, x or 0))
        first = i == owner and (t or "") not in done
        if first:
            done.add(t or "")
        out.append((i, owner, len(ids), first, sha(t or "")))
    return in_order(out)


@pytest.mark.parametrize("memory", [1, 3000, E.TRIE_MEMORY])
def test_exact_dedup(spark, memory):
    rows = awkward() + list(enumerate(noisy(1), 100))
    got = E.exact_dedup(docs(spark, rows, clashing=True), memory_bytes=memory)
    assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(rows)


def test_exact_dedup_empty(spark):
    assert E.exact_dedup(docs(spark, [])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=6), st.one_of(st.none(), st.integers(0, 9))), max_size=30), st.integers(0, 2000))
def test_radix_trie(entries, memory):
    trie, want = E.RadixTrie("max", memory), {}
    for key, owner in entries:
        trie.insert(key, owner, 1)
        old = want.get(key, (None, 0))
        want[key] = (max(old[0], owner, key=lambda x: (x is not None, x or 0)), old[1] + 1)
    assert dict(trie.items()) == want


# lines ------------------------------------------------------------------------

@pytest.mark.parametrize("min_docs", [2, 4])
def test_line_dedup(spark, min_docs):
    rng = random.Random(min_docs)
    rows = awkward() + [(50 + k, "\n".join(rng.choices(["Head ", "head", "x\t", "", " ", "ÉÀ", "éà", "tail", str(k)], k=rng.randint(1, 9))))
                        for k in range(40)]
    want = brute_lines(rows, min_docs)
    table = docs(spark, rows, clashing=True)
    got = L.line_dedup_report(table, min_docs=min_docs)
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == in_order((i, n, d, sha(t)) for i, n, d, t in want)
    kept = L.line_dedup(table, min_docs=min_docs)
    assert kept.schema == table.schema
    assert rows_of(kept, "doc_id", "text", "n_chars") == in_order(
        (i, None, None) if old is None and not d else (i, t, len(t)) for (_, old), (i, n, d, t) in zip(rows, want))


def test_line_dedup_empty(spark):
    assert L.line_dedup(docs(spark, [])).count() == L.line_dedup_report(docs(spark, [])).count() == 0


# suffix arrays -----------------------------------------------------------------

@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_array(values):
    t = np.array(values, np.uint8)
    assert S.suffix_array(t, 80).tolist() == sorted(range(len(t)), key=lambda i: t[i:].tobytes())


@pytest.mark.parametrize("length,gram,crowd", [(40, 16, 1000), (40, 16, 1), (24, 8, 2), (60, 40, 3)])
def test_suffix_dedup(spark, length, gram, crowd):
    rows = list(enumerate(noisy(3))) + [(None, noisy(3)[3]), (5, noisy(3)[5]), (None, None), (9, "")]
    got = S.suffix_dedup(docs(spark, rows, clashing=True), length=length, gram=gram, crowd=crowd, slab=2000)
    want = brute_removed([(t or "").encode() for _, t in rows], length)
    assert in_order((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()) \
        == in_order((i, *w) for (i, _), w in zip(rows, want))
    for r in got.collect():
        assert sum(b - a for a, b in r.spans) == r.n_removed and len(r.spans) == r.n_spans


def test_suffix_dedup_parts(spark, monkeypatch):
    """Long texts are handled in parts; repeats across their borders are found."""
    rng = random.Random(8)
    part = "".join(rng.choices("abcdef ", k=3000))
    texts = ["".join(rng.choices("ghijk", k=700)) + part, part + "".join(rng.choices("lmnop", k=500))]
    monkeypatch.setattr(S, "PART", 257)
    hashes = S.Hashes(257 + 41)
    owned = [[(lo, hi) for *_, l, h in S.anchors(t.encode(), hashes, 40, 16) for lo, hi in zip(l, h)] for t in texts]
    for t, ranges in zip(texts, owned):  # every start belongs to exactly one anchor
        assert sorted(s for lo, hi in ranges for s in range(lo, hi + 1)) == list(range(len(t) - 39))


def test_suffix_dedup_copies_in_a_crowd(spark):
    """Copies within one batch whose anchor has so many rows that it is streamed."""
    rng = random.Random(9)
    passage = "".join(rng.choices("abcdefgh ", k=300))
    texts = ["".join(rng.choices("stuvwxyz", k=8)) + passage for _ in range(60)]
    rows = list(enumerate([t for t in texts[:5] for _ in range(2)] + texts[5:]))
    most = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(most)
    spark.conf.set(most, "20")
    try:
        table = docs(spark, rows).coalesce(1).sortWithinPartitions("doc_id")
        got = rows_of(S.suffix_dedup(table, length=80, gram=16, crowd=1), "doc_id", "n_bytes", "n_removed", "n_spans", "kept")
    finally:
        spark.conf.set(most, before)
    assert got == in_order((i, *b) for (i, _), b in zip(rows, brute_removed([t.encode() for _, t in rows], 80)))


def test_suffix_dedup_empty(spark):
    assert S.suffix_dedup_digests(docs(spark, [])).count() == 0


# n-gram Jaccard ----------------------------------------------------------------

@pytest.mark.parametrize("share,block", [(10, 2048), (0, 3), (75, 4)])
def test_jaccard_components(spark, share, block):
    rows = awkward() + list(enumerate(noisy(4), 100))
    table = docs(spark, rows, clashing=True)
    want, group = brute_components(rows)
    got = J.jaccard_report(table, share=share, block_sets=block)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == in_order(want)
    kept = J.jaccard_dedup(table, share=share, block_sets=block)
    assert kept.schema == table.schema
    stay = {}
    for (i, t), (_, n, _), g in zip(rows, want, group):
        if n:
            stay.setdefault(g, []).append((i is None, i or 0))
    ids = [i for (i, _), (_, n, _) in zip(rows, want) if not n] + [None if min(x)[0] else min(x)[1] for x in stay.values()]
    assert in_order((r.doc_id,) for r in kept.collect()) == in_order((i,) for i in ids)


def test_near_copies_meet_pivots_only(spark, monkeypatch):
    """A group of near copies many blocks large is connected by its pivots: no set is left to meet the others."""
    rng, left = random.Random(5), []
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(150):
        w = list(base)
        w[rng.randrange(120)] = f"x{k}"
        rows.append((k, " ".join(w)))
    real = J._with_rest

    def spy(*a):
        out = real(*a)
        left.append(out.count())
        return out
    monkeypatch.setattr(J, "_with_rest", spy)
    got = rows_of(J.jaccard_report(docs(spark, rows), block_sets=10), "doc_id", "component_id")
    assert got == [(k, 0) for k in range(150)] and left == [0]


def test_jaccard_empty(spark):
    assert J.jaccard_report(docs(spark, [])).count() == J.jaccard_dedup(docs(spark, [])).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.frozensets(st.integers(0, 15), min_size=1, max_size=12), min_size=1, max_size=25), st.integers(0, 25))
def test_trie_links(sets, split):
    """Links of the trie join the same sets as all pairs do."""
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    left, right = arrays[:split], arrays[split:]

    def classes(edges, n):
        up = list(range(n))

        def top(x):
            while up[x] != x:
                x = up[x]
            return x
        for a, b in edges:
            up[top(a)] = top(b)
        names = [top(x) for x in range(n)]
        return [names.index(x) for x in names]

    near = [(a, b) for a in range(len(sets)) for b in range(a)
            if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert classes(J.links(arrays, None), len(sets)) == classes(near, len(sets))
    if left and right:
        cross = [(a, b) for a, b in near if (a < split) != (b < split)]
        assert classes(J.links(left, right), len(sets)) == classes(cross, len(sets))


def test_extra_columns_clash():
    assert {"id", "key", "row"} <= set(CLASHING)


def thue_morse(n, swap):
    return bytes(b"ab"[(bin(i).count("1") & 1) ^ swap] for i in range(n)).decode()


@pytest.mark.parametrize("size", [16, 64, 65, 512, 2048, 4096])
def test_structured_words_are_told_apart(spark, size):
    """Two words that any polynomial hash modulo 2^64 takes for equal: the documents do not link."""
    rows = [(i, f"one two {thue_morse(size, i)} four five") for i in (0, 1)] + [(2, f"one two {thue_morse(size, 1)} four five")]
    got = J.jaccard_report(docs(spark, rows))
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == [(0, 1, 0), (1, 1, 1), (2, 1, 1)]


def test_mixed_hashes_read_every_byte():
    """Words that differ in one byte, in their length or by zero bytes at their end have hashes of their own."""
    words = [b"", b"a", b"a\0", b"a\0\0", b"\0", b"\0\0", *(b"x" * n for n in range(1, 140)),
             *(b"x" * n + b"y" + b"x" * (99 - n) for n in range(100)), *(b"x" * n + b"y" + b"x" * (30 - n) for n in range(31))]
    ends = np.cumsum([len(w) for w in words])
    t = np.frombuffer(b"".join(words), np.uint8)
    h = rolling.mixed(t, ends - [len(w) for w in words], ends)
    assert len(set(h.tolist())) == len(set(words))
    alone = [rolling.mixed(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words]
    assert h.tolist() == alone


@pytest.mark.parametrize("hot", [(64, 1024), (1, 1 << 40)])
def test_components_with_hot_keys(spark, monkeypatch, hot):
    """Stars, chains and single edges, with every key hot and with the bounds of production."""
    monkeypatch.setattr(components, "HOT_ROWS", hot[0])
    monkeypatch.setattr(components, "HOT_PART", hot[1])
    edges = [(5, k) for k in range(1000, 1300)] + [(k, k + 1) for k in range(2000, 2040)] + [(7, 3), (3, 9), (9, 7)] + [(1100, 2005)]
    got = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    assert got == {x: top(x) for x in list(up)}
