"""Importance resampling against its formula in plain Python."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, docs, in_order, lower, rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import importance as W

COLUMNS = ("doc_id", "n_features", "weight", "score", "rank", "n_words")


def runs_of(text, runs):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
    return len(w), [" ".join(w[k:k + m]) for m in range(1, runs + 1) for k in range(len(w) - m + 1)]


def brute(rows, target, runs=1, buckets=W.BUCKETS, least=20, percent=10):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (collections.Counter(bucket(f) for x in texts for f in runs_of(x, runs)[1]) for texts in ([x for _, x in rows], target))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[k] + 1) * (big_s + buckets) / ((s[k] + 1) * (big_t + buckets)))) for k in range(buckets)]
    out = []
    for i, x in rows:
        n, features = runs_of(x, runs)
        weight = sum(gain[bucket(f)] for f in features)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return in_order(map(tuple, out))


def corpus(n, seed=0):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)] + ["Straße", "日本", "A1"]
    return [(k, " ".join(rng.choices(vocab[:10 + k % 50], k=rng.randint(0, 60)))) for k in range(n)]


TARGET = ["w1 w2 w3 w1 W1", None, "日本 w59.w59", ""]


@pytest.mark.parametrize("runs, buckets", [(1, W.BUCKETS), (1, 7), (2, 100), (3, W.BUCKETS)])
def test_resample(spark, runs, buckets):
    rows = corpus(300) + [r for r in awkward() if r[0] not in (1, 7)] + [(900, "q" * 3000 + " w1" * 30)]
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = W.resample(docs(spark, rows, clashing=True), target, runs=runs, buckets=buckets)
    assert rows_of(got, *COLUMNS) == brute(rows, TARGET, runs, buckets)


def test_repeated_rows_have_ranks_of_their_own(spark):
    """Equal rows tie in score and id: each of them is drawn and ranked for itself."""
    rows = [(1, "w1 " * 25)] * 30 + [(None, "w1 " * 25)] * 5 + corpus(40, 1)
    target = spark.createDataFrame([("w1",)], "text string")
    got = rows_of(W.resample(docs(spark, rows), target, percent=60), *COLUMNS)
    want = brute(rows, ["w1"], percent=60)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, len([r for r in want if r[4]]) + 1))
    assert in_order(r[:4] + (r[4] is None,) for r in got) == in_order(r[:4] + (r[4] is None,) for r in want)


@pytest.mark.parametrize("percent", [0, 1, 50, 100])
@pytest.mark.parametrize("margin", [0.0, 0.3])
def test_bracket(spark, percent, margin):
    """A bracket that misses the cutoff is widened until exact counts say that it holds it."""
    rows = corpus(500, 2)
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    if margin or percent in (0, 1):
        got = W.resample(docs(spark, rows), target, percent=percent, margin=margin or 1e-9)
        assert rows_of(got, *COLUMNS) == brute(rows, TARGET, percent=percent)
    else:
        scores = docs(spark, rows).selectExpr("doc_id * 7 % 1000 AS score").cache()
        for wanted in (1, 250, 500):
            lo, hi, above = W.bracket(scores, 500, wanted, 1e-9)
            values = sorted((i * 7 % 1000 for i, _ in rows), reverse=True)
            assert lo <= values[wanted - 1] <= hi and above == sum(v > hi for v in values)


def test_nothing(spark):
    none = spark.createDataFrame([], "text string")
    assert rows_of(W.resample(docs(spark, []), none), *COLUMNS) == []
    rows = corpus(30, 4)
    assert rows_of(W.resample(docs(spark, rows), none), *COLUMNS) == brute(rows, [])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abZ9é日 .\x00\x7f-", max_size=90), max_size=6), st.integers(1, 3))
def test_features(texts, runs):
    n, of, bucket = W.features(pa.array(texts, pa.string()), runs, 1 << 31)
    want = [(k, zlib.crc32(f.encode()) % (1 << 31)) for k, t in enumerate(texts) for f in runs_of(t, runs)[1]]
    assert sorted(zip(of.tolist(), bucket.tolist())) == sorted(want)
    assert n.tolist() == [runs_of(t, 1)[0] for t in texts]


def test_features_of_a_slice():
    texts = pa.array(["w1 w2", "", "a" * 500 + " b", "c"], pa.string())
    whole, part = W.features(texts, 2, 997), W.features(texts.slice(2, 2), 2, 997)
    at = whole[1] >= 2
    assert np.array_equal(np.sort(whole[2][at]), np.sort(part[2])) and part[0].tolist() == [2, 1]
