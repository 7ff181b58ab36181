"""BPE, language ID, licences, mixing, quality rules and toxicity."""

import math
import os
import random
from fractions import Fraction

import duckdb
import numpy as np
import public_tokenizers
import pytest
from helpers import awkward, brute_base, docs, in_order, rows_of, sha, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import bpe as B
from tessera.llm import language_id as I
from tessera.llm import licenses as C
from tessera.llm import mixing as M
from tessera.llm import quality_rules as Q
from tessera.llm import queries
from tessera.llm import toxicity as T

PATH = public_tokenizers.path("byte_bpe_50k.json")
LABELS = "doc_id long, quality int, toxic int"


# BPE ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("long_bytes", [20, B.LONG_BYTES])
def test_bpe(spark, tokenizer, long_bytes):
    rows = awkward()
    got = B.bpe_encode_decode(docs(spark, rows, clashing=True), PATH, long_bytes=long_bytes)
    want = []
    for i, t in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), B.packed(ids), tokenizer.decode(ids, skip_special_tokens=False)))
    assert in_order((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded) for r in got.collect()) == in_order(want)


PARTS = st.sampled_from(["a", "b", "the", "ing", " ", "  ", "\n", "'s", "'", "re", "1", "23", "é", "ü", "日本", "😀", "$$", "...", "\t",
                         "\r\n", "'ll", " 'd", "aaaa", "<|endoftext|>", "<|endof", "<|", " ", "　"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PARTS, max_size=60), st.sampled_from([1, 3, 7, 20]))
def test_tree_concatenation(parts, leaf):
    text, codec = "".join(parts), B.codec(PATH)
    want = Tokenizer.from_file(PATH) if not hasattr(test_tree_concatenation, "t") else test_tree_concatenation.t
    test_tree_concatenation.t = want
    ids = []
    for s in codec.segments(text):
        ids += [codec.special[s]] if s in codec.special else codec.tree([(x, *codec.leaf(x)) for x in B.halves(s.encode(), leaf)])[1].tolist()
    assert ids == want.encode(text, add_special_tokens=False).ids


def test_one_long_word(tokenizer, monkeypatch):
    monkeypatch.setattr(B, "PIECE_BYTES", 16)
    rng = random.Random(2)
    for k in (50, 500, 5000):
        word = "".join(rng.choices(["a", "b", "th", "e", "in", "g", "é", "日"], k=k))
        leaves = B.halves(word.encode(), 64)
        assert B.codec(PATH).tree([(x, *B.codec(PATH).leaf(x)) for x in leaves])[1].tolist() \
            == tokenizer.encode(word, add_special_tokens=False).ids


def test_bpe_empty(spark):
    assert B.bpe_digests(docs(spark, []), PATH).count() == 0


# language ID ---------------------------------------------------------------------

def test_language_id_held_out(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = I.language_id(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 150 and (got.lang == got.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_id_cases(spark):
    rows = [(k, ("the cat and the dog", "der Hund und die Katze", "123 456 !?", None, "", "²³")[k % 6]) for k in range(120)]
    table = docs(spark, rows).withColumn("lang", F.when(F.col("text").contains("cat"), "en").when(F.col("text").contains("Hund"), "de"))
    got = {r.doc_id: r for r in I.language_id(table.unionAll(table.limit(3))).collect()}
    for i, t in rows:
        want = "en" if t and "cat" in t else "de" if t and "Hund" in t else "und"
        assert got[i].lang_pred == want and 0 <= got[i].score <= 1
    nothing = I.language_id(table.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}
    assert I.language_id(docs(spark, [])).count() == 0
    assert I.language_id(docs(spark, awkward(), clashing=True)).count() == len(awkward())


def test_word_first_backoff():
    m = I.Model([("a", 0, "hello", 9), ("b", 0, "welt", 9), ("a", 2, "he", 5), ("b", 2, "we", 5), ("b", 1, "z", 3), ("a", 1, "q", 3)])
    assert m.word("hello")[0] > m.word("hello")[1]
    assert m.word("weg").argmax() == 1 and m.word("zzz").argmax() == 1 and m.word("qqq").argmax() == 0
    assert (m.word("日本") == 0).all()


# licences --------------------------------------------------------------------------

def test_license_texts(spark):
    mit = C.KNOWN["MIT"][0]
    rows = [(1, mit), (2, "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace("\n", "\r\n  ")), (3, mit + " More."),
            (4, C.KNOWN["Zlib"][1].replace("acknowledgment", "acknowledgement")), (5, "text\n All rights reserved. \nmore"),
            (6, "© 2020"), (7, "Licenced under the Apache Licence, version 2.0\nall rights reserved")]
    rows += [(20 + k, t) for k, t in enumerate((None, "", " \n"))] + [(None, mit)]
    got = {r.doc_id: r for r in C.license_scan(docs(spark, rows, clashing=True)).collect()}
    assert [got[k].license for k in range(1, 8)] == ["MIT", "MIT", None, "Zlib", None, None, None]
    assert got[None].license == "MIT" and not any(got[20 + k].license or got[20 + k].notices for k in range(3))
    assert got[5].notices == "all-rights-reserved" and got[6].notices == ""
    assert got[7].notices == "Apache-2.0,all-rights-reserved"
    assert C.license_scan(docs(spark, [])).count() == 0


def test_notices_in_any_spelling_of_a_line(spark):
    lines = ["All  rights reserved.", "All rights\treserved", "all\u00a0rights reserved", "ALL RIGHTS-RESERVED", "all rights reserved"]
    rows = [(k, f"text\r\n{x}\r\n\nmore") for k, x in enumerate(lines)]
    assert {r.notices for r in C.license_scan(docs(spark, rows)).collect()} == {"all-rights-reserved"}
    own = {"own": ("Do not copy!",), "blank": ("(c) 2020",)}
    rows = [(1, "a\nDO NOT  COPY\n\nb"), (2, "do not\ncopy"), (3, "all rights reserved\n")]
    assert rows_of(C.license_scan(docs(spark, rows), notices=own), "doc_id", "notices") == [(1, "own"), (2, ""), (3, "")]


def test_long_licences_by_their_digests(spark):
    """Whole texts of long licences, respelled, re-wrapped and under other copyright lines; a part of one is none."""
    folder = "/usr/share/common-licenses"
    names = {"GPL-3.0": "GPL-3", "Apache-2.0": "Apache-2.0", "MPL-2.0": "MPL-2.0", "LGPL-2.1": "LGPL-2.1", "CC0-1.0": "CC0-1.0"}
    if not all(os.path.exists(f"{folder}/{f}") for f in names.values()):
        pytest.skip("the licence texts are not on this machine")
    rows, want = [], []
    for k, (name, f) in enumerate(names.items()):
        with open(f"{folder}/{f}", encoding="utf-8") as h:
            text = h.read()
        other = "(C) 2031 Somebody\n" + text.upper().replace(" LICENSE", "\tLICENCE").replace(".", " . ")
        rows += [(3 * k, text), (3 * k + 1, other), (3 * k + 2, text[:len(text) // 2])]
        want += [(3 * k, name), (3 * k + 1, name), (3 * k + 2, None)]
    assert rows_of(C.license_scan(docs(spark, rows)), "doc_id", "license") == in_order(want)


# mixing ----------------------------------------------------------------------------

def test_exponent():
    tokens = [1000, 100, 100, 10]
    a = M.solve_exponent(tokens, 0.9, 100.0)
    assert abs(M.entropy_share(M.weights(tokens, a)) - 0.9) < 1e-6
    b = M.solve_exponent(tokens, 1.0, 3.0)
    assert abs(max(M.passes(tokens, M.weights(tokens, b), None)) - 3.0) < 1e-6
    assert M.solve_exponent([5, 5], 0.9, 2.0) == 1.0 and M.weights([4, 0], 0.5) == [1.0, 0.0]


def test_mixing(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choices("abcdef", k=rng.randint(1, 40)))) for k in range(3000)]
    table = docs(spark, rows).withColumn("source", F.when(F.col("doc_id") % 10 < 7, "big").when(F.col("doc_id") % 10 < 9, "mid"))
    got = M.mix_report(table, block_tokens=8000).toPandas()
    tokens = {i: len(words(t)) for i, t in rows}
    assert (got.n_tokens == got.doc_id.map(tokens)).all()
    got["source"] = got.source.fillna("none")
    share = got.groupby("source").n_tokens.sum() / got.n_tokens.sum()
    weight = got.groupby("source").weight.first()
    assert (share - weight).abs().max() < 0.01
    total = got.drop_duplicates("doc_id").groupby("source").n_tokens.sum().tolist()
    assert M.entropy_share(list(weight)) > M.entropy_share(M.weights(total, 1.0))
    assert set(got.doc_id) == set(range(3000)) and not got.duplicated(["doc_id", "pass"]).any()
    assert got.groupby("doc_id").size().max() <= math.ceil(M.MAX_REPEATS)
    assert not got.duplicated(["block", "position"]).any()
    blocks = got.pivot_table(index="block", columns="source", values="n_tokens", aggfunc="sum").fillna(0)
    assert blocks.div(blocks.sum(1), axis=0).std().max() < 0.1
    again = M.mix_report(table.repartition(7), block_tokens=8000).toPandas()
    assert in_order(map(tuple, again[["doc_id", "pass", "block", "position"]].to_numpy().tolist())) \
        == in_order(map(tuple, got[["doc_id", "pass", "block", "position"]].to_numpy().tolist()))
    few = M.mix_report(table, block_tokens=8000, budget_tokens=10_000).toPandas()
    assert few.n_tokens.sum() <= 10_000 and few.n_tokens.sum() > 9_500


def test_mixing_cases(spark):
    table = docs(spark, awkward(), clashing=True)
    got = M.mix(table)
    assert got.schema == table.schema
    assert {r.doc_id for r in got.collect()} == {i for i, _ in awkward()} and got.count() >= len(awkward())
    blank = docs(spark, [(1, None), (2, ""), (None, " ")])
    assert M.mix(blank).count() == 3
    assert M.mix(docs(spark, [])).count() == M.mix_report(docs(spark, [])).count() == 0


def test_mixing_blocks_hold_few_rows(spark):
    """Rows without tokens fill blocks too: a table of blank texts, and a source of them beside another."""
    blank = docs(spark, [(k, (None, "", " ")[k % 3]) for k in range(2000)])
    got = M.mix_report(blank, block_rows=100).toPandas()
    assert len(got) == 2000 and got.block.nunique() == 20 and got.groupby("block").size().max() < 200
    mixed = blank.unionByName(docs(spark, [(5000 + k, "a b c") for k in range(100)])) \
        .withColumn("source", F.when(F.col("doc_id") < 5000, "blank").otherwise("text"))
    got = M.mix_report(mixed, block_rows=100, block_tokens=1000).toPandas()
    assert len(got) == 2100 and got.groupby("block").size().max() < 200


# quality rules -----------------------------------------------------------------------

def test_base_counts(spark):
    rng = random.Random(6)
    rows = awkward() + [(100 + k, " ".join(rng.choices(["a", "b", "c\n", "#x", "é|", "\t", "long"], k=rng.randint(0, 90)))) for k in range(80)]
    got = Q.quality_report(docs(spark, rows, clashing=True), spark.createDataFrame([], LABELS))
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows_of(got, *cols) == in_order((i, *brute_base(t)) for i, t in rows)
    assert all(r.kept != r.base_failed for r in got.collect())


def test_binomial(spark):
    for n, k, p in ((10, 0, 0.25), (50, 3, 0.125), (400, 20, 0.0625), (3000, 10, 0.0078125)):
        want = sum(math.comb(n, i) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k + 1))
        got = spark.range(1).select(Q.binomial_cdf(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
        assert math.isclose(got, float(want), rel_tol=1e-9)


def test_certified_cutoffs(spark):
    """Junk is rejected where the holdout certifies it, and only there; good documents stay within the risk."""
    rng = random.Random(9)
    vocab = [f"w{k}" for k in range(500)]
    good = [(k, " ".join(rng.choices(vocab, k=60))) for k in range(2000)]
    junk = [(5000 + k, " ".join(w + "###" for w in rng.choices(vocab, k=60))) for k in range(100)]
    rows = good + junk
    labels = spark.createDataFrame([(i, 1, 0) for i, _ in good] + [(i, 0, 0) for i, _ in junk] + [(None, 1, 0), (3, None, None)], LABELS)
    table = docs(spark, rows).withColumn("lang", F.lit("en"))
    got = {r.doc_id: r.kept for r in Q.quality_report(table, labels).collect()}
    assert all(got[i] for i, _ in good) and not any(got[i] for i, _ in junk)
    kept = Q.quality_filter(table.withColumn("row", F.lit(1)), labels)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in good} and kept.columns == [*table.columns, "row"]
    few = spark.createDataFrame([(i, 1, 0) for i, _ in good[:40]] + [(i, 0, 0) for i, _ in junk], LABELS)
    assert all(r.kept for r in Q.quality_report(table, few).collect())  # 40 rows cannot certify that risk
    other = table.withColumn("lang", F.when(F.col("doc_id") >= 5000, "xx").otherwise("en"))
    assert all(r.kept for r in Q.quality_report(other, labels).collect())  # that stratum has no good rows


def test_every_language_is_a_stratum(spark):
    """Six languages and none: each has cutoffs of its own, whatever is usual in the others; the correction counts them all."""
    rng = random.Random(19)
    vocab = [f"w{k}" for k in range(300)]
    langs = ["en", "de", "fr", "es", "pl", "fi", None]
    rows, labels = [], []
    for k in range(7 * 1900):
        lang, junk = langs[k % 7], k % 26 >= 25
        hashes = lang == "fi" or junk  # in one language every good text is full of symbols
        text = " ".join(w + ("##" if hashes else "") for w in rng.choices(vocab, k=30))
        rows.append((k, text, lang, "s", len(text)))
        labels.append((k, int(not junk), 0))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame(labels, LABELS)
    feats = Q.features(table.select("doc_id", "lang", "text"))
    strata = {r.stratum for r in Q.cutoffs(feats, labels).collect()}
    assert strata == {"en", "de", "fr", "es", "pl", ""}
    kept = {r.doc_id: r.kept for r in Q.quality_report(table, labels).collect()}
    for i, _, lang, _, _ in rows:
        assert kept[i] == (lang == "fi" or i % 26 < 25)


def test_rare_junk_beside_common_junk(spark):
    """A rule acts on what it finds, however many bad documents of another kind the stratum has."""
    rng = random.Random(10)
    vocab = [f"w{k}" for k in range(500)]
    plain = [(k, " ".join(rng.choices(vocab, k=30))) for k in range(3000)]
    junk = [(5000 + k, " ".join(w + "###" for w in rng.choices(vocab, k=30))) for k in range(5)]
    labels = spark.createDataFrame([(i, int(i < 2000), 0) for i, _ in plain + junk], LABELS)  # 1,000 plain ones are bad too
    table = docs(spark, plain + junk).withColumn("lang", F.lit("en"))
    got = {r.doc_id: r.kept for r in Q.quality_report(table, labels).collect()}
    assert all(got[i] for i, _ in plain if i < 2000) and not any(got[i] for i, _ in junk)


def test_quality_empty(spark):
    none = spark.createDataFrame([], LABELS)
    assert Q.quality_report(docs(spark, []), none).count() == Q.quality_filter(docs(spark, []), none).count() == 0
    table = docs(spark, awkward(), clashing=True)
    assert Q.quality_filter(table, none).dtypes == table.dtypes


# toxicity ----------------------------------------------------------------------------

def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op8_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got.predicted == (got.score >= 0.7)).all() and got.score.between(0, 1).all()
    assert got[got.toxic == 1].predicted.mean() > 0.65 and got[got.toxic == 0].predicted.mean() < 0.01


def test_toxicity_cases(spark):
    none = spark.createDataFrame([], LABELS)
    table = docs(spark, awkward(), clashing=True)
    got = T.toxicity(table, none).collect()
    assert len(got) == len(awkward()) and {r.score for r in got} == {0.0}
    one = T.toxicity(table, spark.createDataFrame([(i, 1, 1) for i in range(12)], LABELS)).collect()
    assert {r.score for r in one} == {1.0}
    both = spark.createDataFrame([(i, 1, i % 2) for i in range(12)] + [(None, 1, 1), (2, 1, None)], LABELS)
    assert all(0 <= r.score <= 1 for r in T.toxicity(table, both).collect())
    assert T.toxicity(docs(spark, []), none).count() == 0


def test_threshold_of_a_rare_language(spark):
    """Each language's cut has the highest F1, at the labels' own share of the classes, over all rows not trained on."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(1200):
        bad = rng.random() < 0.2
        text = rng.choices([f"w{k}" for k in range(40)], k=12) + ["vile"] * (rng.random() < (0.8 if bad else 0.1))
        rows.append((i, " ".join(text), "xx" if i % 12 == 0 else "en"))
        labels.append((i, 1, int(bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in T.toxicity(table, spark.createDataFrame(labels, LABELS), toxic=60, clean=90).collect()}
    lang, toxic = {i: g for i, _, g in rows}, {i: y for i, _, y in labels}
    cut = {lang[i]: r.lang_threshold for i, r in got.items()}
    assert len({(lang[i], r.lang_threshold) for i, r in got.items()}) == 2 and T.THRESHOLD not in cut.values()
    lab = T.learnable(spark.createDataFrame(labels, LABELS), 60, 90).collect()
    assert {r.l_id for r in lab} == {i for i, r in got.items() if not r.held_out}
    fresh = [r.l_id for r in lab if not r.sampled or r.aside]
    weight = [sum(toxic[r.l_id] == y for r in lab) / sum(toxic[i] == y for i in fresh) for y in (0, 1)]
    for g in ("en", "xx"):
        at = [i for i in fresh if lang[i] == g]

        def f1(c):
            hit = sum(weight[1] for i in at if toxic[i] and got[i].score >= c)
            return 2 * hit / (sum(weight[toxic[i]] for i in at if got[i].score >= c) + sum(weight[1] for i in at if toxic[i]))
        assert f1(cut[g]) >= max(f1(got[i].score) for i in at) - 0.01  # but for the width of a bin


def test_pieces_score_as_whole(monkeypatch):
    net, rng = T.Net(), np.random.default_rng(1)
    h = rng.integers(0, 1 << 57, 500)
    whole = net.logit(h)
    monkeypatch.setattr(T, "PIECE", 7)
    assert math.isclose(net.logit(h), whole, rel_tol=1e-5)


def test_platt_and_threshold():
    x = np.linspace(-3, 3, 200)
    a, b = T.platt(x, (x > 0.5).astype(int))
    assert a > 1 and abs(-b / a - 0.5) < 0.3
    assert T.best_threshold(np.array([0.1, 0.2, 0.8, 0.9]), np.array([0, 0, 1, 1])) == 0.5


# registered queries against SQL ---------------------------------------------------------

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.sql(queries.ORACLES[name])
    got = queries.QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got, *want.columns) == in_order(want.fetchall())


def test_contract_columns(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    kinds = {"op1_bpe_encode_decode": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
             "op2_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
             "op5_suffix_dedup": {"doc_id": "bigint", "n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
             "op8_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
             "op9_ngram_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"}}
    for name, want in kinds.items():
        got = queries.QUERIES[name](spark, sf)
        assert want.items() <= dict(got.dtypes).items() and got.count() == n, name


def test_op5_brute_force(spark):
    from helpers import brute_removed
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute_removed([t.encode() for _, t in rows], 200)
    got = queries.op5_suffix_dedup(spark, sf)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") \
        == in_order((i, a, b, c, sha(k)) for (i, _), (a, b, c, k) in zip(rows, want))
