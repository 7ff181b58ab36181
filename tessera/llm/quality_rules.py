"""Quality rules whose cutoffs are certified on labelled documents.

DataFrame functions only.  Each document gets four shares (symbols among
characters, words equal to the word before, repeated lines, words in repeated
windows).  For every stratum and rule the cutoffs of a fixed grid are tested
on the labelled holdout: a cutoff is certified when the exact binomial test
rejects "at least ``risk / rules`` of the good documents fall above it" at
level ``delta / (strata * rules * cutoffs)`` (Bonferroni over every test that
is made), so with probability 1 - ``delta`` every stratum loses at most ``risk`` of its
good documents.  Of the certified cutoffs the one that rejects most bad
labelled documents is used, the loosest in a tie; a rule without a certified cutoff that
finds a bad one rejects nothing, whatever share of the bad ones the rule is after.  The grid is fixed beforehand, so all labelled rows
serve as holdout.

Strata are the listed languages and one for the rest, so the table of cutoffs
has ``len(langs) + 1`` rows and can be broadcast.

Defined cases: null text has no words (base_failed); null or unlisted lang is
the stratum "other"; a doc_id with several labels is good only if all are;
null labels do not count; rows that repeat are judged alike; without labels
only the base rules act; empty tables give empty results; other columns of the
documents pass through ``quality_filter`` under any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import SPACE, let, words, written

RULES = ("symbol_share", "same_word_share", "dup_line_share", "repeat_share")
CUTOFFS = (0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5)
RISK = 0.02
DELTA = 0.05
WINDOW = 8  # words
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
MAX_BROADCAST_STRATA = 10_000  # rows of a language and its cutoffs; more are joined by shuffle
MAX_BROADCAST_REJECTED = 500_000  # rows of an id, a hash and a language


def _hashed_windows(h: Column) -> Column:
    """Hashes of all 8-word windows from word hashes, by doubling 1, 2, 4, 8."""
    def doubled(a: Column, step: int) -> Column:
        return let(a, lambda x: F.transform(x, lambda v, i: F.xxhash64(v, F.get(x, i + step))))
    n = F.size(h) - (WINDOW - 1)
    return F.when(n >= 1, F.slice(doubled(doubled(doubled(h, 1), 2), 4), 1, n)).otherwise(F.array().cast("array<bigint>"))


def _covered_words(windows: Column) -> Column:
    """Number of words in windows that occur twice or more."""
    def positions(s: Column) -> Column:
        twice = F.filter(s, lambda e, j: F.coalesce(F.get(s, j - 1)["h"] == e["h"], F.lit(False))
                         | F.coalesce(F.get(s, j + 1)["h"] == e["h"], F.lit(False)))
        return F.sort_array(F.transform(twice, lambda e: e["i"]))
    ordered = F.sort_array(F.transform(windows, lambda v, i: F.struct(v.alias("h"), i.alias("i"))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    add = lambda acc, p: F.struct((acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"), p.alias("last"))
    counted = F.aggregate(let(ordered, positions), start, add, lambda acc: acc["n"])
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), counted).otherwise(F.lit(0).cast("long"))


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The input columns but ``text_col``, plus the counts and shares of every text.

    Windows are compared by 64-bit hashes within one text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    w = docs.withColumn("_t", text).withColumn("_w", words(F.col("_t")))
    lines = F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    w = w.select(*[c for c in docs.columns if c != text_col], "_t",
                 F.size("_w").cast("long").alias("n_words"),
                 F.char_length(F.array_join("_w", "")).cast("long").alias("word_chars"),
                 F.regexp_count("_t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                 let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                               (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("_l"),
                 F.transform("_w", lambda x: F.xxhash64(x)).alias("_h"))
    same = let(F.col("_h"), lambda h: F.size(F.filter(h, lambda v, i: F.coalesce(v == F.get(h, i - 1), F.lit(False)))))
    w = w.withColumn("n_dup_lines", F.col("_l.dup")).withColumn("_same", same.cast("long")) \
         .withColumn("n_repeat_words", let(let(F.col("_h"), _hashed_windows), _covered_words))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    return w.select("*",
                    share(F.col("n_symbols"), F.col("word_chars")).alias("symbol_share"),
                    share(F.col("_same"), F.col("n_words")).alias("same_word_share"),
                    share(F.col("n_dup_lines"), F.col("_l.n")).alias("dup_line_share"),
                    share(F.col("n_repeat_words"), F.col("n_words")).alias("repeat_share"),
                    ((F.col("n_words") < MIN_WORDS)
                     | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed")
                    ).drop("_t", "_l", "_h", "_same")


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(Binomial(n, p) <= k), exact but for rounding; 1 where k >= n * p (never certified there).

    The point mass at k is summed in logarithms, the smaller terms relative to it.
    """
    zero = F.lit(0.0)
    to_k = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    log_mass = F.aggregate(to_k, zero, lambda a, i: a + F.log((n - k + i) / i)) \
        + k * math.log(p) + (n - k) * math.log1p(-p)
    ratio = lambda j: (j * (1 - p)) / ((n - j + 1) * p)  # noqa: E731  mass at j - 1 over mass at j
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum"))

    def step(acc, i):  # i = 1..k stands for j = k - i + 1
        term = acc["term"] * ratio(k - i + 1)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))
    tail = F.aggregate(to_k, start, step, lambda acc: acc["sum"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.exp(log_mass) * tail))


def stratum(lang: Column) -> Column:
    """Every language is a stratum, and so are the documents without one."""
    return F.coalesce(lang, F.lit(""))


def cutoffs(feats: DataFrame, labels: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", risk: float = RISK,
            delta: float = DELTA, grid: tuple[float, ...] = CUTOFFS) -> DataFrame:
    """(stratum, cutoffs: rule -> cutoff) with a row for each language of the labelled holdout that has a certified rule.

    The correction counts the tests of all these languages.
    """
    good = (labels.where("quality is not null").groupBy(F.col("doc_id").alias("l_id"))
            .agg((F.min("quality") >= 1).alias("good")))
    held = (feats.where(~F.col("base_failed")).select(F.col(id_col).alias("id"), stratum(F.col(lang_col)).alias("stratum"), *RULES)
            .join(good, F.col("id") == F.col("l_id")))
    cells = [(r, c) for r in RULES for c in grid]
    counts = held.groupBy("stratum").agg(
        F.count_if("good").alias("n"),
        *[F.count_if(F.col("good") & (F.col(r) > c)).alias(f"g{i}") for i, (r, c) in enumerate(cells)],
        *[F.count_if(~F.col("good") & (F.col(r) > c)).alias(f"b{i}") for i, (r, c) in enumerate(cells)])
    counts = counts.withColumn("tests", F.count("*").over(Window.partitionBy(F.lit(1))) * len(cells))  # over a row a language
    one = counts.select("stratum", "n", "tests", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"), F.col(f"g{i}").alias("k"), F.col(f"b{i}").alias("caught"))
        for i, (r, c) in enumerate(cells)])).alias("x")).select("stratum", "n", "tests", "x.*")
    certified = one.where((F.col("caught") > 0)
                          & (binomial_cdf(F.col("k"), F.col("n"), risk / len(RULES)) <= F.lit(delta) / F.col("tests")))
    best = certified.groupBy("stratum", "rule").agg(F.max(F.struct("caught", "cutoff"))["cutoff"].alias("cutoff"))
    return best.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))


def judged(feats: DataFrame, labels: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", **how) -> DataFrame:
    """``feats`` with kept: neither the base rules nor a certified rule of the stratum rejects."""
    cut = written(cutoffs(feats, labels, id_col, lang_col, **how).select(F.col("stratum").alias("c_stratum"), "cutoffs"), "cutoffs")
    few = F.broadcast(cut) if cut.count() <= MAX_BROADCAST_STRATA else cut
    got = feats.join(few, stratum(F.col(lang_col)) == F.col("c_stratum"), "left")
    above = [F.coalesce(F.col(r) > F.col("cutoffs")[r], F.lit(False)) for r in RULES]
    rejected = F.col("base_failed")
    for a in above:
        rejected = rejected | a
    return got.withColumn("kept", ~rejected).drop("c_stratum", "cutoffs")


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, counts of the base rules, base_failed, kept, and the four shares."""
    feats = written(features(docs.select("doc_id", "lang", "text")), "quality")
    return judged(feats, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                        "base_failed", "kept", *RULES)


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   lang_col: str = "lang") -> DataFrame:
    """The documents that are kept, with all their columns.

    Only counts are written.  The rejected documents (id, text hash, language) are taken out by an
    anti-join: broadcast up to MAX_BROADCAST_REJECTED rows, so that no text is shuffled, else by shuffle.
    """
    named = [F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("key")]
    feats = written(features(docs.select(*named, F.col(text_col).alias("text"))), "quality")
    bad = (judged(feats, labels, "id").where("not kept")
           .select(F.col("id").alias("b_id"), F.col("key").alias("b_key"), F.col("lang").alias("b_lang")).distinct())
    bad = written(bad, "rejected")
    if bad.count() <= MAX_BROADCAST_REJECTED:
        bad = F.broadcast(bad)
    same = F.col("id").eqNullSafe(F.col("b_id")) & (F.col("key") == F.col("b_key")) & F.col("lang").eqNullSafe(F.col("b_lang"))
    return docs.select(F.struct("*").alias("row"), *named).join(bad, same, "left_anti").select("row.*")
