"""Language ID by word-first backoff.

Training counts words per language in a bounded sample and, from the sampled
word types, character n-grams of ``GRAMS`` lengths with word-boundary marks.  A known word
scores its log frequency in each language.  A word that no language
knows falls back to its character n-grams, longest first; an unknown n-gram
is replaced by the two shorter ones it contains, down to single characters;
what is still unknown says nothing.  A document's score is the posterior of
the best language under equal priors.

The sample holds about ``DOCS_PER_LANG`` training documents of each language (all
of a rarer one), picked by a hash of id and text, so fitting costs the same at every
size.  The model keeps ``WORDS`` words and ``PER_LENGTH`` n-grams of each
length per language: that bounds what is collected and broadcast.  Every
document is predicted from its whole text.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
null ids count as the empty text for the fold; rows with null lang are predicted, not
learned from; ties go to the language first in order; without training rows
all are ``und`` with score 0; repeated rows are predicted alike; empty tables give empty
results; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod

DOCS_PER_LANG = 1000
WORDS = 10_000
GRAMS = (4, 3, 2, 1)
PER_LENGTH = 5_000
MEMO = 400_000  # words whose scores a worker remembers
LETTERS = re.compile(r"[^\W\d_]+")
NONE, HELD_OUT_FOLD, FOLDS = "und", 2, 4


def held_out(id_col: Column) -> Column:
    return crc_mod(id_col, FOLDS) == HELD_OUT_FOLD


class Model:
    """Log frequencies of words and n-grams: one matrix row each, languages as columns."""

    def __init__(self, rows: list[tuple[str, int, str, int]]):
        """rows: (lang, n or 0 for words, item, count)."""
        self.langs = sorted({r[0] for r in rows})
        at = {x: i for i, x in enumerate(self.langs)}
        self.words, self.grams = self._fit([r for r in rows if r[1] == 0], at), {}
        self.tables = []
        base = 1  # row 0: unknown, says nothing
        self.word_rows, table = self.words
        parts = [np.zeros((1, len(at))), table]
        self.word_rows = {w: i + base for w, i in self.word_rows.items()}
        base += len(table)
        for n in GRAMS:
            index, table = self._fit([r for r in rows if r[1] == n], at)
            self.grams |= {g: i + base for g, i in index.items()}
            parts.append(table)
            base += len(table)
        self.table = np.vstack(parts)
        del self.words, self.tables

    @staticmethod
    def _fit(rows: list[tuple], at: dict[str, int]) -> tuple[dict[str, int], np.ndarray]:
        index: dict[str, int] = {}
        for r in rows:
            index.setdefault(r[2], len(index))
        counts = np.zeros((len(index), len(at)))
        for lang, _, item, n in rows:
            counts[index[item], at[lang]] = n
        smooth = counts + 0.5
        logs = np.log(smooth / smooth.sum(0)) if len(index) else smooth
        return index, logs - logs.mean(1, keepdims=True) if len(index) else logs

    def backoff(self, gram: str, out: list[int]) -> None:
        """Rows of the longest known n-grams that make up ``gram``."""
        row = self.grams.get(gram)
        if row is not None:
            out.append(row)
        elif len(gram) > 1:
            self.backoff(gram[:-1], out)
            self.backoff(gram[1:], out)

    def word(self, w: str) -> np.ndarray:
        row = self.word_rows.get(w)
        if row is not None:
            return self.table[row]
        marked, n, rows = f"^{w}$", GRAMS[0], []
        for i in range(max(1, len(marked) - n + 1)):
            self.backoff(marked[i:i + n], rows)
        return self.table[rows].mean(0) if rows else self.table[0]


class Scorer:
    """Scores texts; remembers the words of earlier texts."""

    def __init__(self, model: Model):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.seen: dict[str, int] = {}
        self.rows = np.zeros((4096, len(self.model.langs)))

    def row(self, w: str) -> int:
        i = len(self.seen)
        if i == len(self.rows):
            self.rows = np.vstack([self.rows, np.zeros_like(self.rows)])
        self.rows[i] = self.model.word(w)
        self.seen[w] = i
        return i

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.model.langs or not text or not any(map(str.isalpha, text)):
            return NONE, 0.0
        if len(self.seen) > MEMO:
            self.reset()
        get = self.seen.get
        rows = [self.row(w) if (i := get(w)) is None else i for w in LETTERS.findall(text.lower())]
        total = self.rows[rows].sum(0)
        total -= total.max()
        best = int(total.argmax())
        return self.model.langs[best], float(1.0 / np.exp(total).sum())


def training_counts(docs: DataFrame, per_lang: int = DOCS_PER_LANG) -> DataFrame:
    """(lang, n, item, count) of the sample: words with n = 0, character n-grams of its word types."""
    train = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row per language
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 40)) / float(1 << 40)
    keep = F.lit(False)
    for lang, n in sorted(sizes.items()):
        keep = keep | ((F.col("lang") == lang) & (share < per_lang / n))
    items = (train.where(keep).select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("item"))
             .where("item <> ''").groupBy("lang", "item").agg(F.count("*").alias("count")))
    marked = F.concat(F.lit("^"), "item", F.lit("$"))
    grams = [F.transform(F.sequence(F.lit(1), F.char_length(marked) - (n - 1)),
                         lambda i, n=n: F.struct(F.lit(n).alias("n"), F.substring(marked, i, F.lit(n)).alias("item")))
             for n in GRAMS]
    grams = [F.when(F.char_length(marked) >= n, g).otherwise(F.array().cast("array<struct<n:int,item:string>>"))
             for n, g in zip(GRAMS, grams)]
    by_gram = (items.select("lang", F.explode(F.concat(*grams)).alias("g")).select("lang", "g.n", "g.item")
               .groupBy("lang", "n", "item").agg(F.count("*").alias("count")))
    every = items.select("lang", F.lit(0).alias("n"), "item", "count").unionByName(by_gram)
    rank = F.row_number().over(Window.partitionBy("lang", "n").orderBy(F.desc("count"), "item"))
    return every.withColumn("r", rank).where(F.col("r") <= F.when(F.col("n") == 0, WORDS).otherwise(PER_LENGTH)).drop("r")


def fit(docs: DataFrame, per_lang: int = DOCS_PER_LANG) -> Model:
    """The model, from at most (WORDS + len(GRAMS) * PER_LENGTH) counted items per language."""
    return Model([tuple(r) for r in training_counts(docs, per_lang).collect()])


def _predict(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(shared.value)
    for b in batches:
        got = [scorer.predict(t.as_py()) for t in b.column("text")]
        yield pa.record_batch({"doc_id": b.column("doc_id"), "held_out": b.column("held_out"),
                               "lang_pred": pa.array([g[0] for g in got], pa.string()),
                               "score": pa.array([g[1] for g in got], pa.float64())})


def language_id(docs: DataFrame, per_lang: int = DOCS_PER_LANG) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, per_lang))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(lambda it: _predict(it, shared), "doc_id long, held_out boolean, lang_pred string, score double"))
