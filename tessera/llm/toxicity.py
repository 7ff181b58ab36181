"""Toxicity: a convolutional text classifier trained in numpy.

Each word is hashed three times in the JVM: whole, its first four and its first
five letters.  Its embedding is the sum of one row from each of three tables,
so that two words rarely share all rows and inflected forms share some.  Filters of widths
1, 2 and 3 run over the embeddings, each is pooled by its maximum over the
whole text, and a logistic layer gives the score.  Training is
Adam on the log loss; one embedding dimension starts from the bucket's log
odds in the training rows.  A Platt fit on rows set aside makes the score a
probability at the class shares of the sample.  A threshold per language is calibrated
(highest F1) on the scores of all labelled rows outside the held-out fold that
were not trained on, counted by language and score bin, each class
weighted to its share of the labels; it is an extra column, the language is no input of the score.

The training sample is bounded: about ``TOXIC`` rows with label 1 and
``CLEAN`` rows with label 0, picked by a hash of the id (all
rows where there are fewer).  Every document is scored once on its whole text, in
pieces that overlap by the widest filter less one word, so memory is bounded; the scores
are written, and the thresholds are found and applied without the texts.

Defined cases: null, empty and wordless texts are scored (all filters pool
0); null ids count as the empty text for the fold; a doc_id with several labels is toxic if
any is; null labels are not learned from; without rows of both
classes every score is the share of label 1 (0 without rows); a null or
unseen language has the overall threshold; repeated rows score alike; empty tables give empty
results; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod, written

BUCKETS = 1 << 17
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
TOXIC = 2000
CLEAN = 3000
EPOCHS = 4
BATCH = 32
RATE = 0.01
PIECE = 1 << 15  # words scored at a time
THRESHOLD = 0.7
BINS = 1 << 12  # of scores, for the thresholds
HELD_OUT_FOLD, FOLDS = 1, 3
TABLES = ("e0", "e1", "e2")


def held_out(id_col: Column) -> Column:
    return crc_mod(id_col, FOLDS) == HELD_OUT_FOLD


def word_buckets(text: Column) -> Column:
    """The three buckets of every word (a run of letters or digits, lower-cased) in one long, 20 bits each."""
    found = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(BUCKETS))
    return F.transform(F.filter(found, lambda w: w != ""), lambda w: bucket(w) + bucket(F.substring(w, 1, 4)) * (1 << 20)
                       + bucket(F.substring(w, 1, 5)) * (1 << 40))


def buckets(h: np.ndarray) -> tuple[np.ndarray, ...]:
    return h & (BUCKETS - 1), (h >> 20) & (BUCKETS - 1), (h >> 40) & (BUCKETS - 1)


class Net:
    """Embeddings e0, e1, e2; per width a (width * DIM, FILTERS) kernel and bias; logistic layer v, c; Platt a, b."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        f = np.float32
        self.p = {e: rng.normal(0, 0.05, (BUCKETS, DIM)).astype(f) for e in TABLES} | {
                  "v": rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(f), "c": np.zeros(1, f)}
        for w in WIDTHS:
            self.p[f"k{w}"] = rng.normal(0, (w * DIM) ** -0.5, (w * DIM, FILTERS)).astype(f)
            self.p[f"b{w}"] = np.zeros(FILTERS, f)
        self.platt = (1.0, 0.0)
        self.constant: float | None = None

    def pooled(self, h: np.ndarray, where: bool = False):
        """Maximum of every filter over the words ``h`` (0 at least), and its place."""
        at3 = buckets(h)
        x = sum(self.p[e][ix] for e, ix in zip(TABLES, at3))
        top = np.zeros(FILTERS * len(WIDTHS), np.float32)
        place = np.full(len(top), -1)
        for i, w in enumerate(WIDTHS):
            n = len(h) - w + 1
            if n < 1:
                continue
            k = self.p[f"k{w}"]
            z = x[:n] @ k[:DIM]
            for o in range(1, w):
                z += x[o:o + n] @ k[o * DIM:(o + 1) * DIM]
            s = slice(i * FILTERS, (i + 1) * FILTERS)
            if where:
                at = z.argmax(0)
                m = z[at, np.arange(FILTERS)] + self.p[f"b{w}"]
                place[s] = np.where(m > 0, at, -1)
            else:
                m = z.max(0) + self.p[f"b{w}"]
            top[s] = np.maximum(m, 0)
        return (top, place, at3, x) if where else top

    def logit(self, h: np.ndarray) -> float:
        """Of a whole text, in overlapping pieces."""
        step = PIECE - max(WIDTHS) + 1
        top = self.pooled(h[:PIECE])
        for i in range(step, max(0, len(h) - max(WIDTHS) + 1), step):
            top = np.maximum(top, self.pooled(h[i:i + PIECE]))
        return float(top @ self.p["v"] + self.p["c"][0])

    def score(self, h: np.ndarray) -> float:
        if self.constant is not None:
            return self.constant
        return float(1 / (1 + np.exp(-np.clip(self.platt[0] * self.logit(h) + self.platt[1], -30, 30))))


def train(net: Net, texts: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> None:
    """Adam on the log loss; only the words under each filter's maximum get a gradient."""
    rng = np.random.default_rng(seed)
    odds = np.zeros((len(TABLES), 2, BUCKETS))
    for h, label in zip(texts, y):
        for t, ix in enumerate(buckets(h)):
            odds[t, int(label), np.unique(ix)] += 1
    n = np.array([max(1, (y == 0).sum()), max(1, (y == 1).sum())])
    for t, e in enumerate(TABLES):
        net.p[e][:, 0] += (0.25 * np.log(((odds[t, 1] + 0.5) / (n[1] + 1)) / ((odds[t, 0] + 0.5) / (n[0] + 1)))).astype(np.float32)
    dense = [k for k in net.p if k not in TABLES]
    m1, m2 = ({k: np.zeros_like(v) for k, v in net.p.items()} for _ in range(2))
    step = 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(texts)), max(1, len(texts) // BATCH)):
            g = {k: np.zeros_like(net.p[k]) for k in dense}
            touched: dict[str, tuple[list, list]] = {e: ([], []) for e in TABLES}
            for r in rows:
                top, place, at3, x = net.pooled(texts[r], where=True)
                d = (1 / (1 + np.exp(-np.clip(top @ net.p["v"] + net.p["c"][0], -30, 30))) - y[r]) / len(rows)
                g["v"] += d * top
                g["c"] += d
                for i, w in enumerate(WIDTHS):
                    for f in range(FILTERS):
                        at = place[i * FILTERS + f]
                        if at < 0:
                            continue
                        up = d * net.p["v"][i * FILTERS + f]
                        g[f"k{w}"][:, f] += up * x[at:at + w].ravel()
                        g[f"b{w}"][f] += up
                        back = up * net.p[f"k{w}"][:, f].reshape(w, DIM)
                        for e, ix in zip(TABLES, at3):
                            touched[e][0].extend(ix[at:at + w])
                            touched[e][1].extend(back)
            step += 1
            fix = RATE * (1 - 0.999 ** step) ** 0.5 / (1 - 0.9 ** step)
            for k in dense:
                m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                m2[k] = 0.999 * m2[k] + 0.001 * g[k] ** 2
                net.p[k] -= (fix * m1[k] / (np.sqrt(m2[k]) + 1e-8)).astype(np.float32)
            for e, (ix, back) in touched.items():
                if ix:
                    rows_e, inverse = np.unique(ix, return_inverse=True)
                    ge = np.zeros((len(rows_e), DIM), np.float32)
                    np.add.at(ge, inverse, np.array(back, np.float32))
                    m1[e][rows_e] = 0.9 * m1[e][rows_e] + 0.1 * ge
                    m2[e][rows_e] = 0.999 * m2[e][rows_e] + 0.001 * ge ** 2
                    net.p[e][rows_e] -= fix * m1[e][rows_e] / (np.sqrt(m2[e][rows_e]) + 1e-8)


def platt(logits: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (kept positive) and offset of the logistic fit with smoothed targets, by Newton steps."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        r, w = p - target, p * (1 - p) + 1e-9
        grad = np.array([r @ logits + 1e-3 * (a - 1), r.sum()])
        hess = np.array([[w @ logits ** 2 + 1e-3, w @ logits], [w @ logits, w.sum()]])
        da, db = np.clip(np.linalg.solve(hess, grad), -1, 1)
        a, b = max(0.05, a - da), b - db
        if abs(da) + abs(db) < 1e-6:
            break
    return float(a), float(b)


def best_threshold(scores: np.ndarray, y: np.ndarray, n: np.ndarray | None = None, top: np.ndarray | None = None) -> float:
    """Middle of the gap below the cut with the highest F1; THRESHOLD where a class is missing.

    An entry may stand for ``n`` rows, ``y`` of them toxic, with scores from ``scores`` to ``top``.
    """
    n, top = np.ones(len(y)) if n is None else n, scores if top is None else top
    if not 0 < y.sum() < n.sum():
        return THRESHOLD
    order = np.argsort(-scores, kind="stable")
    s, hit = scores[order], np.cumsum(y[order])
    f1 = 2 * hit / (np.cumsum(n[order]) + y.sum())
    last = np.append(s[1:] < s[:-1], True)  # equal scores are cut together
    i = int(np.where(last, f1, -1).argmax())
    return float((s[i] + (top[order][i + 1] if i + 1 < len(s) else 0.0)) / 2)


def learnable(labels: DataFrame, toxic: int, clean: int) -> DataFrame:
    """(l_id, y, sampled, aside) of the labelled ids outside the held-out fold; a fifth is set aside for calibration."""
    lab = (labels.where("toxic is not null").where(~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").alias("l_id"))
           .agg(F.max((F.col("toxic") >= 1).cast("int")).alias("y")))
    n = {r["y"]: r["n"] for r in lab.groupBy("y").agg(F.count("*").alias("n")).collect()}
    limit = F.when(F.col("y") == 1, toxic / max(1, n.get(1, 0))).otherwise(clean / max(1, n.get(0, 0)))
    share = F.pmod(F.xxhash64("l_id"), F.lit(1 << 40)) / float(1 << 40)
    return lab.select("l_id", "y", (share < limit).alias("sampled"),
                      (F.pmod(F.xxhash64(F.lit(1), "l_id"), F.lit(5)) == 0).alias("aside"))


def fit(docs: DataFrame, lab: DataFrame) -> Net:
    """Train on the bounded sample; what is set aside of it gives the Platt fit."""
    # about toxic + clean rows of a few numbers: bounded by the parameters, so broadcast, and the texts are not shuffled
    got = docs.select("doc_id", "text").join(F.broadcast(lab.where("sampled")), F.col("doc_id") == F.col("l_id")).select(
        "y", word_buckets(F.col("text")).alias("h"), "aside", "doc_id").toArrow()
    order = sorted(range(got.num_rows), key=lambda i: (got["doc_id"][i].as_py() or 0, i))
    texts = [got["h"][i].values.to_numpy().astype(np.int64) for i in order]
    y = np.array([got["y"][i].as_py() for i in order], np.int64)
    aside = np.array([got["aside"][i].as_py() for i in order], bool)
    net = Net()
    if not 0 < y.sum() < len(y):
        net.constant = float(y.mean()) if len(y) else 0.0
        return net
    use = ~aside if 0 < y[~aside].sum() < (~aside).sum() else aside | ~aside
    train(net, [t for t, u in zip(texts, use) if u], y[use])
    aside = ~use if 0 < y[~use].sum() < (~use).sum() else use
    logits = np.array([net.logit(t) for t, u in zip(texts, aside) if u])
    net.platt = platt(logits, y[aside])
    return net


def score_bins(scored: DataFrame, lab: DataFrame) -> DataFrame:
    """(lang, bin, low, high, toxic, n): scores and weighted counts of the labelled rows that were not trained on.

    Training takes another part of each class, so a class is weighted by its labels over those left.  Where a class
    has none left, the rows trained on count too.
    """
    fresh = ~F.col("sampled") | F.col("aside")
    n = {r["y"]: r for r in lab.groupBy("y").agg(F.count("*").alias("n"), F.count_if(fresh).alias("left")).collect()}
    if all(r["left"] for r in n.values()):
        lab, weight = lab.where(fresh), {y: r["n"] / r["left"] for y, r in n.items()}
    else:
        weight = {}
    counts = (scored.join(lab.select("l_id", "y"), F.col("doc_id") == F.col("l_id"))
              .groupBy("lang", F.floor(F.col("score") * BINS).alias("bin"))
              .agg(F.min("score").alias("low"), F.max("score").alias("high"),
                   F.count_if(F.col("y") == 1).alias("n1"), F.count_if(F.col("y") == 0).alias("n0")))
    toxic, clean = F.col("n1") * float(weight.get(1, 1)), F.col("n0") * float(weight.get(0, 1))
    return counts.select("lang", "bin", "low", "high", toxic.alias("toxic"), (toxic + clean).alias("n"))


def _best(bins) -> float:
    return best_threshold(*(bins[c].to_numpy(float) for c in ("low", "toxic", "n", "high")))


def with_thresholds(scored: DataFrame, lab: DataFrame) -> DataFrame:
    """``scored`` with lang_threshold."""
    bins = written(score_bins(scored, lab), "toxicity-bins")
    overall = (bins.groupBy("bin").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("toxic").alias("toxic"),
                                       F.sum("n").alias("n")).orderBy("bin").toPandas())  # BINS rows at most
    # one row per language, from at most BINS + 1 rows each
    cuts = bins.where("lang <> ''").groupBy("lang").applyInPandas(
        lambda p: p[["lang"]].head(1).assign(lang_threshold=_best(p)), "lang string, lang_threshold double")
    return scored.join(cuts.withColumnRenamed("lang", "c_lang").hint("broadcast"), F.col("lang") == F.col("c_lang"), "left").withColumn(
        "lang_threshold", F.coalesce("lang_threshold", F.lit(_best(overall))))


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    net = shared.value
    for b in batches:
        h = b.column("h")
        flat, off = h.values.to_numpy(zero_copy_only=False), h.offsets.to_numpy()
        got = np.array([net.score(flat[off[i]:off[i + 1]]) for i in range(b.num_rows)])
        yield pa.record_batch({"doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "lang": b.column("lang"),
                               "score": pa.array(got, pa.float64())})


def toxicity(docs: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted, lang_threshold, flagged (score at or above it)."""
    lab = learnable(labels, toxic, clean)
    net = fit(docs, lab)
    shared = docs.sparkSession.sparkContext.broadcast(net)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("lang").cast("string").alias("lang"), word_buckets(F.col("text")).alias("h"))
    scored = rows.mapInArrow(lambda it: _score(it, shared), "doc_id long, held_out boolean, lang string, score double")
    if net.constant is None:
        scored = with_thresholds(written(scored, "toxicity"), lab)
    else:
        scored = scored.withColumn("lang_threshold", F.lit(THRESHOLD))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                         "lang_threshold", (F.col("score") >= F.col("lang_threshold")).alias("flagged"))
