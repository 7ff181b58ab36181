"""Target-distribution importance resampling: documents drawn by how much they look like a target text.

1. Features are runs of words, hashed into buckets; every task counts those of its documents
   in an array, and only the buckets' sums leave it (for the corpus and for the target).
2. A bucket's gain is the logarithm of its share in the target over its share in the
   corpus.  Weights are the gains, an array, taken at the buckets of a document's features and summed;
   seeded Gumbel noise on top makes the highest scores a draw without replacement.
3. The cutoff is found by a quantile sketch: KLL sketches, merged, give a bracket around the
   wanted score.  Exact counts outside the bracket tell whether the cutoff lies in it; if not, it is
   widened.  Only the rows inside it are sorted.
4. Ranks come from one range exchange of the drawn rows: the place in the partition plus the
   rows of the partitions before.

At the driver are the gains (one number a bucket), a few counts, and a count for each partition.
Crc-32 is computed on the Arrow buffers, all words at once; no row becomes a Python string.

Defined cases: a null text has no words (weight 0); texts of null in the target count nothing; rows that repeat are
scored and drawn each, with ranks of their own; a null id is hashed as the empty text and comes last among equal
scores; an empty table gives an empty result, an empty target gains from smoothing alone; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import small_table, written

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
LONG_WORD = 64  # bytes: longer words are hashed one by one
SKETCH = 4096  # k of the KLL sketches
MARGIN = 0.002  # of the ranks, on both sides of the cutoff: about twice the sketch's error
SKETCHES = 32  # sketches are merged in so many groups first
SLICE_BYTES = 8 << 20

# the byte that a byte of a text counts as: 0 parts words, A-Z are lower-cased, what lies beyond ASCII is of a word
FOLD = np.array([c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 0
                 for c in range(256)], np.uint8)


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


CRC = _crc_table()


def crc_over(state: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Crc-32 (before its last inversion) carried on over the bytes of each word."""
    state = state.copy()
    at = np.flatnonzero((sizes > 0) & (sizes <= LONG_WORD))
    at = at[np.argsort(-sizes[at], kind="stable")]
    n, s, c = sizes[at], starts[at], state[at]
    live = np.searchsorted(-n, -np.arange(LONG_WORD), "left")  # words with more than p bytes
    for p in range(LONG_WORD):
        k = int(live[p])
        if not k:
            break
        c[:k] = CRC[(c[:k] ^ data[s[:k] + p]) & 0xFF] ^ (c[:k] >> 8)
    state[at] = c
    for k in np.flatnonzero(sizes > LONG_WORD).tolist():
        state[k] = zlib.crc32(data[starts[k]:starts[k] + sizes[k]].tobytes(), int(state[k]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return state


def features(text: pa.StringArray, runs: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each text, text of each feature, bucket of each feature) without nulls in ``text``."""
    wide = np.int64 if pa.types.is_large_string(text.type) else np.int32
    ends = np.frombuffer(text.buffers()[1], wide)[text.offset:text.offset + len(text) + 1].astype(np.int64)
    data = FOLD[np.frombuffer(text.buffers()[2] or b"", np.uint8)[ends[0]:ends[-1]]]
    ends = ends - ends[0]
    inside = data > 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    bounds = ends[1:-1][(ends[1:-1] > 0) & (ends[1:-1] < len(data))]
    first[bounds] = inside[bounds]
    last[bounds - 1] = inside[bounds - 1]
    starts = np.flatnonzero(first)
    sizes = np.flatnonzero(last) + 1 - starts
    of = np.searchsorted(ends, starts, "right") - 1
    n_words = np.bincount(of, minlength=len(text)).astype(np.int64)
    state, texts, hashed = np.full(len(starts), 0xFFFFFFFF, np.uint32), [], []
    for m in range(runs):  # runs of m + 1 words, from those of m
        if m:
            keep = of[:-m] == of[m:] if m < len(of) else np.zeros(0, bool)
            state = state[:len(keep)]
            state = CRC[(state ^ 0x20) & 0xFF] ^ (state >> 8)
        else:
            keep = np.ones(len(starts), bool)
        state = crc_over(state, data, starts[m:], np.where(keep, sizes[m:], 0))
        texts.append(of[:len(keep)][keep])
        hashed.append((state[keep] ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets))
    return n_words, np.concatenate(texts), np.concatenate(hashed).astype(np.int64)


def _slices(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of a few megabytes of text."""
    cuts = np.flatnonzero(np.diff(np.cumsum(np.maximum(b.column("size").to_numpy(), 1)) // SLICE_BYTES, prepend=-1))
    for lo, hi in zip(cuts, [*cuts[1:], b.num_rows]):
        yield b.slice(lo, hi - lo)


def _base(docs: DataFrame, text_col: str, *others: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(*others, text.alias("text"), F.octet_length(text).alias("size"))


def bucket_counts(docs: DataFrame, text_col: str = "text", runs: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for part in _slices(b):
                total += np.bincount(features(part.column("text"), runs, buckets)[2], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.record_batch({"bucket": at, "n": total[at]})
    rows = _base(docs, text_col).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 * ln(share in the target / share in the corpus)), smoothed by one."""
    big_s, big_t = float(corpus.sum()) + len(corpus), float(target.sum()) + len(target)
    return np.array([math.floor(1000 * math.log((t + 1.0) * big_s / ((s + 1.0) * big_t)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", runs: int = 1,
           seed: int = SEED) -> DataFrame:
    """Per document: row (a number of its own), doc_id, n_words, n_features, weight, score."""
    def score(batches):
        for b in batches:
            for part in _slices(b):
                n_words, of, bucket = features(part.column("text"), runs, len(gain))
                weight = np.zeros(part.num_rows, np.int64)
                np.add.at(weight, of, gain[bucket])
                ids = part.column("doc_id").to_pylist()
                yield pa.record_batch({"row": part.column("row"), "doc_id": part.column("doc_id"), "n_words": n_words,
                                       "n_features": np.bincount(of, minlength=part.num_rows).astype(np.int64),
                                       "weight": weight, "score": weight + np.array([noise(i, seed) for i in ids], np.int64)})
    return _base(docs, text_col, F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id")) \
        .mapInArrow(score, "row long, doc_id long, n_words long, n_features long, weight long, score long")


def order() -> list[Column]:
    """Highest score first, then the smaller id."""
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]


def placed(rows: DataFrame, name: str) -> tuple[DataFrame, dict[int, int]]:
    """(rows with the partition they sort into and the place in it, rows before each partition)."""
    at = written(rows.repartitionByRange(*order()).sortWithinPartitions(*order())
                 .withColumn("part", F.spark_partition_id())
                 .withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), name)
    before, out = 0, {}
    for part, n in sorted(at.groupBy("part").count().collect()):  # a row for each partition
        out[part], before = before, before + n
    return at, out


def bracket(rows: DataFrame, total: int, wanted: int, margin: float = MARGIN) -> tuple[int, int, int]:
    """(lowest and highest score of a bracket that holds the ``wanted``-th highest score, rows above it)."""
    groups = rows.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCHES)).alias("g")) \
        .agg(F.kll_sketch_agg_bigint("score", F.lit(SKETCH)).alias("k"))
    row = groups.agg(F.kll_merge_agg_bigint("k").alias("k"))
    at = 1 - (wanted - 0.5) / total
    while True:
        ranks = [max(0.0, at - margin), min(1.0, at + margin)]
        lo, hi = row.select(*[F.kll_sketch_get_quantile_bigint("k", F.lit(r)).alias(f"q{i}") for i, r in enumerate(ranks)]).first()
        above, inside = rows.agg(F.count_if(F.col("score") > hi), F.count_if(F.col("score").between(lo, hi))).first()
        if above < wanted <= above + inside:
            return lo, hi, above
        if margin >= 1:  # the sketch's ends are exact, so this is never reached
            raise ArithmeticError(f"rank {wanted} of {total} is outside the whole range")
        margin *= 4


def cutoff(rows: DataFrame, total: int, wanted: int, margin: float = MARGIN) -> tuple[int, int | None, int]:
    """(score, doc_id, row) of the last row drawn: the ``wanted``-th in the order; only the bracket is sorted."""
    lo, hi, above = bracket(rows, total, wanted, margin)
    at, before = placed(rows.where(F.col("score").between(lo, hi)).select("score", "doc_id", "row"), "bracket")
    target = wanted - above - 1
    part = max(p for p, n in before.items() if n <= target)
    return tuple(at.where((F.col("part") == part) & (F.col("place") == target - before[part])).first()[:3])


def _key(score, doc_id, row) -> Column:
    """A struct that grows along the order."""
    return F.struct(-score, doc_id.isNull(), F.coalesce(doc_id, F.lit(0)), row)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             runs: int = 1, buckets: int = BUCKETS, seed: int = SEED, least_words: int = LEAST_WORDS,
             percent: int = PERCENT, margin: float = MARGIN) -> DataFrame:
    """Per document: doc_id, n_features, weight, score, rank (null where it is not drawn), n_words.

    ``percent`` of the documents with ``least_words`` words are drawn, by the highest scores, ties to the smaller id.
    """
    gain = gains(bucket_counts(docs, text_col, runs, buckets), bucket_counts(target, target_col, runs, buckets))
    rows = written(scored(docs, gain, id_col, text_col, runs, seed), "scores")
    able = rows.where(F.col("n_words") >= least_words)
    total = able.count()
    wanted = percent * total // 100
    columns = ("doc_id", "n_features", "weight", "score", "rank", "n_words")
    if not wanted:
        return rows.withColumn("rank", F.lit(None).cast("long")).select(*columns)
    s, d, r = cutoff(able, total, wanted, margin)
    last = _key(F.lit(s).cast("long"), F.lit(d).cast("long"), F.lit(r).cast("long"))
    drawn = (F.col("n_words") >= least_words) & (_key(F.col("score"), F.col("doc_id"), F.col("row")) <= last)
    at, before = placed(rows.where(drawn), "drawn")
    starts = small_table(docs.sparkSession, part=(pa.int32(), list(before)), before=(pa.int64(), list(before.values())))
    ranked = at.join(F.broadcast(starts), "part").withColumn("rank", F.col("before") + F.col("place") + 1)
    return ranked.select(*columns).unionAll(rows.where(~drawn).withColumn("rank", F.lit(None).cast("long")).select(*columns))


# crc-32 of a word from its bytes, by the table of the polynomial 0xEDB88320
_SQL_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_CRC_STEP = "CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END"


def _nested(times: int) -> str:
    """The table entry of byte c: the step applied eight times, as a chain of columns."""
    inner = "SELECT range AS byte, range::BIGINT AS c FROM range(256)"
    for _ in range(times):
        inner = f"SELECT byte, {_CRC_STEP} AS c FROM ({inner})"
    return inner


ORACLE = f"""
WITH crc_table AS (SELECT list(c ORDER BY byte) AS t FROM ({_nested(8)})),
doc_words AS (SELECT doc_id, {_SQL_WORDS} AS ws FROM documents),
goal_words AS (SELECT {_SQL_WORDS} AS ws FROM benchmark),
vocabulary AS (SELECT DISTINCT unnest(ws) AS w FROM (SELECT ws FROM doc_words UNION ALL SELECT ws FROM goal_words)),
hashed AS (
    SELECT w, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(length(hex(encode(w))) // 2),
            lambda i: ('0x' || substr(hex(encode(w)), (2 * i + 1)::BIGINT, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) % {BUCKETS} AS bucket
    FROM vocabulary, crc_table),
doc_buckets AS (SELECT doc_id, bucket FROM (SELECT doc_id, unnest(ws) AS w FROM doc_words) JOIN hashed USING (w)),
s AS (SELECT bucket, count(*) AS s FROM doc_buckets GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM (SELECT unnest(ws) AS w FROM goal_words) JOIN hashed USING (w) GROUP BY bucket),
gain AS (
    SELECT s.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + {BUCKETS})::DOUBLE
        / ((s + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + {BUCKETS})::DOUBLE)))::BIGINT AS gain
    FROM s LEFT JOIN t USING (bucket)),
weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM doc_buckets JOIN gain USING (bucket) GROUP BY doc_id),
scores AS (
    SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight, len(ws)::BIGINT AS n_words,
        coalesce(weight, 0) + floor(-1000 * ln(-ln(
            (('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM doc_words LEFT JOIN weights USING (doc_id)),
ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scores WHERE n_words >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN place <= {PERCENT} * n // 100 THEN place END AS rank, n_words
FROM scores LEFT JOIN ranked USING (doc_id)
"""
