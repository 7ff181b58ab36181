"""Line dedup: drop lines whose normalised form occurs in many documents.

DataFrame functions only.  Lines are exploded with their position and the
digest of their key; documents per digest are counted with a map-side
combine; the lines of frequent digests are found by a join on (digest, salt),
so that a line of every third document spreads over ``SALTS`` partitions,
which the adaptive skew join may split further.  Only positions travel in that
join.  They are then collected by document (at most its own lines) and the
text is reassembled from the positions that stay.

Defined cases: null and empty text are one empty line; blank keys are never
dropped; every row is a document of its own when documents are counted; rows
that repeat id and text lose the same lines; an empty table gives an empty
result; other columns pass through ``line_dedup`` under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, SPACE, UPPER, ascii_lower, let

MIN_DOCS = 10
MIN_CHARS = 1
SALTS = 16


def line_digests(text: Column, min_chars: int) -> Column:
    """Per line the digest of its key as hex text; null for keys that are too short."""
    def digest(key: Column) -> Column:
        return F.when(F.char_length(key) >= max(1, min_chars), F.md5(key.cast("binary")))
    return F.transform(F.split(text, "\n"), lambda x: let(ascii_lower(F.btrim(x, F.lit(SPACE))), digest))


def dropped_positions(base: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """(d_id, d_key, dropped): per document the positions of lines found in ``min_docs`` documents or more.

    ``base`` has id, key (a hash of the text; id alone may be null or repeated) and text.
    """
    digests = base.select("id", "key", line_digests(F.col("text"), min_chars).alias("digests"))
    frequent = (digests.select(F.explode(F.array_distinct("digests")).alias("h")).where("h is not null")
                .select(F.unhex("h").alias("h")).groupBy("h").count().where(F.col("count") >= min_docs)
                .select("h", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    lines = (digests.select("id", "key", F.posexplode("digests").alias("pos", "h")).where("h is not null")
             .select("id", "key", "pos", F.unhex("h").alias("h"),
                     F.pmod(F.xxhash64("id", "key"), F.lit(SALTS)).cast("int").alias("salt")))
    hit = lines.join(frequent, ["h", "salt"], "left_semi")
    return hit.groupBy(F.col("id").alias("d_id"), F.col("key").alias("d_key")).agg(F.collect_set("pos").alias("dropped"))


def kept_text(text: Column, dropped: Column) -> Column:
    """The lines at the other positions joined by newlines; linear in the number of lines."""
    def rest(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
        return F.array_join(F.transform(stay, lambda p: F.get(lines, p)), "\n")
    return F.when(dropped.isNull(), text).otherwise(let(F.split(text, "\n"), rest))


def _with_kept(docs: DataFrame, id_col: str, text_col: str, min_docs: int, min_chars: int) -> DataFrame:
    """(row, id, text, dropped): ``row`` is the input row as a struct, so that no column name can clash."""
    base = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    gone = dropped_positions(base.select("id", "key", "text"), min_docs, min_chars)
    return base.join(gone, F.col("id").eqNullSafe(F.col("d_id")) & (F.col("key") == F.col("d_key")), "left")


def line_dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS,
                      min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, kept_sha256."""
    docs = docs.select(id_col, text_col)
    return _with_kept(docs, id_col, text_col, min_docs, min_chars).select(
        F.col("id").alias("doc_id"),
        F.size(F.split("text", "\n")).cast("long").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"),
        F.sha2(kept_text(F.col("text"), F.col("dropped")).cast("binary"), 256).alias("kept_sha256"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars",
               min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """The documents with the remaining lines as text; ``chars_col``, if there, is counted anew.

    A text that loses no line stays as it is, null included.
    """
    got = _with_kept(docs, id_col, text_col, min_docs, min_chars)
    text = F.when(F.col("dropped").isNull(), F.col("row")[text_col]).otherwise(kept_text(F.col("text"), F.col("dropped")))
    cols = []
    for c in docs.columns:
        old = F.col("row")[c]
        if c == text_col:
            old = text
        elif c == chars_col:
            old = F.when(F.col("dropped").isNull(), old).otherwise(F.char_length(text).cast(docs.schema[c].dataType))
        cols.append(old.alias(c))
    return got.select(*cols)


ORACLE = f"""
WITH lines AS (
  SELECT doc_id, u.i AS pos, u.line AS line,
         translate(trim(u.line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) d,
       LATERAL (SELECT unnest(l) AS line, generate_subscripts(l, 1) AS i) u),
frequent AS (SELECT k FROM lines WHERE length(k) >= {MIN_CHARS} GROUP BY k HAVING count(DISTINCT doc_id) >= {MIN_DOCS})
SELECT doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM lines LEFT JOIN frequent f USING (k) GROUP BY doc_id
"""
