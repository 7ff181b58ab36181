"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir, ship_package

# ASCII white space of the contracts: [\x20\x09-\x0D]
SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the package is shipped to the executors on the way."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_table(spark: SparkSession, **columns: tuple[pa.DataType, list]) -> DataFrame:
    """A few rows known at the driver, handed over as Arrow (no Python worker reads them)."""
    return spark.createDataFrame(pa.table({c: pa.array(values, kind) for c, (kind, values) in columns.items()}))


WRITTEN: list[str] = []  # paths of the tables that ``written`` has made in this process


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again.

    Cuts the lineage with a table that survives lost executors and that can
    be read with column pruning.  Whoever has written out a result may drop what
    was made for it with ``drop_written``; what is left goes when the driver ends.
    """
    spark = df.sparkSession
    if not WRITTEN:
        atexit.unregister(_drop_rest)
        atexit.register(_drop_rest, spark)
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_written(spark: SparkSession, paths: list[str]) -> None:
    """Delete tables that nothing reads any more."""
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        WRITTEN.remove(p)


def _drop_rest(spark: SparkSession) -> None:
    """At the end of the driver, if its session is still there."""
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        drop_written(spark, list(WRITTEN))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character left as it is."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def words(text: Column) -> Column:
    """Runs of characters outside ASCII white space; null and blank give no words."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return let(t, lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, SPACE_RUN)))


def crc_mod(id_col: Column, m: int) -> Column:
    """crc32 of the id written as text, modulo m (null id: as the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % m
