"""Volumes derived from the driver tables (FIXTURES.md V1-V5).

Each reads the given parquet tables and derives voxels with Spark, so the work
grows with the tables.  Dimensions come from one tiny aggregate (the analogue
of reading a dataset's ``attributes.json``); nothing else reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..volume import Volume, VolumeMeta


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_DIMS: dict = {}


def _cached(sf_dir: str, name: str, compute, *more):
    """Dimensions are metadata of a table file: computed once per (path, modification time)."""
    import os
    path = f"{sf_dir}/{name}.parquet"
    key = (path, os.path.getmtime(path) if os.path.exists(path) else None, compute.__name__, *more)
    if key not in _DIMS:
        _DIMS[key] = compute()
    return _DIMS[key]


def embedding_image(spark: SparkSession, sf_dir: str) -> Volume:
    """V1: x = position in the embedding, y = vec_id, z = 0, v = element (double)."""
    e = _read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    df = e.select(
        F.posexplode("embedding").alias("x", "e"), F.col("vec_id").alias("y")
    ).select(F.col("x").cast("bigint").alias("x"), F.col("y").cast("bigint").alias("y"),
             F.lit(0).cast("bigint").alias("z"), F.col("e").cast("double").alias("v"))
    def embedding_dims():
        r = e.agg(F.max(F.size("embedding")).alias("nx"), F.max("vec_id").alias("ny")).first()
        return (int(r["nx"]), int(r["ny"]) + 1, 1)
    # every embedding has the same length and vec_id runs densely from 0: every voxel has a row
    return Volume(df, VolumeMeta(_cached(sf_dir, "embeddings", embedding_dims), "float64", dense=True))


def embedding_u16(spark: SparkSession, sf_dir: str) -> Volume:
    """V2: V1 quantised to unsigned 16 bit: ``floor((v+1)*32768)``."""
    v1 = embedding_image(spark, sf_dir)
    df = v1.df.select("x", "y", "z", F.floor((F.col("v") + 1.0) * 32768.0).cast("bigint").alias("v"))
    return Volume(df, VolumeMeta(v1.dims, "uint16", dense=True))


def _max_dims(df: DataFrame, sf_dir: str, name: str, **cols) -> tuple:
    """Largest value of each column expression (metadata of the table file)."""
    def largest():
        r = df.agg(*[F.max(c).alias(k) for k, c in cols.items()]).first()
        return tuple(int(r[k]) if r[k] is not None else -1 for k in cols)
    return _cached(sf_dir, name, largest, *cols)


def event_counts(spark: SparkSession, sf_dir: str) -> Volume:
    """V3: x = hour, y = day-1, z = rank of the event type in alphabetic order, v = count(*) — sparse.

    Dims and the type list come from the table.
    """
    ev = _read(spark, sf_dir, "events").select("ts", "event_type")
    hour, day = F.hour("ts").cast("bigint"), (F.dayofmonth("ts") - 1).cast("bigint")

    def event_types():
        return sorted(r["event_type"] for r in ev.select("event_type").distinct().collect())  # a row per type
    types = _cached(sf_dir, "events", event_types)
    nx, ny = _max_dims(ev, sf_dir, "events", hour=hour, day=day)
    rank = F.array_position(F.array(*[F.lit(t) for t in types]), F.col("event_type")) - 1
    df = (ev.select(hour.alias("x"), day.alias("y"), rank.cast("bigint").alias("z"))
          .groupBy("x", "y", "z").agg(F.count(F.lit(1)).alias("v")))
    return Volume(df, VolumeMeta((nx + 1, ny + 1, len(types)), "int64", rank=3))


def _lineitem(spark: SparkSession, sf_dir: str, *more) -> tuple[DataFrame, tuple[int, int, int]]:
    li = _read(spark, sf_dir, "lineitem")
    at = {"x": F.col("l_suppkey").cast("bigint"), "y": (F.col("l_quantity") - 1).cast("bigint"),
          "z": (F.col("l_linenumber") - 1).cast("bigint")}
    dims = tuple(n + 1 for n in _max_dims(li, sf_dir, "lineitem", **at))
    return li.select(*[c.alias(k) for k, c in at.items()], *more), dims


def lineitem_counts(spark: SparkSession, sf_dir: str) -> Volume:
    """V4: x = l_suppkey, y = l_quantity-1, z = l_linenumber-1, v = count(*)."""
    li, dims = _lineitem(spark, sf_dir)
    return Volume(li.groupBy("x", "y", "z").agg(F.count(F.lit(1)).alias("v")), VolumeMeta(dims, "int64", rank=3))


def lineitem_revenue(spark: SparkSession, sf_dir: str) -> Volume:
    """V5: as V4 with v = sum of the extended price in cents (exact BIGINT)."""
    li, dims = _lineitem(spark, sf_dir, F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("c"))
    return Volume(li.groupBy("x", "y", "z").agg(F.sum("c").alias("v")), VolumeMeta(dims, "int64", rank=3))
