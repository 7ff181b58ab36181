"""Container attributes (A4): the metadata of groups and datasets as rows ``(path, key, value, type)``.

``value`` is JSON text and ``type`` the variant schema (``ARRAY<BIGINT>``, ``STRING``, ``OBJECT<...>``).

``list_attributes`` reads N5 files and parses them in Spark.  ``container_attributes`` covers both layouts through a data source of
its own (``format("ndattributes")``), as Spark's file listing skips names with a leading dot.  Both walk groups, reads ``attributes.json``,
``.zgroup``, ``.zarray`` and ``.zattrs`` through the container's store, and do not enter a dataset's numbered folders, so chunks are
never listed (Spark's own listing would send every chunk file's status to the driver).  A partition is a folder of the first level; comparisons of ``path`` with ``=``, ``IN`` and a prefix
(``LIKE 'a/%'``) are pushed into the walk.
"""

from __future__ import annotations

import json
import re
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition, StringStartsWith

from .chunked import CURRENT, Store

FILES = ("attributes.json", ".zgroup", ".zarray", ".zattrs")


def list_attributes(spark: SparkSession, root: str, names=("attributes.json",)) -> DataFrame:
    """N5 attributes of every group and dataset under ``root``; a task walks the groups of a folder of the first level.

    As in Spark's listing, names that start with a dot or an underscore are left out and paths are URI-encoded."""
    st = Store(root)
    above = root.rstrip("/") if "://" in root and not root.startswith("file:") else st.at()

    def walk(it):
        store = Store(root)
        for pdf in it:
            for head, deep in zip(pdf["head"], pdf["deep"]):
                todo = [head]
                while todo:
                    path, dataset = todo.pop(), False
                    for name in {*names, "attributes.json"}:
                        data = store.read(store.at(path, name))
                        if data is None:
                            continue
                        text = data.decode()
                        dataset |= name == "attributes.json" and "dimensions" in json.loads(text)
                        if name in names and not name.startswith((".", "_")):
                            file = "/".join(x for x in (above, path, name) if x)
                            yield pd.DataFrame({"file": [re.sub(r'[ "#%<>?\[\\\]^`{|}]', lambda m: quote(m[0]), file)], "value": [text]})
                    if deep:
                        dataset = dataset or store.exists(store.at(path, ".zarray"))
                        todo += [f"{path}/{n}" for n in store.folders(store.at(path)) if not (n.startswith((".", "_")) or dataset and n.isdigit())]

    heads = [("", False), *((n, True) for n in sorted(st.folders(st.at())) if not n.startswith((".", "_")))]
    df = spark.createDataFrame(heads, "head string, deep boolean").repartition(min(len(heads), 1000), "head") \
        .mapInPandas(walk, "file string, value string").select("file", F.parse_json("value").alias("j"))
    df.createOrReplaceTempView("_tessera_attr_files")
    return spark.sql("""
        SELECT regexp_replace(regexp_replace(file, '^file:', ''), '/[^/]*$', '') AS path,
               e.key AS key, to_json(e.value) AS value, schema_of_variant(e.value) AS type
        FROM _tessera_attr_files, LATERAL variant_explode(j) AS e""")


def get_attribute(attrs: DataFrame, key: str, spark_type: str) -> DataFrame:
    """Typed read of one key per path, e.g. ``get_attribute(a, 'dimensions', 'array<bigint>')``."""
    return attrs.filter(F.col("key") == key).select(
        "path", F.expr(f"variant_get(parse_json(value), '$', '{spark_type}')").alias(key))


class AttributeReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"]
        self.paths, self.prefix = None, ""  # what the pushed filters leave

    def pushFilters(self, filters):
        for f in filters:
            if getattr(f, "attribute", None) != ("path",):
                yield f
            elif isinstance(f, (EqualTo, In)):
                found = {f.value} if isinstance(f, EqualTo) else {v for v in f.value if v is not None}
                self.paths = found if self.paths is None else self.paths & found
            elif isinstance(f, StringStartsWith):
                if f.value.startswith(self.prefix):
                    self.prefix = f.value
                elif not self.prefix.startswith(f.value):
                    self.paths = set()
            else:
                yield f

    def _may_hold(self, path: str) -> bool:
        """Whether the folder or one below it may be asked for."""
        below = f"{path}/" if path else ""
        if not (below.startswith(self.prefix) or self.prefix.startswith(below)):
            return path.startswith(self.prefix)
        return self.paths is None or any(p == path or p.startswith(below) for p in self.paths)

    def _asked(self, path: str) -> bool:
        return path.startswith(self.prefix) and (self.paths is None or path in self.paths)

    def partitions(self):
        first = [n for n in Store(self.root).folders(Store(self.root).at()) if not n.startswith(".") and self._may_hold(n)]
        return [InputPartition(("", False)), *(InputPartition((n, True)) for n in sorted(first))]

    def read(self, partition):
        st, (path, deep) = Store(self.root), partition.value
        todo = [path]
        while todo:
            path = todo.pop()
            at = path
            now = st.json(st.at(path, CURRENT)) if path else None
            if now is not None:  # published by versions: what the current one says
                at = f"{path}/{now['version']}"
            dataset = now is not None
            for name in FILES:
                found = st.json(st.at(at, name))
                if found is None:
                    continue
                dataset |= name == ".zarray" or "dimensions" in found
                if self._asked(path):
                    yield from ((path, name, k, json.dumps(v, separators=(",", ":"), sort_keys=True)) for k, v in found.items())
            if deep:
                # below a dataset there may be others, but its own numbered folders hold chunks
                todo += [p for n in st.folders(st.at(path)) if not (n.startswith((".", "v-")) or dataset and n.isdigit())
                         and self._may_hold(p := f"{path}/{n}")]


class ContainerAttributes(DataSource):
    """``format("ndattributes")``: ``path`` (below the container), ``file``, ``key``, ``value`` (JSON)."""

    @classmethod
    def name(cls):
        return "ndattributes"

    def schema(self):
        return "path string, file string, key string, value string"

    def reader(self, schema):
        return AttributeReader(self.options)


def container_attributes(spark: SparkSession, root: str) -> DataFrame:
    """Attributes of every group and dataset of an N5 or Zarr container: ``path`` (below the root, '' for it), ``file``, ``key``, ``value``, ``type``."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ContainerAttributes)
    df = spark.read.format("ndattributes").option("path", root).load()
    return df.withColumn("type", F.schema_of_variant(F.parse_json("value")))
