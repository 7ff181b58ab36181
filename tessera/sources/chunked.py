"""Chunked n-D array containers as a Spark data source.

``spark.read.format("ndblocks").option("path", root).option("dataset", "em/s4").load()``
returns the block schema with a ``dataset`` column.  The layout is detected
from the dataset's metadata file, following the public format descriptions:

* N5: ``attributes.json`` (``dimensions``, ``blockSize``, ``dataType``,
  ``compression``); chunk ``<dataset>/<gx>/<gy>/<gz>``; big-endian header
  (mode, ndim, cropped block size) then big-endian samples, x fastest.
* Zarr v2: ``.zarray`` (``shape``/``chunks`` slowest axis first, ``dtype``,
  ``compressor``, ``dimension_separator``); chunk key ``gz.gy.gx`` (or with
  ``/``); full-size chunks in C order.

Codecs: raw, gzip and zlib (stdlib); anything else raises a clear error.
A missing chunk is all zero and produces no row; with a Zarr ``fill_value``
other than 0 it produces a filled block.  Zarr filters and datasets of
more than three axes are refused.  ``gx``/``gy``/``gz`` filters are
pushed into the scan (set ``spark.sql.python.filterPushdown.enabled``).

Planning: a small grid is cut into ranges of grid ids sized to ``partition_bytes``.  For a large one (``INDEX_CELLS``) a
Spark job lists the chunks that are stored and writes an index, dealt into partitions by their bytes; the driver
reads one line a partition, a task the keys of its own.

``save_blocks`` replaces a dataset, metadata included, as a whole:

* where folders can be renamed (local, HDFS) tasks write into a staging folder, and the commit moves the old dataset out
  and the new one in.  A note says how far it got, so a commit that was cut off is finished by whoever opens or writes the dataset next;
* elsewhere (object stores) tasks write the final keys of a new version ``<dataset>/v-<id>``, a complete
  dataset, and the commit writes one file, ``<dataset>/current.json``, which names it.  No chunk is moved; older versions
  stay readable for whoever has opened them, until ``drop_old_versions``.

So a rewrite leaves no stale chunk and a failed job no half
dataset.  A retried task rewrites the same chunks.  ``skip_empty`` leaves
all-zero chunks unwritten (A10).  ``save_many`` writes several datasets in one job.

Roots are plain paths or URIs that ``pyarrow.fs`` opens (``file:``, ``s3:``,
``gs:``, ``hdfs:``), on the driver and on the executors.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import math
import os
import re
import struct
import uuid
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.dataset as pads
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, GreaterThan,
                                    GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual,
                                    WriterCommitMessage)

from ..session import BATCH_BYTES, bound_batches
from ..volume import DTYPES, VolumeMeta, dtype_of

SCHEMA = ("dataset string, gx bigint, gy bigint, gz bigint, ox bigint, oy bigint, oz bigint, "
          "sx int, sy int, sz int, payload binary")

ARROW_SCHEMA = pa.schema([("dataset", pa.string()), *[(c, pa.int64()) for c in ("gx", "gy", "gz", "ox", "oy", "oz")],
                          *[(c, pa.int32()) for c in ("sx", "sy", "sz")], ("payload", pa.binary())])

PART_CHUNKS = 1024  # chunks of a scan partition at most, about: opening a file costs time whatever its size
LIST_FOLDERS = 64  # folders that a task lists
LIST_ROWS = 20_000  # chunks of a listing that a task holds

INDEX_CELLS = 10_000  # grids with more cells are planned from the chunks that are stored
CURRENT = "current.json"  # names the version of a dataset that is published by versions


# ------------------------------------------------------------------ storage

class Store:
    """Files under a root, by relative path."""

    def __init__(self, root: str):
        if "://" in root or root.startswith("file:"):
            self.fs, self.base = pafs.FileSystem.from_uri(root)
        else:
            self.fs, self.base = pafs.LocalFileSystem(), os.path.abspath(root)

    @property
    def renames(self) -> bool:
        """Whether a folder can be moved in one step."""
        return self.fs.type_name in ("local", "hdfs")

    def at(self, *parts: str) -> str:
        return "/".join([self.base.rstrip("/"), *[p.strip("/") for p in parts if p.strip("/")]])

    def read(self, path: str) -> bytes | None:
        """The file's bytes, or None if there is no such file."""
        if self.fs.get_file_info(path).type != pafs.FileType.File:
            return None
        with self.fs.open_input_stream(path) as f:
            return f.read()

    def write(self, path: str, data: bytes, made: set | None = None) -> None:
        """``made``: folders that the caller has written into before."""
        folder = os.path.dirname(path)
        if made is None or folder not in made:
            self.fs.create_dir(folder, recursive=True)
            if made is not None:
                made.add(folder)
        with self.fs.open_output_stream(path) as f:
            f.write(data)

    def put(self, path: str, data: bytes, made: set | None = None) -> None:
        """A file that is never seen half written, whoever else writes it at the same time."""
        if not self.renames:  # an object appears as a whole
            return self.write(path, data, made)
        tmp = f"{path}.{uuid.uuid4().hex}.tmp"
        self.write(tmp, data, made)
        self.fs.move(tmp, path)

    def json(self, path: str) -> dict | None:
        data = self.read(path)
        return None if data is None else json.loads(data)

    def children(self, path: str) -> list[str]:
        return [os.path.basename(x.path) for x in self.fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))]

    def files(self, path: str) -> list[tuple[str, int]]:
        """(path below ``path``, bytes) of every file in the folder and its subfolders."""
        if self.fs.get_file_info(path).type != pafs.FileType.Directory:
            return []
        found = self.fs.get_file_info(pafs.FileSelector(path, allow_not_found=True, recursive=True))
        return [(x.path[len(path.rstrip("/")) + 1:], x.size) for x in found if x.type == pafs.FileType.File]

    def each_file(self, path: str):
        """``files`` one by one; of a local folder they are never all held."""
        if self.fs.type_name != "local":
            yield from self.files(path)
            return
        todo = [""] if os.path.isdir(path) else []
        while todo:
            below = todo.pop()
            with os.scandir(os.path.join(path, below)) as found:
                for x in found:
                    if x.is_dir():
                        todo.append(f"{below}{x.name}/")
                    elif x.is_file():
                        yield below + x.name, x.stat().st_size

    def folders(self, path: str) -> list[str]:
        found = self.fs.get_file_info(pafs.FileSelector(path, allow_not_found=True))
        return [os.path.basename(x.path) for x in found if x.type == pafs.FileType.Directory]

    def exists(self, path: str) -> bool:
        return self.fs.get_file_info(path).type != pafs.FileType.NotFound

    def remove(self, path: str) -> None:
        kind = self.fs.get_file_info(path).type
        if kind == pafs.FileType.Directory:
            self.fs.delete_dir(path)
        elif kind == pafs.FileType.File:
            self.fs.delete_file(path)


# ------------------------------------------------------------------ metadata

def read_meta(root: str, dataset: str) -> dict:
    """Layout-independent description: dims/block (x first), dtype, codec, layout, separator, fill, attrs, path.

    ``path`` is where the chunks lie: the dataset itself, or its current version.
    """
    finish_publish(root, dataset)
    st = Store(root)
    now = st.json(st.at(dataset, CURRENT))
    return meta_at(root, dataset if now is None else f"{dataset.rstrip('/')}/{now['version']}")


def meta_at(root: str, dataset: str) -> dict:
    """``read_meta`` of what lies at this very path."""
    st = Store(root)
    z = st.json(st.at(dataset, ".zarray"))
    if z is not None:
        if z.get("filters"):
            raise NotImplementedError(f"{dataset}: Zarr filters {z['filters']} are not supported")
        dt = np.dtype(z["dtype"])
        comp = z.get("compressor")
        out = {"layout": "zarr", "dims": list(reversed(z["shape"])), "block": list(reversed(z["chunks"])),
               "dtype": dt.name, "byteorder": "<" if dt.byteorder in "<|=" else ">",
               "codec": "raw" if comp is None else comp.get("id"), "sep": z.get("dimension_separator", "."),
               "order": z.get("order", "C"), "fill": _fill(z.get("fill_value"), dt),
               "attrs": st.json(st.at(dataset, ".zattrs")) or {}}
    else:
        a = st.json(st.at(dataset, "attributes.json"))
        if a is None:
            raise FileNotFoundError(f"no attributes.json or .zarray under {st.at(dataset)}")
        if "dimensions" not in a:
            raise ValueError(f"{st.at(dataset)} is an N5 group, not a dataset")
        comp = a.get("compression", {"type": "raw"})
        codec = comp.get("type", "raw")
        if codec == "gzip" and comp.get("useZlib"):
            codec = "zlib"
        if a["dataType"] not in DTYPES:
            raise NotImplementedError(f"{dataset}: data type {a['dataType']!r} is not supported")
        out = {"layout": "n5", "dims": a["dimensions"], "block": a["blockSize"], "dtype": a["dataType"],
               "byteorder": ">", "codec": codec, "sep": "/", "fill": 0, "attrs": a}
    if len(out["dims"]) > 3:
        raise ValueError(f"{dataset} has {len(out['dims'])} axes; up to three are supported")
    return out | {"path": dataset}


def _fill(value, dt: np.dtype):
    """A Zarr fill value in its own type: integers stay whole, floats may be NaN or infinite (by name)."""
    if value is None:
        return 0
    return int(value) if dt.kind in "iu" else float(value)


def _pad3(v, fill):
    v = list(v)
    return v + [fill] * (3 - len(v))


def write_meta(root: str, dataset: str, meta: VolumeMeta, block, layout: str = "n5", codec: str = "raw",
               sep: str = ".", attrs: dict | None = None) -> None:
    """The dataset's metadata, with the volume's own number of axes and the given attributes."""
    nd = meta.stored_rank
    dims, blk = list(meta.dims)[:nd], list(block)[:nd]
    st = Store(root)

    def put(path: str, content: dict) -> None:
        st.write(path, json.dumps(content).encode())
    if layout == "n5":
        if st.read(st.at("attributes.json")) is None:
            put(st.at("attributes.json"), {"n5": "4.0.0"})
        comp = {"type": "raw"} if codec == "raw" else {"type": "gzip", "level": -1, "useZlib": codec == "zlib"}
        out = dict(attrs or {})
        out.update({"dimensions": dims, "blockSize": blk, "dataType": meta.dtype, "compression": comp})
        put(st.at(dataset, "attributes.json"), out)
    elif layout == "zarr":
        if st.read(st.at(".zgroup")) is None:
            put(st.at(".zgroup"), {"zarr_format": 2})
        comp = None if codec == "raw" else {"id": codec, "level": 5} if codec in ("gzip", "zlib") else {"id": codec}
        put(st.at(dataset, ".zarray"), {
            "zarr_format": 2, "shape": list(reversed(dims)), "chunks": list(reversed(blk)),
            "dtype": np.dtype(dtype_of(meta.dtype).numpy).str, "compressor": comp, "fill_value": 0,
            "order": "C", "filters": None, "dimension_separator": sep})
        own = {k: v for k, v in (attrs or {}).items() if k not in ("dimensions", "blockSize", "dataType", "compression")}
        if own:
            put(st.at(dataset, ".zattrs"), own)
    else:
        raise ValueError(f"unknown layout {layout!r}")


OWN_FILES = re.compile(r"attributes\.json|\.zarray|\.zattrs|current\.json|v-[0-9a-f]{32}|\d+(\.\d+)*")
ROOT_FILES = ("attributes.json", ".zgroup")  # metadata of the root group


def _note(st: Store, dataset: str) -> str:
    return st.at(f".publish-{hashlib.sha1(dataset.strip('/').encode()).hexdigest()[:20]}.json")


def publish(root: str, stage: str, dataset: str) -> None:
    """Replace the dataset by the staged one, by moving folders; other datasets below it stay."""
    st = Store(root)
    there = st.children(st.at(dataset))
    whole = bool(dataset.strip("/")) and all(OWN_FILES.fullmatch(n) for n in there)
    note = {"stage": stage, "dataset": dataset, "whole": whole, "step": "out"}
    st.put(_note(st, dataset), json.dumps(note).encode())
    _go_on(st, note)


def finish_publish(root: str, dataset: str) -> None:
    """Finish a commit that was cut off between the old dataset and the new one."""
    st = Store(root)
    if st.renames:
        note = st.json(_note(st, dataset))
        if note is not None:
            _go_on(st, note)


def _go_on(st: Store, note: dict) -> None:
    """The steps of a commit from the one that the note names; each may have been done in part."""
    dataset = note["dataset"]
    new, final, old = st.at(note["stage"], dataset), st.at(dataset), st.at(f"{note['stage']}-old")
    if note["step"] == "out":
        if note["whole"]:
            if st.exists(final):
                st.fs.move(final, old)
        else:
            st.fs.create_dir(old, recursive=True)
            for n in sorted(st.children(final)):
                if OWN_FILES.fullmatch(n):
                    st.fs.move(f"{final}/{n}", f"{old}/{n}")
        note = note | {"step": "in"}
        st.put(_note(st, dataset), json.dumps(note).encode())
    if st.exists(new):
        st.fs.create_dir(os.path.dirname(final), recursive=True)
        if note["whole"]:
            st.fs.move(new, final)
        else:
            st.fs.create_dir(final, recursive=True)
            for n in sorted(st.children(new), key=lambda n: not n[:1].isdigit()):  # chunks first, metadata last
                st.fs.move(f"{new}/{n}", f"{final}/{n}")
    _root_files(st, note["stage"])
    st.remove(old)
    st.remove(st.at(note["stage"], dataset))
    st.remove(_note(st, dataset))


def _root_files(st: Store, stage: str) -> None:
    for n in ROOT_FILES:
        data = st.read(st.at(stage, n))
        if data is not None and st.read(st.at(n)) is None:
            st.write(st.at(n), data)


def publish_version(root: str, dataset: str, version: str) -> None:
    """Make a written version the dataset's content: one file."""
    st = Store(root)
    st.put(st.at(dataset, CURRENT), json.dumps({"version": version}).encode())


def drop_old_versions(spark: SparkSession, root: str, dataset: str) -> int:
    """Delete everything of the dataset but its current version, in a Spark job; gives the number of files."""
    st = Store(root)
    now = (st.json(st.at(dataset, CURRENT)) or {}).get("version")
    if now is None:
        return 0
    stale = [n for n in st.children(st.at(dataset)) if OWN_FILES.fullmatch(n) and n not in (CURRENT, now)]
    parts = [(f"{v}/{n}",) for v in stale if v.startswith("v-") for n in st.children(st.at(dataset, v))] \
        + [(n,) for n in stale if not n.startswith("v-")]

    def drop(it):
        store = Store(root)
        for pdf in it:
            for part in pdf["part"]:
                path = store.at(dataset, part)
                n = len(store.files(path)) or int(store.exists(path))
                store.remove(path)
                yield pd.DataFrame({"n": [n]})
    if not parts:
        return 0
    n = spark.createDataFrame(parts, "part string").repartition(min(len(parts), 10_000), "part").mapInPandas(drop, "n long") \
        .agg(F.sum("n")).first()[0]
    for v in stale:
        st.remove(st.at(dataset, v))
    return int(n)


# ------------------------------------------------------------------ chunk codec

def _decompress(data: bytes, codec: str) -> bytes:
    if codec == "raw":
        return data
    if codec == "gzip":
        return gzip.decompress(data)
    if codec == "zlib":
        return zlib.decompress(data)
    raise NotImplementedError(f"chunk codec {codec!r} is not supported (raw, gzip, zlib are)")


def _compress(data: bytes, codec: str) -> bytes:
    if codec == "raw":
        return data
    if codec == "gzip":
        return gzip.compress(data, mtime=0)
    if codec == "zlib":
        return zlib.compress(data)
    raise NotImplementedError(f"chunk codec {codec!r} is not supported (raw, gzip, zlib are)")


def chunk_key(m: dict, g) -> str:
    nd = len(m["dims"])
    g = [str(int(v)) for v in list(g)[:nd]]
    return "/".join(g) if m["layout"] == "n5" else m["sep"].join(reversed(g))


def decode_chunk(raw: bytes, m: dict, size) -> np.ndarray:
    """Chunk bytes -> array (numpy axes z, y, x) of the cropped block ``size`` (x first)."""
    nd = len(m["dims"])
    dt = np.dtype(m["dtype"]).newbyteorder(m["byteorder"])
    if m["layout"] == "n5":
        mode, ndim = struct.unpack(">HH", raw[:4])
        shape = struct.unpack(">" + "I" * ndim, raw[4:4 + 4 * ndim])
        off = 4 + 4 * ndim + (4 if mode == 1 else 0)
        data = _decompress(raw[off:], m["codec"])
        a = np.frombuffer(data, dtype=dt, count=int(np.prod(shape))).reshape(tuple(reversed(shape)))
    else:
        data = _decompress(raw, m["codec"])
        full = tuple(reversed(m["block"]))
        order = "F" if m.get("order") == "F" else "C"
        a = np.frombuffer(data, dtype=dt).reshape(full, order=order)
        a = a[tuple(slice(0, s) for s in reversed(list(size)[:nd]))]
    a = a.astype(dt.newbyteorder("<"), copy=False)
    return a.reshape(tuple(reversed(_pad3(list(a.shape)[::-1], 1))))


def encode_chunk(a: np.ndarray, m: dict) -> bytes:
    """Array (numpy axes z, y, x), cropped block -> chunk bytes."""
    nd = len(m["dims"])
    size = list(a.shape)[::-1][:nd]  # x first
    dt = np.dtype(m["dtype"]).newbyteorder(m["byteorder"])
    if m["layout"] == "n5":
        body = np.ascontiguousarray(a, dtype=dt).tobytes()
        head = struct.pack(">HH", 0, nd) + struct.pack(">" + "I" * nd, *size)
        return head + _compress(body, m["codec"])
    full = np.zeros(tuple(reversed(_pad3(m["block"], 1))), dtype=dt)
    full[:a.shape[0], :a.shape[1], :a.shape[2]] = a
    full = full.reshape(tuple(reversed(m["block"])))
    return _compress(full.tobytes(), m["codec"])


# ------------------------------------------------------------------ reader

class _Part(InputPartition):
    def __init__(self, start, end):
        super().__init__((start, end))
        self.start, self.end = start, end


class ChunkReader(DataSourceReader):
    def __init__(self, options):
        self.root = options["path"]
        self.dataset = options.get("dataset", "")
        self.part_bytes = int(options.get("partition_bytes", 128 << 20))
        self.index = options.get("index", "")
        # the version that was current when the dataset was opened is read, whatever is published later
        self.m = meta_at(self.root, options["at"]) if options.get("at") else read_meta(self.root, self.dataset)
        dims, blk = _pad3(self.m["dims"], 1), _pad3(self.m["block"], 1)
        self.counts = [(d + b - 1) // b for d, b in zip(dims, blk)]
        self.box = [[0, c - 1] for c in self.counts]
        self.sets = [None, None, None]

    def _axis_values(self, a):
        lo, hi = self.box[a]
        vals = range(lo, hi + 1)
        return [v for v in vals if v in self.sets[a]] if self.sets[a] is not None else list(vals)

    def _wanted(self, g) -> bool:
        return all(lo <= v <= hi and (s is None or v in s) for v, (lo, hi), s in zip(g, self.box, self.sets))

    def partitions(self):
        if self.index:
            parts = _index(self.index).to_table(columns=["part", *[f"{e}_{a}" for a in "xyz" for e in ("lo", "hi")]]).to_pylist()
            return [_Part(r["part"], None) for r in parts
                    if all(r[f"lo_{a}"] <= hi and lo <= r[f"hi_{a}"] for a, (lo, hi) in zip("xyz", self.box))] or [_Part(0, 0)]
        n = math.prod(len(self._axis_values(a)) for a in range(3))
        blk = _pad3(self.m["block"], 1)
        bpp = max(1, min(PART_CHUNKS, self.part_bytes // max(1, math.prod(blk) * np.dtype(self.m["dtype"]).itemsize)))
        return [_Part(s, min(n, s + bpp)) for s in range(0, n, bpp)] or [_Part(0, 0)]

    def _keys(self, partition):
        """Grid positions of a partition."""
        if partition.end is None:
            rows = _index(self.index).to_table(columns=["keys"], filter=pads.field("part") == partition.start).to_pylist()
            yield from (g for r in rows for k in r["keys"] if self._wanted(g := (k["gx"], k["gy"], k["gz"])))
            return
        vx, vy, vz = (self._axis_values(a) for a in range(3))
        for i in range(partition.start, partition.end):
            yield vx[i % len(vx)], vy[(i // len(vx)) % len(vy)], vz[i // (len(vx) * len(vy))]

    def read(self, partition):
        """Record batches of about ``BATCH_BYTES``; rows as such would be put into batches by their number alone."""
        out, held = [], 0
        for row in self._rows(partition):
            out.append(row)
            held += len(row[-1]) + 64
            if held > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), ARROW_SCHEMA)], schema=ARROW_SCHEMA)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), ARROW_SCHEMA)], schema=ARROW_SCHEMA)

    def _rows(self, partition):
        dims, blk = _pad3(self.m["dims"], 1), _pad3(self.m["block"], 1)
        st = Store(self.root)
        for g in self._keys(partition):
            data = st.read(st.at(self.m["path"], chunk_key(self.m, g)))
            if data is None and not self.m["fill"]:
                continue
            o = [g[d] * blk[d] for d in range(3)]
            s = [min(blk[d], dims[d] - o[d]) for d in range(3)]
            a = np.full(s[::-1], self.m["fill"], self.m["dtype"]) if data is None else decode_chunk(data, self.m, s)
            yield (self.dataset, g[0], g[1], g[2], o[0], o[1], o[2], s[0], s[1], s[2],
                   np.ascontiguousarray(a).tobytes())


def _index(path: str):
    st = Store(path)
    return pads.dataset(st.at(), filesystem=st.fs, format="parquet")


class PrunedChunkReader(ChunkReader):
    """Reader with grid-key filter push-down (needs spark.sql.python.filterPushdown.enabled)."""

    def pushFilters(self, filters):
        axes = {"gx": 0, "gy": 1, "gz": 2}
        for f in filters:
            col = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            a = axes.get(col)
            if a is None:
                yield f
                continue
            lo, hi = self.box[a]
            if isinstance(f, EqualTo):
                lo, hi = max(lo, int(f.value)), min(hi, int(f.value))
            elif isinstance(f, GreaterThan):
                lo = max(lo, math.floor(f.value) + 1)
            elif isinstance(f, GreaterThanOrEqual):
                lo = max(lo, math.ceil(f.value))
            elif isinstance(f, LessThan):
                hi = min(hi, math.ceil(f.value) - 1)
            elif isinstance(f, LessThanOrEqual):
                hi = min(hi, math.floor(f.value))
            elif isinstance(f, In):
                vals = {int(v) for v in f.value if v is not None}
                self.sets[a] = vals if self.sets[a] is None else self.sets[a] & vals
            else:
                yield f
                continue
            self.box[a] = [lo, hi]


# ------------------------------------------------------------------ writer

class _Done(WriterCommitMessage):
    def __init__(self, written, skipped):
        self.written, self.skipped = written, skipped


class ChunkWriter(DataSourceWriter):
    """Rows go to the dataset that they name; ``stage`` or ``version`` says where its chunks are written (see the module)."""

    def __init__(self, options):
        self.root = options["path"]
        self.datasets = json.loads(options["datasets"])
        self.stage, self.version = options.get("stage", ""), options.get("version", "")
        self.skip_empty = options.get("skip_empty", "true").lower() == "true"

    def place(self, dataset: str) -> str:
        return f"{dataset.rstrip('/')}/{self.version}" if self.version else f"{self.stage}/{dataset}"

    def write(self, rows):
        st, metas, made = Store(self.root), {}, set()
        written = skipped = 0
        for r in rows:
            d = r["dataset"]
            if d not in metas:
                metas[d] = meta_at(self.root, self.place(d))
            m = metas[d]
            a = np.frombuffer(r["payload"], dtype=np.dtype(dtype_of(m["dtype"]).numpy)).reshape(r["sz"], r["sy"], r["sx"])
            if self.skip_empty and not a.any():
                skipped += 1
                continue
            st.put(st.at(self.place(d), chunk_key(m, (r["gx"], r["gy"], r["gz"]))), encode_chunk(a, m), made)
            written += 1
        return _Done(written, skipped)

    def commit(self, messages):
        for d in self.datasets:
            if self.version:
                publish_version(self.root, d, self.version)
            else:
                publish(self.root, self.stage, d)
        if self.stage:
            st = Store(self.root)
            st.remove(st.at(self.stage))

    def abort(self, messages):
        if self.stage:  # a version that was not published is never read; drop_old_versions deletes it
            st = Store(self.root)
            st.remove(st.at(self.stage))


class ChunkedArraySource(DataSource):
    """``format("ndblocks")``: N5 / Zarr v2 chunked arrays as block rows."""

    @classmethod
    def name(cls):
        return "ndblocks"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        if self.options.get("pushdown", "false").lower() == "true":
            return PrunedChunkReader(self.options)
        return ChunkReader(self.options)

    def writer(self, schema, overwrite):
        return ChunkWriter(self.options)


def register(spark: SparkSession) -> None:
    """Register the source, switch on Python filter push-down and bound Arrow batches (runtime SQL settings)."""
    bound_batches(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ChunkedArraySource)


# ------------------------------------------------------------------ helpers

def stored_chunks(spark: SparkSession, root: str, dataset: str, m: dict | None = None) -> DataFrame:
    """``gx, gy, gz, bytes`` of the chunks that are stored, listed in a Spark job.

    A task lists some folders of the first axis of the keys; a layout whose chunks lie side by side in one folder is one listing.
    """
    m = m or read_meta(root, dataset)
    st, nd = Store(root), len(m["dims"])
    nested = m["layout"] == "n5" or m["sep"] == "/"
    heads = [n for n in st.folders(st.at(m["path"])) if n.isdigit()] if nested and nd > 1 else [""]
    sep = "/" if nested else m["sep"]

    def run(it):
        store = Store(root)
        for pdf in it:
            for head in pdf["head"]:
                rows = []
                for name, size in store.each_file(store.at(m["path"], head)):
                    key = (f"{head}/{name}" if head else name).split(sep)
                    if len(key) == nd and all(k.isdigit() for k in key):
                        g = [int(k) for k in key]
                        rows.append((*_pad3(g if m["layout"] == "n5" else g[::-1], 0), size))
                    if len(rows) >= LIST_ROWS:
                        yield pd.DataFrame(rows, columns=["gx", "gy", "gz", "bytes"])
                        rows = []
                yield pd.DataFrame(rows, columns=["gx", "gy", "gz", "bytes"])

    tasks = min(len(heads), max(spark.sparkContext.defaultParallelism, len(heads) // LIST_FOLDERS))  # every task reports to the driver
    df = spark.createDataFrame([(h,) for h in heads], "head string").repartition(max(1, tasks), "head")
    return df.mapInPandas(run, "gx long, gy long, gz long, bytes long")


def write_index(spark: SparkSession, root: str, dataset: str, m: dict, part_bytes: int) -> str:
    """An index of the stored chunks in the shared checkpoint folder: partition, its box of grid positions, its keys.

    Chunks are counted in the order z, y, x: sums inside a slab of the grid, and one number a slab before it.
    """
    from ..session import cut_lineage, ensure_checkpoint_dir
    found = cut_lineage(stored_chunks(spark, root, dataset, m))  # listed once
    found = found.withColumn("bytes", F.col("bytes") + F.lit(part_bytes // PART_CHUNKS))  # what opening a chunk is worth
    slabs = found.groupBy("gz").agg(F.sum("bytes").alias("b"))
    before = slabs.select("gz", (F.sum("b").over(Window.orderBy("gz")) - F.col("b")).alias("before"))
    at = F.sum("bytes").over(Window.partitionBy("gz").orderBy("gy", "gx")) - F.col("bytes")
    part = F.floor((F.col("before") + F.col("at")) / F.lit(part_bytes)).cast("long")
    grid = [F.min(g).alias(f"lo_{g[1]}") for g in ("gx", "gy", "gz")] + [F.max(g).alias(f"hi_{g[1]}") for g in ("gx", "gy", "gz")]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tessera-index-{uuid.uuid4().hex}"
    (found.withColumn("at", at).join(before, "gz").withColumn("part", part)
     .groupBy("part").agg(*grid, F.collect_list(F.struct("gx", "gy", "gz")).alias("keys"))
     .repartitionByRange("part").sortWithinPartitions("part").write.parquet(path))
    return path


def open_blocks(spark: SparkSession, root: str, dataset: str, index: bool | None = None, partition_bytes: int = 128 << 20):
    """A1/A2/A3: open a dataset lazily as a BlockVolume (metadata read once, on the driver).

    ``index``: plan from the chunks that are stored instead of the grid's cells (None: for large grids)."""
    from ..operators.blocks import BlockVolume
    register(spark)
    m = read_meta(root, dataset)
    dims, blk = tuple(_pad3(m["dims"], 1)), tuple(_pad3(m["block"], 1))
    pushdown = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    read = (spark.read.format("ndblocks").option("path", root).option("dataset", dataset)
            .option("pushdown", pushdown).option("partition_bytes", str(partition_bytes)))
    if m["path"] != dataset:
        read = read.option("at", m["path"])
    if index is None:
        index = math.prod(-(-n // b) for n, b in zip(dims, blk)) > INDEX_CELLS
    if index and not m["fill"]:  # with a fill value every cell has a block
        read = read.option("index", write_index(spark, root, dataset, m, partition_bytes))
    meta = VolumeMeta(dims, m["dtype"], attrs=m["attrs"], rank=len(m["dims"]))
    return BlockVolume(read.load().drop("dataset"), meta, blk)


def save_many(df: DataFrame, root: str, datasets: dict[str, tuple[VolumeMeta, tuple]], layout: str = "n5", codec: str = "raw",
              sep: str = ".", skip_empty: bool = True, attrs: dict | None = None, versions: bool | None = None) -> None:
    """Write several datasets in one job: the block columns and ``dataset``, which names one of ``datasets`` (metadata, block size).

    ``versions``: publish by a version file instead of moving folders (None: where the store cannot move folders)."""
    if versions is None:
        versions = not Store(root).renames
    run = uuid.uuid4().hex
    where = {"version": f"v-{run}"} if versions else {"stage": f".stage-{run}"}
    base = root.rstrip("/")
    for name, (meta, block) in datasets.items():
        if versions:
            write_meta(base, f"{name.rstrip('/')}/v-{run}", meta, block, layout, codec, sep, attrs)
        else:
            finish_publish(base, name)
            write_meta(f"{base}/.stage-{run}", name, meta, block, layout, codec, sep, attrs)
    register(df.sparkSession)
    out = df.select("dataset", "gx", "gy", "gz", "ox", "oy", "oz", "sx", "sy", "sz", "payload").write.format("ndblocks").mode("append") \
        .option("path", root).option("datasets", json.dumps(list(datasets))).option("skip_empty", str(skip_empty).lower())
    for k, v in where.items():
        out = out.option(k, v)
    out.save()


def save_blocks(bv, root: str, dataset: str, layout: str = "n5", codec: str = "raw", sep: str = ".",
                block=None, skip_empty: bool = True, attrs: dict | None = None, versions: bool | None = None) -> None:
    """Write a BlockVolume as a dataset (re-blocked to ``block`` first if needed), replacing an older one.

    The dataset has the volume's ``stored_rank`` axes."""
    from ..operators.blocks import retile
    block = tuple(block or bv.block)
    if tuple(bv.block) != block:
        bv = retile(bv, block)
    save_many(bv.df.withColumn("dataset", F.lit(dataset)), root, {dataset: (bv.meta, block)}, layout, codec, sep, skip_empty, attrs, versions)
