"""Spark session helpers.

Settings that matter for block-shaped rows: Arrow batches of a few rows (a
256x256x32 double block is 16.8 MB), AQE on so shuffle partitions coalesce and
skewed partitions split at runtime, and the Python data-source filter push-down
switched on so that block sources prune on grid keys.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# An Arrow batch of block rows: a worker holds it a few times over (Arrow, pandas, what it makes of it), and every step of a stage has workers.
BATCH_BYTES = 8 << 20

# Settings applied to every session this package builds.  They are also the
# settings a cluster job should carry; nothing here is local-only.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # block rows are large: Arrow batches are bounded by bytes, not
    # only by the record count, so a batch of payloads stays small in the worker
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
    "spark.sql.python.filterPushdown.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tessera") -> SparkSession:
    """Build (or reuse) a session with the package defaults."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES`` in a session that this package did not build (a runtime SQL setting; a smaller bound stays)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only a local session without it gets a fresh scratch folder; on any
    other master a missing setting is an error, since executors do not share
    a machine's temporary folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh folder under the shared checkpoint folder (never a machine-local temp dir on a cluster).

    The chunked-array source reads and writes plain paths, so on a cluster the
    checkpoint folder must be a shared mount for jobs that go through it.
    """
    import atexit
    import shutil
    import uuid
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        from urllib.parse import urlparse
        base = urlparse(base).path
    elif "://" in base:
        raise ValueError(f"spark.checkpoint.dir {base!r} is not a mounted path; chunked containers are "
                         "read and written with plain paths, so point it at a shared mount")
    d = os.path.join(base, "tessera-" + name, uuid.uuid4().hex)
    os.makedirs(d, exist_ok=True)
    atexit.register(shutil.rmtree, d, ignore_errors=True)  # scratch of this driver process only
    return d


def ship_package(spark: SparkSession) -> None:
    """Make ``tessera`` importable on every executor, whatever the driver's working directory.

    Functions run by ``mapInPandas``/``applyInPandas`` are pickled by
    reference to this package; a zip of it is added with ``addPyFile`` once
    per SparkContext (Spark copies it to each executor).
    """
    sc = spark.sparkContext
    if getattr(sc, "_tessera_shipped", False):
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tessera-pkg-"), "tessera.zip")
    # sources only: the package folder may be read-only, and executors may run another Python
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(pkg):
            for n in sorted(names):
                if n.endswith(".py"):
                    f = os.path.join(folder, n)
                    z.write(f, os.path.join("tessera", os.path.relpath(f, pkg)))
    sc.addPyFile(out)
    sc._tessera_shipped = True
