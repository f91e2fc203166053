"""Session helpers: building a session and finding the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "adherence",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """A session for tests and local runs. On a cluster, use the cluster's
    session and size ``spark.sql.shuffle.partitions`` to the data."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, stream state and snapshots.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Where it is unset,
    a local master, as in tests, gets a folder of its own; any other master is
    an error, since its executors would not see such a folder."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="adherence-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir().rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint folder, to go on from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Inside, ``values`` hold where the session has not set them itself."""
    own = {k: v for k, v in values.items() if k not in spark.conf.getAll}
    for k, v in own.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in own:
            spark.conf.unset(k)


#: The shuffle files of a query go when it ends, not when the driver happens to
#: collect its garbage.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder as Parquet, to be read several times."""
    path = work_path(df.sparkSession, "stored", unique=True)
    with settings(df.sparkSession, SHUFFLES_GO):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows written to the shared folder as a bucketed Parquet table, one
    bucket for each shuffle partition: a join or an aggregate on ``keys`` reads
    it as it lies, however often, and shuffles only the other side. ``df`` should
    be hash-partitioned on the keys already, so that a bucket is one file."""
    spark, name = df.sparkSession, f"dealt_{uuid.uuid4().hex[:12]}"
    path = work_path(spark, "stored", unique=True)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    with settings(spark, SHUFFLES_GO):
        df.write.bucketBy(n, *keys).option("path", path).option("compression", "zstd").saveAsTable(name)
    rows = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files of a table with a path stay
    return rows


def work_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path below the shared checkpoint folder (optionally made unique)."""
    base = ensure_checkpoint_dir(spark)
    tail = list(parts)
    if unique:
        tail.append(uuid.uuid4().hex[:12])
    return "/".join([base, "adherence"] + tail)


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in the Python workers (as ``--py-files``
    does): zip it once per SparkContext and ``addPyFile`` it."""
    sc = spark.sparkContext
    if getattr(sc, "_adherence_shipped", False):
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="adherence-pyfiles-"), "adherence.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as zf:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    sc._adherence_shipped = True
