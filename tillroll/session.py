"""Session settings and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runtime settings the operators rely on.  All of them can be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot join key even where this costs one more exchange further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call sites per column double the time to build a plan from Python.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "tillroll", **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false").config(
        "spark.ui.showConsoleProgress", "false"
    )
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def is_local(spark: SparkSession) -> bool:
    """Whether the session is known to run on one machine; an unknown master counts as a cluster."""
    master = spark.conf.get("spark.master", None) or ""
    return master == "local" or master.startswith("local[")


def durable_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables, named by ``spark.checkpoint.dir``.

    Only a local session (tests, one machine) may fall back to a temporary folder: on a cluster a
    machine-local path would be lost together with its executor.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tillroll-")
    _FOLDERS.append(folder)
    return folder


def materialize(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage of iterative jobs and, unlike a cache, survives the loss of executors.  The
    table stays until ``release`` is called.
    """
    spark = df.sparkSession
    path = run_folder(spark)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def run_folder(spark: SparkSession, name: str = "tillroll") -> str:
    """A new folder for intermediate data of this run, which ``release`` deletes."""
    path = f"{durable_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _FOLDERS.append(path)
    return path


def release(spark: SparkSession) -> int:
    """Delete the intermediate tables of this run; results must have been written or read by then.

    Returns how many folders there were.  To be called when a run ends, not between its steps.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    n = len(_FOLDERS)
    while _FOLDERS:
        path = jvm.org.apache.hadoop.fs.Path(_FOLDERS.pop())
        path.getFileSystem(conf).delete(path, True)
    return n


#: What this process has written and not released.
_FOLDERS: list[str] = []

SMALL_ROWS = 100_000
SMALL_BYTES = 1 << 25


def small(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> DataFrame:
    """A configuration table as local rows, so that joins with it need no exchange of the big side.

    A table with more rows or bytes than the bounds stays what it is and joins like any other.  Where
    columns have no fixed width, bytes are counted before anything is fetched.
    """
    fixed = all(f.dataType.typeName() not in ("string", "binary", "array", "map", "struct") for f in df.schema)
    head = df.limit(max_rows + 1)
    if not fixed:
        row = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
        n, total = head.agg(F.count(F.lit(1)), F.sum(row)).first()
        if n > max_rows or (total or 0) > max_bytes:
            return df
    rows = head.toArrow()
    return df if rows.num_rows > max_rows else df.sparkSession.createDataFrame(rows, df.schema)
