"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_folders: dict[str, str] = {}
_scopes: list[list[str]] = []


def build_session(app: str = "starkit", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings the operators expect; ``settings`` use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Root for intermediate tables: what the cluster names, or a fresh folder in local mode."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    master = spark.conf.get("spark.master", "")
    if root:
        return root.rstrip("/")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    application = spark.conf.get("spark.app.id", "local")
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="starkit-")
    return _local_folders[application]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/starkit/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    This cuts the lineage in a way that survives lost executors, fixes values that depend on
    how rows were partitioned, and gives the planner the true size of the result.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    if _scopes:
        _scopes[-1].append(path)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(spark: SparkSession, path: str, schema: T.StructType, column: str, buckets: int, fmt: str = "parquet") -> DataFrame:
    """Files that were written in buckets, as a frame that knows it. The table is in the catalog only while it is resolved."""
    name = f"starkit_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} CLUSTERED BY (`{column}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def stage_bucketed(df: DataFrame, label: str, column: str, buckets: int) -> DataFrame:
    """As ``stage``, with rows of one value of ``column`` in one bucket, so that windows, groups and joins on it need no shuffle.

    Each task writes a file for each bucket that it has rows of.
    """
    spark = df.sparkSession
    path, name = fresh_path(spark, label), f"starkit_{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.bucketBy(buckets, column).option("path", path).format("parquet").saveAsTable(name)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


@contextlib.contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that ``stage`` writes inside the block at its end.

    Results must be written or read to the end within the block, as they read those tables. Without a scope, whoever owns the shared folder
    removes them.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
