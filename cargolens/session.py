"""Session helpers: shuffle sizing and the shared scratch folder."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_STAGED: dict[str, list[str]] = {}

#: Target bytes per shuffle partition when sizing a job.
PARTITION_BYTES = 32 * 1024 * 1024


def input_bytes(spark: SparkSession, path: str) -> int:
    """Total file size under a path, from the file system's listing."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.getContentSummary(where).getLength()


def tune(spark: SparkSession, path: str | None = None) -> SparkSession:
    """Set the run-time SQL options the jobs rely on.

    Skewed join partitions are split even if that costs a further shuffle.
    With ``path`` the number of shuffle partitions is raised, never lowered,
    so that one holds about 32 MB of the input, as its columns are packed and
    the rows and texts made of them many times that; small ones are merged
    again at run time.
    """
    conf = spark.conf
    conf.set("spark.sql.adaptive.enabled", "true")
    conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    if path:
        wanted = -(-input_bytes(spark, path) // PARTITION_BYTES)
        if wanted > int(conf.get("spark.sql.shuffle.partitions")):
            conf.set("spark.sql.shuffle.partitions", str(wanted))
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder for staged tables that driver and executors share.

    The session's checkpoint folder, or the warehouse where none is named. A
    warehouse on the local disk counts only where all tasks run on one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith("file:") and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{warehouse.rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/cargolens/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the scratch folder and read it back.

    Cuts the lineage and fixes non-deterministic columns, so a lost executor
    re-reads files instead of re-drawing partition ids. ``drop_staged`` frees it.
    The files are packed tightly, as they are written and read once or a few times.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.staged_path = path
    return table


def delete_path(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def names_under(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, from the file system's listing; none where it does not exist."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []


def refuse_occupied(spark: SparkSession, out_dir: str, checkpoint: str) -> None:
    """Stop a stream whose new checkpoint would number its batches from 0 again over earlier output."""
    if names_under(spark, out_dir) and not names_under(spark, checkpoint):
        raise ValueError(f"{out_dir} holds the output of another checkpoint than {checkpoint}")


@contextmanager
def scratch(spark: SparkSession):
    """Frees what is staged inside, once its results are written."""
    known = _STAGED.setdefault(spark.sparkContext.applicationId, [])
    before = set(known)
    try:
        yield
    finally:
        for path in [p for p in known if p not in before]:
            delete_path(spark, path)
            known.remove(path)


def drop_staged(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete these staged tables, or all that this application staged."""
    known = _STAGED.get(spark.sparkContext.applicationId, [])
    for path in [t.staged_path for t in tables] if tables else list(known):
        delete_path(spark, path)
        if path in known:
            known.remove(path)
