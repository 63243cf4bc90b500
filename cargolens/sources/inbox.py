"""Reading inbound messages; queueing outbound files; the processing log."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cargolens.operators.aggregates import next_id
from cargolens.operators.ordered import serial
from cargolens.session import drop_staged, staged
from cargolens.sources.commits import commit_batch, is_committed, reserve_ids

INBOX = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("source", T.StringType()),
        T.StructField("received_at", T.TimestampNTZType()),
        T.StructField("status", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("json_data", T.StringType()),
        T.StructField("xml_data", T.StringType()),
        T.StructField("other_data", T.StringType()),
        T.StructField("processed_at", T.TimestampNTZType()),
    ]
)


def read_inbox(spark: SparkSession, path: str) -> DataFrame:
    """Inbound messages; a missing status means ``pending``."""
    df = spark.read.schema(INBOX).parquet(path)
    return df.withColumn("status", F.coalesce("status", F.lit("pending")))


def payload_kind() -> Column:
    return (
        F.when(F.col("json_data").isNotNull(), "json")
        .when(F.col("xml_data").isNotNull(), "xml")
        .when(F.col("other_data").isNotNull(), "other")
    )


def processing_log(df: DataFrame, as_of: date, kind: str, extra: dict | None = None) -> DataFrame:
    """One row: run date, number of records, process type."""
    return df.agg(F.count(F.lit(1)).alias("records_processed")).select(
        F.lit(as_of).alias("process_date"),
        "records_processed",
        F.lit(kind).alias("process_type"),
        *[F.lit(v).alias(k) for k, v in (extra or {}).items()],
    )


def to_outbox(
    docs: DataFrame,
    prior: DataFrame | None,
    as_of: datetime,
    prefix: str,
    user: str = "system",
    key: str = "doc_key",
    first: int | None = None,
) -> DataFrame:
    """Queue rows for rendered documents, numbered in the order of their keys.

    Numbers start at ``first``, or after the largest of ``prior``. The latter is
    for one writer at a time; several use ``queue_batch``. Only the keys are
    numbered. The columns are the same for every kind of document; codes that
    one does not have are NULL.
    """
    numbered = docs.join(serial(docs.select(key), [], [key], "_n"), key)
    first = next_id(prior, "file_uid") if first is None else F.lit(first)
    codes = ("company_code", "branch_code", "location_code")
    return numbered.select(
        F.lit(user).alias("create_user"),
        F.lit(as_of).cast("timestamp_ntz").alias("create_date"),
        F.lit(user).alias("run_user"),
        F.lit(as_of).cast("timestamp_ntz").alias("run_date"),
        *[(F.col(c) if c in docs.columns else F.lit(None)).cast("string").alias(c) for c in codes],
        (first + F.col("_n") - 1).alias("file_uid"),
        F.concat(F.lit(prefix), F.col(key).cast("string"), F.lit(".txt")).alias("file_name"),
        F.encode("content", "utf-8").alias("file_content"),
        F.lit("NEW").alias("status"),
        F.lit(0).alias("attempt"),
    )


def queue_batch(
    docs: DataFrame, batch_id: int, out_dir: str, as_of: datetime, prefix: str, user: str = "system", key: str = "doc_key", first: int = 1
) -> DataFrame:
    """Queue a batch of documents beside other writers; its rows.

    The ids are a range that no other writer has, taken from the counter in
    ``out_dir``, whose first one is ``first``. The rows are seen (``committed``)
    once all are written. A batch that was committed is read, not queued again,
    and one that was stopped takes a new range when it is repeated.
    """
    spark = docs.sparkSession
    folder = f"{out_dir}/outbox/batch_id={batch_id}"
    if not is_committed(spark, out_dir, batch_id):
        kept = staged(docs, "documents")
        count = kept.count()
        start = reserve_ids(spark, f"{out_dir}/_ids", count, first) if count else first
        to_outbox(kept, None, as_of, prefix, user, key, start).write.mode("overwrite").parquet(folder)
        commit_batch(spark, out_dir, batch_id, ["outbox"])
        drop_staged(spark, kept)
    return spark.read.parquet(folder)


def render(docs: DataFrame, preview: str | None, prior: DataFrame, as_of: datetime, prefix: str, out: str | None = None):
    """Preview (``None`` or ``Y``) returns the documents and queues nothing;
    otherwise the queue rows are appended to ``out`` and returned."""
    if preview is None or preview == "Y":
        return docs
    queued = to_outbox(docs, prior, as_of, prefix)
    if out:
        queued.write.mode("append").parquet(out)
    return queued
