"""Daily shredding of newly arrived messages into the target tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cargolens.operators.xml_shred import cast_rejects, is_malformed, parse_messages, shred, values_shown
from cargolens.session import refuse_occupied, scratch, staged
from cargolens.sources.commits import commit_batch, is_committed
from cargolens.sources.inbox import processing_log

# Fixed value: process type written to the log.
PROCESS_TYPE = "ETI_MANIFEST"


def write_tables(tables: dict[str, DataFrame], base: str, batch_id: int) -> None:
    """Write each table into its own folder, one sub-folder per batch; a repeated batch replaces its sub-folder."""
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{base}/{name}/batch_id={batch_id}")


def shred_batch(batch: DataFrame, batch_id: int, out_dir: str, as_of: datetime) -> None:
    """Write a batch to all tables, then commit it; a batch that was committed is not written again.

    ``sources.commits.committed`` reads the committed batches of a table, so
    the tables change together, and the messages count as processed with them.
    """
    spark = batch.sparkSession
    if is_committed(spark, out_dir, batch_id):
        return
    with scratch(spark):
        tables = shredded(batch, as_of)
        write_tables(tables, out_dir, batch_id)
        commit_batch(spark, out_dir, batch_id, list(tables))


def shredded(batch: DataFrame, as_of: datetime) -> dict[str, DataFrame]:
    """All tables that come of a batch of messages."""
    parsed = parse_messages(batch.select("id", "xml_data"))
    # of a message that parsed in full the values are staged, not its text beside them
    parsed = parsed.withColumn("xml_data", F.when(is_malformed(), F.col("xml_data")))
    parsed = staged(values_shown(parsed, "id", "xml_data"), "messages")
    good, bad = parsed.filter("good"), parsed.filter("bad").select("id", "xml_data")
    stamp = F.lit(as_of).cast("timestamp_ntz").alias("processed_at")
    tables = shred(good, as_of)
    tables["quarantine"] = bad
    tables["cast_rejects"] = cast_rejects(good)
    tables["processed"] = parsed.select("id", F.lit(True).alias("processed"), stamp)
    tables["processing_log"] = processing_log(parsed, as_of.date(), PROCESS_TYPE)
    return tables


def shred_stream(
    spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, as_of: datetime, files_per_batch: int = 1000
) -> StreamingQuery:
    """Shred all messages not seen before, then stop.

    The checkpoint remembers the files that are done; a run without new files
    writes nothing. A new checkpoint needs a new output folder.
    """
    refuse_occupied(spark, out_dir, checkpoint)
    source = (
        spark.readStream.schema("id long, xml_data string, processed boolean")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(in_dir)
        .filter(~F.coalesce("processed", F.lit(False)))
    )
    return (
        source.writeStream.foreachBatch(lambda df, n: shred_batch(df, n, out_dir, as_of))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
