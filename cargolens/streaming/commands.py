"""Keyed state kept up to date from arriving command files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from cargolens.operators import state_store
from cargolens.operators.commands import Feed, parse_commands
from cargolens.session import refuse_occupied, scratch
from cargolens.sources.commits import published

COMMAND_SCHEMA = "seq long, method string, payload string"


def apply_batch(batch: DataFrame, batch_id: int, base: DataFrame, out_dir: str, feed: Feed) -> None:
    """Batch n goes from manifest n to n+1; a retry repeats exactly that, or nothing where n+1 is there."""
    spark = batch.sparkSession
    with scratch(spark):
        if batch_id == 0:
            state_store.start_store(spark, out_dir, base, feed)
        ok, rejects = parse_commands(batch, feed)

        def write_replies(statuses: DataFrame) -> None:
            replies = statuses.unionByName(rejects.select("seq", "method", "status"))
            replies.write.mode("overwrite").parquet(f"{out_dir}/replies/batch_id={batch_id}")

        state_store.apply_batch(ok, batch_id, out_dir, feed, write_replies)
    state_store.tidy(spark, out_dir)


def versions(spark: SparkSession, out_dir: str) -> list[int]:
    """Numbers of the states that can be read: as many batches are in them."""
    return published(spark, state_store.manifests(out_dir))


def upsert_stream(
    spark: SparkSession, in_dir: str, base: DataFrame, out_dir: str, checkpoint: str, feed: Feed, files_per_batch: int = 1000
) -> StreamingQuery:
    """Apply all command files not seen before, then stop.

    A batch rewrites the buckets of its keys. The order in which files arrive
    does not matter to the state. A new checkpoint needs a new output folder.
    """
    refuse_occupied(spark, out_dir, checkpoint)
    source = (
        spark.readStream.schema(COMMAND_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(in_dir)
    )
    return (
        source.writeStream.foreachBatch(lambda df, n: apply_batch(df, n, base, out_dir, feed))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_state(spark: SparkSession, out_dir: str) -> DataFrame:
    """The state after the newest committed batch."""
    return state_store.read_state(spark, out_dir)
