"""Keyed state in buckets, whatever order its commands arrive in.

The state is the outcome of all commands by ``seq``. A store keeps those that
can still matter: per key the last delete, the last upsert, and of earlier
upserts since that delete what an insert would leave (the created fields). A
command that arrives late finds its place among them, so any split of the same
commands into batches, in any order, gives the same state.

Keys are hashed to a fixed number of buckets. A batch rewrites the buckets of
its keys and no others, in a folder of its own; the manifest of the batch names
the live folder of every bucket and is put in place last. Until then readers,
and a retry, see the state before the batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.operators.commands import Feed, command_statuses
from cargolens.session import delete_path, names_under, staged
from cargolens.sources.commits import content_of, publish, published, withdraw

#: Buckets of a new store, and files that the rows of one bucket are written to.
BUCKETS, FILES_PER_BUCKET = 32, 4

#: Place of the rows that a store starts with, before all commands.
AT_START = -(1 << 63)

#: Manifests kept: the newest, and the one that its batch is retried from.
KEPT_MANIFESTS = 2


def manifests(out_dir: str) -> str:
    return f"{out_dir}/manifests"


def live_folders(spark: SparkSession, out_dir: str, kind: str, batch_id: int | None = None, buckets=None) -> list[str]:
    """Folders of ``kind`` (``state`` or ``log``) as of a batch; the newest unless given."""
    numbers = published(spark, manifests(out_dir))
    number = numbers[-1] if batch_id is None else batch_id + 1
    live = content_of(spark, manifests(out_dir), number)["live"]
    wanted = live if buckets is None else [b for b in live if int(b) in buckets]
    return [f"{out_dir}/{kind}/{live[b]}/bucket={b}" for b in wanted]


def read_folders(spark: SparkSession, folders: list[str], schema) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def bucket_of(feed: Feed, buckets: int) -> Column:
    """Rows without a key lie where their ``seq`` falls."""
    own = F.when(F.col(feed.key).isNotNull(), F.xxhash64(feed.key)).otherwise(F.xxhash64("seq"))
    return F.pmod(own, F.lit(buckets)).cast("int").alias("bucket")


def still_matters(log: DataFrame, feed: Feed) -> DataFrame:
    """The commands of ``log`` that a later batch may need, cut to the fields it may need of them."""
    key, seq, method = feed.key, F.col("seq"), F.col("method")
    changes = log.filter(method.isin("U", "D") if feed.can_delete else method == "U")
    keyed = changes.filter(F.col(key).isNotNull())
    deleted = F.max(F.when(method == "D", seq)).alias("_deleted")
    ends = keyed.groupBy(key).agg(deleted, F.max(F.when(method == "U", seq)).alias("_last"), F.min(F.when(method == "U", seq)).alias("_made"))
    met = keyed.join(ends, key)
    later = (method == "U") & (F.col("_deleted").isNull() | (seq > F.col("_deleted")))
    if not feed.can_delete:
        later = later & ((seq == F.col("_last")) | (seq == F.col("_made")))
    met = met.filter(later | ((method == "D") & (seq == F.col("_deleted"))))
    kept = ["seq", "method", key, *feed.created]
    rest = [F.when((method == "U") & (seq == F.col("_last")), F.col(c)).alias(c) for c in feed.fields if c not in kept]
    # a command that was sent twice is one
    own = met.select(*kept, *rest).dropDuplicates([key, "seq", "method"])
    return own.unionByName(changes.filter(F.col(key).isNull() & (method == "U")).select(*own.columns).dropDuplicates(["seq"]))


def state_of(kept: DataFrame, feed: Feed) -> DataFrame:
    """The rows that ``still_matters`` comes to, by bucket: a key without an upsert there is deleted."""
    seq, upsert = F.col("seq"), F.col("method") == "U"
    rest = [c for c in feed.fields if c != feed.key and c not in feed.created]
    keyed = kept.filter(F.col(feed.key).isNotNull()).groupBy("bucket", feed.key)
    ends = keyed.agg(
        F.max_by(F.struct(*rest), F.when(upsert, seq)).alias("_last"),
        F.min_by(F.struct(*feed.created), F.when(upsert, seq)).alias("_made"),
    ).filter(F.col("_last").isNotNull())
    rows = ends.select(feed.key, "bucket", "_made.*", "_last.*").select(*feed.fields, "bucket")
    # rows without a key are state where they are log
    return rows.unionByName(kept.filter(F.col(feed.key).isNull()).select(*feed.fields, "bucket"))


def put_buckets(spark: SparkSession, out_dir: str, batch: str, log: DataFrame, feed: Feed, buckets: int) -> DataFrame:
    """Write what ``log`` comes to, as log and as state; returns the replies to its commands.

    What still matters is a small part of the log and all that the state is made
    of, so the state is worked out from the files just written.
    """
    bucket, spread = bucket_of(feed, buckets), F.pmod(F.xxhash64("seq"), F.lit(FILES_PER_BUCKET))
    kept = still_matters(log, feed).withColumn("bucket", bucket)
    written = f"{out_dir}/log/{batch}"
    kept.repartition("bucket", spread).write.mode("overwrite").partitionBy("bucket").parquet(written)
    rows = state_of(read_folders(spark, [written], kept.schema), feed)
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{out_dir}/state/{batch}")
    none = spark.createDataFrame([], log.select(*feed.fields).schema)
    return command_statuses(none, log, feed)


def publish_live(spark: SparkSession, out_dir: str, number: int, live: dict, batch: str, touched, buckets: int) -> None:
    """Name the live folder of each bucket; a bucket whose keys are all deleted has a log, but no state."""
    names = names_under(spark, f"{out_dir}/log/{batch}")
    written = sorted(int(n.partition("=")[2]) for n in names if n.startswith("bucket="))
    now = {b: f for b, f in live.items() if int(b) not in set(touched)} | {str(b): batch for b in written}
    publish(spark, manifests(out_dir), number, {"buckets": buckets, "live": now})


def start_store(spark: SparkSession, out_dir: str, base: DataFrame, feed: Feed, buckets: int = BUCKETS) -> None:
    """Deal the rows that the state starts with; a store that was started stays as it is."""
    if published(spark, manifests(out_dir)):
        return
    rows = base.select(F.lit("U").alias("method"), *feed.fields)
    loose = rows.filter(F.col(feed.key).isNull()).withColumn("seq", F.lit(AT_START) + 1 + F.monotonically_increasing_id())
    keyed = rows.filter(F.col(feed.key).isNotNull()).withColumn("seq", F.lit(AT_START))
    put_buckets(spark, out_dir, "start", staged(keyed.unionByName(loose), "start"), feed, buckets)
    publish_live(spark, out_dir, 0, {}, "start", range(buckets), buckets)


def apply_batch(
    commands: DataFrame, batch_id: int, out_dir: str, feed: Feed, write_replies: Callable[[DataFrame], None] | None = None
) -> bool:
    """Bring the commands of a batch into the store; False where it is there already.

    ``commands`` are typed ones, read three times: ``parse_commands`` gives them
    from the scratch folder. ``write_replies`` gets ``seq, method, status``
    of each and has written them before the batch counts. A reply is what is
    known when the batch runs: to a late command, those upserts and deletes that
    the store still has from before it. Commands that were sent twice count once.
    """
    spark = commands.sparkSession
    if batch_id + 1 in published(spark, manifests(out_dir)):
        return False
    before = content_of(spark, manifests(out_dir), batch_id)
    buckets = before["buckets"]
    names = ["seq", "method", *feed.fields]
    new = commands.select(*names)
    touched = {r.bucket for r in new.select(bucket_of(feed, buckets)).distinct().collect()}
    known = read_folders(spark, live_folders(spark, out_dir, "log", batch_id - 1, touched), new.schema)
    log = staged(known.unionByName(new).dropDuplicates(["seq", "method", feed.key]), "log")
    statuses = put_buckets(spark, out_dir, f"batch={batch_id}", log, feed, buckets)
    if write_replies:
        write_replies(statuses.select("seq", "method", "status").join(new.select("seq"), "seq", "left_semi"))
    publish_live(spark, out_dir, batch_id + 1, before["live"], f"batch={batch_id}", touched, buckets)
    return True


def tidy(spark: SparkSession, out_dir: str) -> None:
    """Delete manifests beyond the newest ones, and the folders that none of those names."""
    numbers = published(spark, manifests(out_dir))
    kept, gone = numbers[-KEPT_MANIFESTS:], numbers[:-KEPT_MANIFESTS]
    live = {f for n in kept for f in content_of(spark, manifests(out_dir), n)["live"].values()}
    # a folder of a later batch is being written
    newest = numbers[-1] - 1
    for kind in ("log", "state"):
        for name in names_under(spark, f"{out_dir}/{kind}"):
            number = -1 if name == "start" else int(name.partition("=")[2])
            if name not in live and number <= newest:
                delete_path(spark, f"{out_dir}/{kind}/{name}")
    for n in gone:
        withdraw(spark, manifests(out_dir), n)


def read_state(spark: SparkSession, out_dir: str, batch_id: int | None = None) -> DataFrame:
    """The state as of a committed batch; the newest unless given."""
    there = {(f, n) for f in set(names_under(spark, f"{out_dir}/state")) for n in names_under(spark, f"{out_dir}/state/{f}")}
    folders = [f for f in live_folders(spark, out_dir, "state", batch_id) if tuple(f.split("/")[-2:]) in there]
    if not folders:  # all keys are deleted; the newest files still tell the columns
        some = next(f"{out_dir}/log/{f}" for f in reversed(sorted(names_under(spark, f"{out_dir}/log"))))
        return spark.read.parquet(some).drop("seq", "method", "bucket").limit(0)
    return spark.read.parquet(*folders)
