"""Small files that decide what counts: commits of batches, and ranges of ids taken by writers.

Such a file appears whole and once. It is written under another name first and
then put in place only where nothing stands there, so of two writers of one
file a single one succeeds, and a reader never meets half a file.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from cargolens.session import delete_path, names_under

#: Digits of a number in a file name, so that names sort like numbers.
DIGITS = 20


def publish(spark: SparkSession, folder: str, number: int, content: dict) -> bool:
    """Put ``content`` under this number; False where one stands there already, which stays."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    place = path(f"{folder}/{number:0{DIGITS}d}.json")
    draft = path(f"{folder}/.draft-{uuid.uuid4().hex}")
    files = place.getFileSystem(conf)
    out = files.create(draft, False)
    try:
        out.write(json.dumps(content).encode())
    finally:
        out.close()
    try:
        if files.getUri().getScheme() == "file":
            # a local rename would replace what is there; a link does not
            jvm.java.nio.file.Files.createLink(*(jvm.java.io.File(p.toUri().getPath()).toPath() for p in (place, draft)))
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(draft, place, none)
    except Py4JJavaError as refused:
        if "FileAlreadyExists" not in refused.java_exception.getClass().getName():
            raise
        return False
    finally:
        if files.exists(draft):
            files.delete(draft, False)
    return True


def published(spark: SparkSession, folder: str) -> list[int]:
    """The numbers under which something stands, in order."""
    return sorted(int(n.removesuffix(".json")) for n in names_under(spark, folder) if n.endswith(".json") and not n.startswith("."))


def withdraw(spark: SparkSession, folder: str, number: int) -> None:
    delete_path(spark, f"{folder}/{number:0{DIGITS}d}.json")


def content_of(spark: SparkSession, folder: str, number: int) -> dict:
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{folder}/{number:0{DIGITS}d}.json")
    content = place.getFileSystem(spark._jsc.hadoopConfiguration()).open(place)
    try:
        return json.loads(bytes(content.readAllBytes()))
    finally:
        content.close()


# ---- batches of several tables -------------------------------------------


def commit_batch(spark: SparkSession, out_dir: str, batch_id: int, tables: list[str]) -> None:
    """From here on readers see the batch, in all its tables at once."""
    publish(spark, f"{out_dir}/_commits", batch_id, {"tables": sorted(tables)})


def is_committed(spark: SparkSession, out_dir: str, batch_id: int) -> bool:
    return batch_id in published(spark, f"{out_dir}/_commits")


def committed(spark: SparkSession, out_dir: str, table: str, schema=None) -> DataFrame:
    """Rows of the committed batches of a table, with their ``batch_id``.

    A batch that was stopped on the way, or is being written, shows no row in
    any table. Without a committed batch a ``schema`` is needed for the empty table.
    """
    folder = f"{out_dir}/{table}"
    there = set(names_under(spark, folder))
    paths = [f"{folder}/batch_id={n}" for n in published(spark, f"{out_dir}/_commits") if f"batch_id={n}" in there]
    if not paths:
        if schema is None:
            raise ValueError(f"no batch of {table} is committed in {out_dir}")
        return spark.createDataFrame([], schema)
    return spark.read.option("basePath", folder).parquet(*paths)


# ---- ranges of ids -------------------------------------------------------


def reserve_ids(spark: SparkSession, folder: str, count: int, first: int = 1) -> int:
    """Take ``count`` ids that no other writer has and return the first of them.

    Each writer puts its range behind the last one, under the range's first id;
    who comes second for that place looks again. A writer that stops after this
    leaves a gap of its own range and no more. ``first`` is where an empty
    folder starts; it is not looked at later on.
    """
    if count < 1:
        raise ValueError("count must be 1 or more")
    while True:
        taken = published(spark, folder)
        start = content_of(spark, folder, taken[-1])["next"] if taken else first
        if publish(spark, folder, start, {"next": start + count}):
            return start
