"""Searches that open only the files that can hold a hit.

Beside the files of a table lies, per searched column, a table ``(gram, file)``
of the three-character strings that occur in each file, sorted by gram, so that
a look-up reads few row groups of it. Text between the wildcards of a LIKE
pattern has to stand in a hit as it is: a file that lacks one of its grams is
not opened, and LIKE decides on the rows of the others. Files that are not
indexed yet are always opened, so the index may lag behind the data.

Files are written once and never changed in place, as Spark does it. The driver
holds file names, as it does for any read.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolens.operators.predicates import like_pattern, search_contains
from cargolens.session import delete_path
from cargolens.sources.commits import DIGITS, publish, published

#: Characters of a gram.
GRAM = 3


def literal_runs(pattern: str) -> list[str]:
    """The texts between the wildcards of a LIKE pattern; a backslash takes the next character as it is."""
    runs, at = [""], 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\" and at + 1 < len(pattern):
            at += 1
            runs[-1] += pattern[at]
        elif c in "%_":
            runs.append("")
        else:
            runs[-1] += c
        at += 1
    return [r for r in runs if r]


def grams_of_pattern(pattern: str) -> set[str]:
    """Grams that every text like the pattern holds."""
    return {r[i : i + GRAM] for r in literal_runs(pattern) for i in range(len(r) - GRAM + 1)}


def grams(column: str) -> Column:
    """Distinct grams of a text, by code points; null and shorter texts have none."""

    def of(chars: Column) -> Column:
        def one(i: Column) -> Column:
            return F.concat(*[F.get(chars, i + j) for j in range(GRAM)])

        last = F.size(chars) - GRAM
        return F.when(last >= 0, F.array_distinct(F.transform(F.sequence(F.lit(0), last), one)))

    # the characters are an element of an array, so that they are split once and not once a gram
    return F.get(F.transform(F.array(F.split(F.col(column), "")), of), 0)


def files_of(spark: SparkSession, path: str) -> dict[str, str]:
    """Name of each data file as rows give it, and the path that reads it."""
    listed = spark.read.parquet(path).inputFiles()
    return {_plain(name): unquote(name) for name in listed}


def _plain(name: str) -> str:
    return "file:/" + name.removeprefix("file:").lstrip("/") if name.startswith("file:") else name


def _folder(path: str, column: str) -> str:
    return f"{path.rstrip('/')}/_grams_{column}"


def _batches(spark: SparkSession, folder: str) -> list[str]:
    names = [f"{folder}/{n:0{DIGITS}d}.json" for n in published(spark, folder)]
    return [json.loads(r.value)["batch"] for r in spark.read.text(names, wholetext=True).collect()] if names else []


def _indexed(spark: SparkSession, folder: str, batches: list[str]) -> set[str]:
    if not batches:
        return set()
    return {r.file for r in spark.read.parquet(*[f"{folder}/{b}/files" for b in batches]).distinct().collect()}


def index_files(spark: SparkSession, path: str, column: str) -> int:
    """Index what files of the table are not indexed yet, and return how many they were.

    The grams are seen by searches all at once, when they are all written. A
    run that was stopped leaves nothing that counts. Of two runs at a time both
    may index a file, which does no harm.
    """
    folder = _folder(path, column)
    files = files_of(spark, path)
    known = _indexed(spark, folder, _batches(spark, folder))
    new = sorted(set(files) - known)
    if not new:
        return 0
    batch = f"batch-{uuid.uuid4().hex}"
    name = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/").alias("file")
    rows = spark.read.option("basePath", path).parquet(*[files[f] for f in new])
    found = rows.select(name, F.explode(grams(column)).alias("gram")).distinct()
    try:
        found.repartitionByRange("gram", "file").sortWithinPartitions("gram", "file").write.parquet(f"{folder}/{batch}/grams")
        spark.createDataFrame([(f,) for f in new], "file string").write.parquet(f"{folder}/{batch}/files")
        while not publish(spark, folder, len(published(spark, folder)), {"batch": batch}):
            pass
    except BaseException:
        delete_path(spark, f"{folder}/{batch}")
        raise
    return len(new)


def files_for(spark: SparkSession, path: str, column: str, pattern: str) -> list[str]:
    """Paths of the files that can hold a text like the pattern."""
    folder = _folder(path, column)
    files = files_of(spark, path)
    wanted = sorted(grams_of_pattern(pattern))
    batches = _batches(spark, folder) if wanted else []
    if not batches:
        return list(files.values())
    index = spark.read.parquet(*[f"{folder}/{b}/grams" for b in batches])
    hits = index.filter(F.col("gram").isin(wanted)).groupBy("file").agg(F.count_distinct("gram").alias("n"))
    hits = {r.file for r in hits.filter(F.col("n") == len(wanted)).select("file").collect()}
    known = _indexed(spark, folder, batches)
    return [place for name, place in files.items() if name in hits or name not in known]


def search(spark: SparkSession, path: str, column: str, query: str | None, upper: bool = True) -> DataFrame:
    """``search_contains`` over the table at ``path``, reading only the files that can hold a hit."""
    table = spark.read.parquet(path)
    if query is None:
        return search_contains(table, column, query, upper)
    places = files_for(spark, path, column, like_pattern(query, upper))
    some = spark.read.schema(table.schema).option("basePath", path).parquet(*places) if places else table.filter(F.lit(False))
    return search_contains(some, column, query, upper)
