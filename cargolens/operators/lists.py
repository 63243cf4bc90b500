"""Ordered lists and texts per key.

A list or document that nature bounds (of a shipment, a house, a user) is one
value per key. What grows with the data (of a login, a source, a partner) is
ordered rows ``(key, pos, text)``: a head, the items and a tail, whose
concatenation is the document, so no key has to fit in one value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cargolens.functions.text import json_text
from cargolens.operators.ordered import serial
from cargolens.session import staged


def nest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    fields: Mapping[str, Column | str],
    name: str,
    where: Column | None = None,
) -> DataFrame:
    """Array of structs per key, ordered; ``where`` leaves rows out.

    Keys whose rows are all left out keep an empty array.
    """
    cols = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in fields.items()]
    item = F.struct(F.struct(*order_by).alias("o"), F.struct(*cols).alias("v"))
    if where is not None:
        item = F.when(where, item)
    listed = df.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("_items"))
    return listed.select(*keys, F.transform("_items", lambda x: x["v"]).alias(name))


def string_list(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    sep: str = ",",
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Joined text per key; NULL values are skipped, all NULL gives NULL."""
    order = list(order_by) if order_by else [value]
    item = F.struct(F.struct(*order).alias("o"), F.col(value).cast("string").alias("v"))
    listed = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("_items"))
    return listed.select(*keys, F.array_join(F.transform("_items", lambda x: x["v"]), sep).alias(name))


def text_rows(heads: DataFrame, items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, pos, text)``: head at 0, items at 1, 2, …, tail behind them.

    ``heads`` has ``head`` and ``tail`` per key, ``items`` has ``pos`` and
    ``text``. A NULL tail gives no row.
    """
    keys = list(keys)
    counts = items.groupBy(*keys).agg(F.max("pos").alias("_n"))
    met = heads.join(counts, keys, "left")
    zero = F.lit(0).cast("long").alias("pos")
    after = (F.coalesce("_n", F.lit(0)) + 1).cast("long").alias("pos")
    rows = heads.select(*keys, zero, F.col("head").alias("text"))
    rows = rows.unionByName(items.select(*keys, F.col("pos").cast("long"), "text"))
    return rows.unionByName(met.filter("tail is not null").select(*keys, after, F.col("tail").alias("text")))


def reply_rows(
    df: DataFrame, order_by: Sequence[str], fields: Mapping[str, Column | str], empty: str = "[]"
) -> DataFrame:
    """One JSON array over all rows as ordered rows ``(pos, text)``; without rows ``empty`` is the whole text."""
    # numbering reads the rows several times; what they come from is worked out once
    rows = staged(df, "reply")
    numbered = serial(rows, [], order_by, "pos")
    items = numbered.select("pos", json_item("pos", fields).alias("text"))
    n = rows.agg(F.nullif(F.count(F.lit(1)), F.lit(0)).alias("n")).scalar()
    one = df.sparkSession.range(1)
    head = one.select(F.lit(0).cast("long").alias("pos"), F.when(n.isNull(), empty).otherwise("[").alias("text"))
    tail = one.select((n + 1).cast("long").alias("pos"), F.lit("]").alias("text")).filter("pos is not null")
    return head.unionByName(items).unionByName(tail)


def json_item(pos: str, fields: Mapping[str, Column | str]) -> Column:
    """One item of a JSON array, with the comma before it."""
    cols = [(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in fields.items()]
    return F.concat(F.when(F.col(pos) > 1, F.lit(",")).otherwise(F.lit("")), json_text(F.struct(*cols)))


def array_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    fields: Mapping[str, Column | str],
    where: Column | None = None,
) -> DataFrame:
    """The JSON array of each key as ordered rows; keys whose rows are all left out have an empty one."""
    kept = df if where is None else df.filter(where)
    numbered = serial(kept, keys, order_by, "pos")
    items = numbered.select(*keys, "pos", json_item("pos", fields).alias("text"))
    heads = df.select(*keys).distinct().withColumns({"head": F.lit("["), "tail": F.lit("]")})
    return text_rows(heads, items, keys)


def count_by_code(
    df: DataFrame, keys: Sequence[str], code: str, name: str, sep: str = ","
) -> DataFrame:
    """``2*20GP,1*40HC`` per key.

    Rows are counted per code first, so the second step holds at most one row
    per distinct code of the code table.
    """
    counted = df.groupBy(*keys, code).agg(F.count(F.lit(1)).alias("_n"))
    text = F.concat(F.col("_n").cast("string"), F.lit("*"), F.col(code))
    item = F.when(F.col(code).isNotNull(), F.struct(F.col(code).alias("c"), text.alias("t")))
    listed = counted.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("_items"))
    joined = F.array_join(F.transform("_items", lambda x: x["t"]), sep)
    return listed.select(*keys, F.when(F.size("_items") > 0, joined).alias(name))


def gather_lines(
    lines: DataFrame,
    key: str | Sequence[str],
    order_by: Sequence[str],
    line: str = "line",
    null_blanks_all: bool = True,
    names: DataFrame | None = None,
) -> DataFrame:
    """``(key, content)`` from one row per document line; the key may be several columns.

    With ``null_blanks_all`` a document having any NULL line gets NULL content,
    as text concatenation with NULL gives NULL; else the line is empty.
    ``names`` has further columns per key and ``times``, how often each line of
    that document stands; keys without a name are left out. Lines are dealt by
    their key once and gathered there: lists made before would only be sorted
    and moved in addition.
    """
    value = F.col(line) if null_blanks_all else F.coalesce(line, F.lit(""))
    item = F.struct(F.struct(*order_by).alias("o"), value.alias("v"))
    keys = [key] if isinstance(key, str) else list(key)
    gathered = lines.repartition(*keys).groupBy(*keys).agg(
        F.sort_array(F.collect_list(item)).alias("_items"), F.bool_or(value.isNull()).alias("_blank")
    )
    texts = F.transform("_items", lambda x: x["v"])
    shown = keys
    if names is not None:
        shown = [*keys, *[c for c in names.columns if c not in (*keys, "times")]]
        gathered = names.join(gathered, keys)
        repeated = F.flatten(F.transform("_items", lambda x: F.array_repeat(x["v"], F.col("times"))))
        texts = F.when(F.col("times") == 1, texts).otherwise(repeated)
    return gathered.select(*shown, F.when(~F.col("_blank"), F.array_join(texts, "\n")).alias("content"))
