"""Join and membership operators.

Sides are not hinted. The optimizer broadcasts a side only below the session's
size threshold, measured again at run time, and splits skewed shuffle
partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def role_join(
    df: DataFrame, dim: DataFrame, roles: Mapping[str, str], columns: Sequence[str], key: str = "id", how: str = "inner"
) -> DataFrame:
    """Join one dimension once per role: ``{role: foreign key}`` gives ``role_column``."""
    for role, fk in roles.items():
        side = dim.select(F.col(key).alias(f"_{role}"), *[F.col(c).alias(f"{role}_{c}") for c in columns])
        df = df.join(side, F.col(fk) == F.col(f"_{role}"), how).drop(f"_{role}")
    return df


def role_lookup(
    df: DataFrame, key: str, roles: Mapping[str, str], dim: DataFrame, columns: Sequence[str], dim_key: str = "id"
) -> DataFrame:
    """Values of one dimension for several roles of each key, in one join.

    The role ids become rows, meet the dimension once, and are turned back
    into ``role_column``. Unlike one join per role this moves only ids, which
    pays when the dimension is too large to broadcast. ``key`` must be unique.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(r).alias("role"), F.col(fk).alias("id")) for r, fk in roles.items()]))
    rows = df.select(key, pairs.alias("_p")).filter("_p.id is not null").select(key, "_p.role", F.col("_p.id").alias("_id"))
    side = dim.select(F.col(dim_key).alias("_id"), *columns)
    found = rows.join(side, "_id")
    picked = [F.min(F.when(F.col("role") == r, F.col(c))).alias(f"{r}_{c}") for r in roles for c in columns]
    return df.join(found.groupBy(key).agg(*picked), key, "left")


def bridge_join(left: DataFrame, link: DataFrame, right: DataFrame, left_on, right_on, right_key: str = "id") -> DataFrame:
    """Left and right rows connected by a link table, each pair once."""
    lk, link_left = left_on
    link_right = right_on
    pairs = link.select(F.col(link_left).alias("_l"), F.col(link_right).alias("_r")).distinct()
    return left.join(pairs, F.col(lk) == F.col("_l")).join(right, F.col("_r") == F.col(right_key)).drop("_l", "_r")


def membership_flags(df: DataFrame, column: str, lists: Mapping[str, DataFrame]) -> DataFrame:
    """One boolean ``column IN list`` per named list, with SQL's three values.

    Each list is a one-column table. A NULL in a list makes misses NULL
    instead of false (so ``NOT IN`` is never true); a NULL column over a
    non-empty list is NULL. All lists meet the rows in one join.
    """
    rows = None
    for i, ids in enumerate(lists.values()):
        one = ids.select(F.col(ids.columns[0]).alias("_id"), F.lit(i).alias("_list"))
        rows = one if rows is None else rows.unionByName(one)
    names = list(lists)
    hits = [F.bool_or(F.col("_list") == i).alias(f"_hit{i}") for i in range(len(names))]
    keys = rows.groupBy("_id").agg(*hits)
    facts = []
    for i in range(len(names)):
        facts.append(F.coalesce(F.bool_or(F.col("_list") == i), F.lit(False)).alias(f"filled{i}"))
        with_null = F.bool_or((F.col("_list") == i) & F.col("_id").isNull())
        facts.append(F.coalesce(with_null, F.lit(False)).alias(f"null{i}"))
    # one row on all lists, read once
    about = rows.agg(F.struct(*facts).alias("s")).scalar()
    joined = df.join(keys.filter("_id is not null"), F.col(column) == F.col("_id"), "left").withColumn("_about", about)
    for i, name in enumerate(names):
        hit = F.col(f"_hit{i}")
        known_miss = ~F.col(f"_about.filled{i}") | (F.col(column).isNotNull() & ~F.col(f"_about.null{i}"))
        joined = joined.withColumn(name, F.when(F.coalesce(hit, F.lit(False)), True).when(known_miss, False))
    return joined.drop("_id", "_about", *[f"_hit{i}" for i in range(len(names))])


def left_join_agg(df: DataFrame, child: DataFrame, on: Mapping[str, str], aggs: Mapping[str, Column]) -> DataFrame:
    """Aggregate the child per key first, then left-join one row per key."""
    fk = list(on.values())
    agg = child.groupBy(*fk).agg(*[e.alias(n) for n, e in aggs.items()])
    agg = agg.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(fk)], *aggs)
    cond = None
    for i, k in enumerate(on):
        c = F.col(k) == F.col(f"_k{i}")
        cond = c if cond is None else cond & c
    return df.join(agg, cond, "left").drop(*[f"_k{i}" for i in range(len(fk))])


def child_sums(
    parent: DataFrame,
    children: Mapping[str, DataFrame],
    key: str,
    fk: str,
    sums: Mapping[str, tuple[str, str]],
    fanout: bool = True,
) -> DataFrame:
    """Sums over several one-to-many children of one parent.

    ``sums`` maps an output name to (child, column). With ``fanout`` each sum
    is multiplied by the row counts of the other children, which is what
    joining all children before summing gives; the pairs themselves are never
    built.
    """
    out = parent
    for child, rows in children.items():
        mine = {n: F.sum(c) for n, (ch, c) in sums.items() if ch == child}
        out = left_join_agg(out, rows, {key: fk}, {**mine, f"_n_{child}": F.count(F.lit(1))})
    if fanout:
        for name, (child, _) in sums.items():
            for other in children:
                if other != child:
                    factor = F.greatest(F.coalesce(F.col(f"_n_{other}"), F.lit(1)), F.lit(1))
                    out = out.withColumn(name, F.col(name) * factor)
    return out.drop(*[f"_n_{c}" for c in children])


def partner_lookup(
    df: DataFrame, partners: DataFrame, keys: Sequence[str], required: str = "sender_code", type_: str = "IN"
) -> tuple[DataFrame, DataFrame]:
    """Rows with their partner settings, and the rows that have none.

    Several settings for one key would repeat documents, so the lowest one is
    taken.
    """
    rest = [c for c in partners.columns if c not in keys and c != "sftp_type"]
    live = partners.filter((F.col("sftp_type") == type_) & F.col(required).isNotNull())
    one = live.groupBy(*keys).agg(F.min(F.struct(required, *[c for c in rest if c != required])).alias("_p"))
    flat = one.select(*keys, "_p.*")
    return df.join(flat, list(keys)), df.join(flat, list(keys), "left_anti")


def lookup(df: DataFrame, dim: DataFrame, on: Sequence[str], where: Column | None = None, prefix: str = "") -> DataFrame:
    """Left join on equal column names; other columns get the prefix."""
    dim = dim if where is None else dim.filter(where)
    cols = [F.col(c) if c in on else F.col(c).alias(prefix + c) for c in dim.columns]
    return df.join(dim.select(*cols), list(on), "left")


def translate_code(df: DataFrame, codes: DataFrame, document: str, master: str, column: str, name: str) -> DataFrame:
    """Partner code of a local code; NULL when not mapped."""
    chosen = codes.filter((F.col("document") == document) & (F.col("master") == master))
    one = chosen.groupBy(F.col("code").alias("_code")).agg(F.min("edi_code").alias(name))
    return df.join(one, F.col(column) == F.col("_code"), "left").drop("_code")


def split_existing(batch: DataFrame, base: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is already stored, and the new ones."""
    known = base.select(*keys).distinct()
    return batch.join(known, list(keys), "left_semi"), batch.join(known, list(keys), "left_anti")


def config_value(header: DataFrame, values: DataFrame, key: str) -> Column:
    """One configuration value as a scalar column; NULL when not set."""
    joined = header.filter(F.col("config_key") == key).join(
        values, header["id"] == values["config_header_id"], "left"
    )
    return joined.agg(F.min("config_value").alias("v")).scalar()


def config_row(header: DataFrame, values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All wanted keys as one row, one column per key."""
    joined = header.join(values, header["id"] == values["config_header_id"], "left")
    picked = [F.min(F.when(F.col("config_key") == k, F.col("config_value"))).alias(k) for k in keys]
    return joined.agg(*picked)
