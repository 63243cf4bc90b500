"""Mixing sources to target weights by Pareto order sampling.

A source's target, in words, is split into whole copies that every document
gets for certain and a rest. The rest goes to a sample of fixed size, in words,
of whole documents with unequal probabilities: a document longer than the rest
is included less likely, by as much as it is longer, and the odds of all are
scaled so that the expected words are the rest. Documents are ranked by random
odds divided by inclusion odds and taken in that order. The order goes on
behind a document that does not fit, with those that do, for PASSES passes.

No task orders a whole source: sizes are summed per source and band of that
order, the running sum over bands finds the one in which the rest runs out, and
only that band is cut again, and at last put in order document by document.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from cargolens.llm.textbytes import Words, utf8
from cargolens.session import drop_staged, staged

#: Bits of a random number, those that number its band, and how often a band is cut again.
DRAW_BITS, BAND_BITS, CUTS = 48, 8, 2

#: How often the order is gone through, each time with the documents that still fit.
PASSES = 3

#: Copies of a repeated row that are numbered together, and rows of one repeated row that a task numbers.
STRETCH, NUMBERED = 4096, 1_000_000


@F.arrow_udf(LongType())
def word_count(text: pa.Array) -> pa.Array:
    """Words of a text; 0 for null."""
    return pa.array(Words(*utf8(text)).counts)


def targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Sources by code point, null last, have the weights in turn. Together they
    get ``share`` of all sizes by weight; what is above ``most`` times a
    source's size goes to the others by weight, until none is above. Sources
    that stop are those of smallest size by weight, so one pass in that order
    finds how many stop. There is one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    weighed = weighed.withColumn("at_most", F.lit(float(most)) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("at_most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.lit(float(share)) * F.sum("source_size").over(whole) - F.coalesce(F.sum("at_most").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = F.greatest(left, F.lit(0.0)) / weight_left
    stops = F.col("at_most") <= level * F.col("weight")
    marked = weighed.withColumns({"level": level, "stops": stops})
    # the first source that does not stop sets the level of all that follow
    level = F.max(F.when(~F.col("stops"), F.col("level"))).over(whole)
    target = F.when(F.col("stops"), F.col("at_most")).otherwise(level * F.col("weight"))
    return marked.select("source", "source_size", target.alias("target"))


def included(size: Column, rest: Column, reach: Column) -> Column:
    """Probability of a document; ``reach`` is the sum over its source of its sizes, none counting for more than the rest."""
    return rest / reach * F.when(size > rest, rest / size).otherwise(F.lit(1.0))


def odds_ratio(draw: Column, inclusion: Column) -> Column:
    """Random odds divided by inclusion odds; the smallest are sampled."""
    u = (draw + F.lit(0.5)) / F.lit(float(1 << DRAW_BITS))
    return F.when(inclusion < 1, (u / (1 - u)) / (inclusion / (1 - inclusion))).otherwise(F.lit(0.0))


def rank_number(ratio: Column) -> Column:
    """A number of DRAW_BITS bits that grows with the ratio."""
    share = F.floor(ratio / (1 + ratio) * F.lit(float(1 << DRAW_BITS))).cast("long")
    return F.least(share, F.lit((1 << DRAW_BITS) - 1))


def cut(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Where each source's rest runs out: ``source, below, last``.

    Rows whose number is less than ``below``, or that stand at or before
    ``last`` in the order of ``place``, are sampled.
    """
    found = plan.select(
        "source", "rest", F.when(F.col("rest") > 0, F.lit(0)).cast("long").alias("below"), F.lit(0).cast("long").alias("before")
    )
    same_source = F.col("p.source").eqNullSafe(F.col("r.source"))
    for level in range(1, CUTS + 1):
        left = DRAW_BITS - level * BAND_BITS
        band = F.shiftright("draw", left)
        here = rows.alias("r").join(found.alias("p"), same_source)
        here = here.filter(F.shiftright("draw", left + BAND_BITS) == F.shiftright("below", left + BAND_BITS))
        sums = here.groupBy("r.source", "p.rest", "before", band.alias("band")).agg(F.sum("size").alias("words"))
        running = F.sum("words").over(Window.partitionBy("source").orderBy("band"))
        sums = sums.withColumn("until", F.col("before") + running).filter("until >= rest")
        first = F.min_by(F.struct("band", "words", "until", "rest"), "band").alias("x")
        found = sums.groupBy("source").agg(first).select(
            "source",
            "x.rest",
            F.shiftleft("x.band", left).alias("below"),
            (F.col("x.until") - F.col("x.words")).alias("before"),
        )
    here = rows.alias("r").join(found.alias("p"), same_source)
    left = DRAW_BITS - CUTS * BAND_BITS
    here = here.filter(F.shiftright("draw", left) == F.shiftright("below", left))
    here = here.selectExpr("r.source", "size", "rest", "below", "before", PLACE)
    running = F.sum("size").over(Window.partitionBy("source").orderBy("place")) - F.col("size")
    here = here.withColumn("fits", F.col("before") + running + F.col("size") / 2 <= F.col("rest"))
    return here.groupBy("source").agg(
        F.first("below").alias("below"), F.max(F.when(F.col("fits"), F.col("place"))).alias("last")
    )


#: Order of rows of one source.
PLACE = "struct(draw, doc_id, size, copy) as place"


def copies_of(rows: DataFrame) -> DataFrame:
    """``source, doc_id, size, rows, copy``: a row per input row, those alike numbered from 0."""
    alike = rows.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("rows"))
    single = alike.filter("rows = 1").withColumn("copy", F.lit(0).cast("long"))
    stretches = alike.filter("rows > 1").withColumn("stretch", F.explode(F.sequence(F.lit(0), F.expr("(rows - 1) div 4096"))))
    # a row that is much of the table is many stretches, on as many tasks
    dealt = stretches.repartition("source", "doc_id", "size", "stretch")
    first = F.col("stretch") * STRETCH
    many = dealt.withColumn("copy", F.explode(F.sequence(first, F.least(first + (STRETCH - 1), F.col("rows") - 1)))).drop("stretch")
    return single.unionByName(many)


def joined(rows: DataFrame, by_source: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` with the columns of their source's row."""
    other = by_source.withColumnRenamed("source", "_source")
    return rows.join(other, rows["source"].eqNullSafe(other["_source"]), how).drop("_source")


def is_sampled(number: int) -> Column:
    """Whether a row with ``place`` is taken up to the cut of pass ``number``."""
    fits = (F.col(f"rest{number}") > 0) & (F.col("place.size") <= 2 * F.col(f"rest{number}"))
    here = (F.col("place.draw") < F.col(f"below{number}")) | (F.col("place") <= F.col(f"last{number}"))
    return F.coalesce(fits & F.coalesce(here, F.col("place.draw") < F.col(f"below{number}")), F.lit(False))


def sampled_in(passes: int) -> Column:
    out = F.lit(False)
    for number in range(1, passes + 1):
        out = out | is_sampled(number)
    return out


def cuts_of(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` with ``rest, below, last`` of every pass; the rest of a pass is what those before it left."""
    done = plan.withColumn("rest1", F.col("rest"))
    for number in range(1, PASSES + 1):
        rest = f"rest{number}"
        if number > 1:
            left = joined(rows.selectExpr("source", "size", PLACE), done).groupBy("source").agg(
                F.sum(F.when(sampled_in(number - 1), F.col("size")).otherwise(0)).alias("_taken")
            )
            # a source without a rest has no rows to draw from
            done = joined(done, left, "left").withColumn(rest, F.col("rest") - F.coalesce("_taken", F.lit(0))).drop("_taken")
        open_rows = joined(rows.selectExpr("*", PLACE), done.drop("rest"))
        open_rows = open_rows.filter((F.col("size") <= 2 * F.col(rest)) & ~sampled_in(number - 1)).select(rows.columns)
        ends = cut(open_rows, done.select("source", F.col(rest).alias("rest"))).withColumnsRenamed(
            {"below": f"below{number}", "last": f"last{number}", "source": "_at"}
        )
        done = done.join(ends, done["source"].eqNullSafe(ends["_at"]), "left").drop("_at")
        # where the open rows do not reach the rest, nothing is cut and all of them are taken
        done = staged(done.withColumn(f"below{number}", F.coalesce(f"below{number}", F.lit(1 << DRAW_BITS))), "cuts")
    return done


def mix(
    docs: DataFrame,
    size: Column | None = None,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 1,
) -> DataFrame:
    """All columns of ``docs`` and a struct ``mix`` of what the mix takes.

    ``docs`` has ``doc_id, text, source``; ``size`` is the words of the text
    unless given. ``mix`` holds ``size, source_size, target, copies, ratio``:
    ``copies`` is how often the document is taken, ``ceil(most)`` at most, and
    ``ratio`` what it is ranked by (null where no sample is drawn, or where the
    row is one of several alike). Taken words miss a source's target by half of
    the shortest document that is left out, if PASSES passes are enough, else
    by half of one document that did not fit. Null sources are a source of
    their own; empty and null texts have size 0. Rows alike in id, source and
    size have a draw each; as many of them are taken as draws fit (beyond
    NUMBERED such rows, up to one row more or less for each NUMBERED). An empty
    table gives an empty one. Reruns agree: a draw depends on the row's values
    and ``seed``.
    """
    if "mix" in docs.columns:
        raise ValueError("there is a column mix already")
    spark = docs.sparkSession
    words = (word_count("text") if size is None else size).cast("long")
    sizes = docs.select("source", "doc_id", words.alias("size"))
    rows = staged(copies_of(sizes), "copies")
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most)
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = plan.withColumn("certain", F.floor(copies))
    plan = staged(plan.withColumn("rest", F.col("target") - F.col("certain") * F.col("source_size")), "plan")
    reach = joined(rows, plan.select("source", "rest")).groupBy("source").agg(F.sum(F.least(F.col("size").cast("double"), "rest")).alias("reach"))
    plan = staged(joined(plan, reach), "targets")

    def ratio(copy: Column) -> Column:
        parts = [F.coalesce(c.cast("string"), F.lit("null")) for c in (F.col("doc_id"), F.col("source"), F.col("size"), copy)]
        draw = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), 1, 12), 16, 10).cast("long")
        return odds_ratio(draw, included(F.col("size"), F.col("rest"), F.col("reach")))

    ranked = joined(rows, plan.select("source", "rest", "reach").filter("rest > 0 and reach > 0"))
    ranked = staged(ranked.select("source", "doc_id", "size", "rows", "copy", rank_number(ratio(F.col("copy"))).alias("draw")), "draws")
    by_source = cuts_of(ranked, plan)
    flagged = joined(ranked.filter("rows > 1").selectExpr("*", PLACE), by_source)
    many = flagged.groupBy("source", "doc_id", "size").agg(
        F.max("rows").alias("rows"), F.sum(sampled_in(PASSES).cast("long")).alias("picked")
    )
    many = staged(many, "alike")

    # the user's row stays whole in one column, so none of its names clashes
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", "source", words.alias("size"))
    met = joined(row, by_source)
    keys = [met[c].eqNullSafe(many[c]) for c in ("source", "doc_id", "size")]
    met = met.join(many, keys[0] & keys[1] & keys[2], "left").select(met["*"], many["rows"], many["picked"])
    own = F.when((F.col("rest") > 0) & (F.col("reach") > 0), ratio(F.lit(0)))
    met = met.withColumn("ratio", F.when(F.col("rows").isNull(), own))
    met = met.withColumn("place", F.struct(rank_number(F.col("ratio")).alias("draw"), "doc_id", "size", F.lit(0).cast("long").alias("copy")))
    some = (F.col("picked") > 0) & (F.col("picked") < F.col("rows"))
    alone = F.col("rows").isNull() & F.col("ratio").isNotNull() & sampled_in(PASSES)
    chosen = met.filter(~F.coalesce(some, F.lit(False))).withColumn("taken", alone | F.coalesce(F.col("picked") == F.col("rows"), F.lit(False)))
    if not many.filter(some).isEmpty():
        shares = F.ceil(F.col("rows") / NUMBERED)
        part = met.filter(some).withColumn("part", F.pmod(F.xxhash64(F.monotonically_increasing_id()), shares))
        group = Window.partitionBy("source", "doc_id", "size", "part")
        numbered = part.withColumns({"no": F.row_number().over(group.orderBy("size")), "here": F.count(F.lit(1)).over(group)})
        numbered = numbered.withColumn("taken", F.col("no") <= F.round(F.col("picked") * F.col("here") / F.col("rows")))
        chosen = chosen.unionByName(numbered.drop("part", "no", "here"))
    drop_staged(spark, rows, ranked)
    taken = F.struct(
        "size", "source_size", "target", (F.col("certain") + F.col("taken").cast("long")).alias("copies"), "ratio"
    )
    return chosen.select("row", taken.alias("mix")).select("row.*", "mix")
