"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

Every source has a target of tokens.  Of all document rates between 0 and ``MOST`` that meet the targets, those nearest to
one copy each in relative entropy are exponentially tilted: ``rate = min(MOST, exp(tilt * size))``, one tilt a source.  The
tilts solve the convex dual, by distributed Newton steps on the histogram of sizes, kept in brackets; then rates
are rounded into whole copies.

Sums that decide anything are taken over decimals, so they do not depend on the order of rows: reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.store import dropped, written
from ledgerloom.operators.ordered import numbered

SPACES = "[\\x20\\x09-\\x0D]+"
MOST = 3
BUCKETS = 1024
ROUNDS = 100
SIZES = 32
SOURCE = ["no_source", "source"]


def word_count(text: Column) -> Column:
    """The number of runs outside ``\\x20 \\x09-\\x0D``; null has none."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")).cast("bigint")


def targets(sources: DataFrame, weights: tuple[float, ...], most: int = MOST) -> DataFrame:
    """``sources`` (no_source, source, source_size) with ``target``: shares of all sizes by weight, none above ``most``
    times its source's size.

    Sources in code-point order, the null source last, take ``weights`` in turn.  What a target can't hold is shared among
    the others by weight, round by round until none is above: each round is an aggregate of one row.
    """
    spark = sources.sparkSession
    # an ordered key: null sources after all strings
    keyed = numbered(sources.withColumn("key", F.struct("no_source", "source")), "key", "place").drop("key")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    state, path = written(keyed.withColumn("weight", weight).withColumn("full", F.col("source_size") == 0), "mix-sources")
    while True:
        # sizes are whole numbers, so these sums are exact in any order
        whole, held, share = state.agg(
            F.sum("source_size"), F.coalesce(F.sum(F.when(F.col("full"), most * F.col("source_size"))), F.lit(0)), F.sum(F.when(~F.col("full"), F.col("weight").cast("decimal(38,6)")))
        ).first()
        level = (float(whole - held) / float(share)) if share else 0.0
        marked = state.withColumn("full", F.col("full") | (F.col("weight") * F.lit(level) > most * F.col("source_size")))
        now, new_path = written(marked, "mix-sources")
        grown = now.where("full").count() > state.where("full").count()
        dropped(spark, path)
        state, path = now, new_path
        if not grown:
            break
    return state.withColumn("target", F.when(F.col("full"), (most * F.col("source_size")).cast("double")).otherwise(F.col("weight") * F.lit(level))).drop("place", "weight", "full")


def tilts(histogram: DataFrame, sources: DataFrame, most: int = MOST, rounds: int = ROUNDS) -> DataFrame:
    """``sources`` (no_source, source, source_size, target) with ``tilt``, at which rates ``min(most, exp(tilt * size))`` of
    ``histogram`` (no_source, source, size, n) take the target; null where the target asks for all rates to be ``most``.

    One aggregate a round gives each source its sum and that sum's derivative.  The step is Newton's on the sums' logarithm; where it
    leaves the bracket of tilts known to be too low and too high, the bracket is halved.  A source is done at half a
    word, or when its bracket can't shrink.
    """
    spark = histogram.sparkSession
    start = sources.withColumns(
        {
            "tilt": F.when(F.col("target") < most * F.col("source_size"), F.lit(0.0)),
            "low": F.lit(None).cast("double"),
            "high": F.lit(None).cast("double"),
            "settled": (F.col("source_size") == 0) | (F.col("target") >= most * F.col("source_size")),
        }
    )
    state, path = written(start, "mix-tilts")
    for _ in range(rounds):
        if not state.where("not settled").limit(1).count():
            break
        power = F.col("tilt") * F.col("size")
        rate = F.exp(F.least(power, F.lit(math.log(most))))
        words = F.col("n") * F.col("size") * rate
        open_words = F.when(power < math.log(most), words * F.col("size")).otherwise(F.lit(0.0))
        exact = "decimal(38,6)"
        sums = (
            histogram.where("size > 0").join(state.where("not settled").select(*SOURCE, "tilt"), SOURCE)
            .groupBy(*SOURCE).agg(F.sum(words.cast(exact)).cast("double").alias("sum"), F.sum(open_words.cast(exact)).cast("double").alias("slope"))
        )
        both = state.join(sums, SOURCE, "left").withColumn("over", F.col("sum") - F.col("target"))
        both = both.withColumns({"low": F.when(F.col("over") < 0, F.col("tilt")).otherwise(F.col("low")), "high": F.when(F.col("over") > 0, F.col("tilt")).otherwise(F.col("high"))})
        step = F.col("tilt") - F.log(F.col("sum") / F.col("target")) * F.col("sum") / F.col("slope")
        outside = F.coalesce(step <= F.col("low"), F.lit(False)) | F.coalesce(step >= F.col("high"), F.lit(False)) | F.coalesce(step.isNull() | F.isnan(step) | (F.abs(step) > 1e6), F.lit(True))
        halved = F.when(F.col("low").isNotNull() & F.col("high").isNotNull(), (F.col("low") + F.col("high")) / 2)
        wider = F.when(F.col("high").isNull(), F.greatest(2 * F.col("low"), F.lit(1e-6))).otherwise(F.least(2 * F.col("high"), F.lit(-1e-6)))
        then = F.when(~outside, step).otherwise(F.coalesce(halved, wider))
        settled = F.col("settled") | (F.abs("over") <= 0.5) | (then == F.col("tilt"))
        moved = both.withColumns({"tilt": F.when(settled, F.col("tilt")).otherwise(then), "settled": settled}).drop("sum", "slope", "over")
        now, new_path = written(moved, "mix-tilts")
        dropped(spark, path)
        state, path = now, new_path
    return state.drop("low", "high", "settled")


def copies(histogram: DataFrame, solved: DataFrame, most: int = MOST) -> DataFrame:
    """``histogram`` (no_source, source, size, n) with source_size, target, rate and total, the copies that all n documents of
    the size get together, from 0 to ``most * n``; a source's words come within its small documents' size of its target.

    From the largest size down, totals follow the running sum of what the rates ask for; that leaves at most the largest
    size over or under.  The rest goes, from large sizes to small, to the sizes of each power of two that can take most of
    it: ``SIZES`` of each at most, so under 64 times as many a source.
    """
    rate = F.when(F.col("tilt").isNull(), F.lit(float(most))).otherwise(F.exp(F.least(F.col("tilt") * F.col("size"), F.lit(math.log(most)))))
    rated = histogram.join(solved.select(*SOURCE, "source_size", "target", "tilt"), SOURCE)
    rated = rated.withColumn("rate", F.when(F.col("size") == 0, F.lit(1.0)).otherwise(F.least(rate, F.lit(float(most))))).drop("tilt")
    falling = Window.partitionBy(*SOURCE).orderBy(F.desc("size"))
    through = F.floor(F.sum(F.col("n") * F.col("rate")).over(falling.rowsBetween(Window.unboundedPreceding, 0)) + 0.5)
    rated = rated.withColumn("through", through).withColumn("total", F.col("through") - F.lag("through", 1, 0).over(falling)).drop("through")
    rated, path = written(rated.withColumn("total", F.greatest(F.lit(0), F.least(most * F.col("n"), F.col("total"))).cast("bigint")), "mix-rates")
    rest = rated.groupBy(*SOURCE).agg((F.round(F.first("target")).cast("bigint") - F.sum(F.col("total") * F.col("size"))).alias("rest"))
    room = F.when(F.col("rest") > 0, most * F.col("n") - F.col("total")).otherwise(F.col("total"))
    able = rated.where("size > 0").join(rest.where("rest <> 0"), SOURCE).withColumn("room", room).where("room > 0 and size <= abs(rest)")
    nth = F.row_number().over(Window.partitionBy(*SOURCE, "two").orderBy(F.desc(F.col("room") * F.col("size")), "size"))
    able = able.withColumn("two", F.floor(F.log2("size"))).withColumn("nth", nth).where(F.col("nth") <= SIZES)
    lists = able.groupBy(*SOURCE, "rest").agg(F.sort_array(F.collect_list(F.struct("size", "room")), asc=False).alias("sizes"))

    def passed(state: Column, c: Column) -> Column:
        more = F.least(c["room"], F.floor(F.abs(state["rest"]) / c["size"]).cast("bigint")) * F.signum(state["rest"]).cast("bigint")
        return F.struct((state["rest"] - more * c["size"]).alias("rest"), F.concat(state["moves"], F.array(F.struct(c["size"].alias("size"), more.alias("more")))).alias("moves"))

    none = F.array().cast("array<struct<size:bigint,more:bigint>>")
    folded = F.aggregate("sizes", F.struct(F.col("rest").alias("rest"), none.alias("moves")), passed)
    moves = lists.select(*SOURCE, F.inline(F.filter(folded["moves"], lambda m: m["more"] != 0)))
    both = rated.join(moves, [*SOURCE, "size"], "left")
    return both.withColumn("total", F.col("total") + F.coalesce("more", F.lit(0))).drop("more")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: int = MOST) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies, taken: how often the mix takes each row of ``docs``
    (doc_id, text, source).

    ``taken`` is ``copies * size``.  Of documents of one source and size, those first by a hash of doc_id get the copy more.
    Rows without words are taken once and count nothing.  A null source is a source of its own, after all others; a null
    doc_id hashes like any other; repeated rows are rows of their own; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").isNull().alias("no_source"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        word_count(F.col("text")).alias("size"), F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int").alias("bucket"),
    )
    narrow, _ = written(narrow, "mix-documents")
    cells, cell_path = written(narrow.groupBy(*SOURCE, "size", "bucket").agg(F.count("*").alias("n")), "mix-cells")
    histogram, hist_path = written(cells.groupBy(*SOURCE, "size").agg(F.sum("n").alias("n")), "mix-sizes")
    sources = histogram.groupBy(*SOURCE).agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    plan, _ = written(copies(histogram, tilts(histogram, targets(sources, weights, most), most), most), "mix-plan")
    # every document of a size gets the whole part of its share of their copies, and the first of them, bucket by bucket, one more
    before = Window.partitionBy(*SOURCE, "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = cells.select(*SOURCE, "size", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    base, left = F.floor(F.col("total") / F.col("n")), F.col("total") % F.col("n") - F.col("ahead")
    quota = ahead.join(plan, [*SOURCE, "size"]).select(*SOURCE, "size", "bucket", "source_size", "target", "rate", base.cast("bigint").alias("base"), left.alias("left"))
    quota, _ = written(quota, "mix-quotas")
    dropped(spark, cell_path, hist_path)
    nth = F.row_number().over(Window.partitionBy(*SOURCE, "size", "bucket").orderBy("doc_id"))
    ranked = narrow.withColumn("nth", nth).join(quota, [*SOURCE, "size", "bucket"])
    times = F.col("base") + F.when(F.col("nth") <= F.col("left"), 1).otherwise(0)
    return ranked.withColumn("copies", times).select(
        "doc_id", F.when(~F.col("no_source"), F.col("source")).alias("source"), "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
