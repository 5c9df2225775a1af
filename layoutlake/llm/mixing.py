"""Mixing sources to target weights by entropy balancing.

For each source the documents' rates r minimise the relative entropy to rate 1,
sum of r ln r - r + 1, subject to the source's token constraint
sum of r * size = target and 0 <= r <= 2.  The solution tilts exponentially,
r = min(2, exp(lambda * x)) with x = size / the source's mean size, and lambda
maximises a concave dual.  Newton steps, safeguarded by a bracket, solve all
sources at once: a step is one aggregation over the counts of (source, size),
to which the documents are reduced beforehand without loss.

Rates become copies: with a hashed uniform number u for each document, its first
copy is taken if u - r is below the source's ``shift`` and its second if u - r + 1
is.  A shift of 0 is unbiased rounding; the shift at which the taken words come
nearest the target is found by repeated histograms, and a second search among
documents no larger than what is left over corrects the rest.  Copies depend on
doc_id, size and source alone, so reruns agree at any partitioning, and repeated
rows share their fate.

Everything runs as DataFrame operations.  Null texts have size 0, a null source
is a source of its own that stands last, a null doc_id is hashed like any value;
documents of size 0 take one copy of no words (so do sources that have no others).
An empty table gives an empty result; texts of any length are counted whole.  Sources are assumed to be far
fewer than documents: one row for each source is sorted in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layoutlake.llm.common import drop_written, small, table, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
TOLERANCE = 1e-6
STEPS = 60
BINS = 64
PASSES = 4
OWN = ("size", "source_size", "target", "rate", "copies", "taken")


def with_size(docs: DataFrame) -> DataFrame:
    """``docs`` with ``size``, the number of words of ``text``."""
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"))


def targets(sizes: DataFrame) -> DataFrame:
    """Per source of (source, source_size, documents): its place, weight and target.

    Targets are min(weight * level, 2 * size): the level at which they add up to
    the mix's size is what sharing excess out again and again arrives at.
    """
    w = Window.partitionBy(F.lit(0))
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int")).cast("double")
    ranked = sizes.withColumn("place", F.row_number().over(w.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn("weight", weight)
    by_cap = w.orderBy(MOST * F.col("source_size") / F.col("weight"), "place")
    total = SHARE * F.sum("source_size").over(w)
    # sources before this one are at their caps, this and the later ones share the rest
    full = ranked.withColumn("capped", F.coalesce(F.sum(MOST * F.col("source_size")).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    full = full.withColumn("open", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))).withColumn("level", (total - F.col("capped")) / F.col("open"))
    # the first in this order that stays below its cap sets the level for all
    full = full.withColumn("turn", F.row_number().over(by_cap))
    full = full.withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= MOST * F.col("source_size"), F.struct("turn", "level"))).over(w)["level"])
    return full.select("source", "place", "weight", "source_size", "documents", F.least(MOST * F.col("source_size"), F.coalesce(F.col("weight") * F.col("level"), MOST * F.col("source_size"))).cast("double").alias("target"))


def _rate(size, tilt, mean):
    return F.when(tilt.isNull(), F.lit(MOST)).otherwise(F.least(F.lit(MOST), F.exp(tilt * size / mean)))


def tilts(counts: DataFrame, goals: DataFrame, near) -> DataFrame:
    """Newton's steps on the dual: (place, tilt, mean); a null tilt makes every rate 2.

    ``counts`` has (place, size, n) with size over 0; ``near`` marks a table of
    sources for broadcast where their number allows it.
    """
    full = F.col("target") >= MOST * F.col("source_size") * (1 - 1e-12)
    state = goals.select("place", "target", "source_size", F.coalesce(F.try_divide("source_size", "documents"), F.lit(1.0)).alias("mean"), full.alias("full"))
    state = state.withColumn("tilt", F.when(~F.col("full"), F.log(F.greatest(F.try_divide("target", "source_size"), F.lit(1e-12)))))
    # at the upper end even a document of one word has rate 2
    state = state.withColumn("low", F.lit(-700.0) * F.col("mean")).withColumn("high", F.lit(0.7) * F.col("mean") + 1)
    state = state.withColumn("open", ~F.col("full"))
    rate = F.exp(F.col("tilt") * F.col("size") / F.col("mean"))
    words = F.col("n") * F.col("size")
    state = written(state, "mix-state")
    for _ in range(STEPS):
        moved = counts.join(near(state), "place").filter("open")
        # beyond the cap a rate doesn't move
        sums = moved.groupBy("place").agg(F.sum(words * F.least(F.lit(MOST), rate)).alias("words"), F.sum(F.when(rate < MOST, words * rate * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"))
        both = near(sums).join(state, "place", "right").withColumn("gap", F.col("words") - F.col("target"))
        both = both.withColumn("low", F.when(F.col("gap") < 0, F.col("tilt")).otherwise(F.col("low"))).withColumn("high", F.when(F.col("gap") >= 0, F.col("tilt")).otherwise(F.col("high")))
        newton = F.col("tilt") - F.try_divide("gap", "slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        done = F.col("gap").isNull() | (F.abs("gap") <= TOLERANCE * F.col("target"))
        both = both.withColumn("open", ~done).withColumn("tilt", F.when(F.col("full"), None).when(done, F.col("tilt")).when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2))
        # cut here: a step reads its state twice, so plans would double
        before, state = state, written(both.select(*state.columns), "mix-state")
        drop_written(before)
        if state.filter("open").isEmpty():
            break
    return state.select("place", "tilt", "mean")


def _uniform():
    return F.pmod(F.xxhash64("doc_id", F.lit(20_011)), F.lit(1 << 52)) / float(1 << 52)


def _shift(steps: DataFrame, goals: DataFrame, near) -> DataFrame:
    """(place, shift): the steps with ``mark`` below it come nearest ``wanted`` words.

    ``steps`` has (place, size, mark), ``goals`` (place, wanted).
    """
    state = goals.select("place", "wanted", F.lit(-2.0).alias("low"), F.lit(2.0).alias("high"), F.lit(0.0).alias("base"), F.lit(0.0).alias("reach"))
    state = written(state, "mix-shift")
    w = Window.partitionBy("place").orderBy("bin")
    width = (F.col("high") - F.col("low")) / BINS
    for _ in range(PASSES):
        inside = steps.join(near(state), "place").filter((F.col("mark") >= F.col("low")) & (F.col("mark") < F.col("high")))
        bin_ = F.least(F.floor((F.col("mark") - F.col("low")) / width), F.lit(BINS - 1))
        sums = inside.groupBy("place", bin_.alias("bin")).agg(F.sum("size").cast("double").alias("words"), F.first("base").alias("start"), F.first("wanted").alias("goal"))
        sums = sums.withColumn("through", F.col("start") + F.sum("words").over(w))
        crossing = sums.filter("through >= goal").groupBy("place").agg(F.min(F.struct("bin", "through", "words")).alias("c"))
        none = F.col("c").isNull()  # without a crossing all of them are wanted
        following = near(crossing).join(state, "place", "right").select(
            "place",
            "wanted",
            F.when(none, F.col("high")).otherwise(F.col("low") + F.col("c.bin") * width).alias("low"),
            F.when(none, F.col("high")).otherwise(F.col("low") + (F.col("c.bin") + 1) * width).alias("high"),
            F.when(none, F.col("base")).otherwise(F.col("c.through") - F.col("c.words")).alias("base"),
            F.when(none, F.col("reach")).otherwise(F.col("c.through")).alias("reach"),
        )
        before, state = state, written(following, "mix-shift")
        drop_written(before)
    nearer = F.abs(F.col("reach") - F.col("wanted")) < F.abs(F.col("base") - F.col("wanted"))
    return state.select("place", F.when(nearer, F.col("high")).otherwise(F.col("low")).alias("shift"))


def plan(docs: DataFrame) -> DataFrame:
    """One row for each source: what ``apply`` needs to give every document its copies.

    ``docs`` has (doc_id, source, size).
    """
    counted = written(docs.groupBy("source", "size").agg(F.count("*").alias("n")), "mix-counts")
    sizes = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum(F.when(F.col("size") > 0, F.col("n")).otherwise(0)).alias("documents"))
    goals = written(targets(sizes), "mix-goals")
    # all tables of sources have as many rows as this one and no wider columns
    few = small(goals) is not goals
    near = F.broadcast if few else lambda df: df
    places = goals.select(F.col("source").alias("its_source"), "place")
    counts = written(counted.filter("size > 0").join(near(places), F.col("source").eqNullSafe(F.col("its_source"))).select("place", "size", "n"), "mix-sizes")
    tilted = written(goals.join(tilts(counts, goals, near), "place", "left"), "mix-tilts")
    placed = docs.filter("size > 0").join(near(tilted.withColumnRenamed("source", "its_source")), F.col("source").eqNullSafe(F.col("its_source")))
    first = _uniform() - _rate(F.col("size"), F.col("tilt"), F.col("mean"))
    steps = written(placed.filter(F.col("tilt").isNotNull()).select("place", "size", F.explode(F.array(first, first + 1)).alias("mark")), "mix-steps")
    wanted = tilted.select("place", F.col("target").alias("wanted"))
    shifts = _shift(steps, wanted, near)
    # documents no larger than what is left over then get a shift of their own
    taken = lambda: F.sum(F.when(F.col("mark") < F.col("shift"), F.col("size")).otherwise(0)).cast("double")
    has = steps.join(near(shifts), "place").groupBy("place").agg(taken().alias("has"))
    left = wanted.join(has, "place").select("place", (F.col("wanted") - F.col("has")).alias("left"))
    left = written(left.withColumn("limit", F.floor(F.abs("left")).cast("long")).join(shifts, "place"), "mix-left")
    inside = written(steps.join(near(left), "place").filter(F.col("size") <= F.col("limit")).select("place", "size", "mark", "shift", "left"), "mix-small")
    goal = inside.groupBy("place").agg((taken() + F.max("left")).alias("wanted"))
    fine = _shift(inside.select("place", "size", "mark"), goal, near).withColumnRenamed("shift", "small_shift")
    shifts = left.select("place", "shift", "limit").join(fine, "place", "left").select("place", "shift", F.when(F.col("small_shift").isNull(), -1).otherwise(F.col("limit")).alias("limit"), "small_shift")
    out = written(tilted.join(shifts, "place", "left"), "mix-plan")
    drop_written(counted, goals, counts, tilted, steps, left, inside)
    return out


def apply(docs: DataFrame, planned: DataFrame) -> DataFrame:
    """``docs`` (doc_id, source, size and others) with source_size, target, rate, copies and taken."""
    kept = [c for c in docs.columns if c not in OWN[1:]]
    own = planned.select(F.col("source").alias("its_source"), *(c for c in planned.columns if c != "source"))
    own = own.select(*(F.col(c).alias(f"mix_{c}") for c in own.columns))
    both = docs.select(kept).join(small(own), F.col("source").eqNullSafe(F.col("mix_its_source")), "left")
    both = both.withColumn("rate", _rate(F.col("size"), F.col("mix_tilt"), F.col("mix_mean")))
    shift = F.coalesce(F.when(F.col("size") <= F.col("mix_limit"), F.col("mix_small_shift")).otherwise(F.col("mix_shift")), F.lit(0.0))
    first = _uniform() - F.col("rate")
    copies = F.when(first + 1 < shift, 2).when(first < shift, 1).otherwise(0)
    both = both.withColumn("copies", F.when(F.col("size") == 0, F.lit(1)).otherwise(copies).cast("int"))
    return both.select(*kept, F.col("mix_source_size").alias("source_size"), F.col("mix_target").alias("target"), "rate", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = written(with_size(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text"), "mix-docs")
    return apply(docs, plan(docs)).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")
