"""Mixing sources to target weights: whole epochs, then an Efraimidis-Spirakis sample of the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakejobs.llm.common import stored, whole_text, without, word_count

#: Key ranges to a doubling of the key; only the range in which the budget of a source ends is put in order.
RANGES = 512


def sample_key(identity: Column, weight: Column, seed: int = 0) -> Column:
    """Exponential key ``-ln(u) / weight`` of Efraimidis and Spirakis; ``u`` in (0, 1) is a seeded hash.

    A weight of 0 or less gives an infinite key: such a row is never drawn. A null weight counts as 1.
    """
    digits = F.substring(F.md5(F.concat(F.coalesce(identity.cast("string"), F.lit("")), F.lit(f":{seed}"))), 1, 13)
    uniform = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2**52))
    positive = F.coalesce(weight.cast("double"), F.lit(1.0))
    return F.when(positive > 0, F.try_divide(-F.ln(uniform), positive)).otherwise(F.lit(float("inf")))


def key_range(drawn: Column, ranges: int = RANGES) -> Column:
    """Range of a sample key: equal parts of its logarithm, so weights of any size spread the keys of a source alike.

    About one row of a thousand falls into the fullest range. Infinite keys have the last one, keys of zero the first.
    """
    return F.when(drawn == float("inf"), 2**30).when(drawn <= 0, -(2**30)).otherwise(F.floor(F.log2(drawn) * ranges)).cast("int")


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """Budget of each source: (source, source_size) -> (source, source_size, target).

    Sources in code point order, null last, take the weights in turn. A target
    stops at ``most`` times the source's size; what is above goes to the others
    by weight. That fixed point is found in closed form: in the order of
    ``cap / weight`` the first sources are capped, the others share the rest.
    The frame has one row for each source, so one task orders it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = sizes.select("source", "source_size", F.element_at(
        cycle, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int")).alias("weight"))
    ranked = ranked.withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(from_here)
    leveled = ranked.withColumn("level", level).withColumn("free", F.col("cap") / F.col("weight") >= F.col("level"))
    # The first source that is not capped fixes the level of all that follow it.
    first = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(
        by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return leveled.select("source", "source_size", F.when(first.isNull(), F.col("cap")).otherwise(
        F.least(F.col("cap"), F.col("weight") * first)).alias("target"))


def cutoffs(keys: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0,
            ranges: int = RANGES) -> DataFrame:
    """One row for each source: its budget, whole epochs and the last (key, tie) the fractional part takes.

    ``keys`` holds ``source, size, sample_key, tie``. Words are summed by key range
    first; only rows of the one range in which a budget ends are put in order,
    so a source with most of all rows never meets in one task.
    """
    ranged = keys.withColumn("key_range", key_range(F.col("sample_key"), ranges))
    by_range = ranged.groupBy("source", "key_range").agg(F.sum("size").alias("words"))
    budgets = targets(by_range.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    budgets = budgets.withColumn("epochs", F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
    budgets = budgets.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    before = Window.partitionBy("source").orderBy("key_range").rowsBetween(Window.unboundedPreceding, -1)
    until = by_range.withColumn("words_before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    last = until.alias("u").join(budgets.alias("b"), F.col("u.source").eqNullSafe(F.col("b.source"))).where(
        (F.col("words_before") <= F.col("rest")) & (F.col("words_before") + F.col("words") > F.col("rest"))).select(
        F.col("u.source").alias("last_source"), F.col("key_range").alias("last_range"), "words_before", "rest")
    edge = ranged.join(last, F.col("source").eqNullSafe(F.col("last_source")) & (F.col("key_range") == F.col("last_range")))
    tied = edge.groupBy("source", "sample_key", "tie", "words_before", "rest").agg(F.sum("size").alias("words"))
    running = Window.partitionBy("source").orderBy("sample_key", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = F.col("words_before") + F.sum("words").over(running) - F.col("rest")
    taken = tied.withColumn("over", over).where(F.col("sample_key") < float("inf")).where(
        (F.col("over") <= 0) | ((F.col("over") < F.col("words")) & (F.col("over") * 2 <= F.col("words"))))
    cut = taken.groupBy("source").agg(F.max(F.struct("sample_key", "tie")).alias("cut")).select(
        F.col("source").alias("cut_source"), "cut")
    floor = last.select("last_source", "last_range")
    return budgets.join(floor, F.col("source").eqNullSafe(F.col("last_source")), "left").join(
        cut, F.col("source").eqNullSafe(F.col("cut_source")), "left").select(
        F.col("source").alias("cut_source"), "source_size", "target", "epochs", "rest", "last_range",
        F.col("cut.sample_key").alias("cut_key"), F.col("cut.tie").alias("cut_tie"))


def mix(docs: DataFrame, quality: DataFrame | None = None, weight: Column | None = None, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 0,
        ranges: int = RANGES) -> DataFrame:
    """Every row of ``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``weight``, an expression over ``docs``, and ``quality`` (``key``, ``weight``, 1
    where a row has none) scale the sampling keys; a null weight counts as 1, and a row of
    weight 0 or less is there in whole epochs but never in the fractional part. A source first takes whole epochs; the words still missing are
    taken in the order of the keys. The row that crosses the budget is taken if
    that comes nearer to it.

    Null texts have size 0, null sources form one source, equal keys are ordered
    by hash of the text, repeated rows are taken together or not at all, an empty
    table gives no rows, and columns named like the new ones are replaced.
    """
    docs = without(docs, "size", "source_size", "target", "copies", "taken")
    # Everything that reads the text comes before the join, so that only what is asked for passes its shuffle.
    rows = docs.withColumn("size", word_count(whole_text(text))).withColumn("__tie", F.xxhash64(F.col(key), F.col(text)))
    rows = rows.withColumn("__weight", F.coalesce((F.lit(1.0) if weight is None else weight).cast("double"), F.lit(1.0)))
    if quality is not None:
        one = quality.groupBy(F.col(key).alias("__quality_key")).agg(F.max("weight").cast("double").alias("__quality"))
        rows = rows.join(one, F.col(key) == F.col("__quality_key"), "left").withColumn(
            "__weight", F.col("__weight") * F.coalesce(F.col("__quality"), F.lit(1.0))).drop("__quality_key", "__quality")
    drawn = rows.withColumn("__key", sample_key(F.col(key), F.col("__weight"), seed))
    keys = stored(drawn.select(F.col(source).alias("source"), "size", F.col("__key").alias("sample_key"), F.col("__tie").alias("tie")), "mix-keys")
    # One row for each source, written: Spark broadcasts it only if its files are small.
    plan = stored(cutoffs(keys, weights, share, most, ranges), "mix-cutoffs")
    planned = drawn.join(plan, F.col(source).eqNullSafe(F.col("cut_source")))
    in_range = key_range(F.col("__key"), ranges)
    at_edge = F.coalesce((F.col("__key") < F.col("cut_key")) | ((F.col("__key") == F.col("cut_key")) & (F.col("__tie") <= F.col("cut_tie"))), F.lit(False))
    extra = (F.col("rest") > 0) & (F.col("__key") < float("inf")) & F.coalesce((in_range < F.col("last_range")) | ((in_range == F.col("last_range")) & at_edge), F.lit(False))
    mixed = planned.withColumn("copies", (F.col("epochs") + extra.cast("int")).cast("int"))
    mixed = mixed.withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns], "size", "source_size", "target", "copies", "taken")
