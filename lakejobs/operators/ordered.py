"""Order-dependent operators that do not put a whole key into one task.

A plain window over ``partitionBy(key).orderBy(ts)`` sends every row of a key to
one task. Here the ordered rows are cut into slices of about equal size, windows
run inside ``(key, slice)``, and what earlier slices contribute comes in as a row
of its own at the head of the window. Results equal the plain window's, and
every frame runs the same plan, whatever its size.

Slice borders are literals, so a recomputed task puts a row into the same slice
as before. They are rows of the order columns, compared as a whole with NULL
first, so any orderable type works, NULLs have their place, and a value with
many rows is cut by the next order column in proportion to its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.session import written

ROWS_PER_SLICE = 5_000_000
#: Borders kept as literals; larger frames have larger slices.
MAX_SLICES = 2048
#: Rows looked at for each slice when borders are placed. Borders decide balance only, never results.
SAMPLED_ROWS = 64
SLICE = "_slice"
FIRST = "_first"


def axis(df: DataFrame, column: str) -> Column:
    """Ordered column as a double: micros for dates and times, the value for numbers, the first six bytes for strings."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp")).cast("double")
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.substring(F.hex(column), 1, 12), 12, "0"), 16, 10).cast("double")
    return F.col(column).cast("double")


@dataclass(frozen=True)
class Slices:
    """Ascending border rows of the order columns; a row belongs to the slice of the last border not after it."""

    borders: tuple[tuple, ...] = ()

    @property
    def single(self) -> bool:
        return not self.borders

    def assign(self, df: DataFrame, order: list[str], name: str = SLICE) -> DataFrame:
        """Add the slice number, which grows with the order."""
        if self.single:
            return df.withColumn(name, F.lit(0))
        columns = order[:len(self.borders[0])]
        kinds = [df.schema[c].dataType for c in columns]
        own = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)])
        # Two short searches in place of one over all borders: the group of borders first, then inside it.
        width = max(1, round(len(self.borders) ** 0.5))
        groups = [self.borders[i:i + width] for i in range(0, len(self.borders), width)]

        def literal(border: tuple) -> Column:
            return F.struct(*[F.lit(v).cast(kind).alias(f"k{i}") for i, (v, kind) in enumerate(zip(border, kinds))])

        def passed(borders: Column) -> Column:
            return F.size(F.filter(borders, lambda b: b <= own))

        group = passed(F.array(*[literal(g[0]) for g in groups]))
        inside = passed(F.get(F.array(*[F.array(*[literal(b) for b in g]) for g in groups]), group - 1))
        return df.withColumn("_group", group).withColumn(
            name, F.when(F.col("_group") == 0, 0).otherwise((F.col("_group") - 1) * width + inside).cast("int")).drop("_group")


def plan_slices(df: DataFrame, order: str | list[str], rows_per_slice: int = ROWS_PER_SLICE) -> Slices:
    """Borders so that a slice holds about ``rows_per_slice`` rows, whatever the keys are.

    A count, then a sample of ``SAMPLED_ROWS`` rows for each slice, range
    partitioned by the order columns: the first row of each range is a border. At
    most ``MAX_SLICES`` rows reach the driver.
    """
    columns = [order] if isinstance(order, str) else order
    rows = df.count()
    wanted = min(MAX_SLICES, -(-rows // rows_per_slice))
    if wanted <= 1:
        return Slices()
    share = min(1.0, wanted * SAMPLED_ROWS / rows)
    named = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)])
    sampled = named.sample(share, seed=7) if share < 1 else named
    cut = sampled.repartitionByRange(wanted, *[F.col(c).asc_nulls_first() for c in named.columns])
    first = cut.groupBy(F.spark_partition_id().alias("part")).agg(F.min(F.struct(*named.columns)).alias("b"))
    found = sorted(first.collect(), key=lambda r: r["part"])
    return Slices(tuple(dict.fromkeys(tuple(r["b"]) for r in found[1:])))


def _tail_safe(items: Column, n: int) -> Column:
    """Last ``n`` entries of an array."""
    return F.when(F.size(items) > n, F.slice(items, -n, n)).otherwise(items)


def dense_number(
    df: DataFrame, order: list[str], name: str, start: int = 1, step: int = 1, slices: Slices | None = None
) -> DataFrame:
    """``row_number`` over the whole frame without a one-task window.

    Rows are numbered inside each slice and moved by the row count of earlier
    slices, a table of at most ``MAX_SLICES`` rows. ``order`` together must be
    unique for repeatable numbers.
    """
    cut = slices if slices is not None else plan_slices(df, order[:2])
    placed = cut.assign(df, order)
    offsets = placed.groupBy(SLICE).agg(F.count("*").alias("_n")).select(
        SLICE,
        F.coalesce(
            F.sum("_n").over(Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
    )
    inside = F.row_number().over(Window.partitionBy(SLICE).orderBy(*order))
    numbered = placed.withColumn("_row", inside).join(offsets, SLICE)
    number = F.lit(start) + F.lit(step) * (F.col("_before") + F.col("_row") - 1)
    return numbered.withColumn(name, number.cast("long")).drop(SLICE, "_row", "_before")


def running_totals(
    df: DataFrame, keys: list[str], order: list[str], totals: dict[str, Column], slices: Slices | None = None
) -> DataFrame:
    """Sum of the earlier rows of each key (the current row excluded), 0 for the first row.

    NULL keys are one key and NULL order values come first, as in a plain window.
    """
    cut = slices if slices is not None else plan_slices(df, order[:2])
    inputs = {name: f"_in_{name}" for name in totals}
    placed = cut.assign(df, order).withColumns({inputs[n]: c for n, c in totals.items()})
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    per_slice = placed.groupBy(*keys, SLICE).agg(*[F.sum(inputs[n]).alias(inputs[n]) for n in totals])
    carry = per_slice.select(*keys, SLICE, *[F.sum(inputs[n]).over(before).alias(inputs[n]) for n in totals])
    rows = placed.withColumn(FIRST, F.lit(1)).unionByName(carry.withColumn(FIRST, F.lit(0)), allowMissingColumns=True)
    earlier = Window.partitionBy(*keys, SLICE).orderBy(FIRST, *order).rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.withColumns({n: F.coalesce(F.sum(inputs[n]).over(earlier), F.lit(0)) for n in totals})
    return counted.where(F.col(FIRST) == 1).drop(SLICE, FIRST, *inputs.values())


#: Rows back that ``trailing_sums`` adds up in Arrow batches; deeper sums go through window frames.
BATCHED_ROWS = 64


class Starts:
    """For sorted batches: number of the first row of each row's run of equal ``columns``."""

    def __init__(self, columns: list[str]):
        self.columns, self.last, self.start = columns, None, 0

    def of(self, batch: pa.RecordBatch, number: int) -> np.ndarray:
        new = np.zeros(batch.num_rows, dtype=bool)
        own = [batch.column(c) for c in self.columns]
        for i, column in enumerate(own):
            before = self.last[i] if self.last else column.slice(0, 1)
            a, b = pa.concat_arrays([before, column.slice(0, len(column) - 1)]), column
            differ = pc.or_(pc.xor(a.is_null(), b.is_null()), pc.fill_null(pc.not_equal(a, b), False))
            if pa.types.is_floating(column.type):
                differ = pc.and_not(differ, pc.fill_null(pc.and_(pc.is_nan(a), pc.is_nan(b)), False))
            new |= differ.to_numpy(zero_copy_only=False)
        self.last = [c.slice(len(c) - 1) for c in own]
        starts = np.maximum.accumulate(np.where(new, number + np.arange(len(new)), self.start))
        self.start = starts[-1]
        return starts


def _batched_sums(
    sums: dict[str, tuple[str, int, tuple[str, ...]]], totals: dict[str, str], keys: list[str], out: list[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums over earlier rows of sorted Arrow batches; what the next batch needs is the last rows and the totals.

    ``sums`` is {name: (column, rows back, columns that must be equal too)}, ``totals`` {name: whole-number column}.
    """
    depth = max(n for _, n, _ in sums.values())

    def values(batch: pa.RecordBatch, column: str) -> np.ndarray:
        whole = pa.types.is_integer(batch.schema.field(column).type)
        return batch.column(column).cast(pa.int64() if whole else pa.float64()).fill_null(0).to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = {equal: Starts([*keys, *equal]) for equal in {(), *[e for _, _, e in sums.values()]}}
        tails: dict[str, np.ndarray] = {}
        carried = {name: (0, 0) for name in totals}  # sum of all rows before the batch, and of those before its first key
        number = 0
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            at = number + np.arange(rows)
            starts = {equal: r.of(batch, number) for equal, r in runs.items()}
            made = {}
            for column in dict.fromkeys(c for c, _, _ in sums.values()):
                own = values(batch, column)
                before = tails.get(column, np.zeros(depth, own.dtype))
                series = np.concatenate([before, own])
                tails[column] = series[-depth:]
                for name, (source, n, equal) in sums.items():
                    if source == column:
                        total = np.zeros(rows, own.dtype)
                        for i in range(n, 0, -1):  # oldest first, as a frame adds them up
                            total += np.where(at - i >= starts[equal], series[depth - i:depth - i + rows], 0)
                        made[name] = total
            for name, column in totals.items():
                own = values(batch, column)
                sum_before, key_before = carried[name]
                before = sum_before + np.cumsum(own) - own
                inside = starts[()] >= number
                first = np.where(inside, before[np.maximum(starts[()] - number, 0)], key_before)
                made[name] = before - first
                carried[name] = (before[-1] + own[-1], first[-1])
            number += rows
            arrays = [pa.array(made[c]) if c in made else batch.column(c) for c in out]
            yield pa.RecordBatch.from_arrays(arrays, names=out).filter(pc.equal(batch.column(FIRST), 1))

    return run


def trailing_sums(
    df: DataFrame, keys: list[str], order: list[str], sums: dict[str, tuple], slices: Slices | None = None,
    totals: dict[str, Column] | None = None, keep: list[str] | None = None,
) -> DataFrame:
    """Sums over the ``n`` rows before each row of its key: {name: (value, n)}; 0 where there is none.

    A third entry names leading order columns that must also be equal: (value, n, ["day"])
    sums only rows of the same day, within the same shuffle and sort. ``totals``
    are sums over all earlier rows, as in ``running_totals``, in that shuffle too.
    ``keep`` names the columns of ``df`` that are returned (all where it is not given).

    Across slices the rows themselves are carried: each (key, slice) gets the last
    rows of earlier slices as context, runs the plain window and drops them again.
    Spark deals and sorts the rows; up to ``BATCHED_ROWS`` back they are then added
    up in Arrow batches, a column at a time, in place of a sliding frame that is
    evaluated again for every row and sum. ``totals`` are whole numbers.
    """
    cut = slices if slices is not None else plan_slices(df, order[:2])
    totals = totals or {}
    deepest = max(spec[1] for spec in sums.values())
    named: dict[int, str] = {}  # a value that several sums share is carried once
    inputs = {name: named.setdefault(id(spec[0]), f"_in_{name}") for name, spec in sums.items()}
    fields = list(named.values())
    running = {name: f"_run_{name}" for name in totals}
    placed = cut.assign(df, order).withColumns({
        **{inputs[k]: spec[0] for k, spec in sums.items()}, **{running[k]: value for k, value in totals.items()}})
    kept = [c for c in (df.columns if keep is None else keep) if c not in sums and c not in totals]
    placed = placed.select(*dict.fromkeys([*keys, SLICE, *order, *kept, *fields, *running.values()]))
    newest = Window.partitionBy(*keys, SLICE).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    entry = F.struct((-F.col("_back")).alias("at"), F.struct(*order, *fields).alias("row"))
    tails = (
        placed.withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= deepest)
        .groupBy(*keys, SLICE).agg(F.array_sort(F.collect_list(entry)).alias("_tail"))
    )
    # Every earlier slice of the key holds at least one row, so that many slices back are enough.
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(-deepest, -1)
    carried = _tail_safe(F.flatten(F.collect_list("_tail").over(before)), deepest)
    context = tails.select(*keys, SLICE, carried.alias("_carry")).select(
        *keys, SLICE, F.explode("_carry").alias("_c")
    ).select(*keys, SLICE, "_c.row.*", F.lit(0).alias(FIRST))
    rows = placed.withColumn(FIRST, F.lit(1)).unionByName(context, allowMissingColumns=True)
    if totals:
        # The totals of earlier slices, a row before the context; it has no values of the trailing sums.
        earlier_slices = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        carry = placed.groupBy(*keys, SLICE).agg(*[F.sum(c).alias(c) for c in running.values()]).select(
            *keys, SLICE, *[F.sum(c).over(earlier_slices).alias(c) for c in running.values()], F.lit(-1).alias(FIRST))
        rows = rows.unionByName(carry, allowMissingColumns=True)
    def leading(spec: tuple) -> bool:
        return len(spec) < 3 or list(spec[2]) == order[:len(spec[2])]

    def numeric(column: str) -> bool:
        return isinstance(placed.schema[column].dataType, (T.IntegralType, T.DoubleType, T.FloatType))

    if deepest <= BATCHED_ROWS and all(map(leading, sums.values())) and all(map(numeric, fields)):
        asked = {name: (inputs[name], spec[1], tuple(spec[2]) if len(spec) > 2 else ()) for name, spec in sums.items()}
        made = {name: T.LongType() if isinstance(placed.schema[c].dataType, T.IntegralType) else T.DoubleType()
                for name, c in inputs.items()} | {name: T.LongType() for name in totals}
        schema = T.StructType([*[df.schema[c] for c in kept], *[T.StructField(name, kind) for name, kind in made.items()]])
        dealt = rows.repartition(*keys, SLICE).sortWithinPartitions(*keys, SLICE, FIRST, *order)
        return dealt.mapInArrow(_batched_sums(asked, running, [*keys, SLICE], schema.names), schema)

    def past(n: int, equal: list[str] | None = None):
        return Window.partitionBy(*keys, SLICE, *(equal or [])).orderBy(FIRST, *order).rowsBetween(-n, -1)

    everything = Window.partitionBy(*keys, SLICE).orderBy(FIRST, *order).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.withColumns({
        **{name: F.coalesce(F.sum(inputs[name]).over(past(*spec[1:])), F.lit(0)) for name, spec in sums.items()},
        **{name: F.coalesce(F.sum(running[name]).over(everything), F.lit(0)) for name in totals}})
    return summed.where(F.col(FIRST) == 1).select(*kept, *sums, *totals)


def newest_list(df: DataFrame, keys: list[str], order: list[str], value: Column, n: int, name: str) -> DataFrame:
    """Array of ``value`` of the newest ``n`` rows per key, oldest first.

    The ``row_number <= n`` filter becomes a group limit before the shuffle, so
    at most ``n`` rows per key leave each map task.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    kept = df.withColumn("_value", value).withColumn("_back", F.row_number().over(newest)).where(F.col("_back") <= n)
    return kept.groupBy(*keys).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct((-F.col("_back")).alias("at"), "_value"))), lambda e: e["_value"]
        ).alias(name)
    )


def asof_join(
    left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, columns: list[str],
    tolerance_seconds: int | None = None, tie_break: list[str] | None = None, slices: Slices | None = None,
) -> DataFrame:
    """Every left row with the newest right row of its key at or before its time (NULLs if none).

    Both sides are stacked and the right values are carried forward inside
    ``(key, slice)``; one row at the head of each ``(key, slice)`` brings the newest
    value of earlier slices. No pairs are formed, so nothing fans out.
    ``tie_break`` names right columns that order right rows of equal time. A NULL
    key or time matches nothing; such left rows keep their place with NULLs.
    """
    cut = slices if slices is not None else plan_slices(
        left.select(F.col(left_ts).alias("t")).unionAll(right.select(F.col(right_ts).alias("t"))), "t")
    ties = tie_break or []
    fields = F.struct(F.col(right_ts).alias("_at"), *[F.col(c).alias(c) for c in columns])
    rank = F.struct(F.col(right_ts).alias("_t"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(ties)])
    row = F.struct(*[F.col(c) for c in left.columns])
    stacked_left = left.select(
        *keys, F.col(left_ts).alias("_ts"), F.lit(1).alias("_side"), row.alias("_row")
    )
    stacked_right = right.dropna(subset=[*keys, right_ts]).select(
        *keys, F.col(right_ts).alias("_ts"), F.lit(0).alias("_side"), fields.alias("_hit"), rank.alias("_rank")
    )
    both = cut.assign(stacked_left.unionByName(stacked_right, allowMissingColumns=True), ["_ts"])
    newest = both.groupBy(*keys, SLICE).agg(F.max_by("_hit", "_rank").alias("_newest"))
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = newest.select(*keys, SLICE, F.last("_newest", ignorenulls=True).over(before).alias("_hit"), F.lit(0).alias(FIRST))
    rows = both.withColumn(FIRST, F.lit(1)).unionByName(carry, allowMissingColumns=True)
    forward = Window.partitionBy(*keys, SLICE).orderBy(FIRST, "_ts", "_side", "_rank").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    filled = rows.withColumn("_found", F.last("_hit", ignorenulls=True).over(forward))
    hits = filled.where((F.col(FIRST) == 1) & (F.col("_side") == 1))
    found = F.col("_found")
    if tolerance_seconds is not None:
        age = F.unix_micros(F.col("_ts").cast("timestamp")) - F.unix_micros(F.col("_found._at").cast("timestamp"))
        found = F.when(age <= tolerance_seconds * 1_000_000, found)
    return hits.withColumn("_found", found).select("_row.*", *[F.col(f"_found.{c}").alias(c) for c in columns])


def discrete_percentiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float], slices: Slices | None = None) -> DataFrame:
    """Exact percentiles of each key: the smallest value with at least that share of the key's rows at or below it.

    Equal values are counted first; the running counts then go through slices, so
    a key with most of all rows and many values is no hot task. NULL values are
    left out; NULL keys are a key.
    """
    # Written: the slices are planned on the counts, and the totals, sums and rows read them again.
    counts = written(df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n")))
    upto = running_totals(counts, keys, [value], {"_before": F.col("_n")}, slices).withColumn("_upto", F.col("_before") + F.col("_n"))
    if keys:
        totals = counts.groupBy(*[F.col(k).alias(f"_t_{k}") for k in keys]).agg(F.sum("_n").alias("_total"))
        same = [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys]
        placed = upto.join(totals, same)
    else:
        placed = upto.withColumn("_total", counts.agg(F.sum("_n")).scalar())
    return placed.groupBy(*keys).agg(*[
        F.min(F.when(F.col("_upto") >= F.col("_total") * share, F.col(value))).alias(name) for name, share in shares.items()])
