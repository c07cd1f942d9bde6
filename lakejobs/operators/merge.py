"""Row changes as DataFrame operators: MERGE, UPDATE, DELETE and what follows from them.

Parquet tables take no MERGE statement, so a change returns the new table content
as a DataFrame; the caller writes it as a new version.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.session import ensure_checkpoint_dir

ACTION = "_action"


@dataclass(frozen=True)
class Matched:
    """WHEN MATCHED [AND condition]: update ``columns`` or delete.

    ``columns`` maps target column to an expression over ``t.`` and ``s.``;
    None copies every column the source has.
    """

    columns: dict[str, Column] | None = None
    condition: Column | None = None
    delete: bool = False


@dataclass(frozen=True)
class NotMatched:
    """WHEN NOT MATCHED [AND condition] INSERT; None inserts every column the source has."""

    columns: dict[str, Column] | None = None
    condition: Column | None = None


@dataclass(frozen=True)
class MergePlan:
    matched: Sequence[Matched] = field(default_factory=tuple)
    not_matched: Sequence[NotMatched] = field(default_factory=tuple)


UPSERT = MergePlan((Matched(),), (NotMatched(),))
INSERT_ONLY = MergePlan((), (NotMatched(),))


def changed(columns: Sequence[str]) -> Column:
    """NULL-safe test that any of the columns differs between target and source."""
    test = F.lit(False)
    for c in columns:
        test = test | ~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    return test


def reject_duplicate_keys(source: DataFrame, on: Sequence[str]) -> DataFrame:
    """One source row per key, or a failing job: more than one match would make the result ambiguous.

    A key with a NULL matches nothing, so such rows are all passed on.
    """
    missing = F.lit(False)
    for c in on:
        missing = missing | F.col(c).isNull()
    twice = F.raise_error(F.concat(F.lit("duplicate merge key: "), F.to_json(F.struct(*on))))
    rows = F.struct(*[F.col(c) for c in source.columns])
    single = source.where(~missing).groupBy(*on).agg(F.count("*").alias("_n"), F.any_value(rows).alias("_row"))
    checked = F.when(F.col("_n") > 1, twice.cast(single.schema["_row"].dataType)).otherwise(F.col("_row"))
    return single.select(checked.alias("_row")).select("_row.*").unionAll(source.where(missing))


def _clauses(plan: MergePlan, shared: list[str]) -> list[tuple[Column, str, dict[str, Column]]]:
    """(test, action, values) in clause order; a NULL condition does not fit."""
    in_t, in_s = F.col("t._in_t").isNotNull(), F.col("s._in_s").isNotNull()
    everything = {c: F.col(f"s.{c}") for c in shared}

    def also(condition: Column | None) -> Column:
        return F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))

    pieces = []
    for clause in plan.matched:
        values = {} if clause.delete else everything if clause.columns is None else clause.columns
        pieces.append((in_t & in_s & also(clause.condition), "delete" if clause.delete else "update", values))
    for clause in plan.not_matched:
        values = everything if clause.columns is None else clause.columns
        pieces.append((~in_t & also(clause.condition), "insert", values))
    return pieces


def _resolve(joined: DataFrame, target: DataFrame, pieces) -> DataFrame:
    """Column values and action of each joined row from the first clause that fits."""

    def first_fit(pick, otherwise: Column) -> Column:
        result = None
        for test, action, values in pieces:
            chosen = pick(action, values)
            result = F.when(test, chosen) if result is None else result.when(test, chosen)
        return otherwise if result is None else result.otherwise(otherwise)

    columns = []
    for f in target.schema.fields:
        own = F.col(f"t.{f.name}")

        def value(action, values, own=own, f=f):
            missing = F.lit(None).cast(f.dataType) if action == "insert" else own
            return values[f.name].cast(f.dataType) if f.name in values else missing

        columns.append(first_fit(value, own).alias(f.name))
    in_t = F.col("t._in_t").isNotNull()
    action = first_fit(lambda a, _: F.lit(a), F.when(in_t, F.lit("keep")).otherwise(F.lit("skip")))
    return joined.select(*columns, action.alias(ACTION)).where(F.col(ACTION) != "skip")


def merge_actions(
    target: DataFrame, source: DataFrame, on: Sequence[str], plan: MergePlan = UPSERT, small_source: bool = False
) -> DataFrame:
    """Resulting rows with an ``_action`` column (keep, update, delete, insert); first clause that fits wins.

    The general form is one full outer join. ``small_source`` splits it: a left
    join brings updates to the target rows, and the source rows without a target
    key are appended. Spark can then broadcast the source, if its size is under
    the broadcast threshold, and the wide target rows are not shuffled; only the
    key columns of the target are read a second time.
    """
    one = reject_duplicate_keys(source, on)
    pieces = _clauses(plan, [c for c in one.columns if c in target.columns])
    t = target.withColumn("_in_t", F.lit(True)).alias("t")
    s = one.withColumn("_in_s", F.lit(True)).alias("s")
    same_key = [F.col(f"t.{c}") == F.col(f"s.{c}") for c in on]
    if not plan.not_matched:
        return _resolve(t.join(s, same_key, "left"), target, pieces)
    if not small_source:
        return _resolve(t.join(s, same_key, "full"), target, pieces)
    kept = _resolve(t.join(s, same_key, "left"), target, pieces)
    known = target.select(*on).join(source.select(*on), list(on), "left_semi")
    fresh = one.join(known, list(on), "left_anti").withColumn("_in_s", F.lit(True)).alias("s")
    no_target = target.limit(0).withColumn("_in_t", F.lit(True)).alias("t")
    return kept.unionAll(_resolve(fresh.join(no_target, same_key, "left"), target, pieces))


def merge(
    target: DataFrame, source: DataFrame, on: Sequence[str], plan: MergePlan = UPSERT, small_source: bool = False
) -> DataFrame:
    """New content of the target after the merge."""
    return merge_actions(target, source, on, plan, small_source).where(F.col(ACTION) != "delete").drop(ACTION)


def merge_metrics(actions: DataFrame) -> DataFrame:
    return actions.groupBy(ACTION).agg(F.count("*").alias("rows"))


def insert_only(target: DataFrame, source: DataFrame, on: Sequence[str]) -> DataFrame:
    """Append the source rows whose key the target lacks; only the keys of the target are shuffled."""
    new = reject_duplicate_keys(source, on).join(target.select(*on), list(on), "left_anti")
    return target.unionByName(new.select(*target.columns))


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """UPDATE ... SET ... WHERE; a NULL condition leaves the row as it is. Values see the old row."""
    hit = F.coalesce(condition, F.lit(False))
    return df.select(*[
        F.when(hit, values[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) if f.name in values else F.col(f.name)
        for f in df.schema.fields
    ])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """DELETE ... WHERE; a NULL condition keeps the row."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def table_changes(before: DataFrame, after: DataFrame, on: Sequence[str]) -> DataFrame:
    """Row changes between two versions: insert, delete, update_pre and update_post rows."""
    fields = before.columns
    old = before.select(*on, F.struct(*fields).alias("_old"))
    new = after.select(*on, F.struct(*fields).alias("_new"))
    both = old.join(new, list(on), "full")
    row, kind = F.col("r"), "_change_type"
    pre = F.struct(F.col("_old").alias("r"), F.lit("update_pre").alias("k"))
    post = F.struct(F.col("_new").alias("r"), F.lit("update_post").alias("k"))
    events = (
        F.when(F.col("_old").isNull(), F.array(F.struct(F.col("_new").alias("r"), F.lit("insert").alias("k"))))
        .when(F.col("_new").isNull(), F.array(F.struct(F.col("_old").alias("r"), F.lit("delete").alias("k"))))
        .when(~F.col("_old").eqNullSafe(F.col("_new")), F.array(pre, post))
    )
    return both.select(F.explode(events).alias("e")).select("e.r.*", F.col("e.k").alias(kind))


def apply_changes(before: DataFrame, changes: DataFrame, on: Sequence[str]) -> DataFrame:
    """Replay a change feed on the older version."""
    gone = changes.where(F.col("_change_type").isin("delete", "update_pre")).select(*on)
    new = changes.where(F.col("_change_type").isin("insert", "update_post")).drop("_change_type")
    return before.join(gone, list(on), "left_anti").unionByName(new)


def net_changes(changes: DataFrame, on: Sequence[str], deltas: Sequence[str]) -> DataFrame:
    """Many pending changes per key folded into one source row, so one merge lands them all."""
    return changes.groupBy(*on).agg(*[F.sum(d).alias(d) for d in deltas])


def key_part(on: Sequence[str], parts: int) -> Column:
    """Partition of a row in a table dealt by its keys."""
    return F.pmod(F.xxhash64(*on), F.lit(parts)).cast("int")


def merge_partitions(
    spark, path: str, source: DataFrame, on: Sequence[str], partition: str, plan: MergePlan = UPSERT, small_source: bool = True,
    by_key: bool = False
) -> int:
    """Merge into a partitioned parquet folder and rewrite only the partitions that change.

    The keys and the partition column of the target are read once to find the
    partitions that hold matched keys; the partitions of the source rows are added. With
    ``by_key`` the partition column follows from the keys (``key_part``), so the partitions of the
    source rows are all and nothing of the target is read for it.
    Only those are merged and replaced (dynamic overwrite), the others are neither
    read in full nor written: they meet the target in a semi join, which prunes
    partitions. A row may move to another partition, since its old one is among
    the rewritten; a partition left without rows is removed, and only the folders
    of such partitions come to the driver, one at a time. Returns the number of
    rewritten partitions. One writer at a time. The overwrite replaces one partition after
    the other and empty ones are removed last, so after a job that died in between the
    merge has to be run again before the folder is read.
    """
    ensure_checkpoint_dir(spark)
    target = spark.read.parquet(path)
    file = F.col("_metadata.file_path").alias("_file")
    held = target.select(*on, partition, file).join(source.select(*on), list(on), "left_semi").select(partition, "_file")
    incoming = source.select(partition, F.lit(None).cast("string").alias("_file"))
    if by_key:
        there = target.select(partition, file).join(incoming.select(partition), partition, "left_semi")
        held = there.groupBy(partition).agg(F.max("_file").alias("_file")).select(partition, "_file")
    found = held.unionAll(incoming).groupBy(F.col(partition).alias("_value")).agg(F.max("_file").alias("_file"))
    touched = found.checkpoint()
    number = touched.count()
    if not number:
        return 0
    part = target.join(touched.select("_value"), F.col(partition).eqNullSafe(F.col("_value")), "left_semi")
    merged = merge(part, source, on, plan, small_source)
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    # A rewritten partition has new files only; where an old one is left, no row went to the partition.
    spark.catalog.refreshByPath(path)
    there = spark.read.parquet(path).select(file).distinct()
    for row in touched.join(there, "_file", "left_semi").select("_file").toLocalIterator():
        gone = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(row["_file"])).getParent()  # the name is URI-encoded
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    return number
