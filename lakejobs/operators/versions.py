"""Table versions as parquet folders with a small history written by Spark.

This is a naming convention, not a transaction log: every change writes a new
``data/v=N`` folder and then one history row. There is one writer at a time;
a version without a history row does not exist for readers. Renames, drops,
added defaults and widenings live in the history row, so they rewrite no data.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HISTORY_SCHEMA = (
    "version long, written_at timestamp, operation string, data_path string, row_count long, columns string, "
    "properties string"
)

# Type changes that lose nothing.
WIDENINGS = {
    "tinyint": {"smallint", "int", "bigint", "double"},
    "smallint": {"int", "bigint", "double"},
    "int": {"bigint", "double"},
    "float": {"double"},
    "date": {"timestamp_ntz"},
}


class ChangeRefused(ValueError):
    """The table's properties or the kind of change do not allow it."""


def allowed_widening(old: str, new: str) -> bool:
    if old == new:
        return True
    if old.startswith("decimal(") and new.startswith("decimal("):
        p0, s0 = (int(x) for x in old[8:-1].split(","))
        p1, s1 = (int(x) for x in new[8:-1].split(","))
        return s1 >= s0 and p1 - s1 >= p0 - s0
    return new in WIDENINGS.get(old, set())


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    root: str

    # -- history ---------------------------------------------------------------

    def history(self) -> DataFrame:
        """One row per version, newest first."""
        rows = self.spark.read.schema(HISTORY_SCHEMA).json(f"{self.root}/history")
        return rows.orderBy(F.desc("version"))

    def _entry(self, version: int | None = None) -> dict:
        rows = self.history() if version is None else self.history().where(F.col("version") == version)
        found = rows.first()
        if found is None:
            raise ValueError(f"no version {version} in {self.root}")
        entry = found.asDict()
        entry["columns"] = json.loads(entry["columns"])
        entry["properties"] = json.loads(entry["properties"])
        return entry

    def _record(self, version: int, operation: str, data_path: str, row_count: int, columns: list, properties: dict):
        row = [(version, operation, data_path, row_count, json.dumps(columns), json.dumps(properties))]
        frame = self.spark.createDataFrame(
            row, "version long, operation string, data_path string, row_count long, columns string, properties string")
        frame.withColumn("written_at", F.current_timestamp()).coalesce(1).write.mode("append").json(f"{self.root}/history")

    # -- data --------------------------------------------------------------------

    def create(self, df: DataFrame, properties: dict | None = None, operation: str = "CREATE") -> int:
        return self._write(0, df, operation, properties or {})

    def _write(self, version: int, df: DataFrame, operation: str, properties: dict) -> int:
        path = f"{self.root}/data/v={version}"
        df.write.mode("overwrite").option("compression", properties.get("compression", "snappy")).parquet(path)
        rows = self.spark.read.parquet(path).count()  # parquet footers only
        columns = [
            {"name": f.name, "stored": f.name, "type": f.dataType.simpleString(), "default": None} for f in df.schema.fields]
        self._record(version, operation, path, rows, columns, properties)
        return version

    def commit(self, df: DataFrame, operation: str = "WRITE") -> int:
        """Write new content as the next version; an append-only table takes only APPEND."""
        last = self._entry()
        if last["properties"].get("append_only") and operation != "APPEND":
            raise ChangeRefused(f"{operation} on an append-only table")
        return self._write(last["version"] + 1, df, operation, last["properties"])

    def append(self, df: DataFrame) -> int:
        return self.commit(self.read().unionByName(df, allowMissingColumns=True), "APPEND")

    def read(self, version: int | None = None) -> DataFrame:
        entry = self._entry(version)
        stored = self.spark.read.parquet(entry["data_path"])
        return stored.select(*[self._column(c, stored) for c in entry["columns"]])

    @staticmethod
    def _column(c: dict, stored: DataFrame) -> Column:
        if c["stored"] is None or c["stored"] not in stored.columns:
            return F.lit(c["default"]).cast(c["type"]).alias(c["name"])
        return F.col(c["stored"]).cast(c["type"]).alias(c["name"])

    def restore(self, version: int) -> int:
        """Make an old version the newest; its folder is used again, nothing is copied."""
        old, last = self._entry(version), self._entry()
        self._record(last["version"] + 1, "RESTORE", old["data_path"], old["row_count"], old["columns"], old["properties"])
        return last["version"] + 1

    # -- schema changes without a rewrite -------------------------------------------

    def _change_columns(self, operation: str, columns: list, entry: dict) -> int:
        self._record(
            entry["version"] + 1, operation, entry["data_path"], entry["row_count"], columns, entry["properties"])
        return entry["version"] + 1

    def _mapped(self) -> dict:
        entry = self._entry()
        if not entry["properties"].get("column_mapping"):
            raise ChangeRefused("column mapping is not enabled on this table")
        return entry

    def rename_column(self, old: str, new: str) -> int:
        entry = self._mapped()
        columns = [{**c, "name": new} if c["name"] == old else c for c in entry["columns"]]
        return self._change_columns("RENAME COLUMN", columns, entry)

    def drop_column(self, name: str) -> int:
        entry = self._mapped()
        return self._change_columns("DROP COLUMN", [c for c in entry["columns"] if c["name"] != name], entry)

    def add_column(self, name: str, kind: str, default=None) -> int:
        entry = self._entry()
        if any(c["name"] == name for c in entry["columns"]):
            raise ChangeRefused(f"column {name} exists")
        added = {"name": name, "stored": None, "type": kind, "default": default}
        return self._change_columns("ADD COLUMN", [*entry["columns"], added], entry)

    def widen_column(self, name: str, kind: str) -> int:
        entry = self._entry()
        if not entry["properties"].get("type_widening"):
            raise ChangeRefused("type widening is not enabled on this table")
        columns = []
        for c in entry["columns"]:
            if c["name"] == name and not allowed_widening(c["type"], kind):
                raise ChangeRefused(f"{c['type']} to {kind} may lose values")
            columns.append({**c, "type": kind} if c["name"] == name else c)
        return self._change_columns("CHANGE COLUMN TYPE", columns, entry)

    def set_properties(self, **properties) -> int:
        entry = self._entry()
        self._record(
            entry["version"] + 1, "SET PROPERTIES", entry["data_path"], entry["row_count"], entry["columns"],
            {**entry["properties"], **properties})
        return entry["version"] + 1

    # -- copies, details, cleaning ------------------------------------------------------

    def clone_deep(self, root: str) -> "VersionedTable":
        copy = VersionedTable(self.spark, root)
        copy.create(self.read(), self._entry()["properties"], "CLONE")
        return copy

    def clone_shallow(self, root: str) -> "VersionedTable":
        """New table whose first version points at this table's files."""
        entry = self._entry()
        copy = VersionedTable(self.spark, root)
        copy._record(0, "SHALLOW CLONE", entry["data_path"], entry["row_count"], entry["columns"], entry["properties"])
        return copy

    def files(self) -> DataFrame:
        """Every data file under the table folder: path, bytes, time (the content is not read)."""
        listing = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
            "pathGlobFilter", "*.parquet").load(f"{self.root}/data")
        return listing.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))

    def detail(self) -> DataFrame:
        """Files, bytes, rows and properties of the newest version."""
        entry = self._entry()
        own = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(entry["data_path"])
        return own.agg(F.count("*").alias("num_files"), F.sum("length").alias("size_bytes")).select(
            F.lit("parquet").alias("format"), F.lit(entry["version"]).cast("long").alias("version"), "num_files", "size_bytes",
            F.lit(entry["row_count"]).alias("row_count"), F.lit(json.dumps(entry["properties"])).alias("properties"))

    def vacuum_plan(self, retention_hours: float, log_retention_hours: float = 720.0) -> DataFrame:
        """Files that no version inside the retention needs (a dry run; the caller removes them).

        The retention of removed files must not be longer than that of the history.
        """
        if retention_hours > log_retention_hours:
            raise ChangeRefused("deleted files would be kept longer than the history that names them")
        seconds = F.expr(f"INTERVAL '{int(retention_hours * 3600)}' SECOND")
        limit = F.current_timestamp() - seconds
        history = self.history()
        newest = self.history().agg(F.max("version")).scalar()
        live = history.where((F.col("version") == newest) | (F.col("written_at") >= limit)).select(F.regexp_extract("data_path", r"(v=\d+)$", 1).alias("folder"))
        listed = self.files().withColumn("folder", F.regexp_extract("path", r"/(v=\d+)/[^/]+$", 1))
        return listed.where(F.col("modified") < limit).join(live, "folder", "left_anti").select("path", "bytes", "modified")

