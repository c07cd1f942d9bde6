"""File sources: batch and incremental scans, remembered schemas, idempotent loads."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakejobs.functions.semi import keep_unknown_fields


def stream_csv(spark: SparkSession, path: str, schema: str | T.StructType, **options: str) -> DataFrame:
    """Incremental CSV scan with a declared schema (names may hold spaces)."""
    return spark.readStream.schema(schema).options(header="true", **options).csv(path)


def stream_text(spark: SparkSession, path: str) -> DataFrame:
    """Incremental line scan: one ``value`` column."""
    return spark.readStream.text(path)


def stream_json(spark: SparkSession, path: str, schema: str | T.StructType, **options: str) -> DataFrame:
    return spark.readStream.schema(schema).options(**options).json(path)


def stream_parquet(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Stream over a table's appended files; the schema is that of the files present at the start."""
    return spark.readStream.schema(spark.read.parquet(path).schema).options(**options).parquet(path)


# --- remembered schema ----------------------------------------------------------


def load_schema(spark: SparkSession, location: str) -> T.StructType | None:
    """Newest remembered schema of a stream, None when there is none yet."""
    try:
        found = spark.read.schema("at timestamp, doc string").json(location).agg(F.max_by("doc", "at")).first()[0]
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise
    return T.StructType.fromJson(json.loads(found)) if found else None


def save_schema(spark: SparkSession, location: str, schema: T.StructType, until: str | None = None) -> None:
    row = spark.createDataFrame([(json.dumps(schema.jsonValue()), until)], "doc string, until string")
    row.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").json(location)


# Numeric types from narrow to wide.
NUMERIC = ("int", "bigint", "double")


def common_type(old: T.DataType, new: T.DataType) -> T.DataType:
    """The wider of two numeric types; otherwise different types become string."""
    names = old.simpleString(), new.simpleString()
    if names[0] == names[1]:
        return old
    if all(n in NUMERIC for n in names):
        return max((old, new), key=lambda t: NUMERIC.index(t.simpleString()))
    return T.StringType()


def merge_schemas(old: T.StructType, new: T.StructType) -> T.StructType:
    """Old columns in their order, then the new ones; a changed type becomes the common one."""
    fields = {f.name: f for f in old.fields}
    for f in new.fields:
        known = fields.get(f.name)
        fields[f.name] = T.StructField(f.name, common_type(known.dataType, f.dataType)) if known else f
    return T.StructType(list(fields.values()))


def inferred_until(spark: SparkSession, location: str) -> str | None:
    """Modification time, as text, up to which files went into the remembered schema."""
    try:
        return spark.read.schema("at timestamp, until string").json(location).agg(F.max("until")).first()[0]
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


#: Unseen files, and lines of each, from which types are inferred.
INFER_FILES, INFER_LINES = 16, 1000


def infer_csv(spark: SparkSession, path: str, since: str | None, options: dict[str, str]) -> tuple[T.StructType | None, str | None]:
    """Merged types of the first lines of the newest files at or after ``since``, and the time of the newest; None without files."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where("length > 0")
    unseen = listing.where(F.col("modificationTime") >= F.lit(since).cast("timestamp")) if since else listing
    # The newest second is read again next time: other files may have come in it.
    newest = listing.agg(F.date_format(F.max("modificationTime") - F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd'T'HH:mm:ss").alias("at")).first()["at"]
    heads: dict[str, list[str]] = {}
    for row in unseen.orderBy(F.desc("modificationTime"), "path").select("path").limit(INFER_FILES).collect():
        first, *lines = [r["value"] for r in spark.read.text(row["path"]).limit(INFER_LINES).collect()] or [""]
        # Files with the same first line are one sample: a column that is empty in some of them has the type of the others.
        heads.setdefault(first, []).extend(lines)
    merged = None
    for first, lines in sorted(heads.items()):
        found = spark.read.options(inferSchema="true", **options).csv(spark.sparkContext.parallelize([first, *lines], 1)).schema
        merged = found if merged is None else merge_schemas(merged, found)
    return merged, newest


def stream_csv_inferred(
    spark: SparkSession, path: str, schema_location: str, rescued: str = "_rescued_data", by_field: bool = False, **options: str
) -> DataFrame:
    """Incremental CSV scan with inferred types, a remembered schema and a rescued column.

    At each start types are inferred from the first ``INFER_LINES`` lines of at most ``INFER_FILES``
    files that no earlier start has seen, and merged into the remembered schema, so
    neither types nor columns of older files are lost and no file is read twice. A line
    that does not fit is kept whole in ``rescued`` beside the fields that could be read, or with ``by_field``
    its misfits are kept as in ``rescue_csv``, so the bounded sample loses nothing.
    """
    options = {"header": "true", **options}
    known, since = load_schema(spark, schema_location), inferred_until(spark, schema_location)
    found, newest = infer_csv(spark, path, since if known else None, options)
    merged = known if found is None else found if known is None else merge_schemas(known, found)
    if merged is None:
        raise ValueError(f"no file to infer a schema from in {path}")
    if merged != known or newest != since:
        save_schema(spark, schema_location, merged, newest)
    if by_field:
        return stream_csv_rescued(spark, path, merged, rescued, **options)
    whole = T.StructType([*merged.fields, T.StructField(rescued, T.StringType())])
    return spark.readStream.schema(whole).options(columnNameOfCorruptRecord=rescued, **options).csv(path)


# --- rows that do not fit ---------------------------------------------------------


def read_json_rescued(spark: SparkSession, path: str, schema: str, rescued: str = "_rescued_data") -> DataFrame:
    """JSON lines with the declared columns plus the unknown fields of each line as JSON text."""
    names = [f.name for f in spark.createDataFrame([], schema).schema.fields]
    lines = spark.read.text(path)
    parsed = F.from_json("value", schema)
    return lines.select(parsed.alias("row"), keep_unknown_fields(F.col("value"), names).alias(rescued)).select("row.*", rescued)


#: Text of a line whose fields are not those of the schema, in a reader's schema and as a key of the rescued fields.
LINE = "_line"


def typed(schema: str | T.StructType) -> T.StructType:
    return schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)


def rescue_fields(texts: DataFrame, schema: T.StructType, rescued: str, others: Column | None = None) -> DataFrame:
    """Columns of ``schema`` cast from text, and as JSON the texts that don't fit their type.

    ``texts`` has a text column for each field; ``others`` is a map of further texts to
    keep. A field that does not fit is null, the other fields of its row are kept, and
    ``rescued`` is null where all fit. Works on streams as on tables.
    """
    columns, misfits = [], []
    for f in schema.fields:
        text = F.col(f"`{f.name}`")
        value = text if isinstance(f.dataType, T.StringType) else text.try_cast(f.dataType)
        columns.append(value.alias(f.name))
        misfits.append(F.when(text.isNotNull() & value.isNull(), text))
    kept = F.map_filter(
        F.map_from_arrays(F.array(*[F.lit(f.name) for f in schema.fields]), F.array(*misfits)), lambda _, v: v.isNotNull())
    if others is not None:
        kept = F.map_concat(kept, F.coalesce(others, F.create_map().cast("map<string,string>")))
    return texts.select(*columns, F.when(F.size(kept) > 0, F.to_json(kept)).alias(rescued))


def _csv_texts(schema: T.StructType) -> T.StructType:
    return T.StructType([*(T.StructField(f.name, T.StringType()) for f in schema.fields), T.StructField(LINE, T.StringType())])


def rescue_csv(texts: DataFrame, schema: T.StructType, rescued: str = "_rescued_data") -> DataFrame:
    """``rescue_fields`` of rows read by ``_csv_texts``; a line with too few or too many fields is kept whole beside them."""
    return rescue_fields(texts, schema, rescued, F.when(F.col(LINE).isNotNull(), F.create_map(F.lit(LINE), F.col(LINE))))


def read_csv_rescued(spark: SparkSession, path: str, schema: str | T.StructType, rescued: str = "_rescued_data", **options: str) -> DataFrame:
    """CSV with declared types in which no text is lost, see ``rescue_csv``."""
    fields = typed(schema)
    options = {"header": "true", "columnNameOfCorruptRecord": LINE, **options}
    return rescue_csv(spark.read.schema(_csv_texts(fields)).options(**options).csv(path), fields, rescued)


def stream_csv_rescued(spark: SparkSession, path: str, schema: str | T.StructType, rescued: str = "_rescued_data", **options: str) -> DataFrame:
    """Incremental form of ``read_csv_rescued``."""
    fields = typed(schema)
    options = {"header": "true", "columnNameOfCorruptRecord": LINE, **options}
    return rescue_csv(spark.readStream.schema(_csv_texts(fields)).options(**options).csv(path), fields, rescued)


def stream_json_rescued(spark: SparkSession, path: str, schema: str | T.StructType, rescued: str = "_rescued_data") -> DataFrame:
    """Incremental JSON lines: misfits and unknown fields of each line as JSON, a line that is no JSON object whole."""
    fields = typed(schema)
    names = [f.name for f in fields.fields]
    found = F.from_json("value", "map<string,string>")
    lines = spark.readStream.text(path).select("value", found.alias("found"))
    texts = lines.select("value", "found", *[F.col("found")[n].alias(n) for n in names])
    others = F.when(F.col("found").isNull(), F.create_map(F.lit(LINE), F.col("value"))).otherwise(
        F.map_filter("found", lambda k, _: ~k.isin(*names)))
    return rescue_fields(texts, fields, rescued, others)


def read_csv(spark: SparkSession, path: str, separator: str = ",", schema: str | None = None, fail_fast: bool = False, **options: str) -> DataFrame:
    """CSV with a header; types inferred unless a schema is given; ``fail_fast`` stops at the first bad row."""
    reader = spark.read.options(header="true", sep=separator, mode="FAILFAST" if fail_fast else "PERMISSIVE", **options)
    return reader.schema(schema).csv(path) if schema else reader.options(inferSchema="true").csv(path)


def read_json_path(spark: SparkSession, path: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM json.`{path}`")


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str | None = None) -> DataFrame:
    """XML rows; attributes become ``_name`` columns."""
    reader = spark.read.option("rowTag", row_tag)
    return (reader.schema(schema) if schema else reader).xml(path)


# --- idempotent load -----------------------------------------------------------------


def copy_into(
    spark: SparkSession, source: str, target: str, ledger: str, columns: dict[str, str], separator: str = "|", **options: str
) -> None:
    """Append the rows of files that no earlier call loaded; a second call adds nothing.

    ``columns`` maps output column to an expression over the positional columns
    ``_c0, _c1, ...``. The checkpoint folder ``ledger`` is the record of loaded
    files, so a call that dies and is repeated loads each file once.
    """
    width = len(spark.read.options(sep=separator, **options).csv(source).columns)
    positional = ", ".join(f"_c{i} string" for i in range(width))
    rows = spark.readStream.schema(positional).options(sep=separator, **options).csv(source)
    picked = rows.select(*[F.expr(e).alias(name) for name, e in columns.items()])
    picked.writeStream.option("checkpointLocation", ledger).trigger(availableNow=True).format("parquet").start(
        target).awaitTermination()


#: Files of a micro-batch of ``copy_merged``; the driver reads a header for each.
COPY_FILES = 64


def copy_merged(
    spark: SparkSession, source: str, target: str, ledger: str, types: dict[str, str] | None = None, separator: str = ",", **options: str
) -> None:
    """Append the rows of CSV files with headers that no earlier call loaded; files may have different columns.

    The header of every new file says its columns; files with equal headers are read
    together. A column that a file lacks is null in its rows, a new one is added to the
    table. Columns are text unless ``types`` names their type; a text that does not
    fit its type fails the load, as a cast does. The checkpoint folder ``ledger`` is the record of
    loaded files; a micro-batch owns a folder of the target and replaces it when it
    is repeated, so each file is loaded once whatever call dies. Read by ``read_merged``.
    """
    known = types or {}
    reading = {"header": "true", "sep": separator, **options}

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        groups: dict[tuple[str, ...], list[str]] = {}
        for row in batch.where("length > 0").select("path").collect():
            header = tuple(session.read.options(**reading).csv(row["path"]).columns)
            groups.setdefault(header, []).append(row["path"])
        rows = None
        for header, paths in sorted(groups.items()):
            texts = session.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in header])).options(**reading).csv(paths)
            part = texts.select(*[F.col(f"`{c}`").cast(known.get(c, "string")).alias(c) for c in header])
            rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
        if rows is not None:
            rows.write.mode("overwrite").parquet(f"{target}/{LOAD}={number}")

    listing = "path string, modificationTime timestamp, length long, content binary"
    listed = spark.readStream.format("binaryFile").schema(listing).option("maxFilesPerTrigger", COPY_FILES).load(source).select("path", "length")
    listed.writeStream.foreachBatch(load).option("checkpointLocation", ledger).trigger(availableNow=True).start().awaitTermination()


#: Folder column of the loads of ``copy_merged``.
LOAD = "_load"


def read_merged(spark: SparkSession, target: str) -> DataFrame:
    """All rows of ``copy_merged`` with the columns of all loads."""
    return spark.read.option("mergeSchema", "true").parquet(target).drop(LOAD)


# --- JDBC -------------------------------------------------------------------------------


def jdbc_options(connection: dict[str, str], table: str, partition: dict[str, object] | None = None) -> dict[str, str]:
    """Reader options from a named connection.

    ``partition`` (column, lower, upper, parts) splits the read over tasks; without
    it the whole table would pass through one task.
    """
    options = {"url": connection["url"], "dbtable": table, **{k: v for k, v in connection.items() if k != "url"}}
    if partition:
        options |= {
            "partitionColumn": str(partition["column"]), "lowerBound": str(partition["lower"]),
            "upperBound": str(partition["upper"]), "numPartitions": str(partition["parts"])}
    return options


def read_jdbc(spark: SparkSession, connection: dict[str, str], table: str, partition: dict[str, object] | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(connection, table, partition)).load()


def append_jdbc(df: DataFrame, connection: dict[str, str], table: str) -> None:
    df.write.format("jdbc").options(**jdbc_options(connection, table)).mode("append").save()
