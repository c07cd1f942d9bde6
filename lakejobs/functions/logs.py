"""Access-log parsing and egress attribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakejobs.functions.strings import part, token_uuid

# The 24 fields of an access-log line, in order.
FIELDS = (
    "bucket_owner bucket request_datetime remote_ip requester request_id operation key request_uri http_status "
    "error_code bytes_sent object_size total_time turn_around_time referrer user_agent version_id host_id "
    "signature_version cipher_suite authentication_type host_header tls_version"
).split()
# The time is two blank-separated tokens in brackets.
_TOKENS = [t for f in FIELDS for t in (("request_day", "request_zone") if f == "request_datetime" else (f,))]


def parse_log(lines: DataFrame, value: str = "value") -> DataFrame:
    """One column per field; a line that does not match has NULLs. Works on batch and stream.

    A line is a CSV record with blanks as separators and quotes around the fields
    that may hold blanks, so one pass of the JVM's CSV parser splits it. The
    explode of the one-element array keeps later filters above the parse, so a
    filter does not run it again.
    """
    schema = ", ".join(f"{t} string" for t in [*_TOKENS, "_bad"])
    parsed = F.from_csv(F.col(value), schema, {"sep": " ", "quote": '"', "escape": "\u0000", "columnNameOfCorruptRecord": "_bad"})
    split = lines.select(F.explode(F.array(parsed)).alias("f"))
    matched = F.col("f._bad").isNull() & F.col("f.request_day").startswith("[") & F.col("f.request_zone").endswith("]")
    instant = F.concat_ws(" ", F.substr("f.request_day", F.lit(2)), F.rtrim(F.col("f.request_zone"), F.lit("]")))
    fields = split.select(*[
        F.when(matched, instant if name == "request_datetime" else F.col(f"f.{name}")).alias(name) for name in FIELDS])
    return fields.withColumns({
        "bytes_sent": F.col("bytes_sent").try_cast("long"), "request_uri": part("request_uri", " ", 1),
        "request_date": F.to_date(F.try_to_timestamp("request_datetime", F.lit("dd/MMM/yyyy:HH:mm:ss Z"))),
        "recipient_id": token_uuid("requester")})


def egress_rows(parsed: DataFrame) -> DataFrame:
    """Successful transfers with bytes, a path and a recipient."""
    return parsed.where("http_status = '200' AND bytes_sent > 0 AND request_uri IS NOT NULL AND recipient_id IS NOT NULL").select(
        "request_datetime", "request_date", "requester", "request_uri", "remote_ip", "bytes_sent", "recipient_id")


def attribute(rows: DataFrame, tables: DataFrame, regions: DataFrame) -> DataFrame:
    """Bytes per recipient, table, day and region.

    ``tables`` has (recipient_id, table_name, url_pattern): the recipient is an
    equality, the pattern a residual test. Rows are summed per address first, so
    the pattern test and both joins see reduced rows.
    """
    summed = rows.groupBy("recipient_id", "request_uri", "request_date", "remote_ip").agg(F.sum("bytes_sent").alias("bytes"))
    patterns = tables.where("url_pattern IS NOT NULL").withColumnRenamed("recipient_id", "to")
    fits = (F.col("recipient_id") == F.col("to")) & F.expr("request_uri LIKE url_pattern")
    placed = summed.join(patterns, fits, "left").join(regions, summed["remote_ip"] == regions["ip"], "left")
    return placed.groupBy("recipient_id", "table_name", "url_pattern", "request_date", "region").agg(
        F.sum("bytes").alias("sum_bytes_sent"))
