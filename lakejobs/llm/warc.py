"""WARC archives of pages: payloads once, revisits after, and one globally ordered index of all captures.

Pages are written by Spark's text writer, whose line separator is the end of a
WARC record; each file is a capture run sorted by URL key and time. The archives
are read back, and their index runs are merged by a loser tree in ranges of
the key, so the ranges in order are the capture history of the whole crawl.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakejobs.llm.common import scratch, stored

#: Bytes of an archive on average; a reader holds one archive in memory.
ARCHIVE_BYTES = 16 * 1024 * 1024
#: Index rows of a key range on average; one task merges one range.
RANGE_ROWS = 100_000
#: Fixed value: the base32 alphabet of RFC 4648.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
INDEX = ("url_key string, capture_time string, page_id string, url string, record_type string, refers_to string, "
         "payload_digest string, payload_bytes long, archive string, offset long, length long")


def base32(hexes: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits: ten of them at a time, written to base 32, are eight letters."""
    parts = [F.lpad(F.conv(F.substring(hexes, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32)


def url_key(url: Column) -> Column:
    """Sort key of a URL: host labels from the right, then path and query, in lower case, without fragment."""
    whole = F.lower(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(whole, r"^(?:[a-z][a-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/:?#]*)", 1)
    rest = F.regexp_extract(whole, r"^(?:[a-z][a-z0-9+.-]*://)?[^/?#]*([^#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), rest)


def captures(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least_bytes: int = 0,
             partitions: int | None = None) -> DataFrame:
    """(id, url, payload, digest, bytes, url_key, time, first): ``first`` is set on revisits.

    Of equal payloads of at least ``least_bytes`` bytes the smallest id is the
    response. Only ids and digests meet to find it; payloads are dealt once, by
    id and digest, to where the answer is. Rows that repeat that id are responses
    too; a null id is never the response unless its payload has no other.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    hashed = pages.select(
        F.col(key).alias("id"), F.regexp_replace(F.col(url), r"[\x00-\x20\x7F]", "").alias("url"), payload.alias("payload"),
        F.sha1(payload).alias("hexes"), F.octet_length(payload).cast("long").alias("bytes"))
    rows = hashed.withColumn("capture", F.xxhash64("id", "hexes"))
    first = rows.where(F.col("bytes") >= least_bytes).groupBy(F.col("hexes").alias("seen")).agg(F.min("id").alias("low"))
    known = rows.select("id", "hexes", "capture").distinct().join(first, F.col("hexes") == F.col("seen"), "left").select(
        F.col("capture").alias("known"), F.col("hexes").alias("known_hexes"), F.when(~F.col("id").eqNullSafe(F.col("low")), F.col("low")).alias("first"))
    if partitions:
        rows, known = rows.repartition(partitions, "capture", "hexes"), known.repartition(partitions, "known", "known_hexes")
    seconds = F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.coalesce(F.col("id").cast("long"), F.lit(0)), F.lit(1_000_000_000)))
    instant = F.date_format(F.to_utc_timestamp(seconds, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return rows.join(known, (F.col("capture") == F.col("known")) & (F.col("hexes") == F.col("known_hexes"))).select(
        "id", "url", "payload", base32(F.col("hexes")).alias("digest"), "bytes", url_key(F.col("url")).alias("url_key"),
        instant.alias("time"), "first")


def record(row_id: Column) -> Column:
    """A WARC record without its end, from the columns of ``captures``."""
    end = F.lit("\r\n")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(head, F.when(F.col("first").isNull(), F.col("payload")).otherwise(F.lit("")))
    fields = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(F.col("first").isNull(), F.lit("response")).otherwise(F.lit("revisit"))),
        F.concat(F.lit("WARC-Record-ID: "), name(row_id)),
        F.concat(F.lit("WARC-Date: "), F.col("time")),
        F.concat(F.lit("WARC-Target-URI: "), F.col("url")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
        F.when(F.col("first").isNotNull(), F.concat(F.lit("WARC-Refers-To: "), name(F.col("first")))),
        F.when(F.col("first").isNotNull(), F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *fields), end, end, block)


def write_archives(pages: DataFrame, path: str | None = None, archive_bytes: int = ARCHIVE_BYTES, **columns) -> str:
    """Write the pages as gzip WARC files, each a run sorted by URL key, time and id; returns the folder.

    A file is one gzip stream, so offsets of the index are those of the unpacked archive.
    """
    out = path or scratch(pages.sparkSession, "warc")
    html = columns.get("html", "html")
    total = pages.agg(F.sum(F.coalesce(F.octet_length(F.col(html)), F.lit(0)) + 1000)).first()[0] or 0
    rows = captures(pages, partitions=max(1, -(-total // archive_bytes)), **columns)
    runs = rows.sortWithinPartitions("url_key", "time", "id")
    runs.select(record(F.col("id")).alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(out)
    return out


def _records(content: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, fields, block) of each record of an archive, by its Content-Length."""
    at = 0
    while at < len(content):
        cut = content.find(b"\r\n\r\n", at)
        lines = content[at:cut].decode("utf-8").split("\r\n")
        if cut < 0 or not lines[0].startswith("WARC/1."):
            raise ValueError(f"no WARC record at offset {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        end = cut + 4 + int(fields["Content-Length"])
        if content[end:end + 4] != b"\r\n\r\n":
            raise ValueError(f"record at offset {at} does not end where its length says")
        yield at, end + 4 - at, fields, content[cut + 4:end]
        at = end + 4


def _named(reference: str | None) -> str | None:
    return (reference or "")[len("<urn:page:"):-1] or None


def read_archives(spark, path: str) -> DataFrame:
    """Index rows of all archives below ``path``: every record is parsed and response payloads are verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in INDEX.split(", ")]
        for batch in batches:
            for archive, content in zip(batch.column(0), batch.column(1)):
                rows = []
                for offset, length, fields, block in _records(gzip.decompress(content.as_py())):
                    head, _, payload = block.partition(b"\r\n\r\n")
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(re.search(rb"Content-Length: ([0-9]+)", head)[1])
                    if fields["WARC-Type"] == "response":
                        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest or len(payload) != size:
                            raise ValueError(f"payload of the record at {offset} in {archive} is not what was written")
                    rows.append((fields.get("WARC-Target-URI"), fields["WARC-Date"], _named(fields["WARC-Record-ID"]), fields["WARC-Type"],
                                 _named(fields.get("WARC-Refers-To")), digest, size, offset, length))
                url, time, page, kind, refers, digest, size, offset, length = (list(c) for c in zip(*rows)) if rows else ([],) * 9
                yield pa.RecordBatch.from_arrays([
                    pa.array(url, pa.string()), pa.array(time, pa.string()), pa.array(page, pa.string()), pa.array(url, pa.string()),
                    pa.array(kind, pa.string()), pa.array(refers, pa.string()), pa.array(digest, pa.string()), pa.array(size, pa.int64()),
                    pa.array([archive.as_py()] * len(rows), pa.string()), pa.array(offset, pa.int64()), pa.array(length, pa.int64())], names=names)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, INDEX).withColumn("url_key", url_key(F.col("url")))


class LoserTree:
    """Merge of sorted runs: a node keeps the run that lost there, so the next row takes one path of comparisons."""

    def __init__(self, runs: list[list[tuple]]):
        self.runs, self.at, self.size = runs, [0] * len(runs), len(runs)
        self.losers = [-1] * max(1, self.size)
        for run in range(self.size):
            self._replay(run)

    def _before(self, a: int, b: int) -> bool:
        """Whether run ``a`` comes before ``b``; runs that are used up come last, a seat not yet taken first."""
        if a < 0 or b < 0:
            return a < 0
        if self.at[a] >= len(self.runs[a]) or self.at[b] >= len(self.runs[b]):
            return self.at[a] < len(self.runs[a])
        return (self.runs[a][self.at[a]], a) < (self.runs[b][self.at[b]], b)

    def _replay(self, run: int) -> None:
        node = (run + self.size) // 2
        while node > 0:
            if self._before(self.losers[node], run):
                self.losers[node], run = run, self.losers[node]
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[tuple]:
        while self.size:
            run = self.losers[0]
            if run < 0 or self.at[run] >= len(self.runs[run]):
                return
            yield self.runs[run][self.at[run]]
            self.at[run] += 1
            self._replay(run)


def merge_index(index: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """All index rows in ranges of (url_key, capture_time, page_id), each range merged from its runs by a loser tree.

    A run is an archive in the order of its offsets. Ranges cut within a URL
    too, so a URL with most of all captures is spread over tasks.
    """
    kept = stored(index, "warc-index")
    ranges = max(1, -(-kept.count() // range_rows))
    dealt = kept.repartitionByRange(ranges, "url_key", "capture_time", "page_id", "archive", "offset").sortWithinPartitions("archive", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        held = pa.Table.from_batches(parts)
        heads = list(zip(held["url_key"].to_pylist(), held["capture_time"].to_pylist(), _numbers(held["page_id"].to_pylist()), range(held.num_rows)))
        archives = held["archive"].to_pylist()
        runs: list[list[tuple]] = []
        for i, head in enumerate(heads):
            if not i or archives[i] != archives[i - 1]:
                runs.append([])
            runs[-1].append(head)
        order = [head[-1] for head in LoserTree(runs)]
        yield from held.take(pa.array(order, pa.int64())).combine_chunks().to_batches()

    return dealt.mapInArrow(run, INDEX)


def _numbers(ids: list[str | None]) -> list[tuple]:
    """Ids as they are ordered in a run: null first, numbers by value."""
    return [(0, 0, "") if i is None else (1, int(i), "") if i.lstrip("-").isdigit() else (2, 0, i) for i in ids]


def archive(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages`` as archives, read them back and give the merged index: one row for each capture.

    Null payloads are empty; null URLs have no target field and come first;
    control characters and blanks in URLs are left out; repeated rows are captures
    of their own; an empty table gives no rows; further columns are not archived.
    """
    return merge_index(read_archives(pages.sparkSession, write_archives(pages, path, **options)))
