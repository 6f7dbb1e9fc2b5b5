"""WARC archives: write pages as WARC/1.0 records, read them with a PySpark Python data source.

Writing is Spark's own text writer with the record terminator as line separator,
so archives land in any file system Spark can write and a lost task is simply
written again.  Reading is ``spark.read.format("warc")``: one partition for each
archive file, filters on record type, digest, record id or length are pushed
down and judged on the headers, and a payload that no caller asked for (option
``payload``) or whose headers failed is skipped with ``seek``, never decoded.

Edge cases: null payload is empty; null URL writes no target header; control
characters in header values are percent-encoded.  Equal payloads of at least
``min_bytes`` are stored once, in the record of the smallest id (nulls last, then
equal ids are told apart by nothing and each keeps a record); empty tables give
empty archives.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, LessThan, LessThanOrEqual)

from eventide.llm.base import by_value
from eventide.session import materialize, scratch_path

CRLF = "\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
FIELDS = "record_id string, record_type string, target_uri string, payload_digest string, payload_bytes long, refers_to string, payload binary"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: each 5 hex digits are 20 bits, four characters."""
    digest, out = F.sha1(payload), []
    for i in range(8):
        bits = F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 10).cast("int")
        out += [F.substr(F.lit(BASE32), F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def header_value(value: Column) -> Column:
    """A value that stays on one header line."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(value, "%(?=0[AD])", "%25"), "\r", "%0D"), "\n", "%0A")


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
               min_bytes: int = 0) -> str:
    """Write one record per row below ``path``; equal payloads of ``min_bytes`` or more become revisits.

    Who is first for a payload is found on (digest, length, id) alone: map tasks
    keep one minimum per digest, and only payloads that really repeat are joined
    back.  That list is written first, so Spark knows its size: it is sent to every
    task if it is under the broadcast threshold, else the pages are shuffled."""
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"),
                        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).alias("_payload"))
    rows = rows.withColumn("_bytes", F.octet_length("_payload").cast("long")).withColumn("_digest", sha1_base32(F.col("_payload")))
    keys = rows.filter(F.col("_bytes") >= min_bytes).select("_digest", "_bytes", "_id")
    firsts = materialize(keys.groupBy("_digest", "_bytes").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
                         .filter((F.col("_n") > 1) & F.col("_first").isNotNull()).select("_digest", "_bytes", "_first"))
    marked = (rows.join(firsts, ["_digest", "_bytes"], "left")
              .withColumn("_refers", F.when(~F.col("_first").eqNullSafe(F.col("_id")), F.col("_first"))))
    revisit = F.col("_refers").isNotNull()
    ident = F.coalesce(F.col("_id").cast("string"), F.lit(""))
    block = F.when(revisit, F.lit(HTTP)).otherwise(F.concat(F.lit(HTTP), F.col("_payload")))
    head = F.concat(
        F.lit("WARC/1.0" + CRLF + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit(CRLF + "WARC-Record-ID: <urn:page:"), header_value(ident), F.lit(">"),
        F.when(F.col("_url").isNotNull(), F.concat(F.lit(CRLF + "WARC-Target-URI: "), header_value(F.col("_url")))).otherwise(F.lit("")),
        F.lit(CRLF + "WARC-Payload-Digest: sha1:"), F.col("_digest"),
        F.lit(CRLF + "X-Payload-Length: "), F.col("_bytes").cast("string"),
        F.when(revisit, F.concat(F.lit(CRLF + "WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
                                       + CRLF + "WARC-Refers-To: <urn:page:"), F.col("_refers").cast("string"), F.lit(">"))).otherwise(F.lit("")),
        F.lit(CRLF + "Content-Type: application/http; msgtype=response" + CRLF + "Content-Length: "))
    record = F.concat(head, F.octet_length(block).cast("string"), F.lit(CRLF + CRLF), block)
    (marked.select(record.alias("value")).write.mode("overwrite").option("lineSep", CRLF + CRLF).text(path))
    return path


def _files_below(path: str) -> tuple[object, list[tuple[str, int]]]:
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    found = store.get_file_info(fs.FileSelector(root, recursive=True))
    return store, sorted((f.path, f.size) for f in found
                         if f.type == fs.FileType.File and posixpath.basename(f.path)[0] not in "._" and f.size)


class ArchiveFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    """Plans one partition per archive file; keeps filters that the headers can decide."""

    COLUMNS = ("record_id", "record_type", "payload_digest", "payload_bytes", "refers_to", "target_uri")

    def __init__(self, path: str, payload: bool):
        self.path, self.payload, self.tests = path, payload, []

    def pushFilters(self, filters):
        ops = {EqualTo: "eq", In: "in", GreaterThan: "gt", GreaterThanOrEqual: "ge", LessThan: "lt", LessThanOrEqual: "le"}
        for f in filters:
            if type(f) in ops and len(f.attribute) == 1 and f.attribute[0] in self.COLUMNS:
                self.tests.append((f.attribute[0], ops[type(f)], f.value))
            else:
                yield f

    def partitions(self):
        return [ArchiveFile(p) for p, _ in _files_below(self.path)[1]]

    def _wanted(self, row: dict) -> bool:
        check = {"eq": lambda a, b: a == b, "in": lambda a, b: a in b, "gt": lambda a, b: a > b, "ge": lambda a, b: a >= b,
                 "lt": lambda a, b: a < b, "le": lambda a, b: a <= b}
        return all(row[c] is not None and check[op](row[c], v) for c, op, v in self.tests)

    def read(self, partition) -> Iterator[tuple]:
        if partition is None:  # no archive file at all
            return
        from pyarrow import fs

        store = fs.FileSystem.from_uri(self.path if "://" in self.path or self.path.startswith("file:") else f"file://{self.path}")[0]
        with store.open_input_file(partition.path) as raw:
            size, at = raw.size(), 0
            window, base = b"", 0

            def need(start: int, n: int) -> bytes:  # bytes start..start+n, through one read-ahead window
                nonlocal window, base
                if start < base or start + n > base + len(window):
                    raw.seek(start)
                    base, window = start, raw.read(max(n, 1 << 16))
                return window[start - base:start - base + n]

            while at < size:
                room = 1 << 12
                while (end := (head := need(at, min(room, size - at))).find(b"\r\n\r\n")) < 0:
                    if room > size - at:
                        raise ValueError(f"{partition.path}: record at {at} has no header end")
                    room *= 4
                fields = {}
                lines = head[:end].split(b"\r\n")
                if not lines[0].startswith(b"WARC/"):
                    raise ValueError(f"{partition.path}: no WARC record at {at}")
                for line in lines[1:]:
                    k, _, v = line.partition(b":")
                    fields[k.strip().lower().decode()] = v.strip().decode("utf-8", "replace")
                body, length = at + end + 4, int(fields["content-length"])
                urn = lambda k: fields[k][1:-1].removeprefix("urn:page:") if k in fields else None
                row = {"record_id": urn("warc-record-id"), "record_type": fields["warc-type"], "target_uri": fields.get("warc-target-uri"),
                       "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                       "payload_bytes": int(fields["x-payload-length"]) if "x-payload-length" in fields else None,
                       "refers_to": urn("warc-refers-to")}
                if self._wanted(row):
                    payload = None
                    if self.payload and row["record_type"] == "response":
                        payload = need(body, length).partition(b"\r\n\r\n")[2]
                    yield (*[row[c] for c in ("record_id", "record_type", "target_uri", "payload_digest", "payload_bytes", "refers_to")], payload)
                at = body + length + 4


class WarcDataSource(DataSource):
    """``spark.read.format("warc").option("payload", "true"|"false").load(path)``.

    The path is one that pyarrow's file systems open (file:, hdfs:, s3:, gs:)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return FIELDS

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], self.options.get("payload", "false").lower() == "true")


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def archive_round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html), read the archives back and check every stored payload against its header.

    A response whose payload does not have the digest and length of its header fails the job."""
    spark = pages.sparkSession
    path = write_warc(pages, scratch_path(spark, "warc"), min_bytes=min_bytes)
    kind = dict(pages.dtypes)["page_id"]
    back = read_warc(spark, path, payload=True)
    right = (F.col("record_type") == "revisit") | ((F.octet_length("payload") == F.col("payload_bytes"))
                                                  & (sha1_base32(F.col("payload")) == F.col("payload_digest")))
    return back.select(
        F.when(F.col("record_id") != "", F.col("record_id")).cast(kind).alias("page_id"), "payload_bytes",
        F.when(right, F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("damaged record "), "record_id"))).alias("payload_digest"),
        "record_type", F.col("refers_to").cast(kind).alias("refers_to"), "target_uri")


by_value(__name__)
