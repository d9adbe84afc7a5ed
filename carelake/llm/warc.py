"""WARC archives of web pages: written whole, normalised to a member per record, read by offset.

``records`` makes a WARC record of each page.  Of pages with equal payloads the
one with the smallest id is a ``response`` with its payload, the others are
``revisit`` records, which hold headers only and refer to it; payloads under
``LEAST_BYTES`` are always stored.  ``write_whole`` stores records as most
crawls come: each archive is one gzip stream, in which nothing can be found
without inflating all before it.

``normalised`` mends that.  Each archive's stream is inflated once, line by line
by Spark's reader, so an archive of any size needs the memory of one record; the
records are cut out by their declared lengths, each is written as a gzip member
of its own, and a sidecar index says where every record begins.  ``read`` takes
records by that index, in parallel within an archive, and checks the digest.

Archives are written by tasks under names of their own; only those the index
names count, and the index is a table that Spark commits, so what a failed or
repeated task leaves behind is never read.  They are written and read through
``pyarrow.fs``, so the target may be a folder on any file system it knows.

Defined results: a null payload is empty, a null or empty url is left out, and
white space and signs below 0x21 in urls are percent-encoded.  Null ids are last
and never referred to.  Rows that repeat the smallest id of a payload are all
responses.  Empty tables give archives without records.  An archive that ends
inside a record, or a payload unlike its digest, is an error.  Columns other than
``page_id``, ``url`` and ``html`` are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm import shared, tokens
from carelake.sources import scratch

#: Payloads from this size on are stored once.
LEAST_BYTES = 100
#: Records in one whole archive at most.
RECORDS = 50_000
#: Bytes of members that one task reads back, and that it reads at once.
TASK_BYTES, READ_BYTES = 16 << 20, 4 << 20
#: Index rows are handed over in batches of this size.
ROWS = 2_000
# Fixed values of the format.
END = "\r\n"
BETWEEN = 2 * END
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

INDEX = (
    "path string, offset bigint, length bigint, record_id string, record_type string, target_uri string, "
    "payload_digest string, refers_to string"
)
FOUND = (
    "record_id string, record_type string, refers_to string, target_uri string, payload_bytes bigint, "
    "payload_digest string, payload binary"
)


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def first_holders(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """``digest, first_id``: of payloads that are stored once, the page that stores them."""
    return (
        pages.where(F.octet_length("payload") >= least).groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 AND first_id IS NOT NULL").drop("n")
    )


def records(pages: DataFrame, *, least: int = LEAST_BYTES, date: str = DATE) -> DataFrame:
    """``record``: one WARC record per page, without the two line ends that follow it."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    # Written, its size is known: Spark broadcasts it if it is small and deals the pages by digest if not.
    holders = shared.written(first_holders(rows, least), "warc-holders")
    rows = rows.join(holders, "digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    # Only signs that a header cannot hold are encoded, and most urls have none.
    url = F.when(F.col("url").rlike(r"[\x00-\x20\x7F]"), _encoded("url")).when(F.length("url") > 0, F.col("url"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "),
        F.octet_length("payload").cast("string"), F.lit(BETWEEN),
    )
    rows = rows.select(
        "page_id", "digest", "first_id", "payload", again.alias("again"), url.alias("url"), http.alias("http")
    )
    size = F.octet_length("http") + F.when(F.col("again"), 0).otherwise(F.octet_length("payload"))

    def field(name: str, value: Column) -> Column:
        """A header line; none where the value is null."""
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))

    head = F.concat(
        F.lit(f"WARC/1.0{END}"),
        field("WARC-Type", F.when(F.col("again"), "revisit").otherwise("response")),
        field("WARC-Record-ID", _urn(F.col("page_id"))),
        field("WARC-Date", F.lit(date)),
        field("WARC-Target-URI", F.col("url")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        field("WARC-Refers-To", F.when(F.col("again"), _urn(F.col("first_id")))),
        field("WARC-Profile", F.when(F.col("again"), PROFILE)),
        field("Content-Type", F.lit("application/http; msgtype=response")),
        field("Content-Length", size.cast("string")),
        F.lit(END),
    )
    return rows.select(F.concat(head, "http", F.when(F.col("again"), "").otherwise(F.col("payload"))).alias("record"))


def _encoded(column: str) -> Column:
    """The text with each sign that a header cannot hold as ``%XX``."""
    signs = F.split(column, "")
    return F.array_join(
        F.transform(
            signs,
            lambda c: F.when(c.rlike(r"^[\x00-\x20\x7F]$"), F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0")))
            .otherwise(c),
        ),
        "",
    )


def write_whole(rows: DataFrame, folder: str, most: int = RECORDS) -> str:
    """Store ``record`` rows as archives of one gzip stream each, of at most ``most`` records."""
    writer = rows.select("record").write.option("compression", "gzip").option("maxRecordsPerFile", most)
    # What separates rows is what ends a record.
    writer.option("lineSep", BETWEEN).text(folder)
    return folder


def _headers(head: bytes) -> dict[str, str]:
    pairs = (line.split(":", 1) for line in head.decode("utf-8", "replace").split(END)[1:])
    return {p[0].strip().lower(): p[1].strip() for p in pairs if len(p) == 2}


class _Cutter:
    """Cuts a stream of bytes into records: their headers and bytes, line ends included."""

    def __init__(self) -> None:
        self.rest, self.need = bytearray(), 0

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self.rest += data
        if len(self.rest) < self.need:
            return
        at, gap = 0, BETWEEN.encode()
        while True:
            stop = self.rest.find(gap, at)
            if stop < 0:
                self.need = len(self.rest) - at + 1
                break
            if not self.rest.startswith(b"WARC/", at):
                raise ValueError(f"no WARC record but {bytes(self.rest[at : at + 40])!r}")
            headers = _headers(bytes(self.rest[at:stop]))
            end = stop + len(gap) + int(headers["content-length"]) + len(gap)
            if len(self.rest) < end:
                self.need = end - at
                break
            yield headers, bytes(self.rest[at:end])
            at = end
        del self.rest[:at]

    def finish(self) -> None:
        if self.rest:
            raise ValueError(f"an archive ends inside a record, after {bytes(self.rest[:200])!r}")


class _Archive:
    """A new archive and its index rows."""

    def __init__(self, folder: str) -> None:
        self.path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.gz"
        system, inner = fs.FileSystem.from_uri(self.path)
        system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self.file, self.offset = system.open_output_stream(inner, compression=None), 0

    def add(self, headers: dict[str, str], record: bytes) -> dict[str, object]:
        member = gzip.compress(record, mtime=0)
        self.file.write(member)
        row = {
            "path": self.path, "offset": self.offset, "length": len(member),
            "record_id": headers.get("warc-record-id"), "record_type": headers.get("warc-type"),
            "target_uri": headers.get("warc-target-uri"), "payload_digest": headers.get("warc-payload-digest"),
            "refers_to": headers.get("warc-refers-to"),
        }
        self.offset += len(member)
        return row


def _schema(text: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.large_binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in text.split(", "))])


def _rewritten(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Index rows of the archives that the lines of a task's archives become."""
    rows, source, archive, cutter = [], None, None, _Cutter()
    for batch in batches:
        origin = batch.column("source")
        at = 0
        while at < batch.num_rows:
            now = origin[at].as_py()
            if now != source:
                cutter.finish()
                if archive:
                    archive.file.close()
                source, archive = now, _Archive(folder)
            # An archive's lines are together, so its end is where the next begins.
            end = batch.num_rows
            if origin[end - 1].as_py() != now:
                end = at + next(i for i, o in enumerate(origin.slice(at).to_pylist()) if o != now)
            for part in tokens.parts(batch.slice(at, end - at), "line", READ_BYTES):
                lines = part.column("line").to_pylist()
                for headers, record in cutter.feed(b"\n".join([*lines, b""])):
                    rows.append(archive.add(headers, record))
                    if len(rows) >= ROWS:
                        yield pa.RecordBatch.from_pylist(rows, _schema(INDEX))
                        rows = []
            at = end
    cutter.finish()
    if archive:
        archive.file.close()
    yield pa.RecordBatch.from_pylist(rows, _schema(INDEX))


def normalised(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite the archives below ``source`` with a member per record; returns the sidecar index.

    The archives lie in ``target/archives``, the index in ``target/index``.
    """
    lines = spark.read.option("lineSep", "\n").text(source)
    lines = lines.select(F.xxhash64("_metadata.file_path").alias("source"), F.col("value").cast("binary").alias("line"))
    folder = f"{target.rstrip('/')}/archives"
    index = lines.mapInArrow(lambda b: tokens.tidied(_rewritten(b, folder)), INDEX)
    index.write.parquet(f"{target.rstrip('/')}/index")
    return opened_index(spark, target)


def opened_index(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(f"{target.rstrip('/')}/index")


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    """The members of the index rows, neighbours read at once."""
    path, file = None, None
    for batch in batches:
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length")), strict=True))
        at = 0
        while at < len(rows):
            first, end = rows[at], at + 1
            while end < len(rows) and rows[end][0] == first[0] and rows[end][1] == rows[end - 1][1] + rows[end - 1][2]:
                if rows[end][1] + rows[end][2] - first[1] > READ_BYTES:
                    break
                end += 1
            if first[0] != path:
                path = first[0]
                system, inner = fs.FileSystem.from_uri(path)
                file = system.open_input_file(inner)
            last = rows[end - 1]
            data = file.read_at(last[1] + last[2] - first[1], first[1])
            for _, offset, length in rows[at:end]:
                yield data[offset - first[1] : offset - first[1] + length]
            at = end


def _parsed(member: bytes, payload: bool) -> dict[str, object]:
    head, _, block = gzip.decompress(member).partition(BETWEEN.encode())
    headers = _headers(head)
    block = block[: int(headers["content-length"])]
    http, _, body = block.partition(BETWEEN.encode())
    kind, digest = headers["warc-type"], headers["warc-payload-digest"].removeprefix("sha256:")
    if kind == "revisit":
        # It holds the headers of the full payload, and not the payload.
        size, body = int(_headers(http)["content-length"]), None
    else:
        size = len(body)
        if hashlib.sha256(body).hexdigest() != digest:
            raise ValueError(f"the payload of {headers['warc-record-id']} is not the one its digest names")
    return {
        "record_id": headers["warc-record-id"], "record_type": kind, "refers_to": headers.get("warc-refers-to"),
        "target_uri": headers.get("warc-target-uri"), "payload_bytes": size, "payload_digest": digest,
        "payload": body if payload else None,
    }


def _records_of(batches: Iterator[pa.RecordBatch], payload: bool) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for member in _members(batches):
        rows.append(_parsed(member, payload))
        size += len(rows[-1]["payload"] or b"")
        if len(rows) >= ROWS or size > READ_BYTES:
            yield pa.RecordBatch.from_pylist(rows, _schema(FOUND))
            rows, size = [], 0
    yield pa.RecordBatch.from_pylist(rows, _schema(FOUND))


def read(index: DataFrame, *, payload: bool = False) -> DataFrame:
    """The records that the index rows name, with their payloads if asked for.

    ``payload_bytes`` and ``payload_digest`` are of the full payload; a revisit's
    payload is null, as it lies in the record it refers to.
    """
    size = index.agg(F.sum("length")).first()[0] or 0
    tasks = max(index.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    dealt = index.select("path", "offset", "length").repartitionByRange(tasks, "path", "offset")
    dealt = dealt.sortWithinPartitions("path", "offset")
    return dealt.mapInArrow(lambda b: tokens.tidied(_records_of(b, payload)), FOUND)


def archived(pages: DataFrame, folder: str, *, least: int = LEAST_BYTES) -> DataFrame:
    """Write the pages as whole archives below ``folder``, normalise them; returns the index."""
    spark = pages.sparkSession
    whole = write_whole(records(pages, least=least), f"{folder}/whole")
    return normalised(spark, whole, f"{folder}/normal")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = shared.table(spark, sf_dir, "pages")
    index = archived(pages, scratch.new_folder(spark, "warc"))
    kind = pages.schema["page_id"].dataType

    def page(column: str) -> Column:
        return F.nullif(F.regexp_extract(column, "^<urn:page:(.*)>$", 1), F.lit("")).cast(kind)

    return read(index).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"),
    )


SQL = f"""
    WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages
    ), holders AS (
      SELECT *, CASE WHEN strlen(payload) >= {LEAST_BYTES} THEN min(page_id) OVER (PARTITION BY payload) END AS first_id
      FROM payloads
    )
    SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha256(payload) AS payload_digest,
      CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END
        AS record_type,
      CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
    FROM holders"""
