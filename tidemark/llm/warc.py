"""WARC archives with repeated payloads written as revisit records.

An archive is a series of gzip members, so that a reader can start at any record. Each record is a member of its own, followed by
one that holds its closing line ends: these are always the same bytes, and Spark's text writer sets them between its rows.
An archive begins with a warcinfo record and is bounded in bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import SLICE_BYTES, slices
from tidemark.session import freeze

DATE = "2024-01-01T00:00:00Z"
MIN_BYTES = 100
#: Compressed bytes after which an archive ends.
FILE_BYTES = 64 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"
#: Fields of our own: a page's number, and that of the page a revisit refers to. Record ids tell repeated pages apart.
PAGE, REFERS = "X-Page-ID", "X-Refers-To-Page-ID"
ROW = ("page_id long, record_type string, target_uri string, payload_digest string, payload_bytes long, refers_to long, "
       "payload binary")


def resolve(pages: DataFrame, min_bytes: int = MIN_BYTES, page_id: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to and refers_uri of every row.

    Of rows with equal payloads of at least min_bytes, those with the smallest page_id are responses and the others
    revisit it. The original of a digest is found from headers (id, digest, url) alone, combined before the shuffle;
    each digest is then one row of a stored table on the right of the join, so a payload with very many copies can be
    split on the left.
    A null payload is empty. Rows without a page_id are revisits of one that has it, else responses.
    """
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"),
        F.coalesce(F.col(html), F.lit("")).alias("payload"),
    ).withColumns({
        "payload_bytes": F.octet_length("payload").cast("long"),
        "payload_digest": F.sha2(F.col("payload").cast("binary"), 256),
    })
    originals = freeze(
        rows.where(F.col("payload_bytes") >= min_bytes).select("payload_digest", "page_id", "url")
        .groupBy(F.col("payload_digest").alias("digest"))
        .agg(F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))).alias("first"))
        .where(F.col("first").isNotNull())
    )
    joined = rows.join(originals, F.col("payload_digest") == F.col("digest"), "left")
    again = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    return joined.select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first.page_id")).alias("refers_to"),
        F.when(again, F.col("first.url")).alias("refers_uri"),
    )


def _uri(url: Column) -> Column:
    """No line end or blank may reach a header."""
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(url, " ", "%20"), "\r", "%0D"), "\n", "%0A")
    return clean


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def record(date: str = DATE) -> Column:
    """The text of a record, less the two line ends that close it, from the columns that resolve() gives."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"), F.lit(END),
    )
    block = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.col("record_type")),
        _header("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))),
        _header(PAGE, F.col("page_id").cast("string")),
        F.lit(f"WARC-Date: {date}\r\n"),
        _header("WARC-Target-URI", _uri(F.col("url"))),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _header("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _header(REFERS, F.col("refers_to").cast("string")),
        _header("WARC-Refers-To-Target-URI", F.when(revisit, _uri(F.col("refers_uri")))),
        _header("WARC-Refers-To-Date", F.when(revisit, F.lit(date))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _header("Content-Length", block.cast("string")),
        F.lit("\r\n"), http, F.when(revisit, F.lit("")).otherwise(F.col("payload")),
    )


def _member(data: bytes) -> bytes:
    import zlib

    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def write_archives(resolved: DataFrame, path: str, date: str = DATE, file_bytes: int = FILE_BYTES) -> None:
    """Archives below path, named *.warc.gz, in folders by their number in the task that wrote them.

    An archive ends with the record that reaches file_bytes, so none is much larger, and readers take one as a whole.
    """
    spark = resolved.sparkSession

    def run(batches):
        import uuid

        import pyarrow as pa

        body = b"software: record writer\r\nformat: WARC File Format 1.1\r\n"

        def about() -> bytes:
            head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid4()}>\r\nWARC-Date: {date}\r\n"
            head += f"Content-Type: application/warc-fields\r\nContent-Length: {len(body)}{END}"
            return _member(head.encode() + body)

        file, size, place = 0, 0, 0
        for batch in batches:
            for part in slices(batch, "value", SLICE_BYTES):
                rows = []
                for text in part.column("value").to_pylist():
                    if not size:
                        rows.append((file, place, first := about()))
                        size, place = len(first), place + 1
                    rows.append((file, place, one := _member(text)))
                    size, place = size + len(one), place + 1
                    if size >= file_bytes:
                        file, size = file + 1, 0
                files, places, members = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(files, pa.int32()), pa.array(places, pa.int64()), pa.array(members, pa.binary())], names=["file", "place", "member"]
                )

    texts = resolved.select(record(date).cast("binary").alias("value"))
    members = texts.mapInArrow(run, "file int, place long, member binary").sortWithinPartitions("file", "place")
    # the writer puts out the bytes of a text as they are
    rows = members.select("file", F.col("member").cast("string").alias("value"))
    rows.write.mode("overwrite").partitionBy("file").option("lineSep", _member(END.encode()).decode("latin-1")).option(
        "encoding", "ISO-8859-1"
    ).text(path)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path_of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.globStatus(path_of(f"{path}/file=*/*.txt")):
        one = status.getPath()
        fs.rename(one, path_of(one.getParent(), one.getName().removesuffix(".txt") + ".warc.gz"))


def _records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, found by its length: a payload may hold anything."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record starts with {line[:40]!r}")
        headers = {}
        while (line := stream.readline().rstrip(b"\r\n")):
            name, _, value = line.decode("utf-8").partition(": ")
            headers[name.lower()] = value
        block = stream.read(int(headers["content-length"]))
        if len(block) != int(headers["content-length"]):
            raise ValueError(f"record {headers.get('warc-record-id')} is cut short")
        yield headers, block


def _number(value: str | None) -> int | None:
    return None if value is None else int(value)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: ROW. Of a revisit the payload is null and its length is the one its HTTP header states.

    A response whose payload has not the digest in its header is an error, as is a record cut short.
    """

    def parse(batches):
        import gzip
        import hashlib
        import io

        import pyarrow as pa

        kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
        names = [c.split()[0] for c in ROW.split(", ")]

        def batch(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kinds.get(n, pa.string())) for n, c in zip(names, zip(*rows))], names=names
            )

        for got in batches:
            for content in got.column("content"):
                rows, size = [], 0
                for headers, block in _records(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                    if headers["warc-type"] == "warcinfo":
                        continue
                    http, _, payload = block.partition(END.encode())
                    digest = headers["warc-payload-digest"].partition(":")[2]
                    n = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
                    if headers["warc-type"] == "response" and (
                        hashlib.sha256(payload).hexdigest() != digest or len(payload) != n
                    ):
                        raise ValueError(f"{headers['warc-record-id']}: the payload does not fit its digest")
                    rows.append((
                        _number(headers.get(PAGE.lower())), headers["warc-type"], headers.get("warc-target-uri"), digest, n,
                        _number(headers.get(REFERS.lower())), payload if headers["warc-type"] == "response" else None,
                    ))
                    size += len(block)
                    if size > 1 << 20:
                        yield batch(rows)
                        rows, size = [], 0
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(path)
    return files.select("content").mapInArrow(parse, ROW)
