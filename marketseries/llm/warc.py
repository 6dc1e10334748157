"""WARC archives: writing of page captures, reading of records, assembly of the records of a capture."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END = "\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "record_id string, record_type string, concurrent_to string, refers_to string, target_uri string, date string, "
    "payload_digest string, fields map<string,string>, http_status int, payload binary"
)


def _record(kind: str, record_id: Column, headers: list[tuple[str, Column]], content_type: str, block: Column) -> Column:
    """Text of one record without its closing blank lines; headers that are null are left out."""
    lines = [F.lit("WARC/1.1"), F.lit(f"WARC-Type: {kind}"), F.concat(F.lit("WARC-Record-ID: <"), record_id, F.lit(">"))]
    lines += [F.concat(F.lit(f"{name}: "), value) for name, value in headers]
    lines += [F.lit(f"Content-Type: {content_type}"), F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit(END), block)


def page_records(pages: DataFrame, least_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """One row (``value``) for each record of the pages (page_id, url, html): request, response or revisit, metadata.

    Of pages with equal payloads of at least ``least_bytes`` the one with the largest page_id has a response, the
    others revisit it; smaller payloads always have a response. Null html is an empty payload, a null url leaves the
    target out, rows without page_id are left out. Rows that are equal in all three columns have equal record ids.
    """
    rows = pages.filter("page_id is not null").select(
        F.col("page_id").cast("long").cast("string").alias("page"), F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.regexp_replace(F.col("url").cast("string"), "\r", "%0D"), "\n", "%0A").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("bytes", F.octet_length("html"))
    large = rows.filter(F.col("bytes") >= least_bytes).groupBy("digest").agg(
        F.max_by(F.struct("page_id", "url"), "page_id").alias("kept"), F.count("*").alias("_n"))
    large = large.filter("_n > 1").select(F.col("digest").alias("_digest"), "kept")
    rows = rows.join(large, (F.col("digest") == F.col("_digest")) & (F.col("bytes") >= least_bytes), "left")

    def urn(kind: str, page: Column, url: Column) -> Column:
        h = F.md5(F.concat_ws("\t", F.lit(kind), page, F.coalesce(url, F.lit("\n")), F.col("digest")))
        return F.concat(F.lit("urn:uuid:"), F.regexp_replace(h, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"))

    capture = urn("capture", F.col("page"), F.col("url"))
    again = F.coalesce(F.col("page_id") < F.col("kept.page_id"), F.lit(False))
    target = [("WARC-Target-URI", F.col("url")), ("WARC-Date", F.lit(date))]
    digest = ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest")))
    joined = ("WARC-Concurrent-To", F.concat(F.lit("<"), capture, F.lit(">")))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"), F.lit(END))
    first = F.concat(F.lit("<"), urn("capture", F.col("kept.page_id").cast("string"), F.col("kept.url")), F.lit(">"))
    host = F.coalesce(F.try_parse_url("url", F.lit("HOST")), F.lit(""))
    return rows.select(F.explode(F.array(
        _record("request", urn("request", F.col("page"), F.col("url")), [*target, joined], "application/http; msgtype=request",
                F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit(END))),
        F.when(again, _record("revisit", capture, [
            *target, ("WARC-Refers-To", first), ("WARC-Profile", F.lit(REVISIT_PROFILE)), digest],
            "application/http; msgtype=response", http)).otherwise(
            _record("response", capture, [*target, digest], "application/http; msgtype=response", F.concat(http, F.col("html")))),
        _record("metadata", urn("metadata", F.col("page"), F.col("url")), [*target, joined], "application/warc-fields",
                F.concat(F.lit("pageId: "), F.col("page"), F.lit("\r\npayloadBytes: "), F.col("bytes").cast("string"), F.lit("\r\n"))),
    )).alias("value"))


def write_archives(pages: DataFrame, path: str, least_bytes: int = 1000) -> None:
    """Writes gzipped archives of ``pages`` (see :func:`page_records`) into a folder, by Spark's own text writer.

    The writer's line separator is the end of a WARC record, so each file is the records one after another.
    """
    page_records(pages, least_bytes).write.option("lineSep", END).option("compression", "gzip").text(path)


class _Reader:
    """Records of one archive after another from a stream of byte strings."""

    def __init__(self) -> None:
        self.parts: list[bytes] = []
        self.have = self.need = 0

    def feed(self, data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        self.parts.append(data)
        self.have += len(data)
        while self.have >= self.need:
            text = b"".join(self.parts)
            text = text.lstrip(b"\r\n") if not self.need else text
            head = text.find(b"\r\n\r\n")
            self.parts, self.have, self.need = [text], len(text), 0
            if head < 0:
                self.need = len(text) + 1 if text else 0
                return
            if not text.startswith(b"WARC/"):
                raise ValueError(f"no WARC record begins with {text[:40]!r}")
            headers = {}
            for line in text[:head].decode("utf-8", "replace").split("\r\n")[1:]:
                name, _, value = line.partition(":")
                headers[name.strip().lower()] = value.strip()
            end = head + 4 + int(headers["content-length"])
            if len(text) < end:
                self.need = end
                return
            yield headers, text[head + 4 : end]
            rest = text[end:].lstrip(b"\r\n")
            self.parts, self.have, self.need = [rest], len(rest), 0
            if not rest:
                return

    def close(self) -> None:
        if b"".join(self.parts).strip(b"\r\n"):
            raise ValueError("an archive ends within a record")
        self.__init__()


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of all archives under ``path``, as :data:`RECORD`; ``payload`` is null for revisits, the block of other
    records than HTTP ones. Files are gzipped and so read in order by one task each, which holds one record at a time."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, name = _Reader(), None
        for batch in batches:
            rows, held = [], 0
            for data, file in zip(batch.column("value"), batch.column("file").to_pylist()):
                if file != name:
                    reader.close()
                    name = file
                for headers, block in reader.feed(data.as_py() + END.encode()):
                    rows.append(_row(headers, block))
                    held += len(block)
                if held > 4_000_000:
                    yield _batch(rows)
                    rows, held = [], 0
            yield _batch(rows)
        reader.close()

    lines = spark.read.option("lineSep", END).text(path)
    return lines.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file")).mapInArrow(parse, RECORD)


def _row(headers: dict[str, str], block: bytes) -> tuple:
    bare = lambda name: v.strip("<>") if (v := headers.get(name)) else None
    kind, content = headers.get("warc-type"), headers.get("content-type", "")
    fields: dict[str, str] = {}
    status, payload = None, block
    if content.startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        first, *rest = head.decode("utf-8", "replace").split("\r\n")
        if kind in ("response", "revisit"):
            status = int(first.split()[1])
        fields = dict((k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in rest))
        fields["start"] = first
    elif content.startswith("application/warc-fields"):
        fields = dict((k.strip(), v.strip()) for k, _, v in (x.partition(":") for x in block.decode("utf-8", "replace").split("\r\n") if x))
    digest = (headers.get("warc-payload-digest") or "").partition(":")[2] or None
    return (bare("warc-record-id"), kind, bare("warc-concurrent-to"), bare("warc-refers-to"), headers.get("warc-target-uri"),
            headers.get("warc-date"), digest, list(fields.items()), status, None if kind == "revisit" else payload)


_ARROW = pa.schema([
    *((c, pa.string()) for c in ("record_id", "record_type", "concurrent_to", "refers_to", "target_uri", "date", "payload_digest")),
    ("fields", pa.map_(pa.string(), pa.string())), ("http_status", pa.int32()), ("payload", pa.binary())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_ARROW)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def assemble(records: DataFrame) -> DataFrame:
    """One row for each capture: the response or revisit with its request and metadata, joined by concurrent-to ids.

    ``request`` and ``metadata`` are null where no record names the capture; where several do, the one with the
    least record id counts. Records that belong to no capture are left out. ``payload_bytes`` is the length of a
    response's payload and, for revisits, what the metadata says.
    """
    def side(kind: str, fields: list[str]) -> DataFrame:
        own = records.filter(F.col("record_type") == kind).filter("concurrent_to is not null")
        return own.groupBy(F.col("concurrent_to").alias(f"_{kind}_of")).agg(
            F.min_by(F.struct("record_id", *fields), "record_id").alias(kind))

    main = records.filter(F.col("record_type").isin("response", "revisit")).drop("concurrent_to", "fields")
    main = main.withColumn("_bytes", F.octet_length("payload").cast("long")).withColumn(
        "payload_digest", F.coalesce(F.sha1("payload"), "payload_digest"))
    request, metadata = side("request", ["fields"]), side("metadata", ["fields"])
    out = main.join(request, F.col("record_id") == F.col("_request_of"), "left").join(
        metadata, F.col("record_id") == F.col("_metadata_of"), "left")
    said = F.col("metadata.fields").getItem("payloadBytes").cast("long")
    return out.withColumn("payload_bytes", F.coalesce("_bytes", said)).drop("_bytes", "_request_of", "_metadata_of")


def with_payloads(captures: DataFrame) -> DataFrame:
    """Captures whose revisits hold the payload of the response that they refer to."""
    held = captures.filter("record_type = 'response'").select(F.col("record_id").alias("_id"), F.col("payload").alias("_payload"))
    return captures.join(held, F.col("refers_to") == F.col("_id"), "left").withColumn(
        "payload", F.coalesce("payload", "_payload")).drop("_id", "_payload")
