"""WARC archives: writing captures, reading archives back, and assembling the records of a capture.

Archives are written by the text sink, one record per value and the record terminator as line separator, so
they are committed like any other output of Spark and may lie in any store that Spark writes to. They are read
by the text source with the version line of a record as separator, so that a record, not a file, is the unit
in memory, and compressed archives are streamed. A version line inside a payload would split its record; the
declared length shows that, and such archives are read again as whole files by a parser that follows lengths.

A capture is a response (or revisit) record with the request and metadata records that name it, or that it
names, in WARC-Concurrent-To. Assembly joins them through these identifiers to one nested row per capture.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import stage

# Fixed strings of the format.
VERSION = "WARC/1.1"
CRLF = "\r\n"
END = CRLF + CRLF
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2025-01-01T00:00:00Z"

LEAST_BYTES = 1000  # smaller payloads are never replaced by a revisit
MAIN = ("response", "revisit")


def _record_id(kind: str, key: Column) -> Column:
    digest = F.md5(F.concat(F.lit(f"{kind}:"), F.coalesce(key.cast("string"), F.lit(""))))
    parts = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _lines(*pairs: tuple[str, Column | str]) -> Column:
    """Header lines; a header whose value is null is left out."""
    made = [F.concat(F.lit(f"{name}: "), F.lit(v) if isinstance(v, str) else v, F.lit(CRLF)) for name, v in pairs]
    return F.concat_ws("", *made)


def _record(kind: Column | str, headers: Column, block: Column) -> Column:
    """The bytes of a record up to its terminator; ``block`` is binary."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    head = F.concat(F.lit(f"{VERSION}{CRLF}WARC-Type: "), kind, F.lit(CRLF), headers)
    return F.concat(head.cast("binary"), _lines(("Content-Length", F.octet_length(block).cast("string"))).cast("binary"), F.lit(CRLF).cast("binary"), block)


def captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """``page_id, url, payload, bytes, digest, refers_to``: the payload of each page and the page it repeats.

    Of pages with equal payloads of ``least_bytes`` or more, that with the largest id is the response, and the
    others refer to it; rows that repeat that very id are responses too. Groups are found by digest and length
    on narrow rows, pre-aggregated; only the join back moves payloads, and it splits a group of many copies.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.regexp_replace(F.col(url_col).cast("string"), r"[\r\n]", "").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).cast("binary").alias("payload"),
    )
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("long"), "digest": F.sha1("payload")})
    groups = rows.filter(F.col("bytes") >= least_bytes).groupBy("digest", "bytes")
    groups = groups.agg(F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = stage(groups.filter("n > 1 and first is not null").drop("n"), "repeats")
    joined = rows.join(groups, ["digest", "bytes"], "left")
    # A page without an id is a copy like any other.
    refers = F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first"))
    return joined.select("page_id", "url", "payload", "bytes", "digest", refers.alias("refers_to"))


def write_archives(found: DataFrame, folder: str, compression: str = "gzip") -> str:
    """Writes a request, a response or revisit, and a metadata record for each capture to archives below ``folder``.

    ``found`` is what ``captures`` returns. A revisit has the HTTP header of its response, whose length it keeps,
    and no payload. Record ids are digests of the page ids.
    """
    own, other = _record_id("response", F.col("page_id")), _record_id("response", F.col("refers_to"))
    revisit = F.col("refers_to").isNotNull()
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}"),
        _lines(("Content-Type", "text/html; charset=utf-8"), ("Content-Length", F.col("bytes").cast("string"))),
        F.lit(CRLF),
    ).cast("binary")
    page = F.col("page_id").cast("string")
    main = _record(
        F.when(revisit, "revisit").otherwise("response"),
        _lines(
            ("WARC-Record-ID", own),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", F.col("url")),
            ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", digest),
            ("WARC-Profile", F.when(revisit, PROFILE)),
            ("WARC-Refers-To", F.when(revisit, other)),
            ("X-Page-ID", page),
            ("X-Refers-To-Page-ID", F.col("refers_to").cast("string")),
        ),
        F.concat(http, F.when(revisit, F.lit("").cast("binary")).otherwise(F.col("payload"))),
    )
    host = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-z]+://([^/?#]*)", 1)
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-z]+://[^/?#]*([^#]*)", 1)
    path = F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat(F.lit("/"), path))
    asked = F.concat(F.lit("GET "), path, F.lit(f" HTTP/1.1{CRLF}"), _lines(("Host", host)), F.lit(CRLF)).cast("binary")
    about = F.concat(_lines(("fetchedBytes", F.col("bytes").cast("string")))).cast("binary")

    def beside(kind: str, content: str, block: Column) -> Column:
        lines = _lines(
            ("WARC-Record-ID", _record_id(kind, F.col("page_id"))),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", F.col("url")),
            ("WARC-Concurrent-To", own),
            ("Content-Type", content),
        )
        return _record(kind, lines, block)

    records = F.array(
        beside("request", "application/http; msgtype=request", asked), main, beside("metadata", "application/warc-fields", about)
    )
    values = found.select(F.explode(records).alias("value")).select(F.col("value").cast("string"))
    values.write.mode("errorifexists").option("lineSep", END).option("compression", compression).option("zlib.compress.level", "BEST_SPEED").text(folder)
    return folder


def _split_http(kind: Column, content_type: Column, block: Column) -> tuple[Column, Column]:
    """The HTTP header (text) and payload (binary) of a record's block; other blocks are payload throughout."""
    at = F.locate(END, block.cast("string"))
    http = F.coalesce(F.contains(content_type, F.lit("application/http")), F.lit(False)) & (at > 0)
    head = F.when(http, F.substring(block.cast("string"), F.lit(1), at + 1))
    rest = F.substring(block, F.octet_length(head) + 3, F.octet_length(block))
    return head, F.when(http, rest).otherwise(block)


def _header(head: str, name: str) -> Column:
    """Value of a header line, of the first where there are more; null if there is none."""
    found = F.regexp_extract(F.col(head), rf"(?im)^{name}:[ \t]*(.*?)[ \t]*\r?$", 1)
    return F.when(found != "", found)


def _parsed(raw: DataFrame) -> DataFrame:
    """Records from ``path, head, body``: header lines, and the block with its terminator."""
    length = F.expr("try_cast(_length as int)")
    out = raw.withColumn("_length", _header("head", "Content-Length"))
    # Anything but a block of the declared length and the terminator means that a record was split or two were not.
    fits = (length >= 0) & (F.octet_length("body") == length + len(END))
    out = out.withColumn("complete", F.coalesce(fits, F.lit(False)))
    out = out.withColumn("block", F.substring(F.col("body"), F.lit(1), length))
    out = out.select(
        "path",
        "complete",
        F.lower(_header("head", "WARC-Type")).alias("type"),
        _header("head", "WARC-Record-ID").alias("record_id"),
        F.regexp_extract_all("head", F.lit(r"(?im)^WARC-Concurrent-To:[ \t]*(\S+)"), 1).alias("concurrent_to"),
        _header("head", "WARC-Target-URI").alias("target_uri"),
        _header("head", "WARC-Payload-Digest").alias("declared_digest"),
        _header("head", "WARC-Refers-To").alias("refers_to"),
        _header("head", "Content-Type").alias("content_type"),
        "head",
        "block",
    )
    http, payload = _split_http(F.col("type"), F.col("content_type"), F.col("block"))
    return out.withColumn("http_head", http).withColumn("payload", payload).drop("block", "content_type")


def parse_file(data: bytes) -> Iterator[tuple[str, bytes]]:
    """Header lines and block of each record of an archive, by the declared lengths."""
    at = 0
    while (start := data.find(b"WARC/", at)) >= 0:
        close = data.find(END.encode(), start)
        if close < 0:
            return
        head = data[start : close + 2].decode("utf-8", "replace")
        length = re.search(r"(?im)^Content-Length:[ \t]*(\d+)[ \t]*\r?$", head)
        size = int(length[1]) if length else 0
        yield head, data[close + 4 : close + 4 + size]
        at = close + 4 + size


def read_archives(spark: SparkSession, folder: str, reduce_to: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Records of all archives below ``folder``, plain or gzip-compressed.

    ``path, type, record_id, concurrent_to, target_uri, declared_digest, refers_to, head, http_head, payload``;
    ``head`` has the record's header lines, ``payload`` is binary. Only a file in which a declared length does
    not fit is read as a whole by one task. ``reduce_to`` may replace columns by what is needed of them (all but
    ``path, complete, type``); its result is written, so that the archives are read once.
    """
    # Each record follows a version line; what stands before the first one is empty.
    pieces = spark.read.option("lineSep", f"{VERSION}{CRLF}").text(folder).filter(F.octet_length("value") > 0)
    pieces = pieces.select(F.col("_metadata.file_path").alias("path"), F.col("value").cast("binary").alias("value"))
    # The header is text; the rest is cut off by bytes.
    text = F.col("value").cast("string")
    at = F.locate(END, text)
    head = F.when(at > 0, F.substring(text, F.lit(1), at + 1))
    body = F.substring("value", F.octet_length(head) + 3, F.octet_length("value"))
    records = _parsed(pieces.select("path", head.alias("head"), body.alias("body")))
    if reduce_to is not None:
        records = stage(reduce_to(records), "records")
    broken = stage(records.filter(~F.coalesce("complete", F.lit(False)) | F.col("type").isNull()).select("path").distinct(), "broken")
    if broken.isEmpty():
        return records.drop("complete")
    whole = records.join(broken, "path", "left_anti")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = content.as_buffer().to_pybytes()
                plain = b""
                while data[:2] == b"\x1f\x8b":  # one member after another
                    member = zlib.decompressobj(31)
                    plain += member.decompress(data)
                    data = member.unused_data
                for head, block in parse_file(plain or data):
                    yield pa.RecordBatch.from_pydict({"path": [path], "head": [head], "body": [block + END.encode()]})

    files = spark.read.format("binaryFile").load(folder)
    files = files.select(F.col("_metadata.file_path").alias("path"), "content").join(broken, "path", "left_semi")
    again = _parsed(files.mapInArrow(parse, "path string, head string, body binary"))
    if reduce_to is not None:
        again = reduce_to(again)
    return whole.union(again).drop("complete")


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``record, requests, metadata``.

    ``record`` is the response or revisit; ``requests`` and ``metadata`` are the records linked to it by
    WARC-Concurrent-To in either direction, or to a record that is. A repeated record id counts once beside
    a capture; a capture whose own id is repeated stays as often as it occurs. Records linked to no capture are
    left out.
    """
    main = records.filter(F.col("type").isin(*MAIN))
    beside = records.filter(F.col("type").isin("request", "metadata")).select(
        "type", "record_id", F.struct("record_id", "head", "payload").alias("body"), "concurrent_to"
    )
    named = records.select("type", "record_id", F.explode("concurrent_to").alias("other"))
    links = named.select(F.col("record_id").alias("a"), F.col("other").alias("b"))
    links = links.union(links.select("b", "a")).filter("a is not null and b is not null").distinct()
    links = stage(links, "links")
    anchors = main.filter("record_id is not null").select(F.col("record_id").alias("capture")).distinct()
    near = links.join(anchors, F.col("a") == F.col("capture")).select("capture", F.col("b").alias("record_id"))
    next_ = near.join(links, F.col("record_id") == F.col("a")).select("capture", F.col("b").alias("record_id"))
    reached = near.union(next_).filter("capture <> record_id").distinct()
    once = beside.dropDuplicates(["record_id"])
    attached = reached.join(once, "record_id").groupBy("capture").agg(
        *[F.array_sort(F.collect_list(F.when(F.col("type") == t, F.col("body")))).alias(n) for t, n in (("request", "requests"), ("metadata", "metadata"))]
    )
    joined = main.join(attached, F.col("record_id") == F.col("capture"), "left")
    empty = F.array().cast("array<struct<record_id:string,head:string,payload:binary>>")
    return joined.select(
        F.struct(*main.columns).alias("record"), F.coalesce("requests", empty).alias("requests"), F.coalesce("metadata", empty).alias("metadata")
    )


def page_captures(spark: SparkSession, pages: DataFrame, folder: str) -> DataFrame:
    """Writes the pages as archives, reads them back and assembles the captures.

    ``page_id, payload_bytes, payload_digest, record_type, refers_to, n_requests, n_metadata`` for every page;
    the bytes and the digest of a response are those of the payload read back, of a revisit the declared ones.
    """

    def digested(records: DataFrame) -> DataFrame:
        sizes = records.withColumns({"own_bytes": F.octet_length("payload").cast("long"), "own_digest": F.sha1("payload")})
        return sizes.withColumn("payload", F.when(~F.col("type").isin(*MAIN), F.col("payload")))

    nested = assemble(read_archives(spark, write_archives(captures(pages), folder), digested))
    record = F.col("record")
    revisit = record["type"] == "revisit"
    flat = nested.withColumns({"head": record["head"], "http": record["http_head"]})
    return flat.select(
        _header("head", "X-Page-ID").cast("long").alias("page_id"),
        F.when(revisit, _header("http", "Content-Length").cast("long")).otherwise(record["own_bytes"]).alias("payload_bytes"),
        F.when(revisit, F.regexp_replace(record["declared_digest"], "^sha1:", "")).otherwise(record["own_digest"]).alias("payload_digest"),
        record["type"].alias("record_type"),
        _header("head", "X-Refers-To-Page-ID").cast("long").alias("refers_to"),
        F.size("requests").alias("n_requests"),
        F.size("metadata").alias("n_metadata"),
    )
