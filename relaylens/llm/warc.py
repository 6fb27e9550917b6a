"""WARC archives: write captures as records, read them back, and assemble transactions.

A capture is a request, a response (or a revisit of an equal earlier payload) and a metadata record, tied together by
WARC-Concurrent-To. Archives are written and read by Spark's text source, so they may lie in any store: records are
told apart by the version line at the start of a line. Since a payload must not hold such a line, a response whose body
does is sent in chunks (Transfer-Encoding), cut inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, table, written

VERSION = "WARC/1.1"
#: Payloads from this many bytes on are stored once.
REVISIT_BYTES = 1000
_END = "\r\n"
#: From the end of a line to the end of the version line but one character. It starts with its only line feed, since
#: Hadoop's reader loses separators that begin anew within themselves where they cross its buffer.
SEPARATOR = f"\n{VERSION}\r"
#: Fixed value of the format: the profile of a revisit record.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record(kind: str, record_id: Column, headers: list[Column], block: Column) -> Column:
    """A record without the version line that goes before it and the line ends after it."""
    size = F.octet_length(block).cast("string")
    lines = [F.concat(F.lit("WARC-Type: "), F.lit(kind)), F.concat(F.lit("WARC-Record-ID: <"), record_id, F.lit(">")), *headers, F.concat(F.lit("Content-Length: "), size)]
    return F.concat(F.concat_ws(_END, *lines), F.lit(_END + _END), block)


def _id(capture: Column, kind: str) -> Column:
    h = F.md5(F.concat(F.lit(kind + ":"), capture))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("urn:uuid:"), F.concat_ws("-", *parts))


def _head(name: str, value: Column) -> Column:
    """A header; null (which concat_ws leaves out) where the value is null. Line ends in values become spaces."""
    return F.concat(F.lit(name + ": "), F.regexp_replace(value, "[\r\n]+", " "))


def plan_captures(pages: DataFrame) -> DataFrame:
    """page_id, url, html, capture (its name), bytes, digest, refers_to and target of each page.

    refers_to is the largest page_id of an equal payload of at least REVISIT_BYTES, if that is another page; target is the
    name of its capture. A null html is an empty payload. A capture is named by page_id, digest and url (each may be null)
    and by a number among rows that are equal in all of them, so that each row is a capture of its own.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("bytes", F.octet_length("html").cast("long")).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    narrow = written(rows.select("page_id", "url", "bytes", "digest"))
    same = ["page_id", "url", "digest"]
    repeated = written(narrow.groupBy(*same).count().where("count > 1").select(*[F.col(c).alias(f"r_{c}") for c in same]))
    numbered = rows.withColumn("number", F.lit(1))
    if repeated.limit(1).count():  # tables without repeated rows aren't joined with them
        match = F.lit(True)
        for c in same:
            match = match & F.col(c).eqNullSafe(F.col(f"r_{c}"))
        # Equal rows are counted before the shuffle and then numbered, however many they are.
        counted = rows.join(repeated, match, "left_semi").groupBy(*same).agg(F.first("html").alias("html"), F.first("bytes").alias("bytes"), F.count("*").cast("int").alias("n"))
        numbered = numbered.join(repeated, match, "left_anti").unionByName(counted.select("page_id", "url", "html", "bytes", "digest", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("number")))
    groups = narrow.where(f"bytes >= {REVISIT_BYTES}").groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("last"), F.min("page_id").alias("first"), F.count("*").alias("n"))
    several = written(groups.where("n > 1 and first < last.page_id").select(F.col("digest").alias("same"), F.col("last.page_id").alias("last"), F.col("last.url").alias("last_url")))
    # Both sides of this join are plain shuffles, so Spark splits a digest that a third of the pages have.
    joined = numbered.join(several, (F.col("digest") == F.col("same")) & (F.col("bytes") >= REVISIT_BYTES), "left")
    refers = F.when(F.col("last") != F.col("page_id"), F.col("last"))
    target = F.when(refers.isNotNull(), _name(F.col("last"), F.col("last_url"), F.col("digest"), F.lit(1)))
    return joined.select("page_id", "url", "html", _name(F.col("page_id"), F.col("url"), F.col("digest"), F.col("number")).alias("capture"), "bytes", "digest", refers.alias("refers_to"), target.alias("target"))


def _name(page_id: Column, url: Column, digest: Column, number: Column) -> Column:
    return F.concat_ws(" ", F.coalesce(page_id.cast("string"), F.lit("none")), digest, number.cast("string"), F.concat(F.lit("of "), url))


def write_warc(captures: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", compression: str = "gzip") -> None:
    """Three records for each row of plan_captures, gzipped text files under path; one task writes one file."""
    c = F.col
    url = F.coalesce(c("url"), F.lit("about:blank"))
    common = [_head("WARC-Target-URI", url), _head("WARC-Date", F.lit(date))]
    response, request, metadata = (_id(c("capture"), k) for k in ("response", "request", "metadata"))
    digest = _head("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest"))
    path_of = F.coalesce(F.nullif(F.regexp_replace(url, r"^[a-z]+://[^/]*|[\s]", ""), F.lit("")), F.lit("/"))
    host_of = F.coalesce(F.regexp_extract(url, r"^[a-z]+://([^/\s]*)", 1), F.lit(""))
    http = F.lit(f"HTTP/1.1 200 OK{_END}Content-Type: text/html; charset=utf-8{_END}")
    whole = F.concat(http, F.lit("Content-Length: "), c("bytes").cast("string"), F.lit(_END + _END), "html")
    cut = F.split("html", r"(?<=(^|\n)WA)(?=RC/1\.1\r)", -1)
    chunk = lambda x: F.concat(F.lower(F.hex(F.octet_length(x))), F.lit(_END), x, F.lit(_END))
    chunked = F.concat(http, F.lit(f"Transfer-Encoding: chunked{_END}{_END}"), F.array_join(F.transform(F.filter(cut, lambda x: x != ""), chunk), ""), F.lit(f"0{_END}{_END}"))
    body = F.when((F.instr("html", SEPARATOR) > 0) | F.startswith("html", F.lit(SEPARATOR[1:])), chunked).otherwise(whole)
    is_revisit = c("refers_to").isNotNull()
    as_response = _record("response", response, [*common, _head("Content-Type", F.lit("application/http; msgtype=response")), digest], body)
    as_revisit = _record("revisit", response, [*common, _head("Content-Type", F.lit("application/http; msgtype=response")), digest, F.concat(F.lit("WARC-Refers-To: <"), _id(c("target"), "response"), F.lit(">")), F.lit(f"WARC-Profile: {PROFILE}")], F.concat(http, F.lit(_END)))
    concurrent = F.concat(F.lit("WARC-Concurrent-To: <"), response, F.lit(">"))
    as_request = _record("request", request, [*common, _head("Content-Type", F.lit("application/http; msgtype=request")), concurrent], F.concat(F.lit("GET "), path_of, F.lit(f" HTTP/1.1{_END}Host: "), host_of, F.lit(_END + _END)))
    fields = F.concat_ws(_END, F.concat(F.lit("page-id: "), c("page_id").cast("string")), F.lit(""))
    as_metadata = _record("metadata", metadata, [*common, _head("Content-Type", F.lit("application/warc-fields")), concurrent], fields)
    records = captures.select(F.explode(F.array(F.when(is_revisit, as_revisit).otherwise(as_response), as_request, as_metadata)).alias("value"))
    records.select(F.concat(F.lit(VERSION + _END), "value").alias("value")).write.option("lineSep", _END + _END).option("compression", compression).option("zlib.compress.level", "BEST_SPEED").text(path)


def _header(head: str, name: str) -> Column:
    return F.nullif(F.regexp_extract(head, rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*$", 1), F.lit(""))


def _uri(value: Column) -> Column:
    return F.regexp_replace(value, "^<|>$", "")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """record_id, type, uri, date, concurrent_to (array), refers_to, digest, http, payload of each record under path.

    payload: the block's bytes after its HTTP head for requests and responses (chunks put together), else the block.
    """
    text = spark.read.option("lineSep", SEPARATOR).text(path)
    cut = text.select(F.regexp_replace("value", rf"^({VERSION}\r)?\n", "").alias("v")).select(F.instr("v", _END + _END).alias("at"), "v").where("at > 0")
    parts = cut.select(F.expr("substring(v, 1, at - 1)").alias("head"), F.expr("cast(substring(v, at + 4) as binary)").alias("rest"))
    rows = parts.select(
        _uri(_header("head", "WARC-Record-ID")).alias("record_id"),
        F.lower(_header("head", "WARC-Type")).alias("type"),
        _header("head", "WARC-Target-URI").alias("uri"),
        _header("head", "WARC-Date").alias("date"),
        F.transform(F.regexp_extract_all("head", F.lit(r"(?im)^WARC-Concurrent-To:[ \t]*<?([^>\r\n]*)>?"), 1), lambda x: F.trim(x)).alias("concurrent_to"),
        _uri(_header("head", "WARC-Refers-To")).alias("refers_to"),
        F.regexp_replace(_header("head", "WARC-Payload-Digest"), "^sha1:", "").alias("digest"),
        _header("head", "Content-Type").alias("content_type"),
        _header("head", "Content-Length").alias("length"),
        "rest",
    ).withColumn("block", F.expr("substring(rest, 1, coalesce(try_cast(length as int), 0))"))
    is_http = F.coalesce(F.col("content_type"), F.lit("")).startswith("application/http")
    # The head of an HTTP message is ASCII here, so characters before its end are bytes.
    end = lambda block: F.nullif(F.instr(F.decode(block, "ISO-8859-1"), _END + _END), F.lit(0))
    at = F.when(is_http, F.coalesce(end(F.expr("substring(block, 1, 4096)")), end(F.col("block"))))  # a longer head: the whole block is searched
    rows = rows.withColumn("at", at)
    rows = rows.withColumn("http", F.when(F.col("at") > 0, F.decode(F.expr("substring(block, 1, at - 1)"), "ISO-8859-1")))
    rows = rows.withColumn("payload", F.when(F.col("at") > 0, F.expr("substring(block, at + 4)")).otherwise(F.col("block")))
    chunked = F.coalesce(F.col("http"), F.lit("")).rlike("(?im)^transfer-encoding:[ \t]*chunked")
    return rows.withColumn("payload", F.when(chunked, _dechunked(F.col("payload"))).otherwise(F.col("payload"))).select("record_id", "type", "uri", "date", "concurrent_to", "refers_to", "digest", "http", "payload")


def _dechunked(body: Column) -> Column:
    """Payload of a chunked message; evaluated only for messages that are."""
    text = F.decode(body, "ISO-8859-1")  # a character a byte
    return F.encode(
        F.aggregate(
            F.split(text, _END),
            F.struct(F.lit(1).alias("at"), F.lit("").alias("out")),
            lambda s, _: F.when(_chunk_size(text, s) > 0, F.struct((_chunk_data(text, s) + _chunk_size(text, s) + 2).alias("at"), F.concat(s["out"], F.substr(text, _chunk_data(text, s), _chunk_size(text, s))).alias("out"))).otherwise(s),
            lambda s: s["out"],
        ),
        "ISO-8859-1",
    )


def _chunk_data(text: Column, state: Column) -> Column:
    """Where the data of the chunk that starts at state.at begins."""
    return F.position(F.lit(_END), text, state["at"]) + len(_END)


def _chunk_size(text: Column, state: Column) -> Column:
    """Bytes of that chunk; 0 for the last one and for what isn't a chunk."""
    digits = F.regexp_extract(F.substr(text, state["at"], F.lit(8)), "^[0-9A-Fa-f]+", 0)
    return F.coalesce(F.conv(F.nullif(digits, F.lit("")), 16, 10).cast("int"), F.lit(0))


def assemble(records: DataFrame) -> DataFrame:
    """One nested row a capture: capture_id, response, requests, metadata (arrays of record structs without payload).

    Records are tied through concurrent-to in either direction, directly to a response or revisit, or through one other
    record. Others are captures of their own, without a response. Equal records count once. records: record_id, type,
    uri, concurrent_to, and further columns, all kept in the structs.
    """
    fields = [c for c in records.columns if c not in ("capture_id",)]
    main = records.where("type in ('response', 'revisit')").select(F.col("record_id").alias("capture_id")).distinct()
    said = records.select("record_id", F.explode("concurrent_to").alias("other")).where("record_id is not null and other <> ''")
    ties = said.union(said.select(F.col("other").alias("record_id"), F.col("record_id").alias("other"))).distinct()
    ties = written(ties.join(main.select(F.col("capture_id").alias("record_id")), "record_id", "left_anti"))
    direct = written(ties.join(main, F.col("other") == F.col("capture_id")).groupBy("record_id").agg(F.min("capture_id").alias("capture_id")))
    open_ = ties.join(direct.select("record_id"), "record_id", "left_anti")
    second = open_.join(direct.select(F.col("record_id").alias("other"), "capture_id"), "other").groupBy("record_id").agg(F.min("capture_id").alias("capture_id"))
    home = direct.union(second).withColumnRenamed("record_id", "r").withColumnRenamed("capture_id", "home")
    rows = records.join(home, F.col("record_id") == F.col("r"), "left").withColumn("capture_id", F.coalesce("home", "record_id", F.concat(F.lit("none-"), F.xxhash64(*fields).cast("string"))))
    one = F.struct(*fields)
    is_main = F.col("type").isin("response", "revisit")
    return rows.groupBy("capture_id").agg(
        F.min(F.when(is_main, one)).alias("response"),
        F.sort_array(F.collect_set(F.when(F.col("type") == "request", one))).alias("requests"),
        F.sort_array(F.collect_set(F.when(~F.coalesce(is_main | (F.col("type") == "request"), F.lit(False)), one))).alias("metadata"),
    )


def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to of every page, from archives written and read back.

    The digest and size of a response are those of the payload read. A revisit has no payload: its size and refers_to are
    those of the response whose record WARC-Refers-To names, its digest is the one that its record states.
    """
    path = shared_folder(spark)
    write_warc(plan_captures(table(spark, sf_dir, "pages")), path)
    records = read_warc(spark, path)
    is_response = F.col("type") == "response"
    narrow = records.select(
        "record_id", "type", "uri", "concurrent_to", "refers_to",
        F.when(is_response, F.sha1("payload")).otherwise(F.col("digest")).alias("digest"),
        F.when(is_response, F.octet_length("payload").cast("long")).alias("bytes"),
        F.when(F.col("type") == "metadata", F.decode("payload", "UTF-8")).alias("fields"),
    )
    said = F.get("metadata", F.lit(0))["fields"]
    page_id = F.nullif(F.regexp_extract(said, r"(?m)^page-id: (-?\d+)\r?$", 1), F.lit("")).cast("long")
    captures = written(assemble(written(narrow)).select("capture_id", page_id.alias("page_id"), *[F.col(f"response.{c}").alias(c) for c in ("uri", "type", "digest", "bytes", "refers_to")]))
    earlier = captures.where("type = 'response'").select(F.col("capture_id").alias("earlier_id"), F.col("page_id").alias("earlier_page"), F.col("bytes").alias("earlier_bytes"))
    return captures.join(earlier, F.col("refers_to") == F.col("earlier_id"), "left").select(
        "page_id",
        F.col("uri").alias("url"),
        F.coalesce("bytes", "earlier_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.when(F.col("type") == "revisit", F.col("earlier_page")).alias("refers_to"),
    )


ORACLE_SQL = {
    "op1_warc_transactions": f"""
WITH p AS (SELECT page_id, coalesce(url, 'about:blank') AS url, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT d, max(page_id) AS last FROM p WHERE n >= {REVISIT_BYTES} GROUP BY d)
SELECT p.page_id, p.url, CAST(p.n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN g.last <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN g.last <> p.page_id THEN g.last END AS refers_to
FROM p LEFT JOIN g ON p.d = g.d AND p.n >= {REVISIT_BYTES}"""
}
