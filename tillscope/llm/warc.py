"""WARC archives: writing with revisits, reading by verified chains of boundaries.

Archives are written and read by Spark's text source, whose line separator is the
end of a record when writing and the magic of a record when reading. So files are
split among tasks anywhere. Every place with the magic is a candidate record, and
its task gives the offset that its successor must have. Pointer jumping from the
start of each file keeps the candidates that a chain of lengths reaches; a magic
inside a payload is not one of them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillscope.llm.common import table, written
from tillscope.session import shared_folder

MAGIC = "WARC/1.0\r\n"
CRLF = "\r\n"
END = CRLF + CRLF
#: Payloads of fewer bytes are always stored.
MIN_REVISIT_BYTES = 1000
#: Records of a file at most.
FILE_RECORDS = 20_000
#: Groups of equal payloads whose digests are sent to every executor at most (60 bytes each).
BROADCAST_GROUPS = 200_000
DATE = "2020-01-01T00:00:00Z"


# --- writing --------------------------------------------------------------------------

def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def record_types(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, payload, bytes, digest, refers_to (null for what is stored whole).

    Of pages with equal payloads of at least ``min_bytes`` bytes the largest page_id is
    stored, and rows that repeat it are, too; the others refer to it. Null ids refer
    to it as well, and where all ids are null every page is stored.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("bytes", F.octet_length("payload").cast("long")).withColumn("digest", F.sha1("payload"))
    groups = rows.filter(F.col("bytes") >= min_bytes).groupBy("digest", "bytes").agg(
        F.count("*").alias("copies"), F.max("page_id").alias("stored")
    )
    groups = groups.filter("copies > 1 and stored is not null").select(
        F.col("digest").alias("group_digest"), F.col("bytes").alias("group_bytes"), "stored"
    )
    groups = written(groups, "warc-groups")
    if groups.count() <= BROADCAST_GROUPS:
        groups = F.broadcast(groups)  # otherwise the pages are shuffled by digest
    same = (F.col("digest") == F.col("group_digest")) & (F.col("bytes") == F.col("group_bytes"))
    whole = F.col("stored").isNull() | F.col("page_id").eqNullSafe(F.col("stored"))
    return rows.join(groups, same, "left").select(
        "page_id", "url", "payload", "bytes", "digest", F.when(~whole, F.col("stored")).alias("refers_to")
    )


def record_text(date: str = DATE) -> Column:
    """A record without its closing blank lines, from the columns of ``record_types``."""
    revisit = F.col("refers_to").isNotNull()
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\x00-\x20\x7F]", "%20")
    name = lambda id_: F.concat(F.lit("<urn:page:"), F.coalesce(id_.cast("string"), F.lit("null")), F.lit(">"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
        _header("Content-Length", F.col("bytes").cast("string")), F.lit(CRLF),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload").cast("string"))
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    profile = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
    return F.concat(
        F.lit(MAGIC),
        _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", name(F.col("page_id"))),
        _header("WARC-Date", F.lit(date)),
        _header("WARC-Target-URI", url),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(_header("WARC-Refers-To", name(F.col("refers_to"))), _header("WARC-Profile", F.lit(profile)))).otherwise(F.lit("")),
        _header("Content-Type", F.lit("application/http;msgtype=response")),
        _header("Content-Length", length.cast("string")),
        F.lit(CRLF), http, body,
    )


def write_archives(pages: DataFrame, path: str, file_records: int = FILE_RECORDS, **options) -> None:
    """Writes a record per row of ``pages`` (page_id, url, html, others) to uncompressed archives."""
    records = record_types(pages, **options).select(record_text().alias("value"))
    records.write.option("lineSep", END).option("maxRecordsPerFile", file_records).text(path)


# --- reading --------------------------------------------------------------------------

def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The stretches between magics: file, split, row (their order), value (text), size in bytes.

    A file is the empty stretch before its first magic and then one stretch per
    magic, so offsets are running sums of sizes: of the splits, then within one.
    """
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"), "value",
        (F.octet_length("value") + len(MAGIC)).cast("long").alias("size"),
    )


def _measured(lines: DataFrame) -> DataFrame:
    """What is known of each stretch by itself, without its text."""
    text = F.col("value")
    blank = F.instr(text, END)  # characters; header and HTTP header are ASCII up to there
    header = F.when(blank > 0, F.substring(text, F.lit(1), blank - 1))
    ask = lambda name, of: F.regexp_extract(of, rf"(?mi)^{name}:[ \t]*([^\r\n]*)", 1)
    length = ask("Content-Length", header).try_cast("long")
    lines = lines.withColumn("header", header).withColumn("length", length)
    ahead = len(MAGIC) + F.octet_length("header") + len(END) + F.col("length") + len(END)
    lines = lines.withColumn("reach", F.when(F.col("length") >= 0, ahead.cast("long")))
    rest = F.expr(f"substring(encode(value, 'UTF-8'), octet_length(header) + {len(END) + 1})")
    # where the record ends with the stretch its content is all here
    closed = F.col("reach").eqNullSafe(F.col("size")) & (F.substring(text, -len(END), len(END)) == END)
    lines = lines.withColumn("closed", closed).withColumn("rest", rest)
    content = F.expr("substring(rest, 1, cast(length as int))")
    return lines.select(
        "file", "split", "row", "size", "reach", "closed", "header",
        F.when(F.col("closed"), _content_facts(content)).alias("facts"),
    )


def _content_facts(content: Column) -> Column:
    """Bytes and SHA-1 of the payload in an HTTP message, and the length its header states."""
    at = F.locate(END, F.decode(content, "ISO-8859-1"))  # a byte each
    head = F.decode(F.substring(content, F.lit(1), at - 1), "ISO-8859-1")
    payload = F.substring(content, at + len(END), F.octet_length(content))
    stated = F.regexp_extract(head, r"(?mi)^Content-Length:[ \t]*([0-9]+)", 1).try_cast("long")
    return F.struct(
        F.octet_length(payload).cast("long").alias("bytes"), F.sha1(payload).alias("sha1"), stated.alias("stated")
    )


def _reachable(candidates: DataFrame) -> DataFrame:
    """(file, offset) of the candidates that a chain from offset 0 of their file reaches.

    Candidates that follow each other without a gap form a stretch; what enters one
    leaves it by its last candidate. Pointer jumping doubles the length of known ways
    between the points where stretches are entered, so the rounds are the logarithm
    of the number of breaks, not of the records.
    """
    by_file = Window.partitionBy("file").orderBy("offset")
    linked = candidates.withColumn("next", F.lead("offset").over(by_file))
    linked = linked.withColumn("breaks", (~F.col("successor").eqNullSafe(F.col("next"))).cast("int"))
    before = by_file.rowsBetween(Window.unboundedPreceding, -1)
    linked = linked.withColumn("stretch", F.coalesce(F.sum("breaks").over(before), F.lit(0)))
    linked = written(linked, "warc-candidates")
    exits = linked.filter("breaks = 1").select("file", "stretch", F.col("successor").alias("exit"))
    points = exits.select("file", F.col("exit").alias("offset")).filter("offset is not null")
    points = points.unionAll(linked.select("file", F.lit(0).cast("long").alias("offset"))).distinct()
    entries = linked.select("file", "offset", "stretch").join(points, ["file", "offset"], "left_semi")
    jumps = entries.join(exits, ["file", "stretch"]).select("file", "offset", "exit")
    jumps = written(jumps.filter("exit is not null"), "warc-jumps")
    reached = written(linked.filter("offset = 0").select("file", "offset"), "warc-reached")
    count = reached.count()
    while not jumps.isEmpty():
        further = reached.join(jumps, ["file", "offset"]).select("file", F.col("exit").alias("offset"))
        reached = written(reached.unionAll(further).distinct(), "warc-reached")
        before_count, count = count, reached.count()
        if count == before_count:
            break
        onward = jumps.select("file", F.col("offset").alias("exit"), F.col("exit").alias("far"))
        jumps = written(jumps.join(onward, ["file", "exit"]).select("file", "offset", F.col("far").alias("exit")), "warc-jumps")
    found = reached.join(entries, ["file", "offset"]).groupBy("file", "stretch").agg(F.min("offset").alias("entered"))
    return linked.join(found, ["file", "stretch"]).filter("offset >= entered").select("file", "offset", "successor")


def _offsets(chunks: DataFrame) -> DataFrame:
    """Adds ``offset``, that of the magic in front of each stretch; the one before the first goes."""
    sums = chunks.groupBy("file", "split").agg(F.sum("size").alias("split_size"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("file").alias("f"), F.col("split").alias("s"),
        F.coalesce(F.sum("split_size").over(earlier), F.lit(0)).alias("split_offset"),
    )
    own = Window.partitionBy("file", "split").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    placed = chunks.withColumn("near", F.coalesce(F.sum("size").over(own), F.lit(0)))
    placed = placed.join(sums, (F.col("file") == F.col("f")) & (F.col("split") == F.col("s"))).drop("f", "s")
    # every stretch but a file's first has a magic before it, which its own sum leaves out
    at = F.col("split_offset") + F.col("near") - len(MAGIC)
    return placed.withColumn("offset", at).filter("offset >= 0")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: file, offset, page_id, record_type, refers_to, digest (as stated),
    stated_bytes, bytes and sha1 of the payload that is there.

    Only records on the chain from the start of their file are returned; a file that
    breaks off or does not begin with a record gives those before the break. Page ids
    that are no numbers are null. No file, or empty files, give an empty result.
    """
    placed = written(_offsets(written(_measured(_lines(spark, path)), "warc-stretches")), "warc-offsets")
    candidates = placed.select("file", "offset", (F.col("offset") + F.col("reach")).alias("successor"))
    records = written(_reachable(candidates), "warc-records")
    heads = placed.join(records, ["file", "offset"])
    simple = heads.filter("closed").select("file", "offset", "header", "facts.*")
    parted = heads.filter("not closed").select("file", "offset", "successor")
    if not parted.isEmpty():
        simple = simple.unionByName(_joined(_lines(spark, path), written(parted, "warc-parted")))
    ask = lambda name: F.regexp_extract("header", rf"(?mi)^{name}:[ \t]*([^\r\n]*)", 1)
    page = lambda name: F.regexp_extract(ask(name), r"^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    return simple.select(
        "file", "offset", page("WARC-Record-ID").alias("page_id"), ask("WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
        F.regexp_extract(ask("WARC-Payload-Digest"), r"^sha1:([0-9a-f]{40})$", 1).alias("digest"),
        F.col("stated").alias("stated_bytes"), "bytes", "sha1",
    )


def _joined(lines: DataFrame, parted: DataFrame) -> DataFrame:
    """Records whose content has a magic in it, put together from their stretches.

    Only the files that have such records are read again. A record takes the
    stretches up to its successor, found by a running maximum.
    """
    files = parted.select("file").distinct()
    placed = _offsets(lines.join(files, "file", "left_semi"))
    starts = parted.select("file", "offset", F.col("offset").alias("start"), F.col("successor").alias("stop"))
    by_file = Window.partitionBy("file").orderBy("offset")
    texts = placed.join(starts, ["file", "offset"], "left")
    texts = texts.withColumn("start", F.last("start", ignorenulls=True).over(by_file))
    texts = texts.withColumn("stop", F.max("stop").over(by_file)).filter("offset < stop")
    texts = texts.select("file", "offset", "start", "stop", F.col("value").alias("text"))
    parts = texts.groupBy("file", "start").agg(
        F.sort_array(F.collect_list(F.struct("offset", "text"))).alias("parts"), F.max("stop").alias("stop")
    )
    whole = F.array_join(F.transform("parts", lambda p: p["text"]), MAGIC)
    parts = parts.select("file", F.col("start").alias("offset"), whole.alias("text"))
    header = F.substring("text", F.lit(1), F.instr("text", END) - 1)
    parts = parts.withColumn("header", header)
    length = F.regexp_extract("header", r"(?mi)^Content-Length:[ \t]*([^\r\n]*)", 1).try_cast("int")
    parts = parts.withColumn("length", length)
    content = F.expr(f"substring(encode(text, 'UTF-8'), octet_length(header) + {len(END) + 1}, length)")
    parts = parts.withColumn("facts", _content_facts(content))
    return parts.select("file", "offset", "header", "facts.*")


def archived_pages(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Writes ``pages`` to archives and reads them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to.

    Bytes and digest are those of the stored payload; a revisit has those that its own
    headers state, the digest of which is that of the record it refers to. Null html
    is an empty payload, a null url an empty one. An empty table gives an empty
    result; other columns aren't looked at.
    """
    spark = pages.sparkSession
    path = path or f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, **options)
    records = read_archives(spark, path)
    stored = F.col("record_type") == "response"
    return records.select(
        "page_id",
        F.when(stored, F.col("bytes")).otherwise(F.col("stated_bytes")).alias("payload_bytes"),
        F.when(stored, F.col("sha1")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type", "refers_to",
    )


def query(spark, sf_dir: str) -> DataFrame:
    return archived_pages(table(spark, sf_dir, "pages"))
