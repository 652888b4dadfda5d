"""WARC archives: written by Spark's own writer, read back by verifying the chain of records.

A record ends with two line ends, which is what the text writer puts behind every row; so archives
are ordinary Spark output, committed or retried like any other. Payloads that an earlier page has
already stored become revisit records that refer to it.

To read, a file is cut at every occurrence of the magic ``WARC/1.0``, also inside payloads, by a
splittable scan. Each candidate says where its successor must begin (its header and Content-Length).
Runs of candidates that follow each other without a gap are one node; pointers between runs are
doubled until every run that is reachable from the file's start is marked. All else is payload, and
goes back to the record in which it lies.

Defined results: a null html is an empty payload; a null ``url`` is written as an empty target; rows
with a null ``page_id`` are written, never referred to while another page has that payload; repeated
ids are records of their own; an empty table writes no record; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellspring.session import materialize, work_dir

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
#: Records in a file.
FILE_RECORDS = 20_000
DATE = "2000-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: 20 bits at a time, from 5 hexadecimal digits to 4 of base 32."""
    digits = F.sha1(payload)
    parts = [
        F.lpad(F.lower(F.conv(F.substring(digits, 5 * k + 1, 5), 16, 32)), 4, "0") for k in range(8)
    ]
    return F.translate(
        F.concat(*parts), "0123456789abcdefghijklmnopqrstuv", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    )


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Pages with what their headers say: ``record_type``, ``refers_to``, digest and length.

    Only digests are grouped; html stays in its place unless the list of revisits is long.
    """
    payload = F.coalesce("html", F.lit(""))
    pages = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        payload.alias("payload"),
    )
    keys = pages.select("page_id", F.sha2("payload", 256).alias("key"), F.octet_length("payload").alias("bytes"))
    keys = keys.where((F.col("bytes") >= least_bytes) & F.col("page_id").isNotNull())
    first = keys.groupBy("key", "bytes").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies")
    )
    first = first.where("copies > 1").drop("copies")
    revisits = keys.join(first, ["key", "bytes"]).where(F.col("page_id") != F.col("first_id"))
    revisits = materialize(revisits.groupBy("page_id", "key").agg(F.min("first_id").alias("first_id")))
    # the payload's key is needed only to tell apart rows that share an id
    marked = pages.join(revisits.withColumnRenamed("page_id", "revisit_id"),
                        (F.col("page_id") == F.col("revisit_id"))
                        & (F.sha2("payload", 256) == F.col("key")), "left")
    return marked.select(
        "page_id",
        "url",
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
        F.when(F.col("first_id").isNull(), "response").otherwise("revisit").alias("record_type"),
        F.col("first_id").alias("refers_to"),
    )


def _uri(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def write_archives(rows: DataFrame, path: str | None = None, file_records: int = FILE_RECORDS) -> str:
    """One WARC record a row of ``records``; returns the folder."""
    path = path or work_dir(rows.sparkSession)
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    response = F.col("record_type") == "response"
    clean = F.regexp_replace("url", r"[\x00-\x20\x7f]", "")
    revisit = F.concat(
        line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")),
        line("WARC-Refers-To", _uri(F.col("refers_to"))),
    )
    header = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", _uri(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", clean),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(response, F.lit("")).otherwise(revisit),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(response, F.col("payload_bytes")).otherwise(F.lit(0)).cast("string")),
        F.lit("\r\n"),
    )
    body = F.when(response, F.col("payload")).otherwise(F.lit(""))
    out = rows.select(F.concat(header, body).alias("value"))
    out.write.option("lineSep", END).option("maxRecordsPerFile", file_records).text(path)
    return path


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, line, bytes, reach, value``: what follows each magic, up to the next one.

    The scan may split a file anywhere; ``block`` is the split and ``line`` the order in it.
    ``reach`` has the bytes from behind the magic to the end of the payload, if there is a header.
    """
    lines = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value"),
    )
    header_end = F.instr("value", END)
    head = F.substring_index("value", END, 1)
    length = F.regexp_extract(head, r"(?m)^Content-Length: *(\d{1,18})\r?$", 1)
    header_bytes = F.octet_length(head) + len(END)
    sized = lines.select(
        "file",
        "block",
        "line",
        F.octet_length("value").alias("bytes"),
        F.when((header_end > 0) & (length != ""), header_bytes + length.cast("long")).alias("reach"),
        "value",
    )
    return sized


def _places(sized: DataFrame) -> DataFrame:
    """``file, line, off, next`` of every candidate: the byte at which its magic stands, and at
    which its successor's must. The bytes of all pieces before it, summed up, give the place."""
    narrow = sized.select("file", "block", "line", "bytes", "reach")
    stored = materialize(narrow)
    # pieces stand in a split in the order of their line numbers
    magic = len(MAGIC)
    w = Window.partitionBy("file").orderBy("block", "line")
    ahead = F.coalesce(F.sum(F.col("bytes") + magic).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = stored.select("file", "line", "bytes", "reach", (ahead - magic).alias("off"))
    return placed.select(
        "file",
        "line",
        "off",
        (F.col("off") + magic + F.col("reach") + len(END)).alias("next"),
    )


def reachable(places: DataFrame) -> DataFrame:
    """``places`` with ``is_record``: reachable from the start of the file, by pointer jumping.

    Candidates that follow each other seamlessly form a run. A run has one way out, to a
    candidate in a later run; these pointers are doubled until all marks are set.
    """
    w = Window.partitionBy("file").orderBy("off")
    seam = F.coalesce(F.lag("next").over(w) != F.col("off"), F.lit(True))
    runs = places.withColumn("seam", seam.cast("long"))
    runs = materialize(runs.withColumn("run", F.sum("seam").over(w)).drop("seam"))
    exits = runs.groupBy("file", "run").agg(F.max_by("next", "off").alias("exit"))
    entry = runs.select("file", F.col("off").alias("exit"), F.col("run").alias("to_run"))
    pointers = materialize(
        exits.join(entry, ["file", "exit"]).select("file", "run", "to_run", F.col("exit").alias("entry"))
    )
    start = runs.where(F.col("off") == 0).select("file", "run")
    marked, jump = start, pointers.select("file", "run", "to_run")
    while not jump.isEmpty():
        step = marked.join(jump, ["file", "run"]).select("file", F.col("to_run").alias("run"))
        marked = materialize(marked.unionByName(step).distinct())
        second = jump.select("file", F.col("run").alias("to_run"), F.col("to_run").alias("far"))
        jump = materialize(
            jump.join(second, ["file", "to_run"]).select("file", "run", F.col("far").alias("to_run"))
        )
    # where the chain enters each marked run
    entered = pointers.join(marked, ["file", "run"]).select(
        "file", F.col("to_run").alias("run"), "entry"
    )
    entered = entered.unionByName(start.withColumn("entry", F.lit(0).cast("long")))
    joined = runs.join(entered, ["file", "run"], "left")
    return joined.select(
        "file", "line", "off", "next", F.coalesce(F.col("off") >= F.col("entry"), F.lit(False)).alias("is_record")
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """``record_type, page_id, refers_to, url, payload_digest, payload_length, payload`` of the
    records below ``path``. Pieces that a magic inside a payload cut off are put back."""
    sized = candidates(spark, path)
    known = reachable(_places(sized))
    w = Window.partitionBy("file").orderBy("off")
    owner = F.last(F.when(F.col("is_record"), F.col("line")), ignorenulls=True).over(w)
    known = known.withColumn("record", owner)
    pieces = F.count(F.lit(1)).over(Window.partitionBy("file", "record"))
    odd = materialize(
        known.withColumn("pieces", pieces)
        .where(~F.col("is_record") | (F.col("pieces") > 1))
        .where(F.col("record").isNotNull())
        .select("line", "record", "off")
    )
    junk = materialize(known.where(F.col("record").isNull()).select("line"))
    lines = sized.select("line", "value")
    whole = lines.join(odd.select("line"), "line", "left_anti").join(junk, "line", "left_anti")
    cut = lines.join(odd, "line").groupBy("record").agg(
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.struct("off", "value"))), lambda p: p["value"]), MAGIC
        ).alias("value")
    )
    texts = whole.select("value").unionByName(cut.select("value"))
    head = F.substring_index("value", END, 1)
    field = lambda name: F.regexp_extract("head", rf"(?m)^{name}: ([^\r\n]*)\r?$", 1)
    number = lambda name: F.expr(
        f"try_cast(regexp_extract(head, '(?m)^{name}: <urn:page:(-?[0-9]+)>', 1) AS BIGINT)"
    )
    return texts.select("value", head.alias("head")).select(
        field("WARC-Type").alias("record_type"),
        number("WARC-Record-ID").alias("page_id"),
        number("WARC-Refers-To").alias("refers_to"),
        field("WARC-Target-URI").alias("url"),
        F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        field("WARC-Payload-Length").cast("long").alias("payload_length"),
        F.expr(f"substring(value, char_length(head) + {len(END) + 1}, "
               f"char_length(value) - char_length(head) - {2 * len(END)})").alias("payload"),
    )
