"""A content-addressed WARC archive.

Two tables hold the archive: ``headers`` has one exact header block per record, ``payloads`` has each distinct payload
once, under its SHA-256 digest. Joining them on the digest reconstructs the records; every payload that is read is
verified against its digest. ``write_files`` lays the records out as plain WARC text files.

Equal payloads of at least ``least`` bytes become one response record and revisit records that refer to it.

``parse`` takes records apart again: every field of the header, and the block by its Content-Length.

Defined results: null bodies count as empty; line ends in a URL are percent-encoded; a null URL has no header line;
rows with one id share a record id; smaller payloads are all responses; rows with a null id are responses
only where no other row has their payload; repeated rows that share the smallest id of a payload are all responses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LEAST = 100
_CRLF = "\r\n"


def _uri(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def _header(kind: Column, digest: Column, length: Column, refers_to: Column, date: str) -> Column:
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF))
    return F.concat(
        F.lit(f"WARC/1.1{_CRLF}"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", _uri(F.col("__id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", F.replace(F.replace(F.col("__url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        F.when(kind == "revisit", F.concat(line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")), line("WARC-Refers-To", _uri(refers_to)))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(kind == "revisit", F.lit(0)).otherwise(length).cast("string")),
        F.lit(_CRLF),
    )


def write_archive(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", least: int = LEAST, date: str = "2000-01-01T00:00:00Z", path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Write the tables (key, header, digest) and (digest, payload); return them as read from the shared folder.

    What is grouped by digest are digests and ids, combined before the shuffle. Bodies meet only the table of payloads
    that occur several times, which the optimiser broadcasts if its files are small; else they are shuffled by digest
    and, for the copies, by id too, so that copies of one payload are spread out.
    """
    base = path or common.new_path(pages.sparkSession, "warc")
    rows = pages.select(F.col(key).alias("__id"), F.col(url).alias("__url"), F.encode(F.coalesce(F.col(body), F.lit("")), "UTF-8").alias("__payload"))
    rows = rows.withColumn("__digest", F.sha2("__payload", 256)).withColumn("__name", F.coalesce(F.col("__id").cast("string"), F.lit("-")))
    thin = rows.select("__id", "__url", "__digest", F.octet_length("__payload").cast("long").alias("__length"))

    # most payloads occur once and stay where they are; of the others, one row each is picked by a small table
    shared = rows.select("__digest", "__name").groupBy("__digest").agg(F.min("__name").alias("__name"), F.count(F.lit(1)).alias("__n")).where("__n > 1")
    shared = common.stage(shared.select("__digest", "__name"), "shared", f"{base}/shared")
    single = rows.join(shared.select("__digest"), "__digest", "left_anti").select("__digest", "__payload")
    several = rows.join(shared, ["__digest", "__name"], "left_semi").dropDuplicates(["__digest", "__name"]).select("__digest", "__payload")
    payloads = common.stage(single.unionByName(several).toDF("digest", "payload"), "payloads", f"{base}/payloads")

    first = thin.where(F.col("__length") >= least).groupBy("__digest").agg(F.min("__id").alias("__first"))
    joined = thin.join(first, "__digest", "left")
    again = F.col("__first").isNotNull() & ~F.col("__id").eqNullSafe(F.col("__first"))
    kind = F.when(again, F.lit("revisit")).otherwise(F.lit("response"))
    headers = joined.select(F.col("__id").alias(key), _header(kind, F.col("__digest"), F.col("__length"), F.col("__first"), date).alias("header"), F.col("__digest").alias("digest"))
    return common.stage(headers, "headers", f"{base}/headers"), payloads


def _field(name: str, value: str = r"([^\r]*)", header: str = "header") -> Column:
    """The value of a header line; null if there is none."""
    found = F.regexp_extract(header, rf"\n{name}: {value}\r\n", 1)
    return F.when(F.col(header).contains(f"\n{name}: "), found)


def read_archive(headers: DataFrame, payloads: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, record, payload): ``record`` is the exact record, header and block; the payload of a revisit is that of the
    record it refers to. A payload that does not match its digest is an error."""
    found = headers.select(key, "header", _field("WARC-Payload-Digest", r"sha256:(\w+)").alias("digest")).join(payloads, "digest", "left")
    sound = F.sha2("payload", 256) == F.col("digest")
    checked = found.withColumn("payload", F.when(sound, F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload missing or damaged: "), F.col("digest"))).cast("binary")))
    block = F.when(_field("WARC-Type") == "response", F.col("payload")).otherwise(F.encode(F.lit(""), "UTF-8"))
    return checked.select(key, F.concat(F.encode("header", "UTF-8"), block, F.encode(F.lit(_CRLF * 2), "UTF-8")).alias("record"), "payload")


def parse(records: DataFrame, record: str = "record") -> DataFrame:
    """Adds record_id, record_type, refers_to (the id), digest, uri, length and block to a table of records, all from
    the records' bytes. A record whose block is not as long as its header says, or a response whose block does not
    match its digest, is an error."""
    end = F.instr(F.col(record), _CRLF * 2)  # of bytes: the record is binary
    header = F.decode(F.substring(F.col(record), F.lit(1), end + 1), "UTF-8")
    cut = records.withColumn("__header", header).withColumn("__body", F.substring(F.col(record), end + 4, F.octet_length(record)))
    field = lambda name, value=r"([^\r]*)": _field(name, value, "__header")
    kept = cut.withColumn("length", field("Content-Length").cast("long"))
    kept = kept.withColumns({"record_id": field("WARC-Record-ID", "<urn:page:([^\r]*)>"), "record_type": field("WARC-Type"), "refers_to": field("WARC-Refers-To", "<urn:page:([^\r]*)>"), "digest": field("WARC-Payload-Digest", r"sha256:(\w+)"), "uri": field("WARC-Target-URI")})
    kept = kept.withColumn("block", F.substring(F.col("__body"), F.lit(1), F.col("length").cast("int")))
    whole = F.octet_length("__body") == F.col("length") + 4
    sound = whole & ((F.col("record_type") != "response") | (F.sha2("block", 256) == F.col("digest")))
    return kept.withColumn("block", F.when(sound, F.col("block")).otherwise(F.raise_error(F.concat(F.lit("damaged record: "), F.col("record_id"))).cast("binary"))).drop("__header", "__body")


def write_files(records: DataFrame, path: str, compression: str = "gzip", rows_per_file: int = 100_000) -> None:
    """WARC files of the reconstructed records, for payloads in UTF-8. Each record ends in a line feed, which the text
    writer adds back."""
    text = records.select(F.decode("record", "UTF-8").alias("record"))
    text.select(F.expr("left(record, length(record) - 1)").alias("value")).write.option("compression", compression).option("lineSep", "\n").option("maxRecordsPerFile", rows_per_file).text(path)


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the reconstructed records say when they are taken apart; a revisit's payload is that of its response."""
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    records = parse(read_archive(*write_archive(pages)))
    kind = pages.schema["page_id"].dataType
    payload = F.when(F.col("record_type") == "response", F.col("block")).otherwise(F.col("payload"))
    return records.select("page_id", F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest"), "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


OP5_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, CAST(p.payload_bytes AS BIGINT) AS payload_bytes, p.payload_digest,
       CASE WHEN f.first IS NULL OR f.first IS NOT DISTINCT FROM p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.first IS NULL OR f.first IS NOT DISTINCT FROM p.page_id THEN NULL ELSE f.first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""
