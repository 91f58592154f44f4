"""A content-addressed WARC archive.

Payload bytes are stored once each, under their SHA-256; record headers are
stored exactly, one per page, beside them.  Of records with equal payloads the
one of the largest page id is the ``response`` and the others ``revisit`` it.
Records come back by joining headers to payloads: a record's bytes are its
header block, its payload (``response`` only) and the closing blank lines.
Both tables lie in the shared folder and are committed by Spark's writer.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clinlake.llm import stages
from clinlake.session import derived_path

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"


def base32(hex_digest: Column) -> Column:
    """Upper-case base32 of a hexadecimal SHA-1 (40 digits give 32 characters, without padding)."""
    out = []
    for at in range(1, 41, 5):
        group = F.conv(F.substring(hex_digest, at, 5), 16, 10).cast("int")
        out += [F.substring(F.lit(ALPHABET), F.shiftright(group, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def record_uuid(*parts: Column) -> Column:
    """A record id that follows from what the record is, so that a retried task writes the same one."""
    h = F.md5(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts]))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def header_block(date: str) -> Column:
    """The header lines of a record, with the blank line that ends them."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    revisit = F.col("kind") == "revisit"
    target = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.col("kind")), line("WARC-Record-ID", F.col("record_id")),
        line("WARC-Date", F.lit(date)),
        F.when(F.col("url").isNotNull(), line("WARC-Target-URI", target)).otherwise(""),
        F.when(F.col("page_id").isNotNull(), line("X-Page-ID", F.col("page_id").cast("string"))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(PROFILE)), line("WARC-Refers-To", F.col("response_id")))).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))), F.lit("\r\n"))


@dataclass
class Archive:
    """An archive in a folder."""

    folder: str
    spark: SparkSession

    def headers(self) -> DataFrame:
        return self.spark.read.schema("payload_key binary, kind string, header binary").parquet(f"{self.folder}/headers")

    def payloads(self) -> DataFrame:
        return self.spark.read.schema("payload_key binary, payload binary").parquet(f"{self.folder}/payloads")

    def records(self) -> DataFrame:
        """``(record)``: the bytes of every WARC record.  A response without a stored payload would be missing its bytes and fails."""
        responses = (self.headers().where("kind = 'response'")
                     .join(self.payloads().withColumnRenamed("payload_key", "key"), F.col("payload_key") == F.col("key"), "left")
                     .select(F.concat("header", F.when(F.col("payload").isNotNull(), F.col("payload")).otherwise(
                         F.raise_error(F.lit("a stored payload is missing")).cast("binary")), F.encode(F.lit(END), "utf-8")).alias("record")))
        revisits = self.headers().where("kind = 'revisit'").select(F.concat("header", F.encode(F.lit(END), "utf-8")).alias("record"))
        return responses.unionByName(revisits)

    def pages(self) -> DataFrame:
        """One row per record, read from the record bytes: ``page_id``, ``url``, ``record_type``,
        ``payload_bytes``, ``payload_digest``, ``refers_to``.

        The payload of each response is hashed anew and must match its header;
        a revisit has the figures of the response it refers to.
        """
        text = F.split_part(F.col("record").cast("string"), F.lit(END), F.lit(1))
        parsed = self.records().select(
            text.alias("head"), F.when(F.octet_length("record") > 0, F.col("record")).alias("record"))
        field = lambda name: F.nullif(F.regexp_extract("head", rf"(?m)^{name}: ([^\r\n]*)", 1), F.lit(""))
        body = F.expr("substring(record, octet_length(head) + 5, octet_length(record) - octet_length(head) - 8)")
        parsed = parsed.select(field("WARC-Record-ID").alias("record_id"), field("WARC-Type").alias("record_type"),
                               field("X-Page-ID").cast("long").alias("page_id"), field("WARC-Target-URI").alias("url"),
                               field("WARC-Refers-To").alias("target"),
                               F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("stated"),
                               field("Content-Length").cast("long").alias("stated_bytes"),
                               F.when(field("WARC-Type") == "response", body).alias("body"))
        parsed = stages.store(parsed.select(
            "record_id", "record_type", "page_id", "url", "target", "stated", "stated_bytes",
            F.when(F.col("body").isNotNull(), base32(F.sha1("body"))).alias("digest"), F.octet_length("body").cast("long").alias("bytes")), "warc-read")
        checked = parsed.where("record_type = 'response'").select(
            "record_id", "page_id", "url", "record_type",
            F.when((F.col("digest") == F.col("stated")) & (F.col("bytes") == F.col("stated_bytes")), F.col("bytes")).otherwise(
                F.raise_error(F.lit("a payload does not match its header")).cast("long")).alias("payload_bytes"),
            F.col("digest").alias("payload_digest"), F.lit(None).cast("long").alias("refers_to"))
        first = checked.select(F.col("record_id").alias("target"), "payload_bytes", F.col("payload_digest").alias("held"),
                               F.col("page_id").alias("refers_to"))
        again = parsed.where("record_type = 'revisit'").join(first, "target").select(
            "record_id", "page_id", "url", "record_type", "payload_bytes",
            F.when(F.col("held") == F.col("stated"), F.col("held")).otherwise(
                F.raise_error(F.lit("a revisit refers to another payload"))).alias("payload_digest"), "refers_to")
        return checked.unionByName(again).drop("record_id")


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> Archive:
    """Write one record per row of ``pages``.

    A null payload is empty.  Payloads of fewer than ``min_bytes`` bytes are
    all responses (still stored once).  Null ids count as the smallest and
    leave their header line out, as null urls do.  Rows of equal payload and
    id are ordered by url; of rows equal in all three, one is the first.
    An empty table gives an archive without records.  Other columns are not
    read.  SHA-256 tells payloads apart, and a stored payload is hashed again
    before it is written.
    """
    spark = pages.sparkSession
    folder = derived_path(spark, "warc")
    body = F.encode(F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")), "utf-8")
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), body.alias("payload"))
    rows = rows.select("*", F.unhex(F.sha2("payload", 256)).alias("payload_key"))

    facts = rows.groupBy("payload_key", "page_id", "url").agg(
        F.first(F.sha1("payload")).alias("sha1_hex"), F.first(F.octet_length("payload")).cast("long").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    facts = stages.store(facts, "warc-facts")
    # The last row of the largest id; max() skips no null inside a struct and puts it first.
    leader = facts.groupBy("payload_key").agg(F.max(F.struct("page_id", "url", "rows")).alias("lead"))
    records = facts.join(leader, "payload_key").select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))).alias("nth"))
    first = (F.col("page_id").eqNullSafe(F.col("lead.page_id")) & F.col("url").eqNullSafe(F.col("lead.url"))
             & (F.col("nth") == F.col("lead.rows")))
    small = F.col("bytes") < min_bytes
    key = F.hex("payload_key")
    records = records.select(
        "payload_key", "page_id", "url", "bytes", base32(F.col("sha1_hex")).alias("sha1"),
        F.when(small | first, "response").otherwise("revisit").alias("kind"),
        record_uuid(F.col("page_id"), F.col("url"), key, F.col("nth")).alias("record_id"),
        record_uuid(F.col("lead.page_id"), F.col("lead.url"), key, F.col("lead.rows")).alias("response_id"))
    stages.write(records.select("payload_key", "kind", F.encode(header_block(date), "utf-8").alias("header")), f"{folder}/headers")

    stored = rows.select("payload_key", "payload").dropDuplicates(["payload_key"])
    verified = F.when(F.unhex(F.sha2("payload", 256)) == F.col("payload_key"), F.col("payload")).otherwise(
        F.raise_error(F.lit("a payload does not match its key")).cast("binary"))
    stages.write(stored.select("payload_key", verified.alias("payload")), f"{folder}/payloads")
    return Archive(folder, spark)
