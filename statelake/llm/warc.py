"""A content-addressed web archive.

Payload bytes are stored once per SHA-256, in a table of their own. The exact header block of every
WARC record, and that of the HTTP message in it, is stored separately, with the digest of its payload.
Reading joins the two, checks every payload against the digests it was stored and announced under,
and puts the original records together again.

Of records with equal payloads of at least 1000 bytes the one with the largest page id is a response
and the others are revisits of it; smaller payloads are always responses. Revisits carry no payload
of their own in WARC form and get it through the digest.

Defined cases: a NULL page is an empty payload; rows repeated with one id count as records of their
own, of which one is the response; a NULL id sorts below all others and differs from an empty one; a
NULL address leaves its header out, line ends (CR, LF) in an address are percent-encoded, all other
characters, also such that other software takes for line ends, stand as they are; very long pages move
once, as bytes; an empty table gives an empty archive; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statelake.llm.common import stored
from statelake.session import scratch_path

REVISIT_FROM = 1000
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"


def _line(name: str, value: Column) -> Column:
    """One header line; nothing where the value is NULL."""
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit(END)), F.lit(""))


def _record_id(page: Column, copy: Column) -> Column:
    """``none`` for a NULL id; any other is encoded, so that it holds no delimiter, after a ``=``."""
    name = F.coalesce(F.concat(F.lit("="), F.url_encode(page.cast("string"))), F.lit("none"))
    return F.concat(F.lit("<urn:page:"), name, F.lit(":"), copy.cast("string"), F.lit(">"))


def _page_of(record_id: Column) -> Column:
    return F.url_decode(F.nullif(F.regexp_extract(record_id, "^<urn:page:=?([^:]*):[0-9]+>$", 1), F.when(~F.contains(record_id, F.lit(":=")), F.lit("none"))))


def _header(block: Column, name: str) -> Column:
    """The value of a header line, NULL where there is none. Lines end at CR LF and nowhere else."""
    line = F.concat(F.lit(END), block)
    found = F.regexp_extract(line, rf"(?s)\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(F.contains(line, F.lit(f"{END}{name}: ")), found)


def payload_of(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def with_headers(records: DataFrame) -> DataFrame:
    """Adds ``header`` and ``http``, the two header blocks of every record, as bytes."""
    revisit = F.col("record_type") == "revisit"
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + END + "Content-Type: text/html; charset=utf-8" + END),
        _line("Content-Length", F.col("n_bytes").cast("string")),
        F.lit(END),
    )
    block = F.octet_length("http") + F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes"))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit(VERSION + END),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("copy"))),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("winner.page_id"), F.lit(0)))),
        F.lit("Content-Type: application/http; msgtype=response" + END),
        _line("Content-Length", block.cast("string")),
        F.lit(END),
    )
    return records.withColumn("http", http).withColumn("header", F.encode(header, "UTF-8")).withColumn("http", F.encode("http", "UTF-8"))


def write_archive(pages: DataFrame, folder: str) -> None:
    """Writes ``payloads`` and ``records`` below ``folder``.

    Who is the response is decided on digests alone. Payloads are shuffled once, after every task has
    dropped its own copies, so a page that a third of all rows repeat moves once per task.
    """
    rows = pages.select("page_id", "url", payload_of(F.col("html")).alias("payload")).withColumn("sha256", F.sha2("payload", 256))
    payloads = rows.groupBy("sha256").agg(F.any_value("payload").alias("payload"))
    payloads.write.option("compression", "zstd").parquet(f"{folder}/payloads")
    digests = stored(
        rows.select("page_id", "url", "sha256", F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("n_bytes")),
        "digests",
    )
    same = digests.groupBy("page_id", "url", "sha256", "sha1", "n_bytes").agg(F.count("*").alias("rows"))
    winners = same.groupBy("sha256").agg(F.max(F.struct("page_id", "url")).alias("winner"))
    numbered = same.join(winners, "sha256").withColumn("copy", F.explode(F.sequence(F.lit(0), (F.col("rows") - 1).cast("int"))))
    first = (F.col("copy") == 0) & F.col("winner").eqNullSafe(F.struct("page_id", "url"))
    kind = F.when((F.col("n_bytes") < REVISIT_FROM) | first, F.lit("response")).otherwise(F.lit("revisit"))
    records = with_headers(numbered.withColumn("record_type", kind))
    records.select("sha256", "header", "http").write.option("compression", "zstd").parquet(f"{folder}/records")


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The records with their payloads joined back: ``header``, ``http``, ``payload``, what was
    measured on the payload as stored, and ``verified``.

    Digests are computed beside the payload, so a reader that asks for no bytes moves none.
    """
    payloads = spark.read.parquet(f"{folder}/payloads").select(
        "sha256", "payload",
        F.sha1("payload").alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        (F.sha2("payload", 256) == F.col("sha256")).alias("__intact"),
    )
    value = lambda name: _header(F.decode("header", "UTF-8"), name)
    records = spark.read.parquet(f"{folder}/records").select(
        "sha256", "header", "http",
        value("WARC-Type").alias("record_type"),
        value("WARC-Target-URI").alias("url"),
        _page_of(value("WARC-Record-ID")).alias("page_id"),
        _page_of(value("WARC-Refers-To")).alias("refers_to"),
        value("WARC-Payload-Digest").alias("__announced"),
    )
    joined = records.join(payloads, "sha256")
    verified = F.col("__intact") & (F.col("__announced") == F.concat(F.lit("sha1:"), F.col("payload_digest")))
    return joined.withColumn("verified", verified).drop("__intact", "__announced")


def warc_records(archive: DataFrame) -> DataFrame:
    """Adds ``record``, the exact bytes of every WARC record of ``read_archive``."""
    body = F.when(F.col("record_type") == "revisit", F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload"))
    return archive.withColumn("record", F.concat("header", "http", body, F.encode(F.lit(END + END), "UTF-8")))


def parsed(records: DataFrame) -> DataFrame:
    """What the bytes of each ``record`` say by themselves, and ``sound``: its lengths add up, and the
    payload of a response has the digest and length its headers announce."""
    end = END + END
    head = F.substring_index(F.decode("record", "UTF-8"), end, 1)
    first = F.octet_length(head) + 4
    told = F.try_to_number(_header(F.concat(head, F.lit(END)), "Content-Length"), F.lit("9999999999999999999")).cast("long")
    split = records.withColumn("__head", F.concat(head, F.lit(END))).withColumn("__block", F.substr("record", first + 1, told.cast("int")))
    http = F.substring_index(F.decode("__block", "UTF-8"), end, 1)
    split = split.withColumn("__told", told).withColumn("__http", F.concat(http, F.lit(END))).withColumn("__from", F.octet_length(http) + 5)
    kind = _header(F.col("__head"), "WARC-Type")
    size = F.try_to_number(_header(F.col("__http"), "Content-Length"), F.lit("9999999999999999999")).cast("long")
    announced = F.regexp_extract(_header(F.col("__head"), "WARC-Payload-Digest"), "^sha1:([0-9a-f]{40})$", 1)
    body = F.substr("__block", F.col("__from"), F.octet_length("__block"))
    whole = F.octet_length(F.encode("__head", "UTF-8")) + 2 + F.col("__told") + 4 == F.octet_length("record")
    filled = (F.octet_length(body) == size) & (F.sha1(body) == announced)
    right = whole & F.when(kind == "response", filled).otherwise(F.octet_length(body) == 0)
    return split.select(
        *[c for c in records.columns if c != "record"],
        _page_of(_header(F.col("__head"), "WARC-Record-ID")).alias("page_id"), size.alias("payload_bytes"), announced.alias("payload_digest"),
        kind.alias("record_type"), _page_of(_header(F.col("__head"), "WARC-Refers-To")).alias("refers_to"), F.coalesce(right, F.lit(False)).alias("sound"),
    )


def archived(pages: DataFrame) -> DataFrame:
    """One row per page, read back from an archive written for it in the shared folder.

    Every record is rebuilt to its exact bytes and parsed again; a revisit is also held against the
    stored payload it stands for. Payloads move to their responses only. Raises when a record does not
    parse, or a payload does not have the digest or length it was stored or announced under.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "archive")
    write_archive(pages, folder)
    kind = pages.schema["page_id"].dataType
    stored_ones = read_archive(spark, folder)
    rebuilt = warc_records(stored_ones.filter("record_type = 'response'")).select("record", "verified", F.col("payload_digest").alias("__sha1"), F.col("payload_bytes").alias("__size"))
    bare = F.concat("header", "http", F.encode(F.lit(END + END), "UTF-8"))
    revisits = stored_ones.filter("record_type <> 'response'").select(bare.alias("record"), "verified", F.col("payload_digest").alias("__sha1"), F.col("payload_bytes").alias("__size"))
    found = parsed(rebuilt.unionByName(revisits))
    sound = F.col("sound") & F.col("verified") & (F.col("__sha1") == F.col("payload_digest")) & (F.col("__size") == F.col("payload_bytes"))
    digest = F.when(sound, F.col("payload_digest")).otherwise(F.raise_error(F.lit("a record is not what was archived")))
    return found.select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        digest.cast("string").alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
