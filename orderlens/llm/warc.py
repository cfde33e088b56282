"""WARC archive addressed by content: a payload's bytes are kept once under their SHA-256, the exact
record headers apart from them, and joins give the original records back.

Defined results: a null payload is empty; rows repeated whole keep one record each; a null id is
never the response of a payload that some row with an id has; tied ids with different payloads are records of
their own; payloads of any length are kept whole; an empty table gives an empty archive; only the id, url and payload
columns are read, so other columns may have any names.  A url comes back as it was, null, empty or with line breaks in it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_path

CRLF = "\r\n"
#: Payloads below this many bytes are never revisits: the record header is larger than the payload.
MIN_REVISIT_BYTES = 100


@dataclass(frozen=True)
class Archive:
    """Paths of the two tables of an archive: ``payloads`` (digest, payload), ``records`` (headers)."""
    payloads: str
    records: str


def _lines(*pairs) -> F.Column:
    """Header lines; a pair whose value is null is left out."""
    parts = [F.when(v.isNotNull(), F.concat(F.lit(k + ": "), v, F.lit(CRLF))).otherwise(F.lit("")) for k, v in pairs]
    return F.concat(F.lit("WARC/1.1" + CRLF), *parts, F.lit(CRLF))


#: Tells that a url, which had a line break, is percent-encoded in its header; other urls stand there as they are.
ESCAPED = "X-Target-URI-Encoding"
_ESCAPES = [("%", "%25"), ("\r", "%0D"), ("\n", "%0A")]


def _broken(text: F.Column) -> F.Column:
    return text.contains("\r") | text.contains("\n")


def _header(text: F.Column) -> F.Column:
    """A value on one header line: with a line break in it, which would end the field, it is percent-encoded."""
    out = text
    for a, b in _ESCAPES:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.when(_broken(text), out).otherwise(text)


def _unheader(text: F.Column) -> F.Column:
    for a, b in reversed(_ESCAPES):
        text = F.replace(text, F.lit(b), F.lit(a))
    return text


def write_archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_revisit_bytes: int = MIN_REVISIT_BYTES, path: str | None = None) -> Archive:
    """Write one record per row of ``pages``.  Digests and ids choose each payload's response; payload bytes are
    shuffled once, to their digest, and of equal ones the first that a task meets goes on."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    keyed = rows.select("id", "url", F.length("payload").cast("long").alias("bytes"),
                        F.sha2("payload", 256).alias("digest"))
    first = keyed.groupBy("digest").agg(F.min("id").alias("first_id"))
    # the response's payload is stored; rows that repeat an id are equal by digest, so any one will do
    stored = (rows.withColumn("digest", F.sha2("payload", 256))
              .groupBy("digest").agg(F.any_value("payload").alias("payload")))
    stored.write.parquet(f"{path}/payloads")
    revisit = (F.col("bytes") >= min_revisit_bytes) & ~F.col("id").eqNullSafe(F.col("first_id"))
    kind = F.when(revisit, "revisit").otherwise("response")
    uri = F.concat(F.lit("urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("-")))
    headers = _lines(
        ("WARC-Type", kind),
        ("WARC-Record-ID", F.concat(F.lit("<"), uri, F.lit(">"))),
        ("WARC-Target-URI", _header(F.col("url"))),
        (ESCAPED, F.when(_broken(F.col("url")), F.lit("percent"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("first_id").cast("string"), F.lit(">")))),
        ("WARC-Profile", F.when(revisit, F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        ("Content-Type", F.lit("text/html; charset=utf-8")),
        ("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
    )
    (keyed.join(first, "digest")
     .select("id", "digest", headers.cast("binary").alias("headers"))
     .write.parquet(f"{path}/records"))
    return Archive(f"{path}/payloads", f"{path}/records")


def read_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """The stored payloads, each checked against its digest."""
    df = spark.read.schema("digest string, payload binary").parquet(archive.payloads)
    good = F.sha2("payload", 256) == F.col("digest")
    return df.select("digest", F.when(good, F.col("payload"))
                     .otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest "), F.col("digest"))))
                     .alias("payload"))


def field(name: str) -> F.Column:
    """A header field's value, read from the record's header bytes; null if the record has none."""
    text = F.col("headers").cast("string")
    return F.when(text.contains(f"\r\n{name}: "), F.regexp_extract(text, rf"\r\n{name}: ([^\r\n]*)\r\n", 1))


def read_archive(spark: SparkSession, archive: Archive, id_type: str = "long", payload: bool = True) -> DataFrame:
    """Records read back: fields parsed from the header bytes, payloads joined by digest.

    ``id, url, record_type, payload_digest, refers_to, payload_bytes``, and with ``payload`` also
    the full ``payload`` and the ``record`` bytes as they stand in a WARC file.  A revisit's full
    payload comes by the same join as its response's.
    """
    records = spark.read.schema(f"id {id_type}, digest string, headers binary").parquet(archive.records)
    stored = read_payloads(spark, archive)
    if not payload:
        stored = stored.select("digest", F.length("payload").cast("long").alias("payload_bytes"))
    out = records.join(stored, "digest")
    refers = F.regexp_extract(F.coalesce(field("WARC-Refers-To"), F.lit("")), r"^<urn:page:(.*)>$", 1)
    cols = [
        F.when(F.regexp_extract(field("WARC-Record-ID"), r"^<urn:page:(.*)>$", 1) != "-",
               F.regexp_extract(field("WARC-Record-ID"), r"^<urn:page:(.*)>$", 1)).cast(id_type).alias("id"),
        F.when(field(ESCAPED).isNotNull(), _unheader(field("WARC-Target-URI"))).otherwise(field("WARC-Target-URI")).alias("url"),
        field("WARC-Type").alias("record_type"),
        F.regexp_extract(field("WARC-Payload-Digest"), r"^sha256:(.*)$", 1).alias("payload_digest"),
        F.when(refers != "", refers).cast(id_type).alias("refers_to"),
        (F.length("payload").cast("long") if payload else F.col("payload_bytes")).alias("payload_bytes"),
    ]
    if payload:
        body = F.when(field("WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
        cols += [F.col("payload"), F.concat(F.col("headers"), body, F.lit((CRLF + CRLF).encode())).alias("record")]
    return out.select(*cols)
