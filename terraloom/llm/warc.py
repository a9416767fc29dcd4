"""Content-addressed WARC archive.

Payload bytes are stored once each, by SHA-256; the exact header block of every record is
stored on its own, with the digest of its payload. Records are put together again by joining
the two on the digest, and every payload is digested anew when it is read: bytes that no
longer match their address raise an error.

Of the records with equal payloads of at least ``least`` bytes, that with the smallest id is
a response and the others revisit it; smaller payloads are always responses. Equal rows (the
same id and payload) count as the same response. A null id is never the one referred to
unless no other record has the payload, and then its records are responses. Null html is an
empty payload; a null url is an empty target.

``export_files`` writes real WARC files (each record followed by CRLF CRLF) through Spark's
writer, in the cluster's file system; ``import_files`` reads such files.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .runtime import Scratch

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:terraloom:page:"
LEAST = 100


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _record_id(page: Column) -> Column:
    return F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def record_facts(pages: DataFrame, least: int = LEAST, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, bytes) of each page; the payload in UTF-8."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    return rows.withColumns({"digest": F.sha2("payload", 256), "bytes": F.length("payload").cast("long")})


def headers(facts: DataFrame, firsts: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, digest, header): the exact header block of each record, CRLF CRLF at its end."""
    f = facts.join(firsts, "digest")
    revisit = (F.col("bytes") >= least) & ~F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("first_id").isNotNull()
    # A url can't end its header line: CR, LF and % are percent-encoded, reversibly.
    url = F.replace(F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("%"), F.lit("%25")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        F.when(revisit, F.concat(_line("WARC-Profile", F.lit(PROFILE)), _line("WARC-Refers-To", _record_id(F.col("first_id"))))).otherwise(""),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit(CRLF),
    )
    return f.select("page_id", "digest", header.cast("binary").alias("header"))


def write_archive(pages: DataFrame, tmp: Scratch, least: int = LEAST, **cols) -> tuple[DataFrame, DataFrame]:
    """Write the archive below tmp; (headers, payloads) as read from there."""
    rows = record_facts(pages, least, **cols)
    facts = tmp.write(rows.drop("payload"), "facts")
    firsts = facts.groupBy("digest").agg(F.min("page_id").alias("first_id"))
    head = tmp.write(headers(facts, firsts, least), "headers")
    # Of a digest's pages only its first meets here; as join and repeats go by the same keys, payloads are shuffled once, and copies to many tasks.
    keys = lambda c: (F.coalesce(c, F.lit(0)).alias("k"), F.col(c).isNull().alias("none"))
    stored = rows.select("digest", "payload", *keys("page_id")).join(firsts.select("digest", *keys("first_id")), ["digest", "k", "none"])
    payloads = tmp.write(stored.dropDuplicates(["digest", "k", "none"]).select("digest", "payload"), "payloads")
    tmp.drop("facts")
    return head, payloads


def reconstruct(head: DataFrame, payloads: DataFrame) -> DataFrame:
    """(header, payload, record): each record's bytes as in a WARC file, and its full payload, also that of revisits."""
    joined = head.join(payloads, "digest", "left")
    ok = F.sha2("payload", 256) == F.col("digest")
    payload = F.when(F.coalesce(ok, F.lit(False)), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload does not match its address "), F.col("digest"))).cast("binary"))
    is_revisit = F.contains("header", F.lit(f"{CRLF}WARC-Type: revisit{CRLF}".encode()))
    record = F.concat("header", F.when(is_revisit, F.lit(b"")).otherwise(F.col("payload")), F.lit((CRLF * 2).encode()))
    return joined.select("header", payload.alias("payload")).withColumn("record", record)


def _field(name: str, header: Column) -> Column:
    return F.regexp_extract(header, rf"\r\n{name}: ([^\r\n]*)\r\n", 1)


def read_records(records: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload), all parsed from the records' bytes.

    The payload of a response is cut out of the record by its Content-Length; that of a
    revisit is what its digest leads to.
    """
    head = F.substring_index(F.col("record").cast("string"), CRLF * 2, 1)
    r = records.select("payload", "record", F.concat(head, F.lit(CRLF * 2)).alias("h"))
    kind, length = _field("WARC-Type", F.col("h")), _field("Content-Length", F.col("h")).cast("int")
    own = F.substring(F.col("record"), F.octet_length("h") + 1, length)
    r = r.select("h", kind.alias("record_type"), F.when(kind == "revisit", F.col("payload")).otherwise(own).alias("payload"))
    digest = F.sha2("payload", 256)
    said = F.replace(_field("WARC-Payload-Digest", F.col("h")), F.lit("sha256:"), F.lit(""))
    number = lambda name: F.regexp_extract(_field(name, F.col("h")), r"(-?\d+)>$", 1)
    url = F.replace(F.replace(F.replace(_field("WARC-Target-URI", F.col("h")), F.lit("%0D"), F.lit("\r")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))
    as_long = lambda c: F.when(c != "", c).cast("long")
    return r.select(
        as_long(number("WARC-Record-ID")).alias("page_id"), url.alias("url"), F.length("payload").cast("long").alias("payload_bytes"),
        F.when(digest == said, digest).otherwise(F.raise_error(F.concat(F.lit("digest mismatch in a record of "), said)).cast("string")).alias("payload_digest"),
        "record_type", F.when(F.col("record_type") == "revisit", as_long(number("WARC-Refers-To"))).alias("refers_to"), "payload",
    )


def export_files(records: DataFrame, path: str, per_file: int = 20_000) -> None:
    """WARC files (gzip) of at most per_file records each, by Spark's writer: works on any Hadoop file system."""
    records.select(F.concat("header", F.when(F.contains("header", F.lit(f"{CRLF}WARC-Type: revisit{CRLF}".encode())), F.lit(b"")).otherwise(F.col("payload"))).cast("string").alias("value")).write.option("lineSep", CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def import_files(spark: SparkSession, path: str) -> DataFrame:
    """(header, block) of each record of the WARC files below path; files are read whole, so keep them of bounded size."""

    def run(batches):
        import zlib

        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                if data[:2] == b"\x1f\x8b":
                    out, rest = [], data
                    while rest:  # members may be concatenated
                        d = zlib.decompressobj(31)
                        out.append(d.decompress(rest))
                        rest = d.unused_data
                    data = b"".join(out)
                at, heads, blocks = 0, [], []
                while at < len(data):
                    end = data.index(b"\r\n\r\n", at) + 4
                    length = next(int(x[15:]) for x in data[at:end].split(b"\r\n") if x.lower().startswith(b"content-length:"))
                    if data[end + length : end + length + 4] != b"\r\n\r\n":
                        raise ValueError("a record does not end where its Content-Length says")
                    heads.append(data[at:end])
                    blocks.append(data[end : end + length])
                    at = end + length + 4
                yield pa.RecordBatch.from_arrays([pa.array(heads, pa.binary()), pa.array(blocks, pa.binary())], names=["header", "block"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "header binary, block binary")
