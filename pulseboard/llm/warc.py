"""WARC archives: writing, normalising a monolithic gzip stream to one member per record, reading by offset.

``write_archives`` writes records as text, one gzip stream per file, through Spark's own writer. ``normalise`` inflates each
such file once as a single stream, rewrites every record as a gzip member of its own, and leaves the members of a file on
end as one archive file with a sidecar table of offsets. ``read_records`` cuts members out by the index and
reads them; each can be read without the others.

All files go through Spark's readers and writers, so any file system that Spark knows will do; a file of a lost
task is written again under the same commit rules.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulseboard.session import new_path

#: A record ends with two line ends; it is also what the text writer puts behind each row.
END = "\r\n\r\n"
REVISIT_BYTES = 100
#: Rows of one archive file at most; with pages of some kilobytes a file inflates to some tens of megabytes.
FILE_RECORDS = 4_000
_DATE = "1970-01-01T00:00:00Z"  # the pages carry no time of capture
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def classified(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """``page_id, url, payload, payload_bytes, payload_digest, refers_to``: null bodies are empty.

    Of equal payloads of at least ``REVISIT_BYTES`` bytes the smallest page_id stays a response (all rows of that id);
    ``refers_to`` names it for the others. Rows without an id are revisits of a named one, else responses.
    """
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(body_col), F.lit("")).alias("payload"))
    rows = (rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
            .withColumn("payload_digest", F.sha2(F.col("payload").cast("binary"), 256)))
    # Only digests that several rows share are joined; the counts are combined before their shuffle. Their number grows
    # with the pages, so they are never broadcast: small inputs take the same plan as large ones.
    shared = (rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy(F.col("payload_digest").alias("d"))
              .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null"))
    return (rows.join(shared.hint("merge"), rows["payload_digest"] == shared["d"], "left")
            .withColumn("refers_to", F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))
            .drop("d", "first", "n"))


def records(rows: DataFrame) -> DataFrame:
    """``record``: a WARC 1.1 record per row without its closing line ends. Line ends in a URL are taken out."""
    revisit = F.col("refers_to").isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    # A URL that could not stand in a header line is kept beside it, as hexadecimal of its bytes.
    url = F.coalesce(F.hex(F.col("url").cast("binary")), F.lit("-"))
    uri = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n\x00-\x1f]", "")
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("-"))
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), name, F.lit(">"))),
        line("WARC-Date", F.lit(_DATE)),
        line("WARC-Target-URI", uri),
        line("X-Target-Bytes", url),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        line("X-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(_PROFILE)),
                                 line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))))
        .otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block)
    return rows.select(head.alias("record"))


def write_archives(rows: DataFrame, path: str, file_records: int = FILE_RECORDS) -> None:
    """Archive files of at most ``file_records`` records, each one gzip stream."""
    (records(rows).write.option("compression", "gzip").option("lineSep", END)
     .option("maxRecordsPerFile", file_records).text(path))


def split_stream(data: bytes) -> Iterator[bytes]:
    """Records of a whole gzip file, inflated once from front to end; members on end are one stream.

    Zero bytes between members are passed over, as gzip allows padding. Raises ValueError on a broken record.
    """
    buffer, at = bytearray(), 0
    rest = data
    while rest.strip(b"\0"):
        rest = rest.lstrip(b"\0")
        inflate = zlib.decompressobj(31)
        buffer += inflate.decompress(rest)
        buffer += inflate.flush()
        if not inflate.eof:
            raise ValueError("gzip stream ends early")
        rest = inflate.unused_data
    whole = bytes(buffer)
    while at < len(whole):
        body = whole.find(b"\r\n\r\n", at)
        head = whole[at:body]
        if body < 0 or not head.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        length = next((int(h.split(b":", 1)[1]) for h in head.split(b"\r\n")[1:] if h.lower().startswith(b"content-length:")), None)
        if length is None:
            raise ValueError("record without a length")
        end = body + 4 + length
        if whole[end:end + 4] != b"\r\n\r\n":
            raise ValueError("record does not end where its length says")
        yield whole[at:end + 4]
        at = end + 4


def member(record: bytes) -> bytes:
    """The record as a gzip member, without a time, so that a repeated task writes the same bytes."""
    deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
    return deflate.compress(record) + deflate.flush()


def _rewritten(spark: SparkSession, source: str) -> DataFrame:
    """(archive, content, offsets, lengths) per source file; the same bytes on every evaluation."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source)
             .select(F.regexp_extract("path", r"([^/]+)\.gz$", 1).alias("archive"), "content"))

    def rewrite(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, content in frame.itertuples(index=False):
                members = [member(record) for record in split_stream(bytes(content))]
                lengths = np.array([len(m) for m in members], np.int64)
                yield pd.DataFrame({"archive": [archive], "content": [b"".join(members)],
                                    "offsets": [np.cumsum(lengths) - lengths], "lengths": [lengths]})

    return files.mapInPandas(rewrite, "archive string, content binary, offsets array<long>, lengths array<long>")


def normalise(spark: SparkSession, source: str, target: str, index: str) -> None:
    """Rewrite the archives of folder ``source``: one file per archive in ``target``, offsets in ``index``.

    ``target`` has a folder ``archive=<name>`` per source file. Behind the last member stands one zero byte, which is gzip
    padding. ``index`` holds ``archive, number, offset, length``, from a second evaluation that makes the same bytes. A source
    file is held by one task; files are bounded by the writer.
    """
    rows = _rewritten(spark, source)
    # The text writer puts a string's bytes out as they are.
    (rows.where(F.octet_length("content") > 0).select("archive", F.col("content").cast("string").alias("value"))
     .write.partitionBy("archive").option("maxRecordsPerFile", 1).option("lineSep", "\0").text(target))
    (rows.select("archive", F.posexplode(F.arrays_zip("offsets", "lengths")).alias("number", "m"))
     .select("archive", "number", F.col("m.offsets").alias("offset"), F.col("m.lengths").alias("length")).write.parquet(index))


def parse(record: bytes) -> dict:
    """One record's fields. The payload's digest and length are checked where the payload is there."""
    head, body = record[:-4].split(b"\r\n\r\n", 1)
    fields = dict(h.split(": ", 1) for h in head.decode().split("\r\n")[1:])
    page = lambda name: None if name in ("<urn:page:->", None) else int(name[10:-1])
    kind, digest, size = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:"), int(fields["X-Payload-Length"])
    if kind == "response" and (len(body) != size or hashlib.sha256(body).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is not what its digest says")
    url = fields["X-Target-Bytes"]
    return {"page_id": page(fields["WARC-Record-ID"]), "url": None if url == "-" else bytes.fromhex(url).decode(),
            "payload_bytes": size, "payload_digest": digest, "record_type": kind, "refers_to": page(fields.get("WARC-Refers-To")),
            "payload": body.decode() if kind == "response" else None}


FIELDS = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")


def read_records(spark: SparkSession, target: str, index: str, payload: bool = True) -> DataFrame:
    """The records of normalised archives, each cut out by its offset and inflated alone.

    ``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` and, if asked for, ``payload`` (null for revisits).
    """
    wanted = (spark.read.schema("archive string, number int, offset long, length long").parquet(index)
              .groupBy("archive").agg(F.collect_list(F.struct("offset", "length")).alias("at")))  # at most a file's records
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").option("recursiveFileLookup", "true").load(target)
             .select(F.regexp_extract("path", r"archive=([^/]+)/", 1).alias("archive"), "content"))
    fields = FIELDS if payload else FIELDS[:-1]
    schema = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
              + ", payload string" * payload)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content, at in frame.itertuples(index=False):
                data = bytes(content)
                rows = [parse(zlib.decompress(data[m["offset"]:m["offset"] + m["length"]], 31)) for m in at]
                out = pd.DataFrame({f: pd.Series([r[f] for r in rows], dtype=object) for f in fields})
                yield out

    return files.join(wanted.hint("merge"), "archive").select("content", "at").mapInPandas(cut, schema)


def round_trip(pages: DataFrame, payload: bool = False, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as archives, normalise them, and read all records back. An empty table gives no records.

    Files stay in ``folder`` (a fresh one in the shared folder if not given): ``stream``, ``archives`` and ``index``.
    """
    spark = pages.sparkSession
    folder = folder or new_path(spark, "warc")
    write_archives(classified(pages), f"{folder}/stream")
    normalise(spark, f"{folder}/stream", f"{folder}/archives", f"{folder}/index")
    return read_records(spark, f"{folder}/archives", f"{folder}/index", payload)
