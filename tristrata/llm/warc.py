"""WARC archives: a writer that stores equal payloads once, and a reader that salvages.

The writer turns pages into records (a response with its payload, or a revisit that refers to the
response with an equal payload) and lets Spark's text sink write them, one uncompressed record
after the other. Hot payloads are never gathered: their largest id is found by a sum that
combines inside the tasks, and joined back with a salt.

The reader takes plain archives and such with a gzip member for each record. A record counts
when its version line, header, length, end and block digest are right, a member when its own
checks are right too. After a failed check the reader looks for the next place where a valid
member or version line begins, goes on there, and logs the bytes in between as a gap.

Defined results: null html is an empty payload; a null url has no target header; a null id has no
id header and its row refers to the largest id that is there; rows that share the largest id are
all responses; an empty table gives an archive without records, an empty or hopeless file no
records and one gap over all its bytes. Other columns are not looked at. Files are read whole, one
at a time, so archives should be cut to sizes that fit into a task (the writer's are).
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.llm.bits import bitmap, passing
from tristrata.llm.common import salt_of, salted
from tristrata.scratch import staged

#: Smallest payload that can be revisited, in bytes.
LEAST = 0
SALTS = 16
#: A file ends with the record that reaches this many bytes.
FILE_BYTES = 64 << 20
CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
#: Digits of base 32 as ``conv`` writes them, and as RFC 4648 does.
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(data: Column) -> Column:
    """SHA-1 in upper-case base 32: five hex digits are four digits."""
    hexa = F.sha1(data)
    parts = [
        F.lpad(F.conv(F.substring(hexa, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)
    ]
    return F.translate(F.concat(*parts), DIGITS, BASE32)


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page_id.cast("string"), F.lit("none")), F.lit(">"))


def records(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least: int = LEAST,
) -> DataFrame:
    """``record``: the text of each page's WARC record, without the last line end."""
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("payload"),
        F.sha2(F.coalesce(F.col(html_col), F.lit("")).cast("binary"), 256).alias("key"),
        salt_of(SALTS, F.col(id_col)).alias("salt"),
    )
    groups = (
        rows.groupBy("key")
        .agg(F.max("page_id").alias("refers_to"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("key", "refers_to")
    )
    # Only payloads that are repeated need to meet their group; the others stay where they are.
    groups = staged(groups, "payloads")
    bits = bitmap(groups, ["key"])
    alone = passing(rows, bits, ["key"], wanted=False).withColumn(
        "refers_to", F.lit(None).cast(rows.schema["page_id"].dataType)
    )
    shared = passing(rows, bits, ["key"]).join(salted(groups, SALTS), ["key", "salt"], "left")
    rows = alone.unionByName(shared)
    revisit = (
        F.col("refers_to").isNotNull()
        & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
        & (F.octet_length("payload") >= least)
    )
    rows = rows.withColumn("revisit", revisit).withColumn("n", F.octet_length("payload"))
    # A line end inside a url would break the header.
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("n").cast("string"),
        F.lit(CRLF + CRLF),
    )
    block = F.when(F.col("revisit"), http).otherwise(F.concat(http, F.col("payload")))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))

    rows = rows.withColumn("block", block)
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        line("WARC-Record-ID", record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", url),
        line("X-Page-Id", F.col("page_id").cast("string")),
        line("WARC-Refers-To", F.when(F.col("revisit"), record_id(F.col("refers_to")))),
        line(
            "WARC-Profile",
            F.when(
                F.col("revisit"),
                F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ),
        ),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1_base32(F.col("payload").cast("binary")))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), sha1_base32(F.col("block").cast("binary")))),
        line("X-Payload-Bytes", F.col("n").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit(CRLF),
    )
    return rows.select(F.concat(header, F.col("block"), F.lit(CRLF)).alias("record"))


def file_number(file_bytes: int):
    """For sizes of records, the number of the file within the task, by their running sum."""

    def number(sizes: Iterator[pd.Series]) -> Iterator[pd.Series]:
        done = 0
        for own in sizes:
            ends = own.cumsum() + done
            yield (ends - own) // file_bytes
            done = int(ends.iloc[-1]) if len(ends) else done

    return F.pandas_udf(number, "long").asNondeterministic()


def write(pages: DataFrame, path: str, file_bytes: int = FILE_BYTES, **columns) -> None:
    """Write the pages' records below ``path``, in files of ``file_bytes`` and one record at most.

    Only the sizes of the records go through Python; the records stay in their tasks.
    """
    size = F.octet_length("record").cast("long") + len(CRLF)
    rows = records(pages, **columns).withColumn("file", file_number(file_bytes)(size))
    rows.write.partitionBy("file").option("lineSep", CRLF).text(path)


VERSION = re.compile(rb"WARC/1\.[01]\r?\n")
#: Where a record may begin: a gzip member or a version line.
START = re.compile(rb"\x1f\x8b\x08|WARC/1\.[01]\r?\n")
#: Bytes that a gzip member is fed at once.
FEED = 1 << 16
INNER = re.compile(rb"WARC/1\.[01]$")
HEADER_END = re.compile(rb"\r?\n\r?\n")


class Bad(Exception):
    """A failed check."""


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def plain_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Header, block and end of the record whose version line stands at ``at``."""
    version = VERSION.match(data, at)
    if not version:
        raise Bad("no version line")
    end = HEADER_END.search(data, version.end() - 2)
    if not end:
        raise Bad("header without end")
    header, before = {}, frozenset()
    for raw in data[version.end() : end.start()].splitlines():
        name, colon, value = raw.partition(b":")
        if not colon:
            raise Bad("broken header line")
        field = name.strip().decode("latin-1").lower()
        if field in before:
            raise Bad("version line inside the header")
        header[field] = value.strip().decode("utf-8", "replace")
        # A value may end as a version line does; what comes behind one of the next record repeats
        # the fields in front of it.
        if INNER.search(raw):
            before = frozenset(header)
    length = header.get("content-length", "")
    if not (length.isascii() and length.isdigit()):
        raise Bad("no content length")
    begin, stop = end.end(), end.end() + int(length)
    if stop > len(data):
        raise Bad("cut short")
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise Bad("wrong length")
    block = data[begin:stop]
    kind, _, want = header.get("warc-block-digest", "").partition(":")
    if kind.lower() == "sha1" and want.upper() != digest(block):
        raise Bad("wrong digest")
    return header, block, stop + 4


def record_at(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    if data[at : at + 2] != b"\x1f\x8b":
        return plain_record(data, at)
    member, parts, fed = zlib.decompressobj(31), [], at
    try:
        while not member.eof and fed < len(data):
            parts.append(member.decompress(data[fed : fed + FEED]))
            fed = min(fed + FEED, len(data))
    except zlib.error as error:
        raise Bad("broken member") from error
    if not member.eof:
        raise Bad("cut short")
    content = b"".join(parts)
    header, block, end = plain_record(content, 0)
    if content[end:].strip():
        raise Bad("bytes behind the record")
    return header, block, fed - len(member.unused_data)


def salvage(data: bytes) -> Iterator[tuple]:
    """``("record", offset, length, header, block)`` and ``("gap", offset, length, reason)``, in
    the file's order; together they cover every byte."""
    at, gap, why = 0, None, ""
    while at < len(data):
        try:
            header, block, end = record_at(data, at)
        except Bad as error:
            if gap is None:
                gap, why = at, str(error)
            found = START.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if gap is not None:
            yield "gap", gap, at - gap, why
            gap = None
        yield "record", at, end - at, header, block
        at = end
    if gap is not None:
        yield "gap", gap, len(data) - gap, why


def payload_of(header: dict[str, str], block: bytes) -> bytes:
    """The block without its HTTP header."""
    if not header.get("content-type", "").startswith("application/http"):
        return block
    end = HEADER_END.search(block)
    return block[end.end() :] if end else b""


FIELDS = (
    "kind string, file string, offset long, length long, reason string, header map<string,string>,"
    " payload_bytes long, payload_digest string, payload binary"
)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of the archives below ``path``; see ``FIELDS``. ``payload_bytes`` and
    ``payload_digest`` are computed from what a record holds, ``payload`` is null unless asked for."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "content")
    )
    kinds = {
        "kind": pa.string(), "file": pa.string(), "offset": pa.int64(), "length": pa.int64(),
        "reason": pa.string(), "header": pa.map_(pa.string(), pa.string()),
        "payload_bytes": pa.int64(), "payload_digest": pa.string(), "payload": pa.binary(),
    }

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content")):
                out, held = [], 0
                for kind, at, size, *rest in salvage(content.as_py() or b""):
                    if kind == "gap":
                        out.append((kind, name.as_py(), at, size, rest[0], None, None, None, None))
                    else:
                        header, block = rest
                        data = payload_of(header, block)
                        own = (len(data), digest(data), data if payloads else None)
                        out.append((kind, name.as_py(), at, size, None, list(header.items()), *own))
                        held += len(data) * payloads + 1000
                    if held > 16 << 20:
                        yield as_batch(out)
                        out, held = [], 0
                if out:
                    yield as_batch(out)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds)
        )

    return files.mapInArrow(parse, FIELDS)


def gaps(read_back: DataFrame) -> DataFrame:
    """The quarantine log: ``file, offset, length, reason``."""
    return read_back.where("kind = 'gap'").select("file", "offset", "length", "reason")


def pages_of(read_back: DataFrame, id_type: str = "long") -> DataFrame:
    """``page_id, url, record_type, payload_bytes, payload_digest, refers_to, payload``.

    A revisit holds no payload; its size and digest are those its header states. Ids are given as
    ``id_type``, and as null where they are none of that type; ``string`` takes all.
    """
    header = F.col("header")
    revisit = header["warc-type"] == "revisit"
    stated = F.regexp_replace(header["warc-payload-digest"], "^[Ss][Hh][Aa]1:", "")
    return read_back.where("kind = 'record'").select(
        header["x-page-id"].try_cast(id_type).alias("page_id"),
        header["warc-target-uri"].alias("url"),
        header["warc-type"].alias("record_type"),
        F.when(revisit, header["x-payload-bytes"].try_cast("long"))
        .otherwise(F.col("payload_bytes"))
        .alias("payload_bytes"),
        F.when(revisit, stated).otherwise(F.col("payload_digest")).alias("payload_digest"),
        F.when(revisit, F.regexp_extract(header["warc-refers-to"], r"<urn:x-page:(.*)>", 1).try_cast(id_type))
        .alias("refers_to"),
        "payload",
    )
