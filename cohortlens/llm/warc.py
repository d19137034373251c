"""WARC archives: one gzip member per record, and a splittable reader.

Writing: records with equal payloads become one ``response`` and revisits of
it. Reading: tasks get byte ranges, not files; each scans its range for gzip
magic, validates a candidate member by decoding its WARC header, and owns the
records that start inside its range (the last one may end beyond it).
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import AttemptFile, filesystem, scratch_path, text_of, written

#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1\r\n"
MAGIC = b"\x1f\x8b\x08"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:x-page:"

ROLL_BYTES = 1 << 30
SPLIT_BYTES = 8 << 20
CHUNK = 1 << 16
RECORD_DATE = "2024-01-01T00:00:00Z"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, refers_to, date: str = RECORD_DATE) -> bytes:
    """One record as a gzip member; ``refers_to`` (a page id) makes it a revisit.

    The HTTP header keeps the payload's length in either case; a revisit has no
    payload. URLs are percent-encoded, so they cannot break the header.
    """
    revisit = refers_to is not None
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            b"Content-Length: %d\r\n\r\n" % len(payload))
    body = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", f"<{RECORD_ID}{'' if page_id is None else page_id}>"),
              ("WARC-Date", date),
              ("WARC-Payload-Digest", "sha1:" + sha1_base32(payload)),
              ("Content-Type", "application/http; msgtype=response"),
              ("Content-Length", str(len(body)))]
    if url is not None:
        fields.insert(2, ("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=-._~")))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE),
                   ("WARC-Refers-To", f"<{RECORD_ID}{refers_to}>")]
    head = VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + body + b"\r\n\r\n") + packer.flush()


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 0, id_col: str = "page_id",
                   url_col: str = "url", html_col: str = "html",
                   roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write a record per row under ``folder``; the manifest ``(path, size)`` of its files.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with
    the smallest id is the response and the others revisit it; smaller ones are
    all responses. A null html is an empty payload, a null url is left out, a
    record without id revisits like any other but is never revisited (rows with
    the smallest id repeated are all responses). Extra columns are ignored; an
    empty table writes no file.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        text_of(html_col).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html"))
    first = (rows.filter(F.octet_length("html") >= min_bytes).groupBy("digest")
             .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("copies"))
             .filter("copies > 1").select("digest", "first"))
    # the hot side of a skewed digest is split by Spark; `first` has one row per digest
    joined = rows.join(first, "digest", "left").select(
        "page_id", "url", "html",
        F.when(F.col("page_id").eqNullSafe(F.col("first")), None)
        .otherwise(F.col("first")).alias("refers_to"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, done = None, []
        for batch in batches:
            for page_id, url, html, refers_to in zip(
                    batch["page_id"].astype(object).where(batch["page_id"].notna(), None),
                    batch["url"], batch["html"],
                    batch["refers_to"].astype(object).where(batch["refers_to"].notna(), None),
                    strict=True):
                out = out or AttemptFile(folder, ".warc.gz")
                out.write(record(None if page_id is None else int(page_id), url,
                                 html.encode("utf-8", "surrogatepass"),
                                 None if refers_to is None else int(refers_to)))
                if out.size >= roll_bytes:
                    out.close()
                    done, out = [*done, (out.uri, out.size)], None
        if out:
            out.close()
            done.append((out.uri, out.size))
        yield pd.DataFrame(done, columns=["path", "size"])

    return written(joined.mapInPandas(write, "path string, size long"), "warc-manifest")


class Member:
    """Decodes one gzip member from ``position`` of an open file, piece by piece."""

    def __init__(self, source, position: int):
        self.source, self.position, self.used = source, position, 0
        self.unpack = zlib.decompressobj(31)
        self.data = bytearray()

    def more(self) -> bool:
        """Decode another chunk; False at the member's end. Raises zlib.error on bad data."""
        if self.unpack.eof:
            return False
        self.source.seek(self.position + self.used)
        chunk = self.source.read(CHUNK)
        if not chunk:
            raise zlib.error("truncated member")
        self.data += self.unpack.decompress(chunk)
        self.used += len(chunk) - len(self.unpack.unused_data)
        return True

    def header(self) -> dict[str, str] | None:
        """The WARC header fields, or None if this is not the start of a record."""
        try:
            # a member that begins like a record is bounded by itself, other data by its first bytes
            seen = 0
            while self.data.find(b"\r\n\r\n", max(0, seen - 3)) < 0:
                seen = len(self.data)
                if not self.more():
                    break
                if not self.data.startswith(b"WARC/1."[:len(self.data)]):
                    return None
        except zlib.error:
            return None
        head, end, _ = self.data.partition(b"\r\n\r\n")
        if not end or not head.startswith(b"WARC/1."):
            return None
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)
        return fields if {"WARC-Type", "Content-Length"} <= fields.keys() else None

    def body(self) -> bytes:
        while self.more():
            pass
        return bytes(self.data.partition(b"\r\n\r\n")[2][:-4])


def find_magic(source, position: int, end: int) -> int | None:
    """The first gzip magic that starts in ``[position, end)``."""
    while position < end:
        source.seek(position)
        chunk = source.read(CHUNK + len(MAGIC) - 1)
        at = chunk.find(MAGIC)
        if at >= 0:
            return position + at if position + at < end else None
        if len(chunk) < CHUNK:
            return None
        position += CHUNK
    return None


def records_in(source, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header and body of every record whose member starts in ``[start, end)``."""
    at = find_magic(source, start, end)
    while at is not None:
        member = Member(source, at)
        fields = member.header()
        if fields is None:  # the magic's bytes inside other data
            at = find_magic(source, at + 1, end)
            continue
        yield fields, member.body()
        at = find_magic(source, at + member.used, end)


def page_of(uri: str | None) -> int | None:
    number = (uri or "").strip("<>").removeprefix(RECORD_ID)
    return int(number) if number else None


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES,
                  payloads: bool = True) -> DataFrame:
    """All records: ``page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload``.

    Length and digest are those of the full payload: taken from the bytes of a
    response (which must match its header) and from the header of a revisit.
    ``payload`` is null for revisits, and for all records without ``payloads``.
    """
    ranges = manifest.filter("size > 0").select("path", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    number = ranges.count()

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"], strict=True):
                fs, name = filesystem(path)
                rows, held = [], 0
                with fs.open_input_file(name) as source:
                    for fields, body in records_in(source, int(start), int(start) + split_bytes):
                        http, _, payload = body.partition(b"\r\n\r\n")
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        revisit = fields["WARC-Type"] == "revisit"
                        if revisit:
                            size = int(http.rpartition(b"Content-Length: ")[2])
                        else:
                            size = len(payload)
                            if sha1_base32(payload) != digest:
                                raise ValueError(f"{path}: damaged record "
                                                 f"{fields['WARC-Record-ID']}")
                        uri = fields.get("WARC-Target-URI")
                        keep = payload if payloads and not revisit else None
                        rows.append((page_of(fields.get("WARC-Record-ID")),
                                     None if uri is None else unquote(uri), fields["WARC-Type"],
                                     page_of(fields.get("WARC-Refers-To")), size, digest, keep))
                        held += len(keep or b"") + 200
                        if held > 16 << 20:
                            yield frame(rows)
                            rows, held = [], 0
                yield frame(rows)

    def frame(rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["page_id", "url", "record_type", "refers_to",
                                          "payload_bytes", "payload_digest", "payload"])
        return out.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})

    return (ranges.repartition(max(1, min(number, 100_000)), "path", "start")
            .mapInPandas(read, "page_id long, url string, record_type string, refers_to long, "
                               "payload_bytes long, payload_digest string, payload binary"))


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the shared folder and read the record facts back."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), payloads=False).drop("payload")
