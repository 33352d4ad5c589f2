"""WARC archives with a shared Zstandard dictionary.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, followed by one Zstandard frame per record: a warcinfo record, then
the pages' records. A reader takes the dictionary from the leading frame and can
decompress any record alone from its offset.

The dictionary is built from a bounded sample of the records as they are archived, headers
included (``sample_records`` of the smallest id hashes, ``sample_bytes`` of each at most), once per run, so
that all archives share it. Equal payloads are stored once: the record with the
largest id is the response, the others revisit it. Each task streams its
rows into one archive below the shared folder under a name of its own; only
archives named in the committed manifest are read, so a lost or repeated task leaves nothing behind that counts.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.llm.common import qualified, scratch_uri, stored
from cartpulse.llm.files import open_input, open_output

SKIPPABLE = 0x184D2A5D
MIN_REVISIT = 1000
DICT_BYTES, SAMPLE_RECORDS, SAMPLE_BYTES = 65_536, 2_000, 16_384
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"  # fixed, so that equal inputs give equal archives
READ_BYTES = 1 << 20


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, str(page_id))}>"


def record(kind: str, page_id, url: str | None, payload: bytes, digest: str, refers_to=None) -> bytes:
    """One WARC/1.1 record. A revisit has no body; its headers name the record it repeats."""
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}"]
    if kind != "warcinfo":
        target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
        head += [f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Page-Id: {'' if page_id is None else page_id}",
                 f"X-Payload-Length: {len(payload)}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    body = b"" if kind == "revisit" else payload
    head += [f"Content-Type: {'application/warc-fields' if kind == 'warcinfo' else 'text/html'}", f"Content-Length: {len(body)}"]
    return b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict, bytes]:
    """Headers and body of one record; checks its length and end."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    n = int(fields["Content-Length"])
    if lines[0] != "WARC/1.1" or rest[n:] != b"\r\n\r\n":
        raise ValueError("damaged WARC record")
    return fields, rest[:n]


def train_dictionary(samples: list[bytes]) -> bytes:
    """A Zstandard dictionary, or the samples' own bytes (a raw-content dictionary)
    where there are too few for training; empty without samples."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, max(1024, sum(map(len, samples)) // 8)), samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


def read_archive(source):
    """Records of one archive, in order. ``source`` is a binary file object."""
    magic, n = struct.unpack("<II", source.read(8))
    if magic != SKIPPABLE:
        raise ValueError("no leading dictionary frame")
    words = source.read(n)
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words)) if words else zstandard.ZstdDecompressor()
    one, parts, data = unpack.decompressobj(), [], b""
    while True:
        data = data or source.read(READ_BYTES)
        if not data:
            break
        parts.append(one.decompress(data))
        data = one.unused_data if one.eof else b""
        if one.eof:
            yield parse(b"".join(parts))
            one, parts = unpack.decompressobj(), []
    if parts:  # fed, but its frame did not end
        raise ValueError("archive ends inside a record")


def plan_records(pages: DataFrame, min_revisit: int = MIN_REVISIT, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """``(page_id, url, payload, payload_digest, refers_to)``; ``refers_to`` is NULL for responses."""
    body = F.coalesce(F.encode(F.col(body_col).cast("string"), "UTF-8"), F.lit(b"").cast("binary"))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), body.alias("payload"))
    rows = rows.select("page_id", "url", "payload", F.sha1("payload").alias("payload_digest"))
    big = rows.filter(F.octet_length("payload") >= min_revisit)
    repeats = big.groupBy(F.col("payload_digest").alias("digest"), F.octet_length("payload").alias("bytes")).agg(
        F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n")).filter("n > 1 and last is not null")
    joined = rows.join(repeats, (F.col("payload_digest") == F.col("digest")) & (F.octet_length("payload") == F.col("bytes")), "left")
    return joined.select("page_id", "url", "payload", "payload_digest", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def sample_of(pages: DataFrame, sample_records: int = SAMPLE_RECORDS, sample_bytes: int = SAMPLE_BYTES, id_col: str = "page_id", url_col: str = "url",
              body_col: str = "html", **options) -> list[bytes]:
    """The records to train on: of the ids of smallest hashes one page each, archived among
    themselves by the rule that all follow, bodies cut at ``sample_bytes``."""
    plain = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(body_col).cast("string").alias("html")).filter("page_id is not null")
    # the ids are picked first, the smallest of every task: only the sample's payloads travel
    picked = F.broadcast(plain.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(sample_records))
    one = plain.join(picked, "page_id", "left_semi").groupBy("page_id").agg(F.min(F.struct("url", "html")).alias("p")).select("page_id", "p.*")
    heads = plan_records(one, **options).select("page_id", "url", F.substring("payload", 1, sample_bytes).alias("head"), "payload_digest", "refers_to")
    return [record("response" if r["refers_to"] is None else "revisit", r["page_id"], r["url"], bytes(r["head"]), r["payload_digest"], r["refers_to"])
            for r in heads.orderBy("page_id").collect()]


def write_archives(pages: DataFrame, folder: str, sample_records: int = SAMPLE_RECORDS, sample_bytes: int = SAMPLE_BYTES, **options) -> DataFrame:
    """Write the archives below ``folder``; returns the manifest ``(path, records, bytes)``, stored."""
    folder = qualified(pages.sparkSession, folder)
    rows = plan_records(pages, **options)
    words = train_dictionary(sample_of(pages, sample_records, sample_bytes, **options))

    def run(batches):
        out, n, size, path = None, 0, 0, f"{folder}/{uuid.uuid4().hex}.warc.zst"
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(words)) if words else zstandard.ZstdCompressor(level=LEVEL)
        for b in batches:
            for page, url, payload, digest, ref in zip(*(c.to_pylist() for c in b.columns)):
                if out is None:
                    out = open_output(path)
                    info = record("warcinfo", path.rsplit("/", 1)[1], None, b"format: WARC File Format 1.1\r\n", "")
                    size += out.write(struct.pack("<II", SKIPPABLE, len(words)) + words + pack.compress(info))
                kind = "response" if ref is None else "revisit"
                size += out.write(pack.compress(record(kind, page, url, payload, digest, ref)))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64()), pa.array([size], pa.int64())], ["path", "records", "bytes"])

    return stored(rows.mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` per archived record.
    A response's length and digest are those of the body read back (checked against its headers)."""

    def run(batches):
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for b in batches:
            for path in b.column(0).to_pylist():
                rows = []
                with open_input(path) as source:
                    for head, body in read_archive(source):
                        kind = head["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        n, digest = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response" and (n, digest) != (len(body), hashlib.sha1(body).hexdigest()):
                            raise ValueError(f"{path}: damaged payload")
                        ids = [int(x) if x else None for x in (head["X-Page-Id"], head.get("X-Refers-To-Page", ""))]
                        rows.append((ids[0], n, digest, kind, ids[1]))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    spread = manifest.select("path").repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism), "path")
    return spread.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_pages(pages: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write the pages as archives (below ``spark.checkpoint.dir`` unless ``folder`` is
    given) and return what the archives hold, one row per input row.

    A NULL page has an empty payload. Payloads under ``MIN_REVISIT`` bytes are always
    responses. Rows that repeat the largest id of a payload are all responses; a NULL
    id is never referred to. An empty table writes no archive; extra columns are not read.
    """
    return read_archives(write_archives(pages, folder or scratch_uri(pages.sparkSession, "warc"), **options))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
q AS (SELECT page_id, n, sha1(html) AS digest, max(page_id) OVER (PARTITION BY html) AS last, count(*) OVER (PARTITION BY html) AS copies FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND copies > 1 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND copies > 1 AND page_id <> last THEN last END AS refers_to
FROM q
"""
