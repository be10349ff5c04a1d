"""Media columns: content-addressed payloads in tar shards, and metadata from header-only range reads.

A payload, the text's UTF-8 bytes padded with bytes 32 to a positive multiple of 192, is stored as a
lossless 8-bit greyscale PNG of width 192, named by the payload's SHA-256, inside an uncompressed
tar shard in the shared folder. Each task streams its rows into shards of its own, storing a digest
once per shard; the index of (digest, shard, offset, length) is a table, and one address per digest,
the smallest, is the one that rows carry. So a payload with copies in every task is kept at most once
a task, and no text is ever shuffled. Metadata columns are filled by reading only the first 33 bytes
of a member; payload features read the member whole. A digest is read once, not once per row.

Recovery: a shard has a name of its own per attempt and is closed before its task ends. The index is a saved
table, which holds rows of committed attempts only, and a task commits at its end; so every address is in a
complete shard, and what a lost attempt wrote is never addressed. Its shards stay until the folder is cleared.

Nulls and edge cases: a NULL or empty text is 192 spaces; equal texts have equal values; every row
of the input gives one row, repeated rows too; a NULL doc_id is kept; an empty table gives no rows.
Extra columns are ignored. The payload of one text must fit in a task's memory a few times.
"""

from __future__ import annotations

import hashlib
import struct
import tarfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, scratch_path, small_batches, table
from .textkit import buffers, slices

WIDTH = 192
PNG_SIGN = b"\x89PNG\r\n\x1a\n"
HEADER_BYTES = 33
#: A shard is closed at this size.
SHARD_BYTES = 256 << 20
LEVEL = 1


def pad(raw: bytes) -> bytes:
    return raw + b" " * (-len(raw) % WIDTH if raw else WIDTH)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def encode(payload: bytes) -> bytes:
    """An 8-bit greyscale PNG whose samples are the payload's bytes."""
    rows = len(payload) // WIDTH
    raw = np.zeros((rows, WIDTH + 1), np.uint8)
    raw[:, 1:] = np.frombuffer(payload, np.uint8).reshape(rows, WIDTH)
    return PNG_SIGN + _chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, rows, 8, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(raw.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def header(first: bytes) -> tuple[int, int, int]:
    """Width, height and bits per sample from the first HEADER_BYTES of a PNG."""
    if first[:8] != PNG_SIGN or first[12:16] != b"IHDR":
        raise ValueError("not a PNG header")
    return struct.unpack(">IIB", first[16:25])


def decode(media: bytes) -> bytes:
    width, height, _ = header(media)
    at, body = 8, b""
    while at < len(media):
        size, kind = struct.unpack(">I4s", media[at : at + 8])
        if kind == b"IDAT":
            body += media[at + 8 : at + 8 + size]
        at += 12 + size
    return np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, width + 1)[:, 1:].tobytes()


def feature(payload: bytes) -> str:
    """Mean, deviation and entropy of the samples, and their shares in sixteen equal bins."""
    counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256).astype(float)
    share = counts / counts.sum()
    mean = float(share @ np.arange(256))
    spread = float(np.sqrt(share @ (np.arange(256) - mean) ** 2))
    seen = share[share > 0]
    bins = ",".join(f"{x:.4f}" for x in share.reshape(16, 16).sum(1))
    return f"mean={mean:.4f};std={spread:.4f};entropy={float(-(seen * np.log2(seen)).sum()):.4f};bins={bins}"


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if ":" not in uri or "//" in uri else uri.replace(":/", ":///", 1))


class _Shard:
    def __init__(self, folder: str):
        self.uri = f"{folder}/shard-{uuid.uuid4().hex}.tar"
        system, path = _open(self.uri)
        self.out, self.at, self.known = system.open_output_stream(path), 0, {}

    def put(self, digest: str, payload: bytes) -> tuple[int, int]:
        if digest not in self.known:
            media = encode(payload)
            info = tarfile.TarInfo(f"{digest}.png")
            info.size = len(media)
            head = info.tobuf(tarfile.USTAR_FORMAT)
            self.out.write(head + media + b"\0" * (-len(media) % 512))
            self.known[digest] = self.at + len(head), len(media)
            self.at += len(head) + len(media) + -len(media) % 512
        return self.known[digest]

    def close(self) -> None:
        self.out.write(b"\0" * 1024)
        self.out.close()


INDEX = "doc_id long, n_bytes long, digest string, shard string, offset long, length long"


def write_shards(docs: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Store all payloads of docs (doc_id, text); the saved index of rows, with each row's own copy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        try:
            for whole in batches:
                for b in slices(whole, "text"):
                    data, offsets = buffers(b.column("text"))
                    raw, rows = data.tobytes(), []
                    for i in range(b.num_rows):
                        own = raw[offsets[i] : offsets[i + 1]]
                        payload = pad(own)
                        shard = shard or _Shard(folder)
                        digest = hashlib.sha256(payload).hexdigest()
                        rows.append((len(own), digest, shard.uri, *shard.put(digest, payload)))
                        if shard.at >= shard_bytes:
                            shard.close()
                            shard = None
                    n, d, u, o, s = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64()), pa.array(d), pa.array(u), pa.array(o, pa.int64()), pa.array(s, pa.int64())], ["doc_id", "n_bytes", "digest", "shard", "offset", "length"])
        finally:
            if shard is not None:
                shard.close()

    small_batches(docs.sparkSession)
    return saved(docs.select("doc_id", "text").mapInArrow(run, INDEX), "media-index")


def addresses(index: DataFrame) -> DataFrame:
    """One address per digest: digest, shard, offset, length."""
    return index.groupBy("digest").agg(F.min(F.struct("shard", "offset", "length")).alias("a")).select("digest", "a.*")


def _ranges(stored: DataFrame, columns: str, read, most: int | None = None) -> DataFrame:
    """Adds read(bytes) as columns to rows with shard, offset, length; reads a range of each member in shard order."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, source = None, None
        for b in batches:
            rows = []
            for uri, at, size in zip(*(b.column(c).to_pylist() for c in ("shard", "offset", "length")), strict=True):
                if uri != opened:
                    if source is not None:
                        source.close()
                    system, path = _open(uri)
                    opened, source = uri, system.open_input_file(path)
                rows.append(read(bytes(source.read_at(size if most is None else min(most, size), at))))
            made = [pa.array(x) for x in zip(*rows, strict=True)] if rows else []
            if made:
                yield pa.RecordBatch.from_arrays([*b.columns, *made], [*b.schema.names, *names])
        if source is not None:
            source.close()

    kinds = ", ".join(f"{n} {t}" for n, t in stored.dtypes)
    return stored.mapInArrow(run, f"{kinds}, {columns}")


def with_headers(stored: DataFrame) -> DataFrame:
    """Adds width, height and bits, by reading HEADER_BYTES of each member and no more."""
    return _ranges(stored, "width long, height long, bits long", header, HEADER_BYTES)


def with_payloads(stored: DataFrame) -> DataFrame:
    """Adds what is computed from the bytes read back."""

    def read(media: bytes) -> tuple:
        payload = decode(media)
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature(payload)

    return _ranges(stored, "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", read)


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "media")
    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    index = write_shards(table(spark, sf_dir, "documents"), folder)
    stored = addresses(index).repartition("shard").sortWithinPartitions("shard", "offset")
    seen = with_payloads(with_headers(stored))
    own = index.select("doc_id", "n_bytes", "digest")
    return own.join(seen, "digest").select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "digest", "shard", "offset", "length", "width", "height", "bits")


def media_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can tell of op3_media's rows, which are read back from the shards."""
    return op3_media(spark, sf_dir).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", F.length(F.col("digest")).cast("long").alias("digest_chars"), (F.col("width") * F.col("height")).alias("samples"))


SQL = {
    "media_digests": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, strlen(coalesce(text, '')) AS n FROM documents),
p AS (SELECT doc_id, n, t || repeat(' ', CASE WHEN n = 0 THEN 192 ELSE (192 - n % 192) % 192 END) AS payload FROM d)
SELECT doc_id, n::BIGINT AS n_bytes, strlen(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_sha256, 64::BIGINT AS digest_chars, strlen(payload)::BIGINT AS samples FROM p"""
}
