import hashlib
import tarfile
import zlib

from pyarrow import fs

from lakeloom.llm import media
from lakeloom.llm.common import scratch_path
from tests.oracle import same


def test_png_round_trip():
    for raw in (b"", b"a", b"x" * 192, bytes(range(256)) * 7):
        payload = media.pad(raw)
        assert len(payload) % 192 == 0 and payload.startswith(raw)
        stored = media.encode(payload)
        assert media.decode(stored) == payload and media.header(stored[: media.HEADER_BYTES]) == (192, len(payload) // 192, 8)


def test_shards(spark, documents, odd_rows, monkeypatch):
    folder = scratch_path(spark, "media-test")
    system, path = media._open(folder)
    system.create_dir(path, recursive=True)
    docs = documents(odd_rows)
    index = media.write_shards(docs, folder, shard_bytes=4096)
    assert index.count() == len(odd_rows)
    stored = media.addresses(index)
    assert stored.count() == index.select("digest").distinct().count()
    for uri in {r["shard"] for r in index.collect()}:
        local = media._open(uri)[1]
        with tarfile.open(local) as tar:
            for member in tar:
                payload = media.decode(tar.extractfile(member).read())
                assert hashlib.sha256(payload).hexdigest() == member.name.removesuffix(".png")
    seen = {r["digest"]: r for r in media.with_payloads(media.with_headers(stored)).collect()}
    for r in index.join(docs.select("doc_id", "text"), "doc_id").collect():
        x, raw = seen[r["digest"]], (r["text"] or "").encode()
        payload = media.pad(raw)
        if hashlib.sha256(payload).hexdigest() == r["digest"]:
            assert (x["payload_bytes"], x["payload_sha256"], x["tail_crc32"], r["n_bytes"]) == (len(payload), r["digest"], zlib.crc32(payload[-16:]), len(raw))
            assert x["width"] * x["height"] == len(payload)


def test_header_reads_no_more(spark, documents):
    asked = []

    class Source:
        def __init__(self, f):
            self.f = f

        def read_at(self, size, at):
            asked.append(size)
            return self.f.read_at(size, at)

        def close(self):
            self.f.close()

    folder = scratch_path(spark, "media-test")
    system, path = media._open(folder)
    system.create_dir(path, recursive=True)
    index = media.write_shards(documents([(1, "x" * 5000)]), folder)
    row = index.first()
    f = fs.LocalFileSystem().open_input_file(media._open(row["shard"])[1])
    assert media.header(bytes(Source(f).read_at(media.HEADER_BYTES, row["offset"]))) == (192, 27, 8) and asked == [33]


def test_empty(spark, documents):
    folder = scratch_path(spark, "media-test")
    system, path = media._open(folder)
    system.create_dir(path, recursive=True)
    assert media.write_shards(documents([]), folder).count() == 0


def test_query(spark, sf):
    got = {r["doc_id"]: r for r in media.op3_media(spark, sf).collect()}
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(texts)
    by_text = {}
    for doc_id, text in texts:
        payload, r = media.pad((text or "").encode()), got[doc_id]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len((text or "").encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
        assert r["media_bytes"] == r["length"] and by_text.setdefault(text, (r["media_sha256"], r["feature"])) == (r["media_sha256"], r["feature"])


def test_sql(spark, sf):
    same(media.media_digests(spark, sf), media.SQL["media_digests"], sf)
