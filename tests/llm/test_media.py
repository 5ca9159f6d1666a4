import hashlib
import zlib

import pytest

from gantry.llm import media as M


def rows():
    return [(1, "a"), (2, None), (3, ""), (4, "x" * 64), (5, "é" * 100), (None, "no key"), (1, "a"), (7, "long " * 60_000)]


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(*r, 5) for r in rows()], "doc_id long, text string, payload int").repartition(3)
    manifest = M.store(df, "doc_id", "text", f"file://{tmp_path}/m").cache()
    assert sum(r.members for r in manifest.collect()) == 8
    got = M.described(M.read_archives(spark, manifest, range_bytes="100")).collect()
    key = lambda x: (x[0] is None, x)
    want = []
    for i, text in rows():
        raw = (text or "").encode()
        full = raw + bytes(max(1, -(-len(raw) // 64)) * 64 - len(raw))
        want.append((i, len(raw), len(full), hashlib.sha256(full).hexdigest(), zlib.crc32(full[-64:])))
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    assert len({tuple(r) for r in got if r.doc_id == 1}) == 1
    empty = M.store(df.limit(0), "doc_id", "text", f"file://{tmp_path}/n")
    assert M.described(M.read_archives(spark, empty)).collect() == []


def test_damaged_members(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text {i} " * 50) for i in range(20)], "doc_id long, text string").coalesce(1)
    manifest = M.store(df, "doc_id", "text", f"file://{tmp_path}/m").cache()
    path = manifest.first().archive.removeprefix("file://")
    data = bytearray(open(path, "rb").read())
    data[60] ^= 255
    open(path, "wb").write(data)
    read = M.read_archives(spark, manifest, on_error="null").collect()
    assert [r.key for r in read if r.error] == [0] and len(read) == 20
    with pytest.raises(Exception, match="damaged|decompress"):
        M.read_archives(spark, manifest).collect()


def test_retry_reads_the_member_at_its_offset(tmp_path, spark, monkeypatch):
    df = spark.createDataFrame([(i, f"text {i}") for i in range(5)], "doc_id long, text string").coalesce(1)
    row = M.store(df, "doc_id", "text", f"file://{tmp_path}/m").first()
    reader = M.ArchiveReader({"archives": f'[["{row.archive}", {row.bytes}]]'})
    import zipfile

    monkeypatch.setattr(zipfile.ZipFile, "read", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    got = [b for p in reader.partitions() for b in reader.read(p)]
    assert got[0].column("key").to_pylist() == [0, 1, 2, 3, 4]
    assert [x[: len("text 0")] for x in got[0].column("payload").to_pylist()] == [f"text {i}".encode() for i in range(5)]
