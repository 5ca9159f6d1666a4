"""Media columns: payloads kept as members of archives, read through a custom Spark data source.

``store`` writes the payloads of a column as graymap images (8-bit samples, WIDTH to a row) into zip archives, one for
each task, and gives a manifest row for each archive. The manifest is a table written under Spark's commit protocol, so archives that a lost or repeated
task left behind are never read.

The data source ``media_archive`` plans byte ranges over the archives of a manifest, from their sizes alone; a task
reads the directory at the end of its archive, takes the members whose header lies in its range, and streams them in
batches through Arrow. A member that can't be read is tried anew at its own offset, on a newly opened file; after
``retries`` it fails the task, or, with ``on_error`` = "null", gives a row with a null payload and the error.

Cases: a null or empty payload is stored as one row of zeros with a length of 0; equal payloads give equal stored bytes; rows may repeat;
an empty table gives an empty manifest and no rows; a null key stays null; a very long payload is one member, streamed as a batch of its own; extra columns are left out.
Archives are opened by pyarrow's file systems, so their folder has to be on one of these (local, HDFS, S3, GCS, Azure).
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from contextlib import closing

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gantry.llm.shared import documents, new_path, written

WIDTH = 64
RANGE_BYTES = 16 << 20
BATCH_BYTES = 8 << 20
SCHEMA = "key long, offset long, n_bytes long, media binary, payload binary, error string"


def file_system(uri: str) -> tuple[pa.fs.FileSystem, str]:
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri.replace("file:///", "/") if uri.startswith("file:") else uri)


def to_media(payload: bytes) -> bytes:
    """A binary graymap of the payload, filled with zeros to whole rows; a comment holds its length."""
    rows = max(1, -(-len(payload) // WIDTH))
    return b"P5\n#n %d\n%d %d\n255\n" % (len(payload), WIDTH, rows) + payload + bytes(rows * WIDTH - len(payload))


def from_media(media: bytes) -> tuple[int, bytes]:
    """Length of the payload, and its samples with the filling."""
    magic, note, shape, top, samples = media.split(b"\n", 4)
    width, rows = map(int, shape.split())
    if magic != b"P5" or not note.startswith(b"#n ") or top != b"255" or len(samples) != width * rows:
        raise ValueError("not a graymap of this library")
    return int(note[3:]), samples


def store(df: DataFrame, key: str, payload: str, folder: str) -> DataFrame:
    """Writes the payloads (binary or string) as archives under ``folder``; the manifest: archive, bytes, members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = None
        for batch in batches:
            keys, payloads = batch.column(0).to_pylist(), batch.column(1)
            for i, k in enumerate(keys):
                if out is None:
                    system, where = file_system(folder)
                    system.create_dir(where, recursive=True)
                    path = f"{where}/{uuid.uuid4().hex}.zip"
                    stream = system.open_output_stream(path)
                    out, members = zipfile.ZipFile(_Counted(stream), "w", zipfile.ZIP_DEFLATED, compresslevel=1), 0
                media = to_media(payloads[i].as_py() or b"")
                out.writestr(zipfile.ZipInfo(f"{members}/{'' if k is None else k}.pgm", (1980, 1, 1, 0, 0, 0)), media, zipfile.ZIP_DEFLATED, 1)
                members += 1
        if out is not None:
            out.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({"archive": [f"{folder}/{path.rsplit('/', 1)[1]}"], "bytes": [system.get_file_info(path).size], "members": [members]})

    return df.select(F.col(key).cast("long"), F.col(payload).cast("binary")).mapInArrow(run, "archive string, bytes long, members long")


class _Counted(io.RawIOBase):
    """A stream that knows how far it has been written, for writers that ask."""

    def __init__(self, stream):
        self.stream, self.at = stream, 0

    def writable(self):
        return True

    def tell(self):
        return self.at

    def write(self, data):
        data = bytes(data)
        self.stream.write(data)
        self.at += len(data)
        return len(data)

    def seekable(self):
        return False


class Range(InputPartition):
    def __init__(self, archive: str, begin: int, end: int):
        self.archive, self.begin, self.end = archive, begin, end


class ArchiveReader(DataSourceReader):
    def __init__(self, options: dict):
        self.archives = json.loads(options["archives"])
        self.range_bytes = int(options.get("range_bytes", RANGE_BYTES))
        self.retries = int(options.get("retries", 3))
        self.on_error = options.get("on_error", "fail")

    def partitions(self) -> list[Range]:
        return [Range(a, b, b + self.range_bytes) for a, size in self.archives for b in range(0, max(size, 1), self.range_bytes)] or [Range("", 0, 0)]

    def member(self, archive: str, info: zipfile.ZipInfo) -> bytes:
        """One member's bytes, read at its offset from a newly opened file."""
        system, path = file_system(archive)
        with system.open_input_file(path) as f:
            f.seek(info.header_offset)
            head = f.read(30)
            if head[:4] != b"PK\x03\x04":
                raise OSError(f"no member at {info.header_offset} of {archive}")
            f.seek(info.header_offset + 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little"))
            data = f.read(info.compress_size)
        media = zlib.decompress(data, -15) if info.compress_type == zipfile.ZIP_DEFLATED else data
        if len(media) != info.file_size or zlib.crc32(media) != info.CRC:
            raise OSError(f"the member at {info.header_offset} of {archive} is damaged")
        return media

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        system, path = file_system(partition.archive)
        rows, held = [], 0
        with closing(system.open_input_file(path)) as f:
            with zipfile.ZipFile(f) as z:
                members = [x for x in z.infolist() if partition.begin <= x.header_offset < partition.end]
                for info in members:
                    key = info.filename.split("/")[1].removesuffix(".pgm")
                    media, error = None, None
                    try:
                        media = z.read(info)
                    except Exception as first:
                        error = first
                        for _ in range(self.retries):
                            try:
                                media, error = self.member(partition.archive, info), None
                                break
                            except Exception as e:
                                error = e
                        if error is not None and self.on_error != "null":
                            raise error
                    n, payload = from_media(media) if media is not None else (None, None)
                    rows.append((int(key) if key else None, info.header_offset, n, media, payload, error and str(error)))
                    held += len(media or b"")
                    if held >= BATCH_BYTES:
                        yield self.batch(rows)
                        rows, held = [], 0
        if rows:
            yield self.batch(rows)

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.string()]
        names = ["key", "offset", "n_bytes", "media", "payload", "error"]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


class MediaArchive(DataSource):
    """Format ``media_archive``. Options: archives (JSON list of [path, bytes]), range_bytes, retries, on_error."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ArchiveReader:
        return ArchiveReader(self.options)


def read_archives(spark: SparkSession, manifest: DataFrame, **options: str) -> DataFrame:
    """The members of the archives of a manifest. The driver holds the archives' names, not their members."""
    spark.dataSource.register(MediaArchive)
    archives = json.dumps([[r["archive"], r["bytes"]] for r in manifest.select("archive", "bytes").collect()])
    return spark.read.format("media_archive").options(archives=archives, **options).load()


def feature(samples: np.ndarray) -> str:
    """Mean, spread and histogram entropy of 8-bit samples, from whole-number sums."""
    n, counts = len(samples), np.bincount(samples, minlength=256)
    total, squares = int(counts @ np.arange(256)), int(counts @ np.arange(256) ** 2)
    p = counts[counts > 0] / n
    return f"mean={total / n:.4f};var={squares / n - (total / n) ** 2:.3f};entropy={float(-(p * np.log2(p)).sum()):.4f};edges={int(np.count_nonzero(samples[1:] != samples[:-1]))}"


def described(members: DataFrame) -> DataFrame:
    """Digests and the feature of each member, from the bytes that were read back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            media, payloads = batch.column("media").to_pylist(), batch.column("payload").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("n_bytes"),
                    pa.array([len(x) for x in payloads], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in payloads], pa.string()),
                    pa.array([zlib.crc32(x[-WIDTH:]) for x in payloads], pa.int64()),
                    pa.array([len(x) for x in media], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in media], pa.string()),
                    pa.array([feature(np.frombuffer(x, np.uint8)) for x in payloads], pa.string()),
                ],
                names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )

    return members.mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")


def op6_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = written(store(documents(spark, sf_dir), "doc_id", "text", new_path(spark, "media")), "manifest")
    return described(read_archives(spark, manifest))
