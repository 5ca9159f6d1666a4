"""Packing along a space-filling curve.

Each document becomes token ids and a hashed vector: every id adds a sign per dimension, and the sums, scaled by the document's
length, are laid on a grid. The Hilbert index of the cell is the sort key, so documents of similar content lie next
to each other. A range sort by (key, doc_id) deals the documents out; a prefix sum over the token counts, one number
for each range, gives every document its place in one stream, which is cut every ``length`` tokens. Only the last
sequence is padded.

Cases: a null or empty text is its end id alone; repeated rows are packed as often as they occur; an empty table gives
no pieces; a document longer than a sequence is cut into several pieces, however long it is; documents with equal keys, doc_ids and counts stand in any order; a null doc_id sorts first; extra columns are
left out of the token table and may have any names. An added token of the file in a text becomes its id, as that tokenizer gives it.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.llm.shared import documents, drop_written, released, sliced, written

LENGTH = 1024
#: Bytes of ids in each range of the curve, about.
RANGE_BYTES = 32 << 20
DIMENSIONS, BITS = 4, 12
#: Characters of the longest pre-token whose ids a worker keeps (``tokencounts``), and of a piece of text that is encoded at once, about.
LONG, PIECE = 64, 1 << 20
#: White space as the byte-level pre-tokenizer's pattern has it. No pre-token holds white space after another character.
_WS = "\t-\r \x85\xa0  -     　"
#: Between these two characters every text can be cut: what lies on both sides is encoded as it is in the whole.
CUT = re.compile(f"[^{_WS}](?=[{_WS}])")


#: Fixed value: the pattern of byte-level pre-tokenization.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_characters() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: itself if printable, else the next free one from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return {chr(b if b in plain else next(free)): b for b in range(256)}


def merge_ranks(whole: dict) -> dict[bytes, int] | None:
    """Bytes to id of a tokenizer file's content in which ids rise in the order of merges, so that the id is the rank; else None."""
    model, split = whole["model"], whole.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or whole.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space", True) or not split.get("use_regex", True):
        return None
    special = {x["content"] for x in whole.get("added_tokens", ())}
    byte = byte_characters()
    made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    return ranks if made == sorted(set(made)) and len(ranks) == 256 + len(made) and len([t for t in ranks if len(t) == 1]) == 256 else None


class ChunkTokenizer:
    """A byte-level BPE tokenizer file, applied to whole texts, long ones in pieces.

    Texts go to the merge loop for vocabularies of ranks (tiktoken's) where the file's ids are ranks: the ids are the same, without the
    alignments the other library keeps. A text with one of the file's added tokens goes to the tokenizer itself, as do all texts where ids are no ranks.
    """

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            content = json.load(f)
        self.file, self._whole, ranks, added = file, None, merge_ranks(content), content.get("added_tokens", ())
        #: Finds the file's added tokens in a text, the longest first.
        self.added = re.compile("|".join(map(re.escape, sorted((x["content"] for x in added), key=len, reverse=True)))) if added else None
        self.added_width = max([0, *(len(x["content"]) for x in added)])
        self.plain = not any(x.get(k) for x in added for k in ("lstrip", "rstrip", "single_word"))
        self.size = 1 + max([*content["model"]["vocab"].values(), *(x["id"] for x in added)])
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.ranked = None
        if ranks:
            import tiktoken

            self.ranked = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @property
    def whole(self):
        """The file's own tokenizer."""
        if self._whole is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self._whole = Tokenizer.from_file(self.file)
        return self._whole

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _ranks(self, text: str) -> bytes:
        """Packed ids of a text, by pieces of about PIECE characters that end where white space follows."""
        out, at = [], 0
        while at < len(text):
            cut = CUT.search(text, at + PIECE) if len(text) - at > PIECE else None
            end = cut.end() if cut else len(text)
            out.append(self._pack(self.ranked.encode_ordinary(text[at:end])))
            at = end
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text, in ``dtype``: those of the file's tokenizer without special tokens of its own. Equal texts are encoded once."""
        if self.ranked is None:
            return [self._pack(e.ids) for e in self.whole.encode_batch(texts, add_special_tokens=False)]
        own = lambda x: self._pack(self.whole.encode(x, add_special_tokens=False).ids) if self.added and self.added.search(x) else self._ranks(x)
        known = {x: own(x) for x in dict.fromkeys(texts)}
        return [known[x] for x in texts]

    def forget(self) -> None:
        """Gives memory back at the end of a task."""
        released()


_TOKENIZERS: dict[str, ChunkTokenizer] = {}


def tokenizer(file: str) -> ChunkTokenizer:
    if file not in _TOKENIZERS:
        _TOKENIZERS[file] = ChunkTokenizer(file)
    return _TOKENIZERS[file]


def signs(size: int, dimensions: int) -> np.ndarray:
    """A sign for each id and dimension, from a 64-bit mix of the id."""
    x = np.arange(size, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return np.stack([((x >> np.uint64(d)) & np.uint64(1)).astype(np.float32) * 2 - 1 for d in range(dimensions)], 1)


def grid(sums: np.ndarray, lengths: np.ndarray, bits: int) -> np.ndarray:
    """Cells of mean signs; the logistic function spreads the middle, where most documents lie."""
    mean = sums / np.maximum(lengths, 1)[:, None]
    return np.minimum((1 / (1 + np.exp(-12 * mean)) * (1 << bits)).astype(np.int64), (1 << bits) - 1)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of each row of cells, by the transform between axes and transposed index, for all rows at once."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[:, i] & q) != 0
            t = np.where(high, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] ^= np.where(high, p, t)
            x[:, i] ^= t
        q >>= 1
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t ^= np.where((x[:, n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def tokenized(df: DataFrame, file: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n (ids with the end id), key (Hilbert index) and ids (packed in the tokenizer's width)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(file)
        table, end = signs(coder.size, DIMENSIONS), np.array([end_id], coder.dtype).tobytes()
        for batch in sliced(batches, 1):
            packed = [x + end for x in coder.encode([x or "" for x in batch.column(1).to_pylist()])]
            n = np.array([len(x) // coder.dtype.itemsize for x in packed], np.int64)
            ids, starts = np.frombuffer(b"".join(packed), coder.dtype), np.cumsum(n) - n
            sums = np.stack([np.add.reduceat(np.take(table[:, d], ids), starts) for d in range(DIMENSIONS)], 1)
            key = hilbert(grid(sums, n, BITS), BITS)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(key), pa.array(packed, pa.binary())], names=["doc_id", "n", "key", "ids"])
        coder.forget()

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, n long, key long, ids binary")


def pack(tokens: DataFrame, itemsize: int, length: int = LENGTH) -> DataFrame:
    """Pieces of the table that ``tokenized`` gives: doc_id, start, length, ids, doc_tokens, sequence_id, offset."""
    spark = tokens.sparkSession
    tokens = written(tokens, "tokens")
    size = (tokens.agg(F.sum("n")).first()[0] or 0) * itemsize
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // RANGE_BYTES)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            at = np.cumsum(n) - n + total
            total += int(n.sum())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n"), batch.column("ids"), pa.array(np.full(len(n), part, np.int64)), pa.array(at)], names=["doc_id", "n", "ids", "part", "at"])

    ordered = tokens.repartitionByRange(parts, "key", "doc_id").sortWithinPartitions("key", "doc_id", "n")
    placed = written(ordered.mapInArrow(place, "doc_id long, n long, ids binary, part long, at long"), "placed")
    drop_written(tokens)
    before, base = 0, {}
    for row in sorted(placed.groupBy("part").agg(F.sum("n").alias("n")).collect()):  # one row for each range
        base[row["part"]] = before
        before += row["n"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 2):
            out: list[list] = [[] for _ in range(7)]
            for doc, n, ids, part, at in zip(*[c.to_pylist() for c in batch.columns]):
                begin, start = base[part] + at, 0
                while start < n:
                    sequence, offset = divmod(begin + start, length)
                    take = min(n - start, length - offset)
                    for column, x in zip(out, (doc, start, take, ids[start * itemsize : (start + take) * itemsize], n, sequence, offset)):
                        column.append(x)
                    start += take
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return placed.mapInArrow(cut, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")


def wide_crc32(ids: bytes, itemsize: int) -> int:
    """crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids if itemsize == 4 else np.frombuffer(ids, "<u2").astype("<u4").tobytes())


def packed_digests(df: DataFrame, file: str, end_id: int = 0, length: int = LENGTH) -> DataFrame:
    itemsize = tokenizer(file).dtype.itemsize
    pieces = pack(tokenized(df, file, end_id), itemsize, length)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = pa.array([wide_crc32(x, itemsize) for x in batch.column("ids").to_pylist()], pa.int64())
            yield batch.set_column(batch.schema.get_field_index("ids"), "ids_crc32", crc)

    return pieces.mapInArrow(digest, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed_digests(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
