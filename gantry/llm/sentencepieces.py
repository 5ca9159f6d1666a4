"""SentencePiece BPE encoding by backtracking, and decoding.

A merge-type model joins, again and again, the adjacent pair whose joined piece scores best (leftmost first among
equals). The result is found here without a queue of pairs: an Aho-Corasick automaton gives the longest piece at every position; pieces
are taken left to right, each only if it is compatible with the one before, which a re-merge of the two along their
common border tells; if no piece fits, the position is marked as failed in a bitfield and the last piece is shortened.

No piece has a white-space mark after another character, so a text splits before each run of marks and its units
are encoded one by one; a bounded cache keeps units that return. Runs of marks share one score and are merged
greedily from the left, as the library does. Characters outside the vocabulary become byte pieces.

Cases: null is taken as an empty text; an empty text gives begin and end ids alone; text of any length is encoded whole;
of pieces of equal score the leftmost is merged first, as in the library; rows may repeat; an empty table gives an empty result; extra columns pass through.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import re
import struct
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, IntegerType

from gantry.llm.shared import documents

MARK = "▁"
#: Units and pairs kept by a Python worker. A full table of units becomes the older one, which still answers.
CACHE = 300_000

codecs.register_error("each_byte", lambda e: ("\ufffd", e.start + 1))


class PieceCodec:
    """Encoder and decoder of one merge-type model file with byte fallback, an identity normaliser and a dummy prefix."""

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=model_file)
        n = sp.vocab_size()
        self.bos, self.eos = sp.bos_id(), sp.eos_id()
        self.pieces = [sp.id_to_piece(i) for i in range(n)]
        self.byte_ids = {int(self.pieces[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_set = set(self.byte_ids.values())
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))]
        self.runs = {len(self.pieces[i]): i for i in plain if not self.pieces[i].strip(MARK)}
        words = [i for i in plain if self.pieces[i].strip(MARK) or self.pieces[i] == MARK]
        self.rank = {self.pieces[i]: r for r, i in enumerate(sorted(words, key=lambda i: (-sp.get_score(i), i)))}
        self.id_of = {self.pieces[i]: i for i in words}
        if any(MARK in p.lstrip(MARK) for p in self.id_of) or any(p.startswith(MARK * 2) for p in self.id_of):
            raise ValueError("the model has pieces across words")
        self._tables()
        self.raw = [b"" if sp.is_control(i) else bytes([int(self.pieces[i][3:5], 16)]) if sp.is_byte(i) else " ⁇ ".encode() if sp.is_unknown(i) else self.pieces[i].replace(MARK, " ").encode() for i in range(n)]
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.split = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")

    def _tables(self) -> None:
        """Each piece's last merge, the next shorter piece it begins with, and the automaton.

        A piece that its own characters don't merge to never occurs. A piece with a part that is merged later than
        itself is irregular: texts in which one occurs are merged pair by pair.
        """
        self.parts: dict[str, tuple[str, str] | None] = {}
        self.irregular: set[str] = set()
        for piece in sorted(self.rank, key=len):
            if len(piece) == 1:
                self.parts[piece] = None
            elif (merged := self.merge(piece, last := []))[0] == piece and len(merged) == 1:
                self.parts[piece] = last[-1]
                if any(self.parts.get(x) and (self.rank[x] > self.rank[piece] or x in self.irregular) for x in last[-1]):
                    self.irregular.add(piece)
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.parts), None) for p in self.parts}
        self.automaton = ahocorasick.Automaton()
        for piece in self.parts:
            self.automaton.add_word(piece, (len(piece) - 1, piece))
        self.characters = {p for p in self.parts if len(p) == 1}
        self.automaton.make_automaton()

    def merge(self, text: str, merges: list | None = None) -> list[str]:
        """The pieces of ``text`` by merging pair by pair; characters stay as they are where no piece has them."""
        parts: list[str | None] = list(text)
        after = [*range(1, len(parts)), -1]
        before = [*range(-1, len(parts) - 1)]
        heap: list[tuple[int, int, str, str]] = []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) >= 0 and (r := self.rank.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else -1
            if j < 0 or parts[i] != a or parts[j] != b:
                continue
            if merges is not None:
                merges.append((a, b))
            parts[i], parts[j], after[i] = a + b, None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging a + b anew gives a and b again: no pair across their border may join before its sides have grown."""
        key = (a, b)
        if (known := self.pairs.get(key)) is not None:
            return known
        rank, parts, limit, fits = self.rank, self.parts, len(self.rank), None
        while fits is None:
            joined = rank.get(a + b)
            if joined is not None and joined < limit:
                fits = False
                break
            ra = rank[a] if parts[a] else -1
            rb = rank[b] if parts[b] else -1
            if ra < 0 and rb < 0:
                fits = True
            elif ra > rb:
                limit, a = ra, parts[a][1]
            else:  # of two equal pieces the right one was made later
                limit, b = rb + 1, parts[b][0]
        if len(self.pairs) >= CACHE:
            self.pairs.clear()
        self.pairs[key] = fits
        return fits

    def backtrack(self, text: str) -> list[str]:
        """The pieces of a text of known characters."""
        longest: list[str] = [""] * len(text)
        for end, (before, piece) in self.automaton.iter(text):
            longest[end - before] = piece  # ends ascend: the longest comes last
        if self.irregular and not self.irregular.isdisjoint(p for _, (_, p) in self.automaton.iter(text)):
            return self.merge(text)
        alive = (1 << (len(text) + 1)) - 1 if len(text) < 4096 else None  # bit i: position i hasn't failed
        failed = bytearray(len(text) + 1) if alive is None else None
        out: list[str] = []
        at, piece, shorter, compatible = 0, longest[0], self.shorter, self.compatible
        while at < len(text):
            last = out[-1] if out else None
            while True:
                end = at + len(piece)
                if (alive >> end & 1 if failed is None else not failed[end]) and (last is None or compatible(last, piece)):
                    out.append(piece)
                    at = end
                    piece = longest[at] if at < len(text) else ""
                    break
                if (piece := shorter[piece]) is None:
                    if failed is None:
                        alive &= ~(1 << at)
                    else:
                        failed[at] = 1
                    piece = out.pop()
                    at -= len(piece)
                    break
        return out

    def unit(self, unit: str) -> bytes:
        """Packed ids of a run of marks and the characters that follow it."""
        if (packed := self.older.get(unit)) is not None:
            return self._keep(unit, packed)
        body = unit.lstrip(MARK)
        marks = len(unit) - len(body)
        text, id_of = (MARK if marks else "") + body, self.id_of
        if self.characters.issuperset(text):
            ids = [id_of[p] for p in self.backtrack(text)]
        else:
            ids, start = [], 0
            for i in range(len(text) + 1):
                if i == len(text) or text[i] not in self.characters:
                    if start < i:
                        ids += [id_of[p] for p in self.backtrack(text[start:i])]
                    if i < len(text):
                        ids += [self.byte_ids[x] for x in text[i].encode()]
                    start = i + 1
        if marks > 1 or marks and not body:
            lone = ids[0] == self.id_of[MARK]
            ids = self.run(marks if lone else marks - 1) + ids[lone:]
        packed = struct.pack(f"<{len(ids)}I", *ids)
        return self._keep(unit, packed) if len(unit) <= 64 else packed

    def _keep(self, unit: str, packed: bytes) -> bytes:
        if len(self.units) >= CACHE:
            self.older = self.units.copy()
            self.units.clear()
        self.units[unit] = packed
        return packed

    def run(self, n: int) -> list[int]:
        """Ids of n marks alone. All runs score alike, so the leftmost one grows until no longer run is a piece."""
        longest, lengths = max(self.runs), self.runs
        whole, rest = divmod(n, longest)
        left = [longest] * (whole - 1) if whole else []
        parts = [1] * (rest + longest * bool(whole))
        i = 0
        while i < len(parts) - 1:
            if parts[i] + parts[i + 1] in lengths:
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                i = 0
            else:
                i += 1
        return [lengths[x] for x in left + parts]

    def encode_packed(self, text: str) -> bytes:
        """Ids of the whole text, begin and end included, as little-endian unsigned 32-bit integers."""
        begin, end = struct.pack("<I", self.bos), struct.pack("<I", self.eos)
        if not text:
            return begin + end
        units, slow = self.units, self.unit
        return b"".join([begin, *[units.get(u) or slow(u) for u in self.split.findall(MARK + text.replace(" ", MARK))], end])

    def encode(self, text: str) -> list[int]:
        packed = self.encode_packed(text)
        return list(struct.unpack(f"<{len(packed) // 4}I", packed))

    def decode(self, ids: list[int]) -> str:
        """The text of ids: pieces joined, marks as spaces, without the dummy prefix; bytes that are no UTF-8 become U+FFFD."""
        raw = self.raw
        first = next((i for i in ids if raw[i]), None)
        out = b"".join([raw[i] for i in ids])
        if first is not None and out.startswith(b" ") and self.pieces[first].startswith(MARK):
            out = out[1:]
        try:
            return out.decode()
        except UnicodeDecodeError:
            return self._decode_runs(ids)

    def _decode_runs(self, ids: list[int]) -> str:
        """As ``decode``; each byte of a run of byte pieces that no UTF-8 character starts with becomes U+FFFD."""
        out, run, first = [], b"", True
        for i in [*ids, None]:
            if i is not None and i in self.byte_set:
                run += self.raw[i]
                first = False
                continue
            if run:
                out.append(run.decode("utf-8", "each_byte"))
                run = b""
            if i is not None and self.raw[i]:
                piece = self.raw[i].decode()
                out.append(piece[1:] if first and self.pieces[i].startswith(MARK) else piece)
                first = False
        return "".join(out)


_CODECS: dict[str, PieceCodec] = {}


def codec(model_file: str) -> PieceCodec:
    """The worker's codec for a model file, built once."""
    if model_file not in _CODECS:
        _CODECS[model_file] = PieceCodec(model_file)
    return _CODECS[model_file]


def _texts(batch: pa.RecordBatch, text: str) -> list[str]:
    return [x or "" for x in batch.column(batch.schema.get_field_index(text)).to_pylist()]


def encode(df: DataFrame, model_file: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the array column ``ids`` of each whole text, a column of that name replaced."""
    rest = [c for c in df.columns if c != ids]
    schema = df.select(*rest).schema.add(ids, ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model_file)
        for batch in batches:
            lists = pa.array([coder.encode(x) for x in _texts(batch, text)], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, ids])

    return df.select(*rest).mapInArrow(run, schema)


def decode(df: DataFrame, model_file: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the string column ``text`` of each list of ids; null ids give an empty text."""
    rest = [c for c in df.columns if c != text]
    schema = df.select(*rest).schema.add(text, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model_file)
        for batch in batches:
            texts = pa.array([coder.decode(x or []) for x in batch.column(batch.schema.get_field_index(ids)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=[*batch.schema.names, text])

    return df.select(*rest).mapInArrow(run, schema)


def digests(df: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text, encoded and decoded in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model_file)
        for batch in batches:
            n, ids_sha, decoded_sha = [], [], []
            for x in _texts(batch, text):
                packed = coder.encode_packed(x)
                n.append(len(packed) // 4)
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                decoded_sha.append(hashlib.sha256(coder.decode(memoryview(packed).cast("I").tolist()).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select("doc_id", text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
