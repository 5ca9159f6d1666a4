"""Language-model scores by context-tree weighting over binary-decomposed bytes.

A text is its words, joined by single spaces, and an end byte. Each byte is eight binary decisions; each decision is
estimated by the Krichevsky-Trofimov rule at every context of up to DEPTH bytes before, and the estimates of all depths are mixed with the
weights that context-tree weighting gives them after all training texts. The tree holds every context that occurs at least LEAST times
before a training byte, at every size of the corpus; the rarer continuations of a context share one child, so every training byte counts at every depth.

The tree is never in one place. Each block of documents sends its distinct strings of DEPTH bytes and the byte after them, with their
training counts, to the part that their last SPLIT context bytes belong to. A part adds them up, has the whole subtrees below those bytes, and weighs them
one decision at a time. What a subtree adds to the decisions at the last byte goes to the driver (256 * 255 sums at most, whatever the
corpus), which weighs the top; then each part sends each block the log probabilities of the strings it asked for.

Word counts of the unigram base go by blocks of documents in the same way: a block
sends each distinct word once and gets its corpus count back, so a frequent word is one row for each block.

DEPTH, the longest context in bytes, is a parameter of the model, and so is SPLIT: a part holds whole subtrees of SPLIT context bytes.

Cases: a null or empty text is the end alone; without training text every byte has probability 1/256 and no token is known;
equal texts get equal scores; rows may repeat; a null doc_id is a training row; an empty table gives an empty result;
extra columns are left out; a very long text is a block of its own.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import groupby
from math import log10

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.llm.shared import documents, released, written

DEPTH, SPLIT, LEAST = 6, 2, 2
END = 10
PAD = bytes([END]) * DEPTH
BLOCK_BYTES = 16 << 20


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


# Blocks -------------------------------------------------------------------------------------------------------------


_BLOCK = "block long, ids binary, nulls binary, held binary, tokens binary, sizes binary, text binary, train_texts long, train_tokens long"


def blocks_of(df: DataFrame, key: str = "doc_id", text: str = "text", hold: Callable = held_out) -> DataFrame:
    """block, ids, nulls and held (a flag each), tokens and sizes (bytes) with the end, the compressed texts, each after DEPTH end bytes, and sums over training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, ids, texts, tokens, bytes_ = TaskContext.get().partitionId(), 0, [], [], [], 0
        names = [c.split()[0] for c in _BLOCK.split(", ")]
        kinds = [pa.int64(), *[pa.binary()] * 6, pa.int64(), pa.int64()]

        def out() -> pa.RecordBatch:
            held = np.array([hold(i) for i in ids], bool)
            n = np.array(tokens, np.int64)
            packed = zstandard.ZstdCompressor(1).compress(b"".join(PAD + t + b"\n" for t in texts))
            row = [(part << 32) + made, np.array([i or 0 for i in ids], np.int64).tobytes(), bytes(i is None for i in ids), held.tobytes(), n.tobytes(), np.array([len(t) + 1 for t in texts], np.int64).tobytes(), packed, int((~held).sum()), int(n[~held].sum())]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names=names)

        for batch in batches:
            for at in range(batch.num_rows):  # texts may be long: one at a time
                i, words = batch.column(0)[at].as_py(), (batch.column(1)[at].as_py() or "").encode().lower().split()
                t = b" ".join(words)
                if ids and bytes_ + len(t) > BLOCK_BYTES:
                    yield out()
                    made, ids, texts, tokens, bytes_ = made + 1, [], [], [], 0
                ids.append(i)
                texts.append(t)
                tokens.append(len(words) + 1)
                bytes_ += len(t)
        if ids:
            yield out()

    return df.select(F.col(key).cast("long"), text).mapInArrow(run, _BLOCK)


class Block:
    def __init__(self, held: bytes, sizes: bytes, text: bytes):
        self.held, self.sizes = np.frombuffer(held, np.bool_), np.frombuffer(sizes, np.int64)
        self.text = zstandard.ZstdDecompressor().decompress(text, max_output_size=int((self.sizes + DEPTH).sum()))
        self.ends = np.cumsum(self.sizes + DEPTH)
        self.begins = self.ends - self.sizes - DEPTH
        self.data = np.frombuffer(self.text, np.uint8)
        self.own = np.ones(len(self.text), bool)  # flags of the bytes of texts, ends included
        for k in range(DEPTH):
            self.own[self.begins + k] = False

    def words(self) -> Iterator[tuple[bool, list[bytes]]]:
        for hold, end, size in zip(self.held.tolist(), self.ends.tolist(), self.sizes.tolist()):
            yield hold, self.text[end - size : end].split()

    def steps(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """Ranges of positions and their strings, those of pads too."""
        for a in range(DEPTH, len(self.data), STEP):
            b = min(len(self.data), a + STEP)
            yield a, b, strings(self.data, a, b)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct strings of all texts, in order, and how often each occurs in training texts."""
        train = np.repeat(~self.held, self.sizes + DEPTH)
        found, held, n = [], [], 0

        def gather() -> None:
            g = np.concatenate(held or [np.zeros(0, np.int64)])
            held.clear()
            g.sort()
            first = np.flatnonzero(np.concatenate([np.ones(min(1, len(g)), bool), (g[1:] ^ g[:-1]) > 1]))
            found.append((g[first] >> 1, np.add.reduceat(g & 1, first) if len(g) else first))

        for a, b, mine in self.steps():
            held.append((mine << 1 | train[a:b])[self.own[a:b]])
            n += b - a
            if n >= SORTED:
                gather()
                n = 0
        gather()
        return added(*map(list, zip(*found)))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):  # a row is a whole block: one at a time
            yield tuple(c[i].as_py() for c in batch.columns)


# Contexts -----------------------------------------------------------------------------------------------------------


#: Positions that are looked at, and strings that are sorted, at a time.
STEP, SORTED = 1 << 18, 1 << 22
#: Strings that a part gathers before it adds them up.
GATHERED = 2_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def strings(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """The DEPTH bytes before each of the bytes a..b of x, the last one highest, and the byte itself lowest."""
    g = np.zeros(b - a, np.int64)
    for k in range(1, DEPTH + 1):
        g <<= 8
        g |= x[a - k : b - k]
    return g << 8 | x[a:b]


def part_of(g: np.ndarray, parts: int) -> np.ndarray:
    """The part of each string: all of one subtree go to one."""
    return (((g >> 8 * (DEPTH - SPLIT + 1)).astype(np.uint64) + np.uint64(1)) * _MIX >> np.uint64(33)) % np.uint64(parts)


def added(g: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct strings in order and the sums of their counts."""
    g, n = np.concatenate(g), np.concatenate(n)
    order = np.argsort(g, kind="stable")
    g = g[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(g)), bool), g[1:] != g[:-1]]))
    return g[first], np.add.reduceat(n[order], first) if len(first) else n


def _packed(g: np.ndarray, n: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(np.diff(g, prepend=0).tobytes() + n.astype(np.int64).tobytes())


def _unpacked(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.int64).reshape(2, -1)
    return np.cumsum(both[0]), both[1]


_PIECE = "part long, block long, payload binary"


def _pieces(part: list[int], block: list[int], payload: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(block, pa.int64()), pa.array(payload, pa.binary())], names=["part", "block", "payload"])


def block_strings(blocks: DataFrame, parts: int) -> DataFrame:
    """part, block, payload: the distinct strings of each block and how often they occur in its training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, held, sizes, text in _rows(batches):
            g, n = Block(held, sizes, text).distinct()
            part = part_of(g, parts)
            order = np.argsort(part, kind="stable")
            bounds = [0, *(np.flatnonzero(np.diff(part[order])) + 1).tolist(), len(order)]
            payloads = [_packed(g[k], n[k]) for k in (order[a:b] for a, b in zip(bounds, bounds[1:]))]
            yield _pieces(part[order[bounds[:-1]]].astype(np.int64), [number] * len(payloads), payloads)

    return blocks.select("block", "held", "sizes", "text").mapInArrow(run, _PIECE)


def subtrees(pieces: DataFrame, parts: int) -> DataFrame:
    """part, block (-1), payload: all strings of a part with their training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in groupby(_rows(batches), key=lambda r: r[0]):
            g, n, more = [], [], 0
            for _, payload in rows:
                one = _unpacked(payload)
                g.append(one[0])
                n.append(one[1])
                more += len(one[0])
                if more > GATHERED:
                    (g, n), more = [[c] for c in added(g, n)], 0
            yield _pieces([part], [-1], [_packed(*added(g, n))])

    return pieces.select("part", "payload").repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, _PIECE)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Log gamma of x >= 0.5: Stirling's series after a shift by eight."""
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        shift += np.log(y)
        y += 1
    inv = 1 / y
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + inv / 12 - inv**3 / 360 + inv**5 / 1260 - shift


_SMALL = 4096
_TABLES = {add: _lgamma(np.arange(_SMALL) + add) for add in (0.5, 1.0)}


def _lgamma_plus(n: np.ndarray, add: float) -> np.ndarray:
    out = _TABLES[add].take(np.minimum(n, _SMALL - 1))
    if len(large := np.flatnonzero(n >= _SMALL)):
        out[large] = _lgamma(n[large] + add)
    return out


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a zeros and b ones in a given order."""
    return _lgamma_plus(a, 0.5) + _lgamma_plus(b, 0.5) - _lgamma_plus(a + b, 1.0) - np.log(np.pi)


def _kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (b + 0.5) / (a + b + 1)


def _sums(at: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(at, values, size)


class Decisions:
    """The estimates of one of the eight decisions at the contexts of one depth, an entry for each context and the bits decided before."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray, exists: np.ndarray, below: np.ndarray | None = None):
        """``below``: zeros, ones and log probability of the longer contexts of the tree, by entry; without, there are none."""
        self.zeros, self.ones, self.exists = zeros, ones, exists
        self.rest = (zeros, ones) if below is None else (zeros - below[0].astype(np.int64), ones - below[1].astype(np.int64))
        own, split = _log_kt(zeros, ones), _log_kt(*self.rest) + (0 if below is None else below[2])
        self.both = np.logaddexp(own, split) - np.log(2)
        self.stop = 0.5 * np.exp(own - self.both)

    def sent(self, parent: np.ndarray, size: int) -> np.ndarray:
        """``below`` of the next shorter contexts."""
        return np.stack([_sums(parent, c * self.exists, size) for c in (self.zeros, self.ones, self.both)])

    def path(self, summed: np.ndarray, going: np.ndarray, one: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What is summed on the way to each context and the weight of going on, and the probability of a one at the deepest context, from those of the shorter one."""
        summed = summed + going * self.stop * _kt(self.zeros, self.ones)
        going = going * (1 - self.stop)
        return summed, going, np.where(self.exists, summed + going * _kt(*self.rest), one)


class Subtrees:
    """The contexts of SPLIT to DEPTH bytes of a part: for each depth the distinct strings of context and byte."""

    def __init__(self, g: np.ndarray, n: np.ndarray, least: int):
        self.levels = []  # (strings, counts, flags of those whose context is in the tree, place of each in the next level)
        for d in range(DEPTH, SPLIT - 1, -1):
            first = np.concatenate([[True], g[1:] >> 8 != g[:-1] >> 8])
            node = np.cumsum(first) - 1
            exists = (np.add.reduceat(n, np.flatnonzero(first)) >= least)[node]
            if d == SPLIT:
                self.levels.append((g, n, exists, None))
                break
            up, place = np.unique(g >> 16 << 8 | g & 255, return_inverse=True)
            self.levels.append((g, n, exists, place))
            g, n = up, np.bincount(place, n, len(up)).astype(np.int64)

    def decided(self, k: int) -> list[tuple[Decisions, np.ndarray, np.ndarray]]:
        """For each depth from DEPTH on: decisions after k bits, the entry of each string, and the parent's entry of each entry."""
        entries = []
        for g, _, _, _ in self.levels:
            change = np.concatenate([[True], g[1:] >> (8 - k) != g[:-1] >> (8 - k)])
            entries.append((np.cumsum(change) - 1, np.flatnonzero(change)))
        out, below = [], None
        for i, (g, n, exists, place) in enumerate(self.levels):
            of, first = entries[i]
            ones = np.add.reduceat(n * (g >> (7 - k) & 1), first)
            x = Decisions(np.add.reduceat(n, first) - ones, ones, exists[first], below)
            if place is None:
                e = g[first] >> (8 - k)  # two context bytes and k bits; of the parent's, the last byte and the bits
                out.append((x, of, e >> (8 * (SPLIT - 1) + k) << k | e & ((1 << k) - 1)))
            else:
                parent = entries[i + 1][0][place[first]]
                below = x.sent(parent, len(entries[i + 1][1]))
                out.append((x, of, parent))
        return out

    def logs(self, top: list[tuple]) -> np.ndarray:
        """log10 probability of the byte of each string."""
        total = np.zeros(len(self.levels[0][0]))
        for k in range(8):
            entry, *path = top[k]
            for x, of, parent in reversed(self.decided(k)):
                at = np.searchsorted(entry, parent) if entry is not None else parent
                entry, path = None, x.path(*[c[at] for c in path])
            one = np.clip(path[2], 1e-12, 1 - 1e-12)[of]
            total += np.log10(np.where(self.levels[0][0] >> (7 - k) & 1, one, 1 - one))
        return total


#: Units of log probabilities that are summed as whole numbers, so that their order doesn't matter.
UNIT = 1 << 20


def tops(trees: DataFrame, least: int) -> list[tuple]:
    """For each of the eight decisions: entries (last byte and bits), and what ``Decisions.path`` gives there; from sums over all subtrees."""
    columns = ["zeros", "ones", "z", "o", "both"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (payload,) in _rows(batches):
            tree = Subtrees(*_unpacked(payload), least)
            for k in range(8):
                x, _, parent = tree.decided(k)[-1]
                entry, at = np.unique(parent, return_inverse=True)
                whole = [_sums(at, c, len(entry)) for c in (x.zeros, x.ones)]
                z, o, both = x.sent(at, len(entry))
                arrays = [np.full(len(entry), k), entry, *[np.rint(c).astype(np.int64) for c in (*whole, z, o, both * UNIT)]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in arrays], names=["k", "entry", *columns])

    sums = trees.select("payload").mapInArrow(run, "k long, entry long, " + ", ".join(f"{c} long" for c in columns))
    rows = sums.groupBy("k", "entry").agg(*[F.sum(c).alias(c) for c in columns]).collect()  # at most 256 * 255
    out = []
    total: dict[int, int] = {r["entry"]: r["zeros"] + r["ones"] for r in rows if r["k"] == 0}
    for k in range(8):
        mine = sorted(tuple(r)[1:] for r in rows if r["k"] == k)
        entry, zeros, ones, z, o, both = np.array(mine, np.int64).reshape(-1, 6).T
        exists = np.array([total[e] >= least for e in (entry >> k).tolist()], bool)
        last = Decisions(zeros, ones, exists, np.stack([z, o, both / UNIT]))
        size = 1 << k
        at = entry & (size - 1)
        root = Decisions(_sums(at, zeros, size).astype(np.int64), _sums(at, ones, size).astype(np.int64), np.ones(size, bool), last.sent(at, size))
        path = root.path(np.zeros(size), np.ones(size), np.zeros(size))
        out.append((entry, *last.path(*[c[at] for c in path])))
    return out


def string_logs(pieces: DataFrame, trees: DataFrame, top: list[tuple], least: int, parts: int) -> DataFrame:
    """part, block, payload: log10 probabilities of the strings of each piece, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, rows in groupby(_rows(batches), key=lambda r: r[0]):
            g = logs = None
            for _, block, payload in rows:
                keys, n = _unpacked(payload)
                if block < 0:  # comes first
                    g, logs = keys, Subtrees(keys, n, least).logs(top).astype(np.float32)
                else:
                    yield _pieces([part], [block], [logs[np.searchsorted(g, keys)].tobytes()])

    return pieces.union(trees).repartition(parts, "part").sortWithinPartitions("part", "block").mapInArrow(run, _PIECE)


def context_logs(blocks: DataFrame, parts: int) -> DataFrame:
    """part, block, payload: log10 probabilities of the distinct strings of each block, by the tree of all training texts."""
    pieces = written(block_strings(blocks, parts), "strings", "none")
    trees = written(subtrees(pieces, parts), "subtrees", "none")
    return string_logs(pieces, trees, tops(trees, LEAST), LEAST, parts)


class Lookup:
    """Values of distinct strings, found by open addressing."""

    def __init__(self, g: np.ndarray, values: np.ndarray):
        bits = max(1, (2 * len(g)).bit_length())
        self.last, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.float32)
        left, at = np.arange(len(g)), self._place(g)
        while len(left):
            free = self.keys[at] == -1
            self.keys[at[free]] = g[left[free]]
            won = self.keys[at] == g[left]
            self.values[at[won]] = values[left[won]]
            left, at = left[~won], at[~won] + 1 & self.last

    def _place(self, g: np.ndarray) -> np.ndarray:
        return (g.astype(np.uint64) * _MIX >> self.shift).astype(np.int64)

    def get(self, g: np.ndarray) -> np.ndarray:
        """Values of strings, all of which are known."""
        at = self._place(g)
        left = np.flatnonzero(self.keys.take(at) != g)
        while len(left):
            at[left] = at[left] + 1 & self.last
            left = left[self.keys.take(at[left]) != g[left]]
        return self.values.take(at)


def scores(block: Block, logs: list, parts: int) -> np.ndarray:
    """log10 probability of each text of a block from the pieces (part, payload) of ``context_logs``."""
    g, _ = block.distinct()
    part, values = part_of(g, parts), np.zeros(len(g), np.float32)
    order = np.argsort(part, kind="stable")
    place = part[order]
    for p, payload in logs:
        values[order[np.searchsorted(place, np.uint64(p)) : np.searchsorted(place, np.uint64(p), side="right")]] = np.frombuffer(payload, np.float32)
    known, out = Lookup(g, values), np.zeros(len(block.sizes))
    for a, b, found in block.steps():
        own = block.own[a:b]
        total = np.zeros(b - a)
        total[own] = known.get(found[own])
        first, last = np.searchsorted(block.begins, a, side="right") - 1, np.searchsorted(block.begins, b)
        out[first:last] += np.add.reduceat(total, np.maximum(block.begins[first:last] - a, 0))
    return out


# Words --------------------------------------------------------------------------------------------------------------


def word_counts(blocks: DataFrame, parts: int) -> DataFrame:
    """block, words (joined by spaces), counts: training counts in the corpus of each block's distinct words, in pieces.

    A row with a null block counts the distinct training words.
    """

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, held, sizes, text in _rows(batches):
            seen: Counter = Counter()
            others: set[bytes] = set()
            for hold, words in Block(held, sizes, text).words():
                others.update(words) if hold else seen.update(words)
            words = [*seen, *others.difference(seen)]
            n = np.zeros(len(words), np.int64)
            n[: len(seen)] = list(seen.values())
            for at in range(0, len(words), 50_000):
                part = words[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array(np.full(len(part), block)), pa.array(n[at : at + 50_000])], names=["word", "block", "n"])

    def corpus(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        word = pa.chunked_array([b.column(0) for b in held]).combine_chunks().dictionary_encode()
        block, n = (np.concatenate([b.column(i).to_numpy() for b in held]) for i in (1, 2))
        code = word.indices.to_numpy()
        counts = np.zeros(len(word.dictionary), np.int64)
        np.add.at(counts, code, n)
        names = ["block", "words", "counts"]
        kinds = [pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array([None], kinds[0]), pa.array([b""], kinds[1]), pa.array([np.array([np.count_nonzero(counts)]).tobytes()], kinds[2])], names=names)
        order = np.argsort(block, kind="stable")
        bounds = [0, *(np.flatnonzero(np.diff(block[order])) + 1).tolist(), len(order)]
        words = word.dictionary.to_pylist()
        for a, b in zip(bounds, bounds[1:]):
            mine = code[order[a:b]]
            row = [int(block[order[a]]), b" ".join([words[i] for i in mine]), counts[mine].tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds)], names=names)

    rows = blocks.select("block", "held", "sizes", "text").mapInArrow(distinct, "word binary, block long, n long")
    return rows.repartition(parts, "word").mapInArrow(corpus, "block long, words binary, counts binary")


def scored(df: DataFrame, key: str = "doc_id", text: str = "text", hold: Callable = held_out) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row."""
    spark = df.sparkSession
    blocks = written(blocks_of(df, key, text, hold), "texts", "none")
    size = blocks.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // (8 << 20))
    counts = written(word_counts(blocks, parts), "words")
    row = blocks.agg(F.sum("train_texts"), F.sum("train_tokens")).first()
    n_texts, n_tokens = row[0] or 0, row[1] or 0
    distinct = sum(int(np.frombuffer(r["counts"], np.int64)[0]) for r in counts.filter("block IS NULL").select("counts").collect()) + (n_texts > 0)  # a row for each part
    below = log10(n_tokens + distinct + 1)
    unseen = log10(1) - below

    # all that belongs to a block, in the order of ``kind``: its texts, the logs of its strings, the counts of its words
    columns = ["block", "kind", "part", "ids", "nulls", "held", "tokens", "sizes", "text", "counts"]
    types = dict(block="long", kind="int", part="long") | {c: "binary" for c in columns[3:]}
    row_of = lambda d, kind, **has: d.select(*[F.lit(kind).alias(c) if c == "kind" else F.col(has.get(c, c)).alias(c) if has.get(c, c) in d.columns else F.lit(None).cast(types[c]).alias(c) for c in columns])
    logs = context_logs(blocks, parts)
    rows = row_of(blocks, 0).unionByName(row_of(logs, 1, text="payload")).unionByName(row_of(counts.filter("block IS NOT NULL"), 2, text="words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, mine in groupby(_rows(batches), key=lambda r: r[0]):
            _, _, _, ids, nulls, held, tokens, sizes, texts, _ = next(mine)
            block, pieces, score = Block(held, sizes, texts), [], None
            known = {b"\n": n_texts}
            for _, kind, part, *_, payload, found in mine:
                if kind == 1:
                    pieces.append((part, payload))
                    continue
                if score is None:
                    score, pieces = scores(block, pieces, parts), []
                known.update(zip(payload.split(), np.frombuffer(found, np.int64).tolist()))
            if score is None:  # no words at all
                score = scores(block, pieces, parts)
            for w, c in known.items():
                known[w] = log10(c + 1) - below if c else unseen
            end, n_known, base = known[b"\n"], [], []
            for _, words in block.words():
                got = [end, *map(known.__getitem__, words)]
                n_known.append(len(got) - got.count(unseen))
                base.append(sum(got))
            keys = pa.array(np.frombuffer(ids, np.int64), mask=np.frombuffer(nulls, np.bool_))
            found = [keys, pa.array(block.held), pa.array(np.frombuffer(tokens, np.int64)), pa.array(n_known, pa.int64()), pa.array(np.full(len(keys), n_tokens)), pa.array(base, pa.float64()), pa.array(score)]
            yield pa.RecordBatch.from_arrays(found, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        released()

    dealt = rows.repartition(parts, "block").sortWithinPartitions("block", "kind")
    return dealt.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op9_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(documents(spark, sf_dir))
