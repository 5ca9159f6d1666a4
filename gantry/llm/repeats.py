"""Repeated passages across documents, by suffix order around shared anchors.

A passage of LENGTH bytes or more that two documents share contains, in both, the same anchor: the 24-byte string of least
hash in each LENGTH-byte window. So only anchors that occur twice are looked at, each with its context: the bytes before
it and after it that a window with this anchor can reach.

The contexts of an anchor are put in the order of their right sides, the suffixes that begin at the anchor, with the lengths of common prefixes of
neighbours. A scan with a stack gives the intervals of that order with a common prefix, and within each interval the same scan over the reversed left
sides tells where the left extensions differ. Each pair of such intervals with LENGTH bytes in all is a maximal repeat with all its occurrences (as far
as the contexts reach; a longer passage is a chain of overlapping repeats, which ``Repeats.groups`` joins). A byte is removed where a repeat covers it of which an occurrence lies
in a document of a smaller id.

Documents are kept in compressed blocks of a bounded size. Equal contexts of a block are one row, so are equal windows; an anchor with over HOT occurrences is
taken apart into its windows, each of which has one row for each block at most. So no group holds more than HOT contexts or
one row for each block. Exact copies are found first; all but the least id leave before anchors are taken.

Cases: a null text counts as empty; texts under LENGTH bytes lose nothing; rows with one id never remove bytes of each
other; a null id counts as the largest of 64-bit numbers; an empty table gives an empty result; extra columns are left out of
``repeated_bytes`` and pass through ``without_repeats``; a very long text is a block of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gantry.llm.shared import documents, drop_written, private, released, rows_of, written

LENGTH, ANCHOR = 50, 24
WINDOW = LENGTH - ANCHOR + 1
LEFT = LENGTH - ANCHOR
HOT = 2000
BLOCK_BYTES, STEP = 4 << 20, 1 << 20
#: Anchors and contexts that one partition holds at the most, about.
PART_ANCHORS, PART_CONTEXTS = 2_000_000, 100_000
#: Of zstd, for blocks and contexts: both are written once and shuffled twice or more.
LEVEL = 9
NO_ID = (1 << 63) - 1
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of two neighbouring strings from their hashes."""
    a = (a ^ (a >> np.uint64(31))) * _C1
    a += (b ^ (b >> np.uint64(29))) * _C2
    return a


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all strings of ANCHOR (16 + 8) bytes."""
    h = (data.astype(np.uint64) + np.uint64(1)) * _C2
    for n in (1, 2, 4):
        h = _join(h[: len(h) - n], h[n:])
    eight = h
    h = _join(h[: len(h) - 8], h[8:])
    h = _join(h[: len(h) - 8], eight[16:])
    return h ^ (h >> np.uint64(32))


def _window_hashes(windows: np.ndarray) -> np.ndarray:
    """Hashes of rows of LENGTH bytes."""
    wide = np.zeros((len(windows), -(-LENGTH // 8) * 8), np.uint8)
    wide[:, :LENGTH] = windows
    words = wide.view("<u8")
    h = words[:, 0].copy()
    for k in range(1, words.shape[1]):
        h = _join(h, words[:, k])
    return h ^ (h >> np.uint64(32))


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """Best of each ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        x = best(x[: len(x) - have], x[have:])
        have *= 2
    return best(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def anchors(data: np.ndarray, ends: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of the texts that end at ``ends`` in ``data``, without those to skip; STEP bytes at a time."""
    found = [_anchors(data, ends, skip, a, min(a + STEP, len(data))) for a in range(0, len(data), STEP)]
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def _anchors(data: np.ndarray, ends: np.ndarray, skip: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchors at positions a..b: all windows that hold such a position are in the part that is looked at."""
    low, high = max(0, a - WINDOW + 1), min(len(data), b + LENGTH)
    if high - low < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = _gram_hashes(data[low:high])
    order = (h * _C1 >> np.uint64(32)).astype(np.uint32)
    order |= np.uint32(1)
    least = _slide(order, WINDOW, np.minimum)
    first, last = np.searchsorted(ends, low, side="right"), np.searchsorted(ends, high, side="left")
    for i in range(first, min(last + 1, len(ends))):  # windows that begin in a text and don't end in it, or in one to skip
        s, e = (int(ends[i - 1]) if i else 0), int(ends[i])
        least[max(0, (s if skip[i] else max(s, e - LENGTH + 1)) - low) : max(0, e - low)] = 0
    pad = np.zeros(WINDOW - 1, np.uint32)
    most = _slide(np.concatenate([pad, least, pad]), WINDOW, np.maximum)
    at = np.flatnonzero(most == order)
    at = at[(at >= a - low) & (at < b - low)]
    return at + low, h[at]


class Block:
    """Documents of one block row."""

    def __init__(self, ids: bytes, sizes: bytes, text: bytes, copies: list[int] | None):
        self.ids, self.sizes = np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64)
        self.text = zstandard.ZstdDecompressor().decompress(text, max_output_size=max(1, int(self.sizes.sum())))
        self.data = np.frombuffer(self.text, np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.copy = np.zeros(len(self.ids), bool)
        self.copy[copies or []] = True

    def anchors(self):
        return anchors(self.data, self.ends, self.copy)


def blocks_of(df: DataFrame, key: str, text: str) -> DataFrame:
    """block, ids, sizes, hashes, bytes, the compressed text and flags of null ids of up to BLOCK_BYTES (or one document) a row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, made, rows, nulls, held = TaskContext.get().partitionId(), 0, [], [], 0

        def out() -> pa.RecordBatch:
            raw = [t for _, t in rows]
            hashes = b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in raw)
            row = [(part << 32) + made, np.array([i for i, _ in rows], np.int64).tobytes(), np.array([len(t) for t in raw], np.int64).tobytes(), hashes, held, zstandard.ZstdCompressor(LEVEL).compress(b"".join(raw)), bytes(nulls)]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.binary()])], names=["block", "ids", "sizes", "hashes", "bytes", "text", "nulls"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                t = (t or "").encode()
                if rows and held + len(t) > BLOCK_BYTES:
                    yield out()
                    made, rows, nulls, held = made + 1, [], [], 0
                rows.append((NO_ID if i is None else i, t))
                nulls.append(i is None)
                held += len(t)
        if rows:
            yield out()

    return df.select(F.col(key).cast("long"), text).mapInArrow(run, "block long, ids binary, sizes binary, hashes binary, bytes long, text binary, nulls binary")


def _copies(blocks: DataFrame) -> DataFrame:
    """block and the places in it of texts that a smaller id has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, hashes in rows_of(batches):
            ids, h = np.frombuffer(ids, np.int64), np.frombuffer(hashes, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), block)), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids), pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy())], names=["block", "place", "id", "h1", "h2"])

    rows = blocks.select("block", "ids", "hashes").mapInArrow(run, "block long, place int, id long, h1 long, h2 long")
    least = written(rows.groupBy("h1", "h2").agg(F.min("id").alias("least"), F.count("*").alias("n")).filter("n > 1").select("h1", "h2", "least"), "copies")
    return rows.join(least, ["h1", "h2"]).filter("id > least").groupBy("block").agg(F.collect_list("place").alias("copies"))


def _packed(hashes: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted hashes and their counts: bytes of the differences, plane by plane, as most of a plane is noise or zero."""
    planes = np.diff(hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(1).compress(np.ascontiguousarray(planes).tobytes() + counts.astype(np.int32).view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8)
    n = len(raw) // 12
    hashes = np.cumsum(np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(np.uint64).ravel(), dtype=np.uint64)
    return hashes, np.ascontiguousarray(raw[8 * n :].reshape(4, n).T).view(np.int32).ravel()


def _shared(blocks: DataFrame, parts: int) -> DataFrame:
    """block, cold and hot (packed 64-bit hashes): anchors with two occurrences or more, in the blocks that have them; rows by block and part of the hashes."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, ids, sizes, text, copies in rows_of(batches):
            hashes, counts = np.unique(Block(ids, sizes, text, copies).anchors()[1], return_counts=True)
            part = (hashes * _C1 >> np.uint64(33)) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            bounds = [0, *(np.flatnonzero(np.diff(part[order])) + 1).tolist(), len(order)] if len(order) else [0]
            picks = [order[a:b] for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(part[order[bounds[:-1]]].astype(np.int64)), pa.array([block] * len(picks), pa.int64()), pa.array([_packed(hashes[k], counts[k]) for k in picks], pa.binary())], names=["part", "block", "payload"])
        released()

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, mine in groupby(rows_of(batches), key=lambda r: r[0]):  # one part at a time
            blocks_, pieces = [], []
            for _, block, payload in mine:
                blocks_.append(block)
                pieces.append(_unpack(payload))
            sizes = [len(h) for h, _ in pieces]
            hashes, n = (np.concatenate(c) for c in zip(*pieces))
            order = np.argsort(hashes, kind="stable")
            starts = np.flatnonzero(np.concatenate([[True], np.diff(hashes[order]) != 0]))
            total = np.empty(len(hashes), np.int64)
            total[order] = np.repeat(np.add.reduceat(n[order].astype(np.int64), starts), np.diff(np.append(starts, len(hashes))))
            at = 0
            for block, size in zip(blocks_, sizes):
                h, t = hashes[at : at + size], total[at : at + size]
                at += size
                if (t > 1).any():
                    row = [block, h[(t > 1) & (t <= HOT)].tobytes(), h[t > max(1, HOT)].tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, [pa.int64(), pa.binary(), pa.binary()])], names=["block", "cold", "hot"])
            del pieces, hashes, n, order, starts, total, h, t
            released()

    rows = blocks.select("block", "ids", "sizes", "text", "copies").mapInArrow(found, "part long, block long, payload binary")
    return rows.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(both, "block long, cold binary, hot binary")


_CONTEXT = "block long, part long, payload binary"
_SPAN = LEFT + LENGTH


def _contexts(blocks: DataFrame, parts: int) -> DataFrame:
    """Rows (block, part, payload) of two kinds, compressed.

    With a part from 0 on: a block's contexts whose anchor's hash falls to that part, as numbers, hashes, least ids, and
    the bytes with the lengths of both sides. Part -1: the block's occurrences (document, position, context, left, right).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            yield from out(*row)
        released()

    def out(block, ids, sizes, text, copies, cold, hot) -> Iterator[pa.RecordBatch]:
        docs = Block(ids, sizes, text, copies)
        positions, hashes = docs.anchors()
        signed = hashes.view(np.int64)
        pick = np.isin(signed, np.frombuffer(b"".join(cold or []), np.int64))
        hits = positions[np.isin(signed, np.frombuffer(b"".join(hot or []), np.int64))]
        at, keys = positions[pick], signed[pick]
        doc = np.searchsorted(docs.ends, at, side="right")
        left, right = np.minimum(LEFT, at - docs.starts[doc]), np.minimum(LENGTH, docs.ends[doc] - at)
        windows = np.unique((hits[:, None] - np.arange(WINDOW)).ravel()) if len(hits) else hits
        windows = windows[windows >= 0]
        wdoc = np.searchsorted(docs.ends, windows, side="right")
        inside = (wdoc < len(docs.ends)) & (windows + LENGTH <= docs.ends[np.minimum(wdoc, len(docs.ends) - 1)])
        windows, wdoc = windows[inside], wdoc[inside]
        m = len(windows)
        at, doc = np.concatenate([at, windows]), np.concatenate([doc, wdoc])
        if m:
            keys = np.concatenate([keys, _window_hashes(np.lib.stride_tricks.sliding_window_view(docs.data, LENGTH)[windows]).view(np.int64)])
        left, right = np.concatenate([left, np.zeros(m, np.int64)]), np.concatenate([right, np.full(m, LENGTH)])
        whole = left + right >= LENGTH
        at, doc, keys, left, right = at[whole], doc[whole], keys[whole], left[whole], right[whole]
        if not len(at):
            return
        bytes_ = np.zeros((len(at), _SPAN + 2), np.uint8)
        padded = np.concatenate([np.zeros(LEFT, np.uint8), docs.data, np.zeros(LENGTH, np.uint8)])
        bytes_[:, :_SPAN] = np.lib.stride_tricks.sliding_window_view(padded, _SPAN)[at]
        column = np.arange(_SPAN)
        bytes_[:, :_SPAN][(column < (LEFT - left)[:, None]) | (column >= (LEFT + right)[:, None])] = 0
        bytes_[:, _SPAN], bytes_[:, _SPAN + 1] = left, right
        _, first, number = np.unique(bytes_.view(f"V{_SPAN + 2}").ravel(), return_index=True, return_inverse=True)
        least = np.full(len(first), NO_ID)
        np.minimum.at(least, number, docs.ids[doc])
        times = np.bincount(number, minlength=len(first)).astype(np.int64)
        pack = zstandard.ZstdCompressor(LEVEL).compress
        occurrences = np.stack([doc, at, number, left, right], 1).astype(np.int32)
        yield rows([block], [-1], [pack(occurrences.tobytes())])
        part = (keys[first].view(np.uint64) >> np.uint64(20)) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        bounds = [0, *(np.flatnonzero(np.diff(part[order])) + 1).tolist(), len(order)]
        payloads = []
        for a, b in zip(bounds, bounds[1:]):
            k = order[a:b]
            payloads.append(pack(b"".join([k.astype(np.int64).tobytes(), keys[first[k]].tobytes(), least[k].tobytes(), times[k].tobytes(), bytes_[first[k]].tobytes()])))
        yield rows([block] * len(payloads), part[order[bounds[:-1]]].astype(np.int64), payloads)

    def rows(block, part, payload) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(part, pa.int64()), pa.array(payload, pa.binary())], names=["block", "part", "payload"])

    return blocks.select("block", "ids", "sizes", "text", "copies", "cold", "hot").mapInArrow(run, _CONTEXT)


def _unpacked(block: int, payload: bytes) -> Iterator[tuple]:
    """(hash, block, context, left, right, least, times) of each context of a payload."""
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(payload)
    n = len(raw) // (32 + _SPAN + 2)
    number, key, least, times = (np.frombuffer(raw, np.int64, n, 8 * n * i).tolist() for i in range(4))
    at = 32 * n
    for i in range(n):
        row = raw[at : at + _SPAN + 2]
        at += _SPAN + 2
        yield key[i], block, number[i], row[LEFT - row[_SPAN] : LEFT], row[LEFT : LEFT + row[_SPAN + 1]], least[i], times[i]


def intervals(values: list[bytes], cap: int) -> Iterator[tuple[int, int, int]]:
    """(first, last, length) of the intervals of sorted strings with a common prefix, by a scan with a stack."""
    numbers = [int.from_bytes(v.ljust(cap, b"\0"), "big") for v in values]
    stack: list[tuple[int, int]] = []  # (length, first)
    for i in range(len(values)):
        if i + 1 < len(values):
            lcp = min(cap - (((numbers[i] ^ numbers[i + 1]).bit_length() + 7) >> 3), len(values[i]), len(values[i + 1]))
        else:
            lcp = -1
        first = i
        while stack and stack[-1][0] > lcp:
            length, first = stack.pop()
            yield first, i, length
        if lcp >= 0 and (not stack or stack[-1][0] < lcp):
            stack.append((lcp, first))


def maximal_repeats(contexts: list[tuple[bytes, bytes]]) -> Iterator[tuple[list[int], int, int]]:
    """(members, left, right) of each maximal repeat of LENGTH bytes or more among the contexts (left, right) of an anchor."""
    order = sorted(range(len(contexts)), key=lambda i: contexts[i][1])
    back = [c[0][::-1] for c in contexts]
    for a, b, right in intervals([contexts[i][1] for i in order], LENGTH):
        if right < LENGTH - LEFT:
            continue
        members = sorted(order[a : b + 1], key=back.__getitem__)
        for c, d, left in intervals([back[i] for i in members], LEFT):
            if left + right >= LENGTH:
                yield members[c : d + 1], left, right


def _groups(contexts: DataFrame, parts: int, run, schema: str) -> DataFrame:
    """``run``(rows of one anchor) for all anchors, where rows are (hash, block, context, left, right, least, times)."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in schema.split(", ")]
        held: list[tuple] = []

        def flush(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

        for _, part in groupby(rows_of(batches), key=lambda r: r[0]):  # one part at a time
            rows = sorted((r for _, block, payload in part for r in _unpacked(block, payload)), key=lambda r: r[0])
            for _, group in groupby(rows, key=lambda r: r[0]):
                held.extend(run(list(group)))
                if len(held) >= 20_000:
                    yield flush(held)
                    held = []
        if held:
            yield flush(held)

    rows = contexts.filter("NOT own").select("part", "block", "payload")
    return rows.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(each, schema)


def _covered(rows: list[tuple]) -> list[tuple]:
    """(block, context, left, right): how far around the anchor repeats reach that a smaller id has too."""
    if len(rows) < 2:
        return []
    reach = [(0, 0)] * len(rows)
    for members, left, right in maximal_repeats([(r[3], r[4]) for r in rows]):
        least = min(rows[i][5] for i in members)
        for i in members:
            if rows[i][5] > least:
                reach[i] = (max(reach[i][0], left), max(reach[i][1], right))
    return [(r[1], r[2], a, b) for r, (a, b) in zip(rows, reach) if a + b]


def _grouped(rows: list[tuple]) -> list[tuple]:
    """(hash, number, left, right, block, context) of each member of each maximal repeat of an anchor."""
    found = list(maximal_repeats([(r[3], r[4]) for r in rows]))
    whole = {i for members, left, right in found for i in members if (left, right) == (len(rows[i][3]), len(rows[i][4]))}
    found += [([i], len(r[3]), len(r[4])) for i, r in enumerate(rows) if r[6] > 1 and i not in whole]  # equal contexts of one block are one row
    return [(rows[0][0], k, left, right, rows[i][1], rows[i][2]) for k, (members, left, right) in enumerate(found) for i in members]


class Repeats:
    """The tables of a search for repeated passages in ``df``; each is written to the shared folder once."""

    def __init__(self, df: DataFrame, key: str = "doc_id", text: str = "text"):
        spark = df.sparkSession
        blocks = written(blocks_of(df, key, text), "blocks", "none")
        total = blocks.agg(F.sum("bytes")).first()[0] or 0
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.parts = max(least, total // (7 * PART_ANCHORS))
        copies = written(_copies(blocks), "copied")
        self.blocks = blocks.join(copies, "block", "left")
        shared = written(_shared(self.blocks, self.parts), "shared", "none")
        self.used = [blocks, copies]
        lists = shared.groupBy("block").agg(F.collect_list("cold").alias("cold"), F.collect_list("hot").alias("hot"))
        n = shared.agg(F.sum(F.octet_length("cold") + F.octet_length("hot"))).first()[0] or 0
        self.parts = max(least, n // 8 // PART_CONTEXTS)
        contexts = _contexts(self.blocks.join(lists, "block"), self.parts)
        self.contexts = written(contexts.withColumn("own", F.col("part") < 0), "contexts", "none", by=("own",))  # own: occurrences of a block
        drop_written(shared)
        self.used.append(self.contexts)

    def drop(self) -> None:
        """Deletes the tables of the search, once nothing reads them any more."""
        drop_written(*self.used)

    def reach(self) -> DataFrame:
        self.used.append(written(_groups(self.contexts, self.parts, _covered, "block long, context long, left long, right long"), "reach"))
        return self.used[-1]

    def groups(self) -> DataFrame:
        """hash, number (of the group), length, id, start: all occurrences of all maximal repeats, copies included.

        What repeats at several anchors with the same occurrences is one group. Exact copies make a group of their whole text.
        """
        fragments = written(self._fragments(), "fragments")
        group = ["hash", "number"]
        first = fragments.groupBy(*group).agg(F.min(F.struct("id", "doc", "start", "length")).alias("f")).select(*group, "f.*")
        origin = first.select(*group, F.col("id").alias("_id"), F.col("doc").alias("_doc"), F.col("start").alias("_start"))
        placed = fragments.join(origin, group)
        # sums of two hashes tell sets of occurrences, relative to the first, apart
        marks = [F.sum(F.xxhash64(F.lit(s), "doc", F.col("start") - F.col("_start")).cast("decimal(38,0)")).alias(f"mark{s}") for s in (1, 2)]
        sets = placed.groupBy(*group).agg(F.count("*").alias("n"), *marks).join(first, group)
        row = Window.partitionBy("n", "mark1", "mark2", "doc").orderBy("start", F.desc("length"), *group)
        ended = F.max(F.col("start") + F.col("length")).over(row.rowsBetween(Window.unboundedPreceding, -1))
        chained = sets.withColumn("new", F.coalesce((F.col("start") > ended).cast("int"), F.lit(1))).withColumn("chain", F.sum("new").over(row.rowsBetween(Window.unboundedPreceding, 0)))
        chain = ["n", "mark1", "mark2", "doc", "chain"]
        lengths = chained.groupBy(*chain).agg(F.min(F.struct("start", (-F.col("length")).alias("less"), *group)).alias("m"), (F.max(F.col("start") + F.col("length")) - F.min("start")).alias("length"))
        kept = lengths.select("m.hash", "m.number", "length")
        found = written(fragments.drop("length").join(kept, group), "found")  # a chain begins where its first fragment does
        documents_ = self._documents()
        same = documents_.groupBy("h1", "h2").agg(F.count("*").alias("times"), F.min(F.struct("id", "doc")).alias("m")).filter("times > 1").select("h1", "h2", F.col("m.doc").alias("_doc"))
        equal = written(documents_.join(same, ["h1", "h2"]), "equal")
        again = found.join(equal.filter("copy").select(F.col("_doc").alias("doc"), F.col("id").alias("_id")), "doc").select(*group, "length", F.col("_id").alias("id"), "start")
        wholes = equal.filter(F.col("size") >= LENGTH).select(F.col("h1").alias("hash"), F.lit(-1).cast("long").alias("number"), F.col("size").alias("length"), "id", F.lit(0).cast("long").alias("start"))
        parts = found.select(*group, "length", "id", "start").union(again)
        return parts.union(wholes).withColumn("id", F.when(F.col("id") != NO_ID, F.col("id")))

    def _documents(self) -> DataFrame:
        """doc (block and place in it), id, size, h1, h2 (of the text) and copy (whether a smaller id has the text) of each row."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, ids, sizes, hashes, copies in zip(*[c.to_pylist() for c in batch.columns]):
                    ids, sizes, h = np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int64), np.frombuffer(hashes, np.int64).reshape(-1, 2)
                    copy = np.zeros(len(ids), bool)
                    copy[copies or []] = True
                    columns = [np.full(len(ids), block), np.arange(len(ids)), ids, sizes, h[:, 0].copy(), h[:, 1].copy(), copy]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "place", "id", "size", "h1", "h2", "copy"])

        rows = self.blocks.select("block", "ids", "sizes", "hashes", "copies").mapInArrow(run, "block long, place long, id long, size long, h1 long, h2 long, copy boolean")
        return rows.select(F.struct("block", "place").alias("doc"), "id", "size", "h1", "h2", "copy")

    def _fragments(self) -> DataFrame:
        """hash, number, length, id, doc, start: all occurrences of all maximal repeats within contexts, without exact copies."""
        members = _groups(self.contexts, self.parts, _grouped, "hash long, number long, left long, right long, block long, context long")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, raw, ids, sizes in zip(*[c.to_pylist() for c in batch.columns]):
                    x = _occurrences(raw)
                    starts = np.cumsum(np.frombuffer(sizes, np.int64)) - np.frombuffer(sizes, np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), block)), pa.array(x[:, 2].copy()), pa.array(np.frombuffer(ids, np.int64)[x[:, 0]]), pa.array(x[:, 0].copy()), pa.array(x[:, 1] - starts[x[:, 0]])], names=["block", "context", "id", "place", "at"])

        packed = self.contexts.filter("own").select("block", F.col("payload").alias("occurrences")).join(self.blocks.select("block", "ids", "sizes"), "block")
        places = packed.select("block", "occurrences", "ids", "sizes").mapInArrow(run, "block long, context long, id long, place long, at long")
        return members.join(places, ["block", "context"]).select("hash", "number", (F.col("left") + F.col("right")).alias("length"), "id", F.struct("block", "place").alias("doc"), (F.col("at") - F.col("left")).alias("start"))

    def spans(self, run, schema) -> DataFrame:
        """``run``(block, covered bytes) for each block. Contexts go once their reach is known: ``groups`` comes before, or from a search of its own."""
        reach = self.reach().groupBy("block").agg(F.collect_list(F.struct("context", "left", "right")).alias("reach"))
        drop_written(self.contexts, folder="own=false")
        packed = self.contexts.filter("own").select("block", F.col("payload").alias("occurrences"))
        rows = self.blocks.drop("hashes", "bytes").join(packed, "block", "left").join(reach, "block", "left")
        rows = rows.select("block", "ids", "sizes", "text", "copies", "occurrences", F.col("reach.context").alias("c"), F.col("reach.left").alias("l"), F.col("reach.right").alias("r"), "nulls")

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, ids, sizes, text, copies, occurrences, c, left, right, nulls in rows_of(batches):
                docs = Block(ids, sizes, text, copies)
                docs.nulls = np.frombuffer(nulls, np.bool_)
                yield from run(docs, _mask(docs, occurrences, c or [], left or [], right or []))
            released()

        return rows.mapInArrow(each, schema)


def _occurrences(raw: bytes | None) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompressobj().decompress(raw), np.int32).reshape(-1, 5).astype(np.int64) if raw else np.zeros((0, 5), np.int64)


def _mask(docs: Block, occurrences: bytes | None, c: list[int], left: list[int], right: list[int]) -> np.ndarray:
    """Which bytes of a block go."""
    doc, at, context, l_all, r_all = _occurrences(occurrences).T
    n = int(context.max()) + 1 if len(context) else 0
    reach = np.zeros((2, n), np.int64)
    reach[:, c] = left, right
    least = np.full(n, NO_ID)
    ids = docs.ids[doc]
    np.minimum.at(least, context, ids)
    later = ids > least[context]
    a, b = np.where(later, l_all, reach[0][context]), np.where(later, r_all, reach[1][context])
    edge = np.bincount(at - a, minlength=len(docs.data) + 1) - np.bincount(at + b, minlength=len(docs.data) + 1)
    mask = np.cumsum(edge)[:-1] > 0
    for i in np.flatnonzero(docs.copy & (docs.sizes >= LENGTH)):
        mask[docs.starts[i] : docs.ends[i]] = True
    return mask


_REMAINING = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def repeated_bytes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the remaining bytes) of each row."""
    return _remaining(Repeats(df, key, text)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept")


def _remaining(repeats: Repeats) -> DataFrame:
    """The columns of ``repeated_bytes``, and the md5 of the text where bytes go."""

    def run(docs: Block, mask: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = []
        for i, null, s, e in zip(docs.ids.tolist(), docs.nulls.tolist(), docs.starts.tolist(), docs.ends.tolist()):
            gone = mask[s:e]
            spans = int(np.count_nonzero(gone[1:] & ~gone[:-1])) + int(e > s and gone[0])
            rows.append((None if null else i, e - s, int(np.count_nonzero(gone)), spans, docs.data[s:e][~gone].tobytes() if spans else docs.text[s:e], hashlib.md5(docs.text[s:e]).hexdigest() if spans else None))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "hash"])

    return repeats.spans(run, _REMAINING + ", hash string")


def without_repeats(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the text that remains. A character of which a byte went goes whole. Rows of one key (or null) and different texts each keep their own."""
    names = private(df, "_key", "_hash", "_kept")
    repeats = Repeats(df, key, text)
    kept = written(_remaining(repeats).filter("n_removed > 0").select(*[F.col(c).alias(n) for c, n in zip(("doc_id", "hash", "kept"), names)]), "kept")
    repeats.drop()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([None if x is None else x.decode("utf-8", "ignore") for x in batch.column(2).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=names)

    decoded = kept.mapInArrow(run, f"{names[0]} long, {names[1]} string, {names[2]} string").dropDuplicates(names[:2])  # equal rows lose the same bytes
    joined = df.join(decoded, F.col(key).cast("long").eqNullSafe(F.col(names[0])) & (F.md5(F.col(text).cast("binary")) == F.col(names[1])), "left")
    return joined.withColumn(text, F.coalesce(names[2], text)).select(*df.columns)


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_bytes(documents(spark, sf_dir))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
