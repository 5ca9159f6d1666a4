"""Near-duplicates by min-max hashing, with links confirmed on full shingle sets.

Under each hash function both the least and the greatest value of a shingle set are kept, so HASHES evaluations give
2 * HASHES values of the signature; each agrees between two sets with their Jaccard similarity as probability. Bands of ROWS values
make candidates: sets of a similarity of 0.8 share none of the bands with a probability under 2e-5.

Equal sets are one node from the start. In each bucket the least node is the pivot; every other node's similarity to
it is computed on full sets, the nodes of a pivot being dealt out over SALTS groups, each of which gets the pivot's set once. Nodes that link with their pivot need no more tests among each other. A node that doesn't
is tested against all nodes that share that pivot, except where the triangle inequality of the Jaccard distance rules a link out; groups are
dealt out in blocks, so no task holds more than two blocks. Thus no pair in a bucket stays undecided, and no
list of all pairs is made. Components come from the confirmed links.

Cases: a null or empty text, or one without words, has no shingles and links with nothing; one with fewer words than a shingle is one
shingle of all its words; a very long text is hashed whole, as a slice of its own; all ties go to the least id or node; repeated rows and equal texts share a component; a null doc_id is never a component's least id
unless all its ids are null; an empty table gives an empty result; extra columns are left out of
``near_duplicates`` and pass through ``keep_first``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, LongType

from gantry.llm.components import components
from gantry.llm.shared import documents, drop_written, private, released, sliced, written

SHINGLE, PERCENT = 5, 80
HASHES, ROWS = 108, 6
BANDS = 2 * HASHES // ROWS
BLOCK, SALTS = 400, 64
_NODE = "decimal(38,0)"
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _WordHashes()
_RNG = np.random.default_rng(20_240_601)
_A = _RNG.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def shingle_sets(texts: list[str | None], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text: words between ASCII white space, A-Z lower-cased."""
    if len(_WORDS) > 400_000:
        _WORDS.clear()
    words = [(x or "").encode().lower().split() for x in texts]
    flat = np.fromiter((_WORDS[w] for ws in words for w in ws), np.uint64, sum(map(len, words)))
    sets, at = [], 0
    for ws in words:
        n = len(ws)
        h = flat[at : at + n]
        at += n
        k = min(size, n)
        acc = np.full(max(n - k + 1, 0) if n else 0, k, np.uint64)
        for j in range(k):
            acc = mix(acc * _M1 + h[j : j + len(acc)])
        sets.append(np.unique(acc))
    return sets


def bands(sets: list[np.ndarray]) -> np.ndarray:
    """Band keys of non-empty sets, a row each."""
    values, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    signature = np.empty((2 * HASHES, len(sets)), np.uint64)
    for i in range(HASHES):
        h = values * _A[i] + _B[i]
        h ^= h >> np.uint64(32)
        np.minimum.reduceat(h, starts, out=signature[2 * i])
        np.maximum.reduceat(h, starts, out=signature[2 * i + 1])
    keys = np.empty((len(sets), BANDS), np.uint64)
    for b in range(BANDS):
        acc = np.full(len(sets), b + 1, np.uint64)
        for j in range(ROWS):
            acc = mix(acc * _M1 + signature[b * ROWS + j])
        keys[:, b] = acc
    return keys.view(np.int64)


def _nodes(sets: list[np.ndarray]) -> pa.Array:
    """126-bit digests of sets as decimals; null for an empty set."""
    raw = np.zeros((len(sets), 16), np.uint8)
    for i, s in enumerate(sets):
        raw[i] = np.frombuffer(hashlib.blake2b(s.tobytes(), digest_size=16).digest(), np.uint8)
    raw[:, 15] &= 63
    valid = np.packbits([len(s) > 0 for s in sets], bitorder="little")
    return pa.Array.from_buffers(pa.decimal128(38, 0), len(sets), [pa.py_buffer(valid.tobytes()), pa.py_buffer(raw.tobytes())])


def signed(df: DataFrame, size: int) -> DataFrame:
    """row, n_shingles, node and bands of each row of (row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1, rows=500):
            sets = shingle_sets(batch.column(1).to_pylist(), size)
            full = [s for s in sets if len(s)]
            keys = bands(full).ravel() if full else np.zeros(0, np.int64)
            offsets = np.concatenate([[0], np.cumsum([BANDS * (len(s) > 0) for s in sets])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int64()), _nodes(sets), lists], names=["row", "n_shingles", "node", "bands"])
        _WORDS.clear()
        released()

    schema = df.select("row").schema.add("n_shingles", "long").add("node", DecimalType(38, 0)).add("bands", ArrayType(LongType()))
    return df.select("row", "text").mapInArrow(run, schema)


def _sets_of(df: DataFrame, size: int) -> DataFrame:
    """node and set (packed hashes) of each row of (node, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 1):
            sets = shingle_sets(batch.column(1).to_pylist(), size)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "set"])
        _WORDS.clear()
        released()

    return df.select("node", "text").mapInArrow(run, f"node {_NODE}, set binary")


def _with_pivot(rows: DataFrame) -> DataFrame:
    """p, s, x, common, nx, np: sizes of the sets and of their intersection, of rows (p, s, x, set), where the pivot's own row, without x, comes first in each group (p, s)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot = np.zeros(0, np.uint64)
        for batch in sliced(batches, 3):
            common, nx, np_ = [], [], []
            own = batch.column(2).is_null().to_pylist()
            for is_pivot, raw in zip(own, batch.column(3)):
                found = np.frombuffer(raw.as_buffer(), np.uint64)
                if is_pivot:
                    pivot = found.copy()
                    continue
                at = np.minimum(np.searchsorted(pivot, found), len(pivot) - 1)
                common.append(int(np.count_nonzero(pivot[at] == found)))
                np_.append(len(pivot))
                nx.append(len(found))
            rest = batch.select([0, 1, 2]).filter(pa.array([not x for x in own]))
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(common, pa.int64()), pa.array(nx, pa.int64()), pa.array(np_, pa.int64())], names=["p", "s", "x", "common", "nx", "np"])

    return rows.select("p", "s", "x", "set").mapInArrow(run, f"p {_NODE}, s int, x {_NODE}, common long, nx long, np long")


def _linked(common, union) -> bool:
    return 100 * common >= PERCENT * union


class _Group:
    """Members of one block pair: failing nodes to test, and the nodes to test them against."""

    def __init__(self):
        self.probe: list[tuple] = []
        self.other: list[tuple] = []

    def links(self) -> Iterator[tuple]:
        """Confirmed links, each of which joins two parts of the group; the pivot's own links make the first part."""
        if not self.probe or not self.other:
            return
        sizes = np.array([len(o[2]) // 8 for o in self.other])
        far = np.array([o[1] for o in self.other])
        values = np.frombuffer(b"".join(o[2] for o in self.other), np.uint64)
        vocabulary, index = np.unique(values, return_inverse=True)
        starts = np.cumsum(sizes) - sizes
        part = {o[0]: "pivot" if o[3] else o[0] for o in self.other}
        members: dict = {}
        for x, root in part.items():
            members.setdefault(root, []).append(x)
        for x, d, raw, _ in self.probe:
            if x not in part:
                part[x] = x
                members[x] = [x]
            s = np.frombuffer(raw, np.uint64)
            near = np.flatnonzero((np.abs(far - d) <= 1 - PERCENT / 100 + 1e-9) & (100 * np.minimum(sizes, len(s)) >= PERCENT * np.maximum(sizes, len(s))))
            if not len(near):
                continue
            at = np.searchsorted(vocabulary, s)
            at = at[at < len(vocabulary)]
            mark = np.zeros(len(vocabulary), np.int32)
            mark[at[np.isin(vocabulary[at], s, assume_unique=True)]] = 1
            common = np.add.reduceat(mark[index], starts)
            for k in near[_linked(common[near], sizes[near] + len(s) - common[near])]:
                y = self.other[k][0]
                a, b = part[x], part[y]
                if a != b:
                    small, large = sorted((a, b), key=lambda r: len(members[r]))
                    for z in members[small]:
                        part[z] = large
                    members[large] += members.pop(small)
                    yield x, y


def _block_links(rows: DataFrame) -> DataFrame:
    """u, v: links found in groups (p, bx, by) of rows (p, bx, by, probe, x, d, xs, linked), sorted by group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, group = None, _Group()

        def out(links: list[tuple]) -> pa.RecordBatch:
            kind = pa.decimal128(38, 0)
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], kind), pa.array([b for _, b in links], kind)], names=["u", "v"])

        for batch in batches:
            for p, bx, by, probe, x, d, xs, linked in zip(*[c.to_pylist() for c in batch.columns]):
                if (p, bx, by) != key:
                    yield out(list(group.links()))
                    key, group = (p, bx, by), _Group()
                (group.probe if probe else group.other).append((x, d, xs, linked))
        yield out(list(group.links()))

    return rows.select("p", "bx", "by", "probe", "x", "d", "xs", "linked").mapInArrow(run, f"u {_NODE}, v {_NODE}")


def links(rows: DataFrame, texts: DataFrame, size: int) -> tuple[DataFrame, list[DataFrame]]:
    """Confirmed links u, v between nodes, and the written tables they are made of. ``rows`` is what ``signed`` gives, written; ``texts`` has row and text."""
    member = rows.filter("node IS NOT NULL").select(F.explode("bands").alias("band"), F.col("node").alias("x")).distinct()
    bucket = member.groupBy("band").agg(F.min("x").alias("p"), F.count("*").alias("n")).filter("n > 1").select("band", "p")
    salt = F.pmod(F.xxhash64("x"), F.lit(SALTS)).cast("int").alias("s")
    edges = written(member.join(bucket, "band").filter("x <> p").select("p", "x").distinct().select("p", salt, "x"), "edges")
    wanted = edges.select(F.col("p").alias("node")).unionByName(edges.select(F.col("x").alias("node"))).distinct()
    pick = rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("row").alias("row")).join(wanted, "node", "left_semi")
    sets = written(_sets_of(texts.join(pick, "row").select("node", "text"), size).dropDuplicates(["node"]), "sets", "none")
    others = edges.join(sets.withColumnRenamed("node", "x"), "x").select("p", "s", "x", "set")
    pivots = edges.select("p", "s").distinct().join(sets.withColumnRenamed("node", "p"), "p").select("p", "s", F.lit(None).cast(_NODE).alias("x"), "set")
    dealt = pivots.unionByName(others).repartition("p", "s").sortWithinPartitions("p", "s", F.asc_nulls_first("x"))
    tested = _with_pivot(dealt).withColumn("d", 1 - F.col("common") / (F.col("nx") + F.col("np") - F.col("common")))
    tested = written(tested.withColumn("linked", 100 * F.col("common") >= PERCENT * (F.col("nx") + F.col("np") - F.col("common"))), "tested")
    open_ = tested.groupBy("p").agg(F.count("*").alias("n"), F.count_if(~F.col("linked")).alias("f")).filter("n > 1 AND f > 0")
    open_ = open_.select("p", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s"), F.ceil(F.col("n") / BLOCK).cast("int").alias("nb"), F.ceil(F.col("f") / BLOCK).cast("int").alias("fb"))
    members = tested.select("p", "s", "x", "d", "linked").join(open_, ["p", "s"])
    block = lambda n: F.pmod(F.xxhash64("x"), n).cast("int")
    probes = members.filter(~F.col("linked")).select("p", "x", "d", "linked", F.lit(True).alias("probe"), block(F.col("fb")).alias("bx"), F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("by"))
    others = members.select("p", "x", "d", "linked", F.lit(False).alias("probe"), F.explode(F.sequence(F.lit(0), F.col("fb") - 1)).alias("bx"), block(F.col("nb")).alias("by"))
    dealt = probes.unionByName(others).join(sets.select(F.col("node").alias("x"), F.col("set").alias("xs")), "x")
    more = _block_links(dealt.repartition("p", "bx", "by").sortWithinPartitions("p", "bx", "by"))
    return tested.filter("linked").select(F.col("p").alias("u"), F.col("x").alias("v")).unionByName(more), [edges, sets, tested]


def near_duplicates(df: DataFrame, size: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row: ``key``, h (hash of the text), n_shingles, component_id (the least key reachable) and kept (key = component_id)."""
    row = F.struct(F.col(key).alias("key"), F.xxhash64(text).alias("h"))
    texts = df.select(row.alias("row"), F.col(text).alias("text"))
    rows = written(signed(texts, size), "signed")
    linked, used = links(rows, texts, size)
    found = components(linked)
    drop_written(*used)
    first = rows.filter("node IS NOT NULL").groupBy("node").agg(F.min("row.key").alias("first"))
    labelled = first.join(found.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left").withColumn("root", F.coalesce("root", "node"))
    labelled = written(labelled, "labelled")
    least = written(labelled.groupBy("root").agg(F.min("first").alias("component")), "least")
    by_node = written(labelled.join(least, "root").select("node", "component"), "classes")
    drop_written(labelled, least, found)
    classes = rows.select("row", "n_shingles", "node").join(by_node, "node", "left")
    component = F.coalesce("component", "row.key")
    kept = F.col("row.key").eqNullSafe(component)
    return classes.select(F.col("row.key").alias(key), F.col("row.h").alias("h"), "n_shingles", component.alias("component_id"), kept.alias("kept"))


def keep_first(df: DataFrame, size: int = SHINGLE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` with the least key of their component; of repeated rows one stays."""
    first, second = private(df, "_first", "_second")
    # two hashes of key and text tell rows apart; not null, so one shuffle of the rows serves join and duplicates
    marks = lambda k, h: {first: F.xxhash64(k, h), second: F.xxhash64(h, F.lit(7), k)}
    kept = near_duplicates(df, size, key, text).filter("kept").select(*[m.alias(n) for n, m in marks(F.col(key), F.col("h")).items()])
    marked = df.withColumns(marks(F.col(key), F.xxhash64(text)))
    return marked.dropDuplicates([first, second]).join(kept, [first, second], "left_semi").select(*df.columns)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), 2).select("doc_id", "n_shingles", "component_id", "kept")
