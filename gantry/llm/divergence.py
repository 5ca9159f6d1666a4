"""Divergence between the sources of each language, in exact integers: heavy terms in dense tiles, rare ones by their postings.

Each source of a language has a share p of each of the language's terms, in parts of a thousand million, smoothed so that every source has a share of every term. The
divergence of two sources is the sum of (p - q)**2 // (p + q) over all terms. Were both without any term, it would be V times the value of their two base shares; each term that one of them
has corrects that sum, so only terms that occur are looked at:

- A heavy term, in over 1 / HEAVY of the language's sources, is a row of a dense numpy tile, terms by sources, base shares where it doesn't occur; a tile gives all its pairs at once.
- A rare term gives its few postings. Where one source has it, the correction against another depends on the two shares alone, so equal shares are counted and
  measured once; where both have it, a further correction for the pair takes the place of the two single ones.

A task gets a slice of a language's terms for two blocks of its sources: at most about TERMS * 2 * BLOCK postings, however large one source or language is, and gives one partial sum
a pair. Counts of words are made a task's documents at a time, before the shuffle.

Cases: null text, lang and source are empty strings, and an empty language or source is one like any other; rows may repeat, each is a document; a source without words has the base share
of each term; a language without terms has divergences of 0 and no terms to report; ties go by the item's UTF-8 bytes; very long texts are split PIECE bytes at a time; an empty table gives an
empty result; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gantry.llm.shared import documents, sliced, written

LEAST_DOCS, TOP = 10, 10
SCALE = 1_000_000_000
HEAVY, BLOCK, TERMS = 4, 256, 2048
PIECE = 1 << 20
#: Different (source, term) that a task holds before it sends their counts on.
HELD = 300_000
#: Letters and bytes beyond ASCII as they are, A-Z in lower case; all others are spaces.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def _terms(raw: bytes) -> Iterator[list[bytes]]:
    raw = raw.translate(_TERMS)
    at = 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE) if len(raw) - at > PIECE else -1
        end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text) to (lang, source, term, n, docs) of some documents at a time."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def flushed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            text = pa.array(terms, pa.binary()).cast(pa.string())
            same = lambda x: pa.array([x], pa.string()).take(pa.array(np.zeros(len(terms), np.int32)))  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays([same(lang), same(source), text, pa.array([n[t] for t in terms], pa.int64()), pa.array([docs[t] for t in terms], pa.int64())], names=["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in sliced(batches, 2):
        langs, sources, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())
        for lang, source, raw in zip(langs, sources, texts):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            own: set[bytes] = set()
            for terms in _terms(raw.as_py()):
                n.update(terms)
                own.update(terms)
            docs.update(own)
        if sum(len(n) for n, _ in held.values()) > HELD:
            yield from flushed()
    yield from flushed()


def share(n: Column, of: Column) -> Column:
    """1 + SCALE * n // of, exact while ``of`` is below 9 * 10**15: three digits of the quotient at a time."""
    one, rest = F.call_function("div", n * 1000, of), (n * 1000) % of
    two, rest2 = F.call_function("div", rest * 1000, of), (rest * 1000) % of
    return (one * 1_000_000 + two * 1000 + F.call_function("div", rest2 * 1000, of) + 1).cast("long")


def gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


def tile_sums(term: np.ndarray, at: np.ndarray, p: np.ndarray, heavy: np.ndarray, bases: np.ndarray, split: int) -> np.ndarray:
    """Sum over terms of the gap less the gap of the bases, for each pair of a row and a column source.

    Postings (term, source, share) are in the order of term and source; sources 0 to split - 1 are the rows, the others the columns. With ``split`` = 0 all are both, and the sums lie above the diagonal.
    """
    n = len(bases)
    rows = n if not split else split
    out = np.zeros((n, n), np.int64)
    base_gap = _gap(bases[:, None], bases[None, :])
    if heavy.any():
        names, row = np.unique(term[heavy], return_inverse=True)
        dense = np.tile(bases, (len(names), 1))
        dense[row, at[heavy]] = p[heavy]
        for a in range(rows):
            others = slice(split or a + 1, n)
            out[a, others] += _gap(dense[:, a, None], dense[:, others]).sum(0) - len(names) * base_gap[a, others]
    rare = ~heavy
    term, at, p = term[rare], at[rare], p[rare]
    if len(term):
        shares, count = np.unique(np.stack([at, p]), axis=1, return_counts=True)
        single = np.zeros((n, n), np.int64)
        for a in np.unique(shares[0]):
            own = shares[0] == a
            single[a] = ((_gap(shares[1][own, None], bases[None, :]) - base_gap[a]) * count[own, None]).sum(0)
        out += single + single.T
        for k in range(1, len(term)):  # as many steps as the longest list of postings has
            i = np.flatnonzero(term[k:] == term[:-k])
            if not len(i):
                break
            a, b = at[i], at[i + k]
            both = _gap(p[i], p[i + k]) - _gap(p[i], bases[b]) - _gap(bases[a], p[i + k]) + base_gap[a, b]
            np.add.at(out, (a, b), both)
    return out


def tiles(block: int):
    """The function of a slice of terms for two blocks of sources: partial sums of their pairs."""

    def tile(key: tuple, postings: pa.Table, sources: pa.Table) -> pa.Table:
        lang, first, second = (k.as_py() for k in key[:3])
        idx, bases = (sources.column(c).to_numpy() for c in ("idx", "base"))
        order = np.argsort(idx)
        idx, bases = idx[order], bases[order]
        split = 0 if first == second else int(np.searchsorted(idx, (first + 1) * block))
        term = postings.column("term").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
        at = np.searchsorted(idx, postings.column("idx").to_numpy())
        p, heavy = postings.column("p").to_numpy(), postings.column("heavy").to_numpy().astype(bool)
        order = np.lexsort((at, term))
        sums = tile_sums(term[order], at[order], p[order], heavy[order], bases, split)
        a, b = np.nonzero(sums)
        use = (a < b) if not split else (a < split) & (b >= split)
        a, b = a[use], b[use]
        return pa.table({"lang": pa.array([lang] * len(a), pa.string()), "a": pa.array(idx[a], pa.int32()), "b": pa.array(idx[b], pa.int32()), "part": pa.array(sums[a, b], pa.int64())})

    return tile


def kept_terms(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, n, postings) of the terms in at least ``least`` documents of a language; postings: source and count there. ``docs`` has lang, source and text without nulls."""
    counts = docs.select("lang", "source", "text").mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
    by_source = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("postings"))
    return by_term.filter(F.col("docs") >= least).drop("docs")


def divergences(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): all other sources of the language by divergence, and the ``top`` terms that mark the source."""
    docs = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    terms = written(kept_terms(docs, least), "terms")
    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("n").alias("lang_n"))
    sums = terms.select("lang", F.explode("postings").alias("o")).groupBy("lang", "o.source").agg(F.sum("o.n").alias("n"))
    groups = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    total = F.coalesce("n", F.lit(0)) + 2 * F.coalesce("v", F.lit(0))
    groups = groups.select(
        "lang",
        "source",
        (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("idx"),
        F.count("*").over(Window.partitionBy("lang")).alias("n_sources"),
        F.coalesce("v", F.lit(0)).cast("long").alias("v"),
        (F.col("lang_n") + 2 * F.col("v")).alias("lang_total"),
        total.alias("total"),
        F.when(total > 0, share(F.lit(2).cast("long"), F.when(total > 0, total))).alias("base"),
    )
    groups = written(groups, "groups")

    each = terms.select("lang", "term", F.col("n").alias("lang_n"), F.size("postings").alias("m"), F.explode("postings").alias("o")).select("lang", "term", "lang_n", "m", "o.source", "o.n")
    shares = each.join(groups, ["lang", "source"]).withColumns({"p": share(F.col("n") + 2, F.col("total")), "q": share(F.col("lang_n") + 2, F.col("lang_total"))})

    marked = shares.filter(F.col("p") > F.col("q")).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))
    ranked = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).cast("int"))
    marked = ranked(marked).filter(F.col("rank") <= top)

    block = lambda c: F.floor(F.col(c) / BLOCK).cast("int")
    slices = F.ceil(F.col("v") / TERMS).cast("int")
    partner = F.explode(F.sequence(F.lit(0), F.ceil(F.col("n_sources") / BLOCK).cast("int") - 1))
    in_order = [F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second")]
    postings = shares.select("lang", "term", "idx", "p", (F.col("m") * HEAVY > F.col("n_sources")).alias("heavy"), F.pmod(F.xxhash64("term"), slices).cast("int").alias("slice"), block("idx").alias("block"), partner.alias("other"))
    sources = groups.filter("v > 0").select(*[F.col(c).alias(c) for c in ("lang", "idx", "base")], block("idx").alias("block"), partner.alias("other"), slices.alias("slices")).select("*", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    left = postings.select("lang", *in_order, "slice", "term", "idx", "p", "heavy").groupBy("lang", "first", "second", "slice")
    right = sources.select("lang", *in_order, "slice", "idx", "base").groupBy("lang", "first", "second", "slice")
    parts = left.cogroup(right).applyInArrow(tiles(BLOCK), "lang string, a int, b int, part bigint").groupBy("lang", "a", "b").agg(F.sum("part").alias("sum"))

    one = groups.select("lang", "source", F.col("idx").alias("i"), F.col("base").alias("p"), "v")
    two = groups.select("lang", F.col("source").alias("item"), F.col("idx").alias("j"), F.col("base").alias("q"))
    pairs = one.join(two, "lang").filter("i <> j").withColumns({"a": F.least("i", "j"), "b": F.greatest("i", "j")}).join(parts, ["lang", "a", "b"], "left")
    value = F.when(F.col("v") > 0, F.col("v") * gap(F.col("p"), F.col("q")) + F.coalesce("sum", F.lit(0))).otherwise(0).cast("long")
    pairs = ranked(pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")))
    return pairs.unionByName(marked)


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(documents(spark, sf_dir))


OP13_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
words AS MATERIALIZED (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs) GROUP BY ALL),
terms AS MATERIALIZED (SELECT lang, term, sum(n) AS n FROM words GROUP BY 1, 2 HAVING count(*) >= 10),
langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM terms GROUP BY 1),
groups AS MATERIALIZED (SELECT DISTINCT lang, source FROM docs),
counts AS MATERIALIZED (SELECT lang, source, term, sum(n) AS n FROM words SEMI JOIN terms USING (lang, term) GROUP BY 1, 2, 3),
shares AS MATERIALIZED (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM (SELECT lang, source, term, coalesce(c.n, 0)::HUGEINT AS n, l.v FROM groups JOIN terms USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term))),
lang_shares AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (t.n + 2)) // (l.n + 2 * l.v) AS q FROM terms t JOIN langs l USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
found AS (
SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
UNION ALL
SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM shares JOIN lang_shares USING (lang, term) WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found QUALIFY part = 'pair' OR rank <= 10
"""
