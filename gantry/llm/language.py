"""Language identification by cross-parsing entropy.

For each language a suffix automaton is built of labelled text; it recognises every substring of it. A document is
parsed greedily into the longest phrases each automaton knows, and the phrases, times the bits of a position in the training text, over the
document's length estimate the cross entropy. The language with the least wins.

Training reads a bounded sample of every language: its labelled documents in the order of a hash of doc_id and text, until
TRAIN_ROWS of them or TRAIN_BYTES are reached; the document that reaches the bytes is cut there. Documents to be predicted are whole. A bound on that hash, from
the number of a language's different documents, leaves about SPARE * TRAIN_ROWS of them to be ranked, however large the corpus is and however often one is repeated.

Documents walk the automata PIECE_BYTES at a time, in blocks of BLOCK bytes side by side. Each block is parsed as if a phrase began with it; then blocks that continue a text
are walked again from the state the block before has ended in, until both parses are in one state, from where on they are the same. So a phrase may
cross any number of blocks, and the count is that of the parse of the whole text.

Automata are held for LANGUAGES languages at a time: where there are more, about HELD bytes of documents are kept and walk one group of languages after the other.

Cases: a null text or one without a letter (Unicode category L) is ``und`` with score 0; without labelled text all are; a very long text is one more run of blocks;
of languages with equal entropies the first by name wins, with score 0; equal texts get equal
results; rows may repeat, also in training, where equal rows count once; an empty table gives an empty result; extra columns are left out or, in ``identify``,
passed through, where lang_pred and score replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gantry.llm.shared import PIECE_BYTES, documents, released, sliced

UNKNOWN = "und"
LANGUAGES, HELD = 16, 32 << 20
TRAIN_ROWS, TRAIN_BYTES = 300, 50_000
#: Values of the hash of a training document, and how many times TRAIN_ROWS documents a language has below the bound on it, about.
HASHES, SPARE = 1 << 40, 4
BLOCK = 1024
LETTER = regex.compile(r"\p{L}")
_PLAIN = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
DEAD, ROOT = 0, 1


def normal(text: str) -> bytes:
    """Lower-case letters as UTF-8, everything else of ASCII as single spaces."""
    return b" ".join(text.lower().encode("utf-8", "replace").translate(_PLAIN).split())


def automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of ``text``: from ROOT, exactly its substrings are readable."""
    moves: list[dict[int, int]] = [{}, {}]
    length, link = [0, 0], [0, 0]
    last = ROOT
    for c in text:
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(ROOT)
        p = last
        while p and c not in moves[p]:
            moves[p][c] = new
            p = link[p]
        if p:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and moves[p].get(c) == q:
                    moves[p][c] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return moves


class Automaton:
    """The automaton of one text as arrays: states with one move keep it; the others have a row in a table. Class 0 stands for bytes the text doesn't have."""

    def __init__(self, text: bytes):
        moves, seen = automaton(text), sorted(set(text))
        self.classes = np.zeros(256, np.uint8)
        self.classes[seen] = np.arange(1, len(seen) + 1)
        self.width = len(seen) + 1
        self.bits = log2(len(text) + 2)
        self.only, self.to = np.full(len(moves), 255, np.uint8), np.zeros(len(moves), np.int32)
        self.row = np.zeros(len(moves), np.int32)
        wide = [s for s, m in enumerate(moves) if len(m) > 1 or s == ROOT]
        self.row[wide] = np.arange(1, len(wide) + 1)
        self.table = np.zeros((len(wide) + 1) * self.width, np.int32)
        classes = self.classes.tolist()
        for k, s in enumerate(wide):
            for c, t in moves[s].items():
                self.table[(k + 1) * self.width + classes[c]] = t
        for s, m in enumerate(moves):
            if len(m) == 1 and s != ROOT:
                [(c, self.to[s])] = m.items()
                self.only[s] = classes[c]
        root = self.table[self.row[ROOT] * self.width :][: self.width]
        self.strange = (root == DEAD).astype(np.int32)
        self.first = np.where(root == DEAD, ROOT, root).astype(np.int32)

    def walk(self, state: np.ndarray, count: np.ndarray, c: np.ndarray) -> np.ndarray:
        """States after one more byte of each; ``count`` gets the phrases that end."""
        to = self.table.take(self.row.take(state) * self.width + c)
        to = np.where(self.only.take(state) == c, self.to.take(state), to)
        stop = np.flatnonzero(to == DEAD)
        if len(stop):
            at = c[stop]
            count[stop] += (state[stop] != ROOT) + self.strange[at]
            to[stop] = self.first[at]
        return to


class CrossParser:
    """The automata of some languages."""

    def __init__(self, texts: dict[str, bytes]):
        self.languages = sorted(texts)
        self.automata = [Automaton(texts[x]) for x in self.languages]
        self.bits = np.array([a.bits for a in self.automata])

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns)."""
        sizes = np.array([len(x) for x in texts], np.int64)
        if not sizes.sum() or not self.languages:
            return np.zeros((len(texts), len(self.languages)), np.int64)
        raw, blocks = _Blocks(sizes), np.frombuffer(b"".join(texts), np.uint8)
        return np.stack([raw.phrases(a, a.classes[blocks]) for a in self.automata], 1)

    def entropy(self, plain: list[bytes]) -> np.ndarray:
        """Bits a byte of each text (rows) in each language (columns)."""
        return self.phrases(plain) * self.bits / np.maximum([len(x) for x in plain], 1)[:, None]


class _Blocks:
    """Texts of these sizes, one after the other, in blocks of at most BLOCK bytes."""

    def __init__(self, sizes: np.ndarray):
        blocks = -(-sizes // BLOCK)
        self.texts = len(sizes)
        self.owner = np.repeat(np.arange(len(sizes)), blocks)
        within = (np.arange(len(self.owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * BLOCK
        self.begin = np.repeat(np.cumsum(sizes) - sizes, blocks) + within
        self.length = np.minimum(BLOCK, np.repeat(sizes, blocks) - within)
        self.follows = np.flatnonzero(within > 0)
        self.last = within + BLOCK >= np.repeat(sizes, blocks)

    def phrases(self, of: Automaton, codes: np.ndarray) -> np.ndarray:
        order = np.argsort(-self.length, kind="stable")
        begin, length = self.begin[order], self.length[order]
        alive = np.searchsorted(-length, -np.arange(1, length[0] + 1), side="right")  # blocks of at least so many bytes
        state, count = np.full(len(order), ROOT, np.int32), np.zeros(len(order), np.int64)
        for t in range(length[0]):
            n = alive[t]
            state[:n] = of.walk(state[:n], count[:n], codes[begin[:n] + t])
        ends, counts = np.empty_like(state), np.empty_like(count)
        ends[order], counts[order] = state, count
        more, ends = self._continued(of, codes, ends)
        return np.bincount(self.owner, counts + more + (self.last & (ends != ROOT)), self.texts).astype(np.int64)

    def _continued(self, of: Automaton, codes: np.ndarray, alone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each block, the phrases that the whole text's parse has there more than its own, and the state in which the former leaves it."""
        more, ends = np.zeros(len(alone), np.int64), alone.copy()
        todo = self.follows[alone[self.follows - 1] != ROOT]
        while len(todo):
            real, guess = ends[todo - 1], np.full(len(todo), ROOT, np.int32)
            n_real, n_guess = np.zeros(len(todo), np.int64), np.zeros(len(todo), np.int64)
            left = alone[todo]
            k = np.arange(len(todo))  # those whose two parses differ still
            for t in range(BLOCK):
                done = t >= self.length[todo[k]]
                left[k[done]] = real[done]
                keep = ~done & (real != guess)
                k, real, guess = k[keep], real[keep], guess[keep]
                if not len(k):
                    break
                c = codes[self.begin[todo[k]] + t]
                a, b = n_real[k], n_guess[k]
                real, guess = of.walk(real, a, c), of.walk(guess, b, c)
                n_real[k], n_guess[k] = a, b
            left[k] = real
            more[todo] = n_real - n_guess
            changed = todo[left != ends[todo]]
            ends[todo] = left
            todo = changed[~self.last[changed]] + 1
        return more, ends


def predict(training: dict[str, bytes], texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text, by all languages."""
    languages = sorted(training)
    if not languages:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    plain = [normal(x) if x and LETTER.search(x) else b"" for x in texts]
    groups = [{x: training[x] for x in languages[i : i + LANGUAGES]} for i in range(0, len(languages), LANGUAGES)]
    entropy = np.concatenate([parser(g).entropy(plain) for g in groups], 1)
    ranked = np.argsort(entropy, axis=1, kind="stable")
    rows = np.arange(len(texts))
    best = entropy[rows, ranked[:, 0]]
    second = entropy[rows, ranked[:, 1]] if len(languages) > 1 else np.full(len(texts), np.inf)
    score = np.where(second > 0, 1 - best / np.where(second > 0, second, 1), 0.0)
    names = [languages[i] if n else UNKNOWN for i, n in zip(ranked[:, 0], plain)]
    return names, [float(s) if n else 0.0 for s, n in zip(score, plain)]


def training_texts(labelled: DataFrame, key: str = "doc_id", lang: str = "lang", text: str = "text") -> dict[str, bytes]:
    """Language to text of the bounded sample, from rows with a language and a text."""
    h = F.pmod(F.xxhash64(key, text), F.lit(HASHES))
    rows = labelled.select(F.col(lang).alias("lang"), h.alias("h"), F.col(text).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    different = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}  # a row for each language
    if not different:
        return {}
    ends = [F.lit(x) for lang, n in different.items() for x in (lang, min(HASHES, -(-HASHES * SPARE * TRAIN_ROWS // n)))]
    begin = F.substring(F.col("text").cast("binary"), 1, TRAIN_BYTES)  # all that training can take of a document
    once = rows.filter(F.col("h") < F.create_map(*ends)[F.col("lang")]).groupBy("lang", "h").agg(F.min(begin).alias("begin"))
    order = Window.partitionBy("lang").orderBy("h")
    first = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TRAIN_ROWS)
    before = F.coalesce(F.sum(F.octet_length("begin")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    texts: dict[str, bytes] = {}
    for r in first.withColumn("before", before).filter(F.col("before") < TRAIN_BYTES).sort("lang", "h").select("lang", "begin").collect():
        if len(got := texts.get(r["lang"], b"")) < TRAIN_BYTES:
            texts[r["lang"]] = (got + b" " + normal(bytes(r["begin"]).decode("utf-8", "ignore")))[:TRAIN_BYTES]
    return {k: v for k, v in texts.items() if v.strip()}


_PARSERS: dict[int, tuple[dict, CrossParser]] = {}


def parser(texts: dict[str, bytes]) -> CrossParser:
    """The task's parser of these texts, built once."""
    key = hash(tuple(sorted(texts.items())))
    if key not in _PARSERS or _PARSERS[key][0] != texts:
        _PARSERS.clear()
        _PARSERS[key] = (texts, CrossParser(texts))
    return _PARSERS[key][1]


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of about HELD bytes, so that few walks share the work of building each group of automata."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.nbytes for b in held) >= HELD:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def identify(df: DataFrame, texts: dict[str, bytes], text: str = "text", found: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``df`` with language and score of each whole text, in columns ``found``."""
    rest = [c for c in df.columns if c not in found]
    schema = df.select(*rest).schema.add(found[0], "string").add(found[1], "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        few, at = len(texts) <= LANGUAGES, rest.index(text)
        for batch in sliced(batches if few else _joined(batches), at, PIECE_BYTES if few else HELD, 1 << 30):
            names, scores = predict(texts, batch.column(at).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*rest, *found])
        _PARSERS.clear()
        released()

    return df.select(*rest).mapInArrow(run, schema)


def with_letters(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text has a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            yield batch.filter(pa.array([bool(x and LETTER.search(x)) for x in texts], pa.bool_()))

    return df.mapInArrow(run, df.schema)


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    texts = training_texts(docs.filter(~held_out(F.col("doc_id"))))
    found = identify(docs.select("doc_id", "text"), texts)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
