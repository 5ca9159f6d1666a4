"""Token counts under edits.

A document's text is split into pre-tokens, between which no token lies. Leaves of a segment tree hold a run of them: their text, their
lengths and their token counts; the nodes above hold sums of characters and tokens. An edit finds its place by descending the character sums, and
takes the pre-tokens it touches with a context before and after in which the split may change. That region alone is split anew, up to the first old boundary
that is one again; pre-tokens that were not there are encoded, and the differences of the sums go up the paths. The token count of the whole text is the root's sum.

``trees`` keeps the tree of each document as a row; ``edited`` takes such a table and a table of edits, and gives the trees after them, without encoding what no edit has touched.
``counted`` does both for edits that a function of the text gives, in one pass without a shuffle.

Cases: a null text is empty; edits apply in the order of ``seq``, each to the text the ones before have left (of two with one ``seq`` and document, in the order of start, end and text); an edit beyond
the end is clipped, null positions are 0 and a null new text is empty; an empty list of edits
re-encodes nothing; a very long pre-token is encoded whole and not cached; rows may repeat, and an edit applies to each row of its doc_id; edits of a null or unknown doc_id apply to nothing; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.llm.packing import LONG, PATTERN, ChunkTokenizer, tokenizer
from gantry.llm.shared import documents, sliced

LEAF = 64
#: Characters around an edit in which the split of the old text may change, at the least: the pattern looks at most so far beyond a pre-token.
CONTEXT = 3
DIGITS = regex.compile("[0-9]+")
_PRETOKEN = regex.compile(PATTERN)


class Splitter:
    """Pre-tokens of texts and how many tokens they have, for a tokenizer file; added tokens are pre-tokens of their own."""

    def __init__(self, coder: ChunkTokenizer):
        if coder.ranked is None or not coder.plain:
            raise ValueError("token trees need a byte-level file without stripping added tokens")
        self.coder = coder
        self.added = regex.compile(f"({coder.added.pattern})") if coder.added else None
        self.context = max(CONTEXT, coder.added_width)
        self.sizes: dict[str, int] = {}

    def split(self, text: str) -> list[str]:
        if self.added is None or not self.added.search(text):
            return _PRETOKEN.findall(text)
        out = []
        for i, part in enumerate(self.added.split(text)):
            out += [part] if i % 2 else _PRETOKEN.findall(part)
        return out

    def counts(self, tokens: list[str]) -> list[int]:
        """Tokens of each pre-token."""
        try:
            return list(map(self.sizes.__getitem__, tokens))
        except KeyError:
            pass
        if len(self.sizes) > 200_000:
            self.sizes.clear()
        new = list(set(tokens).difference(self.sizes))
        encode, long = self.coder.ranked.encode_ordinary, {}
        for t in new:
            n = 1 if self.added is not None and self.added.fullmatch(t) else len(encode(t))
            (self.sizes if len(t) <= LONG else long)[t] = n
        return [self.sizes[t] if t in self.sizes else long[t] for t in tokens]


class Leaf:
    """A run of pre-tokens."""

    __slots__ = ("text", "lengths", "counts")

    def __init__(self, text: str, lengths: array, counts: array):
        self.text, self.lengths, self.counts = text, lengths, counts


class TokenTree:
    """The segment tree of one text."""

    def __init__(self, text: str | None, splitter: Splitter, lengths: array | None = None, counts: array | None = None):
        """With lengths and counts of the pre-tokens, as ``kept`` gives them, nothing is split or encoded."""
        self.splitter, self.encoded = splitter, 0
        text = text or ""
        if lengths is None:
            lengths, counts = self._measured(splitter.split(text))
        self._build(text, lengths, counts)

    def _measured(self, tokens: list[str]) -> tuple[array, array]:
        self.encoded += len(tokens)
        return array("q", map(len, tokens)), array("q", self.splitter.counts(tokens))

    def _build(self, text: str, lengths: array, counts: array) -> None:
        self.leaves, at = [], 0
        for i in range(0, len(lengths), LEAF):
            n = lengths[i : i + LEAF]
            self.leaves.append(Leaf(text[at : at + sum(n)], n, counts[i : i + LEAF]))
            at += sum(n)
        self.leaves = self.leaves or [Leaf("", array("q"), array("q"))]
        self.base = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.base), [0] * (2 * self.base)
        for i in range(len(self.leaves)):
            self._sum(i)
        for i in range(self.base - 1, 0, -1):
            self._add(i)

    def _sum(self, leaf: int) -> None:
        self.chars[self.base + leaf] = len(self.leaves[leaf].text)
        self.tokens[self.base + leaf] = sum(self.leaves[leaf].counts)

    def _add(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(leaf.text for leaf in self.leaves)

    def kept(self) -> tuple[str, array, array]:
        """What the tree can be built from again."""
        lengths, counts = array("q"), array("q")
        for leaf in self.leaves:
            lengths.extend(leaf.lengths)
            counts.extend(leaf.counts)
        return self.text(), lengths, counts

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf with character ``at`` (or the last leaf), and where it begins."""
        node, before = 1, 0
        while node < self.base:
            node *= 2
            if at >= before + self.chars[node] and self.chars[node + 1]:
                before += self.chars[node]
                node += 1
        return node - self.base, before

    def edit(self, start: int, end: int, new: str) -> None:
        """Replaces characters start..end by ``new``."""
        total, reach = self.chars[1], self.splitter.context
        start = min(max(start, 0), total)
        end = min(max(end, start), total)
        first, at = self._find(max(start - reach - 1, 0))
        if first:  # one pre-token more than the context, whatever leaf it is in
            first -= 1
            at -= self.chars[self.base + first]
        last = self._find(min(end + reach, max(total - 1, 0)))[0]
        more = 1
        while True:
            last = min(last, len(self.leaves) - 1)
            done = self._replace(first, last, at, start, end, new)
            if done:
                return
            last, more = last + more, 2 * more

    def _replace(self, first: int, last: int, at: int, start: int, end: int, new: str) -> bool:
        """Tries the edit within these leaves, the first of which begins at ``at``; False where the split beyond them may change."""
        leaves, reach = self.leaves[first : last + 1], self.splitter.context
        lengths = [n for leaf in leaves for n in leaf.lengths]
        counts = [n for leaf in leaves for n in leaf.counts]
        text = "".join(leaf.text for leaf in leaves)
        start, end = start - at, end - at
        bounds = [0, *accumulate(lengths)]
        a = max(0, int(np.searchsorted(bounds, start - reach)) - 2)  # pre-tokens that end before the context stay, but for one
        fresh = self.splitter.split(text[bounds[a] : start] + new + text[end:])
        shift, open_ = len(new) - (end - start), last + 1 < len(self.leaves)
        limit = len(text) + shift - (reach if open_ else 0)  # what a split may look at lies within these leaves up to here
        old, place, taken, b = set(bounds), bounds[a], 0, None
        for t in fresh:
            if start + len(new) <= place <= limit and place - shift in old:
                b = bounds.index(place - shift)
                break
            place += len(t)
            taken += 1
        if b is None:
            if open_:
                return False
            b = len(lengths)
        n, m = self._measured(fresh[:taken])
        lengths[a:b], counts[a:b] = n, m
        text = text[:start] + new + text[end:]
        if len(lengths) > 4 * LEAF * len(leaves) or not lengths and len(self.leaves) > 1:
            before, after = self.leaves[:first], self.leaves[last + 1 :]
            self._build("".join(x.text for x in before) + text + "".join(x.text for x in after), array("q", [*(n for x in before for n in x.lengths), *lengths, *(n for x in after for n in x.lengths)]), array("q", [*(n for x in before for n in x.counts), *counts, *(n for x in after for n in x.counts)]))
            return True
        share, place = -(-len(lengths) // len(leaves)) or 1, 0
        for k in range(len(leaves)):
            n = array("q", lengths[k * share : (k + 1) * share])
            self.leaves[first + k] = Leaf(text[place : place + sum(n)], n, array("q", counts[k * share : (k + 1) * share]))
            place += sum(n)
            self._sum(first + k)
        nodes = set(range(self.base + first, self.base + last + 1))
        while nodes := {i >> 1 for i in nodes if i > 1}:
            for i in nodes:
                self._add(i)
        return True


_TREE = "doc_id long, text string, lengths binary, counts binary, n_tokens long"


def _row(tree: TokenTree) -> tuple:
    text, lengths, counts = tree.kept()
    return text, np.array(lengths, "<u4").tobytes(), np.array(counts, "<u4").tobytes(), tree.n_tokens


def trees(df: DataFrame, file: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, lengths and counts (of the pre-tokens, packed as unsigned 32-bit integers) and n_tokens of each row: a tree to be kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(tokenizer(file))
        for batch in sliced(batches, 1):
            rows = [_row(TokenTree(t, splitter)) for t in batch.column(1).to_pylist()]
            kinds = [pa.string(), pa.binary(), pa.binary(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(zip(*rows), kinds)]], names=[c.split()[0] for c in _TREE.split(", ")])
        splitter.coder.forget()

    return df.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, _TREE)


def different(kept: DataFrame) -> DataFrame:
    """doc_id and times, how many different texts it has: repeated rows are one tree. Told by a hash, which only decides over how many parts they are dealt."""
    return kept.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.countDistinct(F.xxhash64("text")).alias("times"))


def edited(kept: DataFrame, edits: DataFrame, file: str) -> DataFrame:
    """The trees of ``kept`` (what ``trees`` gives) after ``edits`` (doc_id, seq, start, end, new), with n_before, n_edits and n_encoded (pre-tokens encoded).

    Trees and edits are dealt out by doc_id and sorted, so that a task sees each tree and then its edits, one at a time, however many there are. Where
    several different texts have one doc_id, their trees are dealt out further, and each part gets the edits of that doc_id.
    """
    times = different(kept)
    part = F.pmod(F.xxhash64("text"), F.coalesce("times", F.lit(1)))
    # a repeated row is one tree with a count
    once = kept.groupBy("doc_id", "text").agg(F.first("lengths").alias("lengths"), F.first("counts").alias("counts"), F.count("*").alias("copies"))
    none = lambda kind: F.lit(None).cast(kind)
    left = once.join(times, "doc_id", "left").select("doc_id", part.alias("part"), F.lit(False).alias("is_edit"), none("long").alias("seq"), none("long").alias("start"), none("long").alias("end"), "text", "lengths", "counts", "copies")
    right = edits.join(times, "doc_id").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("times") - 1)))
    right = right.select("doc_id", "part", F.lit(True).alias("is_edit"), F.col("seq").cast("long"), F.col("start").cast("long"), F.col("end").cast("long"), F.col("new").alias("text"), none("binary").alias("lengths"), none("binary").alias("counts"), none("long").alias("copies"))
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text"))  # trees without an id have no edits
    order = ["doc_id", "part", "is_edit", "seq", "start", "end", "text"]
    dealt = left.unionByName(right).repartition("doc_id", "part", spread).sortWithinPartitions(*order)
    schema = _TREE + ", n_before long, n_edits long, n_encoded long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(tokenizer(file))
        held: list[list] = []  # trees of one id and part: [copies, n_before, n_edits, tree]
        key = None

        rows: list[list] = []
        kinds = [pa.int64(), pa.string(), pa.binary(), pa.binary(), *[pa.int64()] * 4]
        names = [c.split()[0] for c in schema.split(", ")]

        def out(last: bool = False) -> Iterator[pa.RecordBatch]:
            for copies, before, n, tree in held:
                row = [key[0], *_row(tree), before, n, tree.encoded]
                for _ in range(copies):
                    rows.append(row)
                    if len(rows) >= 500 or len(row[1]) > 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                        rows.clear()
            held.clear()
            if last and rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                doc, part_, is_edit, _, start, end, text, lengths, counts, copies = (c[i].as_py() for c in batch.columns)
                if (doc, part_) != key or doc is None:
                    yield from out()
                    key = (doc, part_)
                if not is_edit:
                    tree = TokenTree(text, splitter, *[array("q", np.frombuffer(x, "<u4").tolist()) for x in (lengths, counts)])
                    held.append([copies, tree.n_tokens, 0, tree])
                    continue
                for h in held:
                    h[3].edit(start or 0, end or 0, text or "")
                    h[2] += 1
        yield from out(True)
        splitter.coder.forget()

    return dealt.mapInArrow(run, schema)


def counted(df: DataFrame, file: str, edits_of, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_before, n_after, n_edits, n_pretokens and n_encoded (pre-tokens encoded for the edits). edits_of(text) gives (start, end, new), each on the edited text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(tokenizer(file))
        for batch in sliced(batches, 1):
            rows = []
            for t in batch.column(1).to_pylist():
                tree = TokenTree(t, splitter)
                before, pretokens, edits = tree.n_tokens, tree.encoded, edits_of(t or "")
                for edit in edits:
                    tree.edit(*edit)
                rows.append((before, tree.n_tokens, len(edits), pretokens, tree.encoded - pretokens))
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_before", "n_after", "n_edits", "n_pretokens", "n_encoded"])
        splitter.coder.forget()

    return df.select(F.col(key).cast("long"), text).mapInArrow(run, "doc_id long, n_before long, n_after long, n_edits long, n_pretokens long, n_encoded long")


def masked_digits(text: str) -> list[tuple[int, int, str]]:
    """Edits that replace each run of digits by one 0."""
    gone, out = 0, []
    for m in DIGITS.finditer(text):
        out.append((m.start() - gone, m.end() - gone, "0"))
        gone += m.end() - m.start() - 1
    return out


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return counted(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"), masked_digits)
