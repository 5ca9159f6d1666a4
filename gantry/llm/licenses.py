"""Licence scans: short notices found with a bounded number of edits.

A notice of at most e edits, split into e + 1 pieces, keeps at least one piece as it is. So an Aho-Corasick automaton over all pieces of all notices, in one pass over the text, gives the
places where a notice may stand; around these the regex library's bounded-error matching finds it, its span and its edits. Texts are looked at as words (runs of ASCII letters
and digits and of characters beyond ASCII, A-Z in lower case) with single spaces between them, so marks of comments and line ends cost nothing; a match begins and ends with a word.
Edits are characters put in, left out or changed.

Notices without edits are one piece, and each of its places is a span, overlaps too. Others give spans that don't overlap others of the same notice.

Cases: a null or empty text has no words and no spans; very long texts are looked at whole, the automaton reading them PIECE characters at a time; equal texts get equal results; of matches of one
notice that overlap, the leftmost counts; rows may repeat; an empty table gives an empty result; other columns pass through, where n_words and spans replace columns of those names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gantry.llm.shared import documents, sliced


class Notice(NamedTuple):
    label: str
    words: str
    edits: int
    base: bool = False


#: Phrases that count where their words stand as they are.
BASE = (Notice("gpl", "gnu general public license", 0, True), Notice("apache", "apache license", 0, True), Notice("cc-by", "cc by", 0, True), Notice("mit", "mit license", 0, True))
#: Notices and the edits they bear: fewer where a short name alone tells one licence from another.
NOTICES = (
    *BASE,
    Notice("gpl", "gnu general public license", 2),
    Notice("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", 6),
    Notice("lgpl", "gnu lesser general public license", 2),
    Notice("agpl", "gnu affero general public license", 2),
    Notice("apache", "apache license", 1),
    Notice("apache", "licensed under the apache license version 2 0", 4),
    Notice("mit", "mit licence", 0),
    Notice("mit", "released under the mit license", 1),
    Notice("mit", "licensed under the mit license", 1),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", 6),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted", 6),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", 5),
    Notice("mpl", "mozilla public license", 2),
    Notice("epl", "eclipse public license", 2),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 5),
    Notice("cc-by", "creative commons attribution", 2),
    Notice("cc-by-nc", "cc by nc", 0),
    Notice("cc-by-sa", "cc by sa", 0),
    Notice("cc-by-nd", "cc by nd", 0),
)

PIECE = 1 << 22
#: Bytes of words as they are, A-Z in lower case; all others are spaces.
_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))

SPAN = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("edits", pa.int32()), ("score", pa.float64())])
SPANS = "array<struct<label:string,base:boolean,first_word:bigint,last_word:bigint,start:bigint,end:bigint,edits:int,score:double>>"


def normal(raw: bytes) -> str:
    """The words with single spaces between them."""
    raw = raw.translate(_WORDS)
    out, at = [], 0
    while at < len(raw):
        end = raw.find(b" ", at + PIECE) if len(raw) - at > PIECE else -1
        end = len(raw) if end < 0 else end
        if piece := b" ".join(raw[at:end].split()):
            out.append(piece)
        at = end
    return b" ".join(out).decode("utf-8", "replace")


def pieces(words: str, n: int) -> list[tuple[int, str]]:
    """n pieces of about equal length, with where they begin."""
    cuts = [len(words) * i // n for i in range(n + 1)]
    return [(a, words[a:b]) for a, b in zip(cuts, cuts[1:])]


class Scanner:
    def __init__(self, notices: tuple[Notice, ...]):
        self.notices = notices
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, n in enumerate(notices):
            for at, seed in pieces(n.words, n.edits + 1):
                seeds.setdefault(seed, []).append((i, at))
        self.longest = max(map(len, seeds), default=0)
        self.seeds = ahocorasick.Automaton()
        for seed, where in seeds.items():
            self.seeds.add_word(seed, (len(seed), where))
        if seeds:
            self.seeds.make_automaton()
        self.patterns = [regex.compile(rf"(?e)(?<![^ ])(?:{regex.escape(n.words, literal_spaces=True)}){{e<={n.edits}}}(?![^ ])") for n in notices]

    def candidates(self, text: str) -> dict[int, list[list[int]]]:
        """Notice to the stretches of ``text`` in which it may stand, in order and without overlaps; for a notice without edits, to its places."""
        found: dict[int, list[list[int]]] = {}
        for a in range(0, len(text) if self.longest else 0, PIECE):
            begin = max(0, a - self.longest + 1)
            for end, (size, where) in self.seeds.iter(text[begin : a + PIECE]):
                end += begin + 1
                if end <= a:  # the piece before has it
                    continue
                for i, at in where:
                    n = self.notices[i]
                    lo, hi = end - size - at - n.edits, end - size - at + len(n.words) + n.edits
                    own = found.setdefault(i, [])
                    # a match may touch its stretch's edge: one more character on each side shows whether words end there
                    own.append([lo, hi] if not n.edits else [max(0, lo - 1), min(len(text), hi + 1)])
        for i, own in found.items():
            if self.notices[i].edits:
                own.sort()
                merged = own[:1]
                for lo, hi in own[1:]:
                    if lo <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], hi)
                    else:
                        merged.append([lo, hi])
                found[i] = merged
        return found

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits) in ``text``, in order."""
        out = []
        for i, stretches in self.candidates(text).items():
            for lo, hi in stretches:
                if self.notices[i].edits:
                    out += [(m.start(), m.end(), i, sum(m.fuzzy_counts)) for m in self.patterns[i].finditer(text, lo, hi)]
                elif (not lo or text[lo - 1] == " ") and text[hi : hi + 1] in ("", " "):
                    out.append((lo, hi, i, 0))
        return sorted(out)

    def spans(self, raw: bytes) -> tuple[int, list[tuple]]:
        """Number of words, and the spans as values of SPAN."""
        text = normal(raw)
        if not text:
            return 0, []
        n_words, found = text.count(" ") + 1, self.matches(text)
        if not found:
            return n_words, []
        spaces, at, word_at = 0, 0, {}
        for p in sorted({p for a, b, _, _ in found for p in (a, b)}):  # the number of the word that begins or ends there
            spaces += text.count(" ", at, p)
            at, word_at[p] = p, spaces
        from_raw = np.frombuffer(raw, np.uint8)
        of_word = np.frombuffer(raw.translate(_WORDS), np.uint8) != 32
        edges = np.flatnonzero(np.diff(of_word, prepend=False, append=False))
        starts, ends = edges[::2], edges[1::2]
        chars, at, char_at = 0, 0, {}
        for p in sorted({int(x) for a, b, _, _ in found for x in (starts[word_at[a]], ends[word_at[b]])}):
            chars += int(np.count_nonzero((from_raw[at:p] & 0xC0) != 0x80))
            at, char_at[p] = p, chars
        out = []
        for a, b, i, edits in found:
            n, first, last = self.notices[i], word_at[a], word_at[b]
            out.append((n.label, n.base, first, last, char_at[int(starts[first])], char_at[int(ends[last])], edits, 1 - edits / len(n.words)))
        return n_words, out


@cache
def scanner(notices: tuple[Notice, ...]) -> Scanner:
    return Scanner(notices)


def scan(df: DataFrame, notices: tuple[Notice, ...] = NOTICES, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns of ``df`` (or those in ``keep``) with n_words and ``spans``: label, base, numbers of the first and last word, start and end in the text's characters, edits and score."""
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in ("n_words", "spans")]
    whole = "_whole"
    while whole in keep:
        whole += "_"

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner(notices)
        for batch in sliced(batches, 0):
            found = [find.spans(raw or b"") for raw in (x.as_py() for x in batch.column(0).cast(pa.binary()))]
            spans = pa.array([[dict(zip(SPAN.names, s)) for s in x] for _, x in found], pa.list_(SPAN))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array([n for n, _ in found], pa.int64()), spans], names=[*keep, "n_words", "spans"])

    source = df.select(F.col(text).alias(whole), *keep)
    kinds = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in source.select(*keep).schema)
    return source.mapInArrow(scanned, f"{kinds}, n_words bigint, spans {SPANS}" if kinds else f"n_words bigint, spans {SPANS}")


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir).select("doc_id", "text"), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["first_word"])
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0)).alias("score"),
    )
