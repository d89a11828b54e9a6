"""License notices in documents: exact phrases, and fuzzy short notices with a bounded number of edits.

A notice with at most ``k`` edits has at least one of ``k + 1`` pieces of it untouched (pigeonhole). The pieces of all
notices are the seeds of one automaton, which passes over each text once; around every seed the regex library then
looks for the whole notice with at most ``k`` errors, each seed on its own. The best match is kept; where it takes a
part of another seed's surroundings, what is left of those is searched again, until nothing is found. Texts are compared as lower-case words joined by single spaces, so
punctuation and line breaks don't count as edits. Work is per document; nothing is shuffled.

Null or empty texts have no words and no labels. Repeated rows are judged alike.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signwatch.llm import text

#: Phrases whose exact occurrences count, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Short notices, in words, and their labels.
NOTICES = (
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("gnu general public license version", "gpl"),
    ("licensed under the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("permission to use copy modify and or distribute this software", "isc"),
    ("mozilla public license version 2 0", "mpl"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under a creative commons attribution", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by 4 0", "cc-by"),
    ("all rights reserved", "proprietary"),
)
#: Letters for each edit that a notice may have.
LETTERS_AN_EDIT = 10

#: Separators become spaces, A-Z become a-z.
_NORMAL = bytes((x + 32 if 65 <= x <= 90 else x) if 65 <= x <= 90 or text.word_bytes(text.SIGNS)[x] else 32 for x in range(256))


def edits(notice: str) -> int:
    return max(1, len(notice) // LETTERS_AN_EDIT)


def pieces(notice: str) -> list[tuple[int, str]]:
    """The notice in as many pieces as it may have edits, and one more, with their places."""
    n = edits(notice) + 1
    cuts = [len(notice) * k // n for k in range(n + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


@cache
def _automaton(notices: tuple) -> ahocorasick.Automaton:
    seeds: dict[str, list[tuple[int, int]]] = {}
    for number, (notice, _) in enumerate(notices):
        for at, piece in pieces(notice):
            seeds.setdefault(piece, []).append((number, at))
    automaton = ahocorasick.Automaton()
    for piece, uses in seeds.items():
        automaton.add_word(piece, (len(piece), uses))
    automaton.make_automaton()
    return automaton


@cache
def _pattern(notice: str) -> regex.Pattern:
    return regex.compile(f"(?be)(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits(notice)}}}")


def normal(raw: str) -> str:
    """Lower-case words joined by single spaces."""
    return b" ".join(raw.encode("utf-8", "surrogatepass").translate(_NORMAL).split()).decode("utf-8", "surrogatepass")


def notices_in(words: str, notices: tuple = NOTICES) -> list[dict]:
    """Matches of notices with their edits, first and last characters and similarity; the best of those that overlap."""
    windows = set()
    for end, (size, uses) in _automaton(notices).iter(words):
        for number, at in uses:
            slack = edits(notices[number][0])
            begin = end - size + 1 - at
            windows.add((number, max(0, begin - slack), min(len(words), begin + len(notices[number][0]) + slack)))
    found: list[tuple] = []

    def look(number: int, begin: int, end: int) -> None:
        notice, label = notices[number]
        if end - begin >= len(notice) - edits(notice) and (match := _pattern(notice).search(words, begin, end)):
            count = sum(match.fuzzy_counts)
            a, b = match.span()
            heapq.heappush(found, (count / len(notice), a - b, a, label, count, number, begin, end))

    for window in windows:
        look(*window)
    kept: list[tuple[int, int, str, int, float]] = []
    while found:
        share, size, a, label, count, number, begin, end = heapq.heappop(found)
        b = a - size
        # Kept matches don't overlap, so their ends have the order of their begins.
        first = bisect_right(kept, a, key=lambda y: y[1])
        last = bisect_right(kept, b - 1, key=lambda y: y[0])
        if first >= last:
            insort(kept, (a, b, label, count, 1 - share))
        # What no kept match takes of the window.
        first = bisect_right(kept, begin, key=lambda y: y[1])
        last = bisect_right(kept, end - 1, key=lambda y: y[0])
        for y in kept[first:last]:
            look(number, begin, y[0])
            begin = max(begin, y[1])
        look(number, begin, end)
    return [{"label": label, "begin": a, "end": b, "edits": count, "similarity": similarity} for a, b, label, count, similarity in kept]


def phrases_in(words: list[str], phrases: dict[str, str] = PHRASES) -> list[tuple[int, str]]:
    """Places (words from 0) where a phrase's words stand one after another, and the phrase's label."""
    found = []
    for phrase, label in phrases.items():
        parts = phrase.split()
        found += [(k, label) for k, word in enumerate(words) if word == parts[0] and words[k : k + len(parts)] == parts]
    return sorted(found)


SPAN = "struct<label: string, first_word: int, last_word: int, edits: int, similarity: double>"
SCHEMA = f"n_words long, places array<struct<word: int, label: string>>, notices array<{SPAN}>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place = pa.struct([("word", pa.int32()), ("label", pa.string())])
    span = pa.struct(
        [
            ("label", pa.string()),
            ("first_word", pa.int32()),
            ("last_word", pa.int32()),
            ("edits", pa.int32()),
            ("similarity", pa.float64()),
        ]
    )
    for batch in batches:
        n_words, places, spans = [], [], []
        for value in batch.column("text"):
            words = normal(value.as_py() or "")
            n_words.append(words.count(" ") + 1 if words else 0)
            base = phrases_in(words.split(" ")) if " license" in words else []
            places.append([{"word": at, "label": label} for at, label in base])
            matches = notices_in(words)
            if matches:
                blanks = [k for k, c in enumerate(words) if c == " "]
                matches = [
                    {
                        "label": x["label"],
                        "first_word": bisect_right(blanks, x["begin"]),
                        "last_word": bisect_right(blanks, x["end"] - 1),
                        "edits": x["edits"],
                        "similarity": x["similarity"],
                    }
                    for x in matches
                ]
            spans.append(matches)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(places, pa.list_(place)), pa.array(spans, pa.list_(span))],
            names=["doc_id", "n_words", "places", "notices"],
        )


def scan(docs: DataFrame, id: str = "doc_id", texts: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words``, ``places`` of exact phrases, and fuzzy ``notices`` with their spans."""
    docs = docs.select(F.col(id).alias("doc_id"), F.col(texts).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_scan, f"doc_id {kind}, {SCHEMA}")
