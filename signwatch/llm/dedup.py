"""Removal of passages that an earlier document already has, by level-wise doubling.

A passage of ``words`` consecutive words can only repeat if the shorter passages in it do. So short windows come first:
for each window of the next length, one anchor, the short window in it with the smallest hash, goes through a shuffle.
Equal windows have equal anchors, so an anchor seen in one document alone rules out every window it stands for. What is
left is extended to twice the length, and so on up to ``words``. At the last length every candidate window is shuffled,
and words covered by a window that also starts in a document with a smaller id go.

Each task first merges equal windows of its slice of documents, so a passage that a third of all documents share has
one row per slice, not one per document, and only minima and maxima of document ids are taken per window. Windows are
compared by 64-bit hashes, at each length by a hash of its own.

Null texts have no words. Documents without an id take no part and lose nothing; rows with the same id are one
document's texts and don't count as repeats of each other, and each has its own result row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signwatch.llm import text

WORDS = 13
SHORTEST = 8


def levels(words: int) -> list[int]:
    """Window lengths, each at most twice the one before, ending at ``words``."""
    lengths = [words]
    while lengths[0] > SHORTEST:
        lengths.insert(0, (lengths[0] + 1) // 2)
    return lengths


def _sliding(values: np.ndarray, width: int, pick, back: bool = False) -> np.ndarray:
    """Smallest or largest of ``width`` values from each place on (or up to it), by doubling; zero beyond the ends."""
    values = values[::-1] if back else values
    have = 1
    while have < width:
        step = min(have, width - have)
        values = pick(values, text.shifted(values, step))
        have += step
    return values[::-1] if back else values


def _valid(words: text.Words, length: int) -> np.ndarray:
    left = np.repeat(words.first[1:], words.counts()) - np.arange(len(words.starts))
    return left >= length


class Slice:
    """Anchors and candidate windows of some documents."""

    def __init__(self, words: text.Words):
        self.words = words
        self.hashes = words.hashes()
        self.of = words.documents()

    def anchors(self, length: int, longer: int, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of windows of ``length``, the anchor's hash of each candidate window of ``longer``, which are anchors."""
        values = np.where(_valid(self.words, length), text.window_hashes(self.hashes, length), np.uint64(2**64 - 1))
        width = longer - length + 1
        least = np.where(candidates, _sliding(values, width, np.minimum), np.uint64(0))
        return values, least, (_sliding(least, width, np.maximum, back=True) == values) & (values != np.uint64(2**64 - 1))

    def candidates(self, lengths: list[int], found: list[np.ndarray]) -> np.ndarray:
        """Windows of length ``lengths[len(found)]`` whose anchors at all shorter lengths were found elsewhere too."""
        here = _valid(self.words, lengths[min(1, len(lengths) - 1)])
        for k, hashes in enumerate(found):
            values, least, _ = self.anchors(lengths[k], lengths[k + 1], here)
            width = lengths[k + 1] - lengths[k] + 1
            seen = np.where(_among(values, hashes), values, np.uint64(0))
            here = here & (least > 0) & (_sliding(seen, width, np.maximum) >= least)
            if k + 2 < len(lengths):
                here = _valid(self.words, lengths[k + 2]) & _sliding(here, lengths[k + 2] - lengths[k + 1] + 1, np.logical_and)
        return here

    def shuffled(self, lengths: list[int], found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes that the next level compares."""
        k = len(found)
        here = self.candidates(lengths, found)
        if k + 1 < len(lengths):
            values, _, chosen = self.anchors(lengths[k], lengths[k + 1], here)
            at = np.flatnonzero(chosen)
            return at, values[at]
        at = np.flatnonzero(here)
        return at, text.window_hashes(self.hashes, lengths[k])[at]


def _among(values: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which values are among ``some``, which are sorted."""
    if not len(some):
        return np.zeros(len(values), dtype=bool)
    return some[np.minimum(np.searchsorted(some, values), len(some) - 1)] == values


def _rows(ids: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    """One row per distinct hash: its smallest document, and any more documents, in order."""
    by = np.lexsort((ids, hashes))
    ids, hashes = ids[by], hashes[by]
    new = np.ones(len(by), dtype=bool)
    new[1:] = hashes[1:] != hashes[:-1]
    once = new.copy()
    once[1:] |= ids[1:] != ids[:-1]
    ids, hashes, new = ids[once], hashes[once], new[once]
    firsts = np.flatnonzero(new)
    size = np.diff([*firsts, len(ids)])
    offsets = pa.array(np.concatenate([[0], np.cumsum(size - 1)]).astype(np.int32), mask=np.append(size == 1, False))
    return pa.RecordBatch.from_arrays(
        [pa.array(text.signed(hashes[firsts])), pa.array(ids[firsts]), pa.ListArray.from_arrays(offsets, pa.array(ids[~new]))],
        names=["window", "doc_id", "more"],
    )


ROWS = "window long, doc_id long, more array<long>"


def _level(lengths: list[int], level: int):
    """Windows to compare at this level; ``found_k`` has the windows of each earlier level found elsewhere too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            found = [batch.column(f"found_{k}") for k in range(level)]
            for begin, end, words in text.word_slices(batch.column("text"), text.SPACES, lower=False):
                if not len(words.starts):
                    continue
                # What one document has in common with others, the others here have in common too.
                lists = [np.unique(c.slice(begin, end - begin).flatten().to_numpy(zero_copy_only=False).view(np.uint64)) for c in found]
                at, hashes = Slice(words).shuffled(lengths, lists)
                if len(at):
                    yield _rows(np.repeat(ids[begin:end], words.counts())[at], hashes)

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mark the words under the windows to remove; join what is left."""
    for batch in batches:
        texts, length = batch.column("text"), batch.column("length")[0].as_py() if len(batch) else 0
        n_words, kept, removed = [], [], []
        windows = batch.column("windows")
        for k in range(len(batch)):
            raw = texts[k].as_buffer()
            words = raw.to_pybytes().split() if raw is not None else []
            n_words.append(len(words))
            gone = np.zeros(0, dtype=np.int32)
            if words and windows[k].values is not None and len(windows[k].values):
                own = text.find_words(*text.texts_bytes(texts.slice(k, 1)), text.SPACES).hashes()
                hashes = text.window_hashes(own, length)[: max(0, len(own) - length + 1)]
                at = np.flatnonzero(_among(hashes, np.sort(windows[k].values.to_numpy().view(np.uint64))))
                cover = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(cover, at, 1)
                np.add.at(cover, at + length, -1)
                cover = np.cumsum(cover[:-1]) > 0
                gone = np.flatnonzero(cover).astype(np.int32)
                words = [w for w, x in zip(words, cover.tolist(), strict=True) if not x]
            removed.append(gone)
            kept.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n_words, pa.int64()),
                pa.array(removed, pa.list_(pa.int32())),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n_words", "removed", "kept_text"],
        )


def _two_columns(docs: DataFrame, id: str, texts: str) -> DataFrame:
    """``doc_id`` and ``text``; plain columns where they are that already, as an alias would hide equal exchanges."""
    if (id, texts, docs.schema[id].dataType.simpleString()) == ("doc_id", "text", "bigint"):
        return docs.select(id, texts)
    return docs.select(F.col(id).cast("long").alias("doc_id"), F.col(texts).alias("text"))


def remove_repeats(docs: DataFrame, words: int = WORDS, id: str = "doc_id", texts: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, removed`` (numbers of the words removed) and ``kept_text``."""
    docs = _two_columns(docs, id, texts)
    lengths = levels(words)
    own = Window.partitionBy("window")
    # The same rows are dealt by id for each level and at the end, so Spark deals them once.
    named = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL")
    state = named
    for level in range(len(lengths)):
        rows = state.mapInArrow(_level(lengths, level), ROWS)
        last = F.coalesce(F.element_at("more", -1), "doc_id")
        seen = rows.withColumns({"lowest": F.min("doc_id").over(own), "highest": F.max(last).over(own)}).filter("lowest < highest")
        every = F.explode(F.concat(F.array("doc_id"), F.coalesce("more", F.array().cast("array<long>"))))
        seen = seen.select("window", "lowest", every.alias("doc_id"))
        if level + 1 < len(lengths):
            found = seen.groupBy("doc_id").agg(F.collect_list("window").alias(f"found_{level}"))
            state = state.join(found, "doc_id")
    windows = seen.filter("lowest < doc_id").groupBy("doc_id").agg(F.collect_list("window").alias("windows"))
    others = docs.filter("doc_id IS NULL OR text IS NULL").withColumn("windows", F.lit(None).cast("array<long>"))
    every = named.join(windows, "doc_id", "left").select("doc_id", "text", "windows").union(others)
    schema = "doc_id long, n_words long, removed array<int>, kept_text string"
    return every.withColumn("length", F.lit(words)).mapInArrow(_kept, schema)
