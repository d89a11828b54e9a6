"""Toxicity by two class-conditional Kneser-Ney models.

One model is trained on texts labelled toxic, one on texts labelled ordinary. Each predicts a word byte by byte from
what the word has begun with, so it knows abusive stems with any ending as well as whole words. Absolute discounting
takes a fixed amount off every count; that mass goes to a backoff distribution that both models share: the counts of
the same beginnings over *all* documents. What neither class uses often says nothing about the class, since both
models then answer with the shared counts. Words end at any script's marks and blanks. In words longer than ``DEPTH`` bytes, and in scripts
without spaces, each later character begins a unit that is judged like a word, so every byte is scored.

The difference of the two log-likelihoods, divided by the number of words, is taken for the whole text and for its
passages of ``PASSAGES`` words, and for its ``TOP`` most telling words; the highest passage counts, so one abusive
sentence shows in a long text too. A logistic calibration on labelled rows kept apart from the counts turns these into a score.

Class counts come from ``label_rows`` labelled rows at most, half of each class, those with the smallest hash of the
id; that also bounds the table of beginnings that tasks are given. The shared counts cover every document: each task
counts for each beginning the words that end with it in the table, and Spark adds the tasks up.

Null and empty texts score as texts without evidence do. Labels other than 0 and 1 are left out; an id with
several labels counts as toxic if one of them is 1. Repeated rows are scored alike. Without labels of both classes
every score is the share of toxic labels.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signwatch.llm import text

LABEL_ROWS = 24_000
#: Bytes whose words are found and scored at once.
SLICE = 1 << 18
#: Longest beginning of a word, in bytes.
DEPTH = 14
#: Taken off each count of a class; beginnings that are as rare in both classes have no entry.
DISCOUNT = 2
PASSAGES = (1, 4, 16, 64)
#: The highest values among a text's different words, however far apart.
TOP = 8
FEATURES = ["whole", "length", "top", *(f"passage_{n}" for n in PASSAGES)]


def labelled_rows(labels: DataFrame, label_rows: int, label: str = "toxic") -> tuple[DataFrame, float]:
    """At most half of ``label_rows`` ids of each class, those with the smallest hashes; and the share of class 1.

    ``fold`` 3 is for calibration.
    """
    rows = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    rows = rows.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    share = rows.agg(F.avg("label")).first()[0] or 0.0
    by = [F.xxhash64("doc_id"), F.col("doc_id")]
    ordered = [rows.filter(F.col("label") == c).orderBy(*by).limit(label_rows // 2) for c in (0, 1)]
    fold = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)).cast("int")
    return ordered[0].union(ordered[1]).withColumn("fold", fold), share


@cache
def _marks() -> str:
    """A class of the punctuation, symbols, blanks and control characters beyond ASCII."""
    points = [c for c in range(0x80, 0x110000) if unicodedata.category(chr(c))[0] in "PSZ" or unicodedata.category(chr(c)) == "Cc" or c in (0x200B, 0xFEFF)]
    cuts = [0, *(k for k in range(1, len(points)) if points[k] != points[k - 1] + 1), len(points)]
    return "[" + "".join(f"\\x{{{points[i]:X}}}-\\x{{{points[j - 1]:X}}}" for i, j in zip(cuts[:-1], cuts[1:], strict=True)) + "]"


def _spaceless(data: np.ndarray) -> np.ndarray:
    """Where characters of scripts without spaces begin: Thai, Lao, Burmese, Khmer, kana, Han."""
    at = np.flatnonzero(data >= 0xE0)
    at = at[at + 1 < len(data)]
    a, b = data[at], data[at + 1]
    found = (a == 0xE0) & (b >= 0xB8) & (b <= 0xBB) | (a == 0xE1) & ((b <= 0x82) | (b >= 0x9E) & (b <= 0x9F))
    found |= (a == 0xE3) & (b >= 0x81) | (a >= 0xE4) & (a <= 0xE9) | (a == 0xEF) & (b >= 0xBD) & (b <= 0xBE) | (a == 0xF0) & (b >= 0xA0) & (b <= 0xAF)
    return at[found]


def _units(words: text.Words) -> text.Words:
    """Words, and what follows from each later character of a word that is longer than ``DEPTH`` bytes or in a script
    without spaces, so that each byte is scored. What no model looks at is cut off."""
    starts, ends = words.starts, words.ends
    more = _spaceless(words.data)
    long = np.flatnonzero(ends - starts > DEPTH)
    if len(long):
        size = ends[long] - starts[long]
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(starts[long], size)
        more = np.concatenate([more, within[(words.data[within] & 0xC0) != 0x80]])
    if not len(more):
        return words
    every = np.union1d(starts, more)
    # The data are in lower case, so each character of these scripts is inside a word.
    last = ends[np.searchsorted(starts, every, side="right") - 1]
    first = np.searchsorted(every, np.append(starts, len(words.data))[words.first])
    return text.Words(words.data, every, np.minimum(last, every + DEPTH + 1), first, words.sums)


def _words(column: pa.Array) -> Iterator[tuple[int, int, text.Words]]:
    """Words in lower case, in any script, between ASCII and other marks."""
    # Only a slice at a time is copied.
    for begin, end in text.slices(column, SLICE):
        part = pc.utf8_lower(pc.replace_substring_regex(column.slice(begin, end - begin), _marks(), " "))
        for first, last, words in text.word_slices(part, text.SIGNS, most=SLICE):
            yield begin + first, begin + last, _units(words)


def _distinct(words: text.Words) -> tuple[np.ndarray, np.ndarray]:
    """One place of each different word, and for each word which of those it is."""
    _, first, which = np.unique(words.hashes(), return_index=True, return_inverse=True)
    return first, which


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each beginning in this task's labelled texts the words of each class that have it."""
    for batch in batches:
        label = batch.column("label").to_numpy()
        for begin, end, words in _words(batch.column("text")):
            if not len(words.starts):
                continue
            first, which = _distinct(words)
            toxic = np.repeat(label[begin:end], words.counts())
            both = np.bincount(which * 2 + toxic, minlength=2 * len(first)).reshape(-1, 2)
            starts, ends = words.starts[first], words.ends[first]
            parent = np.zeros(len(first), dtype=np.uint64)
            for length in range(1, DEPTH + 1):
                long = np.flatnonzero(ends - starts >= length)
                starts, ends, both, parent = starts[long], ends[long], both[long], parent[long]
                if not len(long):
                    break
                node = words.parts(starts, starts + length)
                found, one, of = np.unique(node, return_index=True, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(text.signed(found)),
                        pa.array(text.signed(parent[one])),
                        pa.array(np.full(len(found), length, dtype=np.int32)),
                        pa.array(np.bincount(of, weights=both[:, 0]).astype(np.int64)),
                        pa.array(np.bincount(of, weights=both[:, 1]).astype(np.int64)),
                    ],
                    names=["node", "parent", "length", "c0", "c1"],
                )
                parent = node


def class_counts(sample: DataFrame) -> pa.Table:
    """Beginnings that a class uses more often than the discount, with their counts by class."""
    counts = sample.mapInArrow(_class_counts, "node long, parent long, length int, c0 long, c1 long")
    counts = counts.groupBy("node", "parent", "length").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1"))
    return counts.filter(F.greatest("c0", "c1") > DISCOUNT).toArrow()


@dataclass
class Model:
    """A trie of beginnings: what each says about the class, with and without more bytes to come."""

    nodes: np.ndarray
    parent: np.ndarray
    length: np.ndarray
    counts: np.ndarray
    value: np.ndarray = field(default_factory=lambda: np.zeros(1))
    tail: np.ndarray = field(default_factory=lambda: np.zeros(1))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES) + 1))

    @classmethod
    def of(cls, counts: pa.Table) -> Model:
        """The trie, its root behind the last node."""
        nodes = counts["node"].to_numpy().view(np.uint64)
        by = np.argsort(nodes)
        nodes = nodes[by]
        length = counts["length"].to_numpy()[by]
        above = counts["parent"].to_numpy().view(np.uint64)[by]
        parent = np.where(length == 1, len(nodes), np.searchsorted(nodes, above))
        both = np.stack([counts["c0"].to_numpy()[by], counts["c1"].to_numpy()[by]]).astype(np.float64)
        total = both[:, length == 1].sum(axis=1, keepdims=True)
        return cls(nodes, parent, length, np.concatenate([both, total], axis=1))

    def smooth(self, shared: np.ndarray) -> None:
        """Log-likelihood ratios, given how many words of all documents stop at each node (the root last)."""
        levels = [np.flatnonzero(self.length == n) for n in range(DEPTH, 0, -1)]
        everywhere = shared.astype(np.float64)
        for level in levels:
            np.add.at(everywhere, self.parent[level], everywhere[level])
        q = everywhere[:-1] / np.maximum(everywhere[self.parent], 1)
        ratio, tail = np.zeros(len(self.nodes)), np.zeros(len(self.nodes) + 1)
        for c, sign in ((0, -1), (1, 1)):
            n = np.maximum(self.counts[c], 1)
            kept = np.maximum(self.counts[c][:-1] - DISCOUNT, 0) / n[self.parent]
            rest = 1 - np.bincount(self.parent, weights=kept, minlength=len(n))
            rest = np.where(self.counts[c] > 0, np.maximum(rest, 1e-9), 1.0)
            ratio += sign * np.log(kept + rest[self.parent] * np.maximum(q, 1e-12))
            tail += sign * np.log(rest)
        self.value = np.zeros(len(self.nodes) + 1)
        for level in reversed(levels):
            self.value[level] = self.value[self.parent[level]] + ratio[level]
        self.tail = tail

    def deepest(self, words: text.Words, which: np.ndarray) -> np.ndarray:
        """The longest beginning of each word that is a node; binary search, since its own beginnings are nodes."""
        starts = words.starts[which]
        size = words.ends[which] - starts
        low, high = np.zeros(len(which), dtype=np.int64), np.minimum(size, DEPTH)
        node = np.full(len(which), len(self.nodes))
        while len(open_ := np.flatnonzero(low < high)) and len(self.nodes):
            middle = (low[open_] + high[open_] + 1) // 2
            keys = words.parts(starts[open_], starts[open_] + middle)
            at = np.minimum(np.searchsorted(self.nodes, keys), len(self.nodes) - 1)
            hit = (self.nodes[at] == keys) & (self.length[at] == middle)
            node[open_[hit]] = at[hit]
            low[open_] = np.where(hit, middle, low[open_])
            high[open_] = np.where(hit, high[open_], middle - 1)
        return node

    def stops(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """How many words of this task's documents stop at each node."""
        counts = np.zeros(len(self.nodes) + 1, dtype=np.int64)
        for batch in batches:
            for _, _, words in _words(batch.column("text")):
                if len(words.starts):
                    first, which = _distinct(words)
                    np.add.at(counts, self.deepest(words, first), np.bincount(which))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["node", "n"])

    def features(self, column: pa.Array) -> np.ndarray:
        out = []
        for _, _, words in _words(column):
            first, which = _distinct(words)
            node = self.deepest(words, first)
            longer = words.ends[first] - words.starts[first] > np.append(self.length, 0)[node]
            value = self.value[node] + np.where(longer, self.tail[node], 0)
            out.append(_features(value[which], which, words))
        return np.concatenate([*out, np.zeros((0, len(FEATURES)))])

    def scores(self, features: np.ndarray) -> np.ndarray:
        z = features @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def calibrate(self, features: np.ndarray, label: np.ndarray, share: float) -> None:
        """Logistic regression by Newton steps, lightly penalised; the sample's odds are then set right."""
        x = np.concatenate([np.ones((len(features), 1)), features], axis=1)
        w = np.zeros(x.shape[1])
        ridge = np.full(len(w), 0.1)
        ridge[0] = 1e-3
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
            gradient = x.T @ (p - label) + ridge * w
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), gradient)
            w = w - np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-7:
                break
        drawn = (label.sum() + 0.5) / (len(label) + 1)
        w[0] += np.log(share / (1 - share)) - np.log(drawn / (1 - drawn))
        self.weights = w


def _features(value: np.ndarray, which: np.ndarray, words: text.Words) -> np.ndarray:
    """The mean of the whole text, the logarithm of its length, the mean of the highest values of different words (as
    far as they are positive), and the best mean of each passage length."""
    count = words.counts()
    sums = np.concatenate([[0.0], np.cumsum(value)])
    out = [(sums[words.first[1:]] - sums[words.first[:-1]]) / np.maximum(count, 1), np.log1p(count)]
    high = np.flatnonzero(value > 0)
    of = np.repeat(np.arange(len(count)), count)[high]
    _, first = np.unique(of * (which.max(initial=0) + 1) + which[high], return_index=True)
    high, of = high[first], of[first]
    by = np.lexsort((-value[high], of))
    high, of = high[by], of[by]
    top = np.arange(len(of)) - np.searchsorted(of, of) < TOP
    out.append(np.bincount(of[top], weights=value[high[top]], minlength=len(count)) / TOP)
    used = count > 0
    for length in PASSAGES:
        # A passage ends with its document; one that is cut short is still divided by the full length.
        end = np.minimum(np.arange(len(value)) + length, np.repeat(words.first[1:], count))
        best = np.zeros(len(count))
        if used.any():
            best[used] = np.maximum.reduceat((sums[end] - sums[:-1]) / length, words.first[:-1][used])
        out.append(best)
    return np.stack(out, axis=1)


def fit(docs: DataFrame, labels: DataFrame, label_rows: int = LABEL_ROWS, label: str = "toxic") -> Model:
    """Train on ``docs`` (``doc_id``, ``text``) and ``labels`` (``doc_id`` and the label column)."""
    docs = docs.select("doc_id", "text").filter("text IS NOT NULL")
    rows, share = labelled_rows(labels, label_rows, label)
    # At most label_rows rows of three numbers.
    sample = docs.join(F.broadcast(rows), "doc_id").select("text", "label", "fold")
    model = Model.of(class_counts(sample.filter("fold <> 3")))
    stops = docs.select("text").mapInArrow(model.stops, "node long, n long").groupBy("node").agg(F.sum("n").alias("n")).toArrow()
    shared = np.zeros(len(model.nodes) + 1, dtype=np.int64)
    shared[stops["node"].to_numpy()] = stops["n"].to_numpy()
    model.smooth(shared)
    schema = "label int, " + ", ".join(f"{f} double" for f in FEATURES)
    found = sample.filter("fold = 3").mapInArrow(_labelled_features(model), schema).toArrow()
    if 0 < share < 1 and found.num_rows:
        model.calibrate(np.stack([found[f].to_numpy() for f in FEATURES], axis=1), found["label"].to_numpy(), share)
    else:
        model.weights[0] = np.log(np.clip(share, 1e-9, 1 - 1e-9) / (1 - np.clip(share, 1e-9, 1 - 1e-9)))
    return model


def _labelled_features(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.features(batch.column("text"))
            columns = [batch.column("label"), *(pa.array(np.ascontiguousarray(found[:, k])) for k in range(len(FEATURES)))]
            yield pa.RecordBatch.from_arrays(columns, names=["label", *FEATURES])

    return run


def _scores(model: Model, texts: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.scores(model.features(batch.column(texts)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: Model, id: str = "doc_id", texts: str = "text") -> DataFrame:
    """One row per document: ``doc_id, score``."""
    docs = docs.select(F.col(id).alias("doc_id"), F.col(texts).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_scores(model, "text"), f"doc_id {kind}, score double")


def _acceptable(model: Model, texts: str, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(model.features(batch.column(texts))) < threshold))

    return run


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.3, texts: str = "text") -> DataFrame:
    """The documents that score under the threshold, all columns kept."""
    return docs.mapInArrow(_acceptable(model, texts, threshold), docs.schema)
