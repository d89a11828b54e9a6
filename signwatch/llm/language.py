"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts become counts of their lower-cased character n-grams of one to three characters, hashed to ``2**SLOT_BITS``
slots. Document frequencies come from all documents; each task counts its own, Spark adds them up. The weights are
trained by follow-the-regularised-leader (FTRL-proximal) with an elastic-net penalty, so most are exactly zero, on
``SAMPLE_ROWS`` labelled rows at most, those with the smallest hash of the id. A temperature, fitted on a fifth of
these rows that training doesn't see, calibrates the probabilities.

Texts that are null or have no letter are ``und`` with score 0, as are all texts if there are no labelled rows. Rows
without a language, a text or an id aren't learned from. Repeated rows are predicted alike. Of equally likely
languages the first by name wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signwatch.llm import text

SAMPLE_ROWS = 4_000
SLOT_BITS = 15
LENGTHS = (1, 2, 3)
#: FTRL: learning rate, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.01
EPOCHS = 3
UNKNOWN = "und"


def documents_grams(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """For each text the slots of its n-grams, how often each occurs, and whether it has a letter."""
    for begin, end in text.slices(column):
        texts = [(x or "").lower() for x in column.slice(begin, end - begin).to_pylist()]
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        slots, value = [], np.zeros(len(codes), dtype=np.uint32)
        for length in LENGTHS:
            ahead = np.zeros_like(codes)
            ahead[: len(codes) - length + 1] = codes[length - 1 :]
            value = (value ^ (ahead + np.uint32(length))) * np.uint32(0x9E3779B1)
            value = value ^ (value >> np.uint32(15))
            slots.append((value * np.uint32(0x85EBCA77) >> np.uint32(32 - SLOT_BITS)).astype(np.int32))
        at = 0
        for x in texts:
            size = len(x)
            own = [s[at : max(at, at + size - n + 1)] for n, s in zip(LENGTHS, slots, strict=True)]
            counts = np.bincount(np.concatenate(own), minlength=1 << SLOT_BITS)
            used = np.flatnonzero(counts)
            yield used.astype(np.int32), counts[used], any(map(str.isalpha, x))
            at += size


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many of this task's documents each slot occurs; slot -1 counts the documents."""
    counts, n = np.zeros(1 << SLOT_BITS, dtype=np.int64), 0
    for batch in batches:
        for used, _, _ in documents_grams(batch.column("text")):
            counts[used] += 1
            n += 1
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.append(used, -1).astype(np.int32)), pa.array(np.append(counts[used], n))], names=["slot", "n"]
    )


def _sample_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(u, np.minimum(c, 2**31 - 1).astype(np.int32)) for u, c, _ in documents_grams(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                batch.column("lang"),
                pa.array([u for u, _ in rows], pa.list_(pa.int32())),
                pa.array([c for _, c in rows], pa.list_(pa.int32())),
            ],
            names=["doc_id", "lang", "slots", "counts"],
        )


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    temperature: float = 1.0

    def vector(self, used: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """TF-IDF of a text, of length 1; the last slot is the constant."""
        value = np.log1p(counts) * self.idf[used]
        norm = np.sqrt((value * value).sum())
        return np.append(used, 1 << SLOT_BITS), np.append(value / norm if norm else value, 1.0)

    def train(self, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
        """FTRL-proximal, one text at a time."""
        shape = ((1 << SLOT_BITS) + 1, len(self.languages))
        z, n, w = np.zeros(shape), np.zeros(shape), np.zeros(shape)
        for epoch in range(EPOCHS):
            for k in np.random.default_rng(epoch).permutation(len(rows)):
                used, value, label = rows[k]
                own = w[used]
                error = _softmax(value @ own)
                error[label] -= 1
                gradient = value[:, None] * error
                square = gradient * gradient
                z[used] += gradient - (np.sqrt(n[used] + square) - np.sqrt(n[used])) / ALPHA * own
                n[used] += square
                leader = z[used]
                w[used] = np.where(
                    np.abs(leader) > L1,
                    -(leader - np.sign(leader) * L1) / ((BETA + np.sqrt(n[used])) / ALPHA + L2),
                    0,
                )
        self.weights = w

    def calibrate(self, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
        """The temperature with the least log-loss, by golden section over its logarithm."""
        if not rows:
            return
        z = np.stack([value @ self.weights[used] for used, value, _ in rows])
        label = np.array([x[2] for x in rows])

        def loss(t: float) -> float:
            return float(-np.log(_softmax(z / np.exp(t))[np.arange(len(z)), label] + 1e-12).mean())

        low, high, ratio = -5.0, 3.0, (5**0.5 - 1) / 2
        for _ in range(60):
            a, b = high - ratio * (high - low), low + ratio * (high - low)
            low, high = (low, b) if loss(a) < loss(b) else (a, high)
        self.temperature = float(np.exp((low + high) / 2))

    def predict(self, column: pa.Array) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for used, counts, letters in documents_grams(column):
            if not letters or not self.languages:
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            used, value = self.vector(used, counts)
            p = _softmax(value @ self.weights[used] / self.temperature)
            names.append(self.languages[int(p.argmax())])
            scores.append(float(p.max()))
        return names, scores


def _sample(labelled: DataFrame, sample_rows: int) -> DataFrame:
    """At most ``sample_rows`` rows (one per language at least), each language with the same share, if it has so many."""
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return labelled
    most = max(1, sample_rows // len(sizes))
    # twice the rows needed are drawn by hash, so few are ranked
    size = F.create_map(*(F.lit(x) for pair in sizes.items() for x in pair))[F.col("lang")]
    drawn = labelled.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) * size < F.lit(float(1 << 31)) * most)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
    return drawn.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most).drop("place")


def fit(docs: DataFrame, labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Document frequencies from ``docs`` (``text``), languages from ``labelled`` (``doc_id, text, lang``)."""
    found = docs.filter("text IS NOT NULL").select("text").mapInArrow(_frequencies, "slot int, n long")
    found = found.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    slot, n = found["slot"].to_numpy(), found["n"].to_numpy()
    documents = int(n[slot < 0].sum())
    idf = np.full(1 << SLOT_BITS, np.log(1 + documents) + 1)
    idf[slot[slot >= 0]] = np.log((1 + documents) / (1 + n[slot >= 0])) + 1
    labelled = labelled.filter("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    labelled = labelled.select("doc_id", "text", "lang")
    sample = _sample(labelled, sample_rows)
    kind = labelled.schema["doc_id"].dataType.simpleString()
    grams = sample.mapInArrow(_sample_grams, f"doc_id {kind}, lang string, slots array<int>, counts array<int>").toArrow()
    languages = sorted(set(grams["lang"].to_pylist()))
    model = Model(languages, idf)
    # The same order on any cluster.
    order = sorted(range(grams.num_rows), key=lambda k: (str(grams["doc_id"][k].as_py()), grams["lang"][k].as_py()))
    rows = []
    for k in order:
        used = grams["slots"][k].values.to_numpy().astype(np.int64) if len(grams["slots"][k]) else np.zeros(0, dtype=np.int64)
        counts = grams["counts"][k].values.to_numpy() if len(used) else np.zeros(0)
        rows.append((*model.vector(used, counts), languages.index(grams["lang"][k].as_py())))
    if rows:
        model.train([x for k, x in enumerate(rows) if k % 5])
        model.calibrate([x for k, x in enumerate(rows) if k % 5 == 0])
    return model


def _predictions(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = model.predict(batch.column("text"))
            columns = [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    return run


def predict(docs: DataFrame, model: Model, id: str = "doc_id", texts: str = "text") -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score``."""
    docs = docs.select(F.col(id).alias("doc_id"), F.col(texts).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(_predictions(model), f"doc_id {kind}, lang_pred string, score double")
