"""Near-duplicate documents by an exact similarity join on word shingles, with parity sketches.

A document's set of shingles is dealt by hash into parts; in each part every shingle flips one bit of a sketch. Where
two sets differ in few shingles, few bits differ, so the Hamming distance of sketches never exceeds the symmetric
difference. Two sets that reach the similarity differ in at most ``d`` shingles, a number that their sizes give, so
with more than ``d`` parts at least one part's sketch is equal in both (pigeonhole). That part is the join key. How
many parts there are depends on a size band, which both documents of a pair have in common. A part without shingles
says nothing: there are some parts more than needed, and only documents with more empty parts than that use them.

Documents with equal sets form one class, which stands for them from then on. First each class is compared with one other,
the smallest centre of its keys, which joins most of a group of near copies with one link per class. Then, round by
round, a key's classes are compared with some of them, its centres, as far as they are in different components. Centres
leave the key after that, and a key all of whose classes are in one component is done. There are one, one, 64, 4096 and so
on centres per key, so even keys of many classes that are not similar need few rounds, and most classes have found their
component before many are compared. Sizes and the Hamming distance of 512-bit sketches filter all pairs, and that of
sketches with a bit or two for each shingle those of large sets, before they are verified on the full sets; pairs that were compared are not compared again. The rounds end when no two classes of a key
are in different components, so no link between different components is left out and components are exact (shingles and
sets are compared by 64-bit hashes).

Null texts and texts without words have an empty set and no links. Rows without an id are kept, without a component.
Rows with the same id are one document for its component.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signwatch.llm import text
from signwatch.llm.components import components
from signwatch.llm.tables import Steps, spread_join, tidy, written

SKETCH = 512
SKETCHES = [f"s{k}" for k in range(SKETCH // 64)]
#: Ids of texts that are broadcast, so that other texts need not be shuffled.
WANTED = 200_000
#: Rounds with one centre per key; from then on each round has so many times more of them.
SINGLE, FACTOR = 2, 64


@dataclass(frozen=True)
class Bands:
    """Size bands for pairs with ``100 * intersection >= percent * union``."""

    percent: int

    def difference(self, size: int) -> int:
        """Most shingles in which two sets of at most ``size`` can differ."""
        return 2 * size * (100 - self.percent) // (100 + self.percent)

    @lru_cache(maxsize=None)  # noqa: B019
    def top(self, band: int) -> int:
        """Largest size in the band. In band -1 only equal sets are similar."""
        if band < 0:
            return (100 + self.percent - 1) // (2 * (100 - self.percent)) if self.percent < 100 else 2**62
        before = self.top(band - 1)
        return max(before + 1, before * max(125, 10000 // self.percent + 1) // 100)

    @lru_cache(maxsize=1 << 20)  # noqa: B019
    def band(self, size: int) -> int:
        band = -1
        while self.top(band) < size:
            band += 1
        return band

    def of(self, size: int) -> range:
        """Bands of the larger set in any pair that a set of this size can be in."""
        return range(max(0, self.band(size)), self.band(size * 100 // self.percent) + 1)

    def parts(self, band: int) -> tuple[int, int]:
        """Parts, and how many of them may be empty in one of the two sets."""
        d = self.difference(self.top(band))
        spare = 1 + d // 16
        return d + 1 + spare, spare


def shingles(words: text.Words, length: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document; fewer words than ``length`` make one shingle."""
    hashes = words.hashes()
    rolling = text.window_hashes(hashes, length)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= length:
            own = np.sort(rolling[a : b - length + 1])
            keep = np.ones(len(own), dtype=bool)
            keep[1:] = own[1:] != own[:-1]
            out.append(own[keep])
        elif b > a:
            out.append(text.mix(text.window_hashes(hashes[a:b], b - a)[:1] + np.uint64(b - a)))
        else:
            out.append(hashes[:0])
    return out


def set_class(own: np.ndarray) -> int:
    """A hash of a set."""
    total = np.add.reduce(text.mix(own ^ np.uint64(0x5851F42D4C957F2D))) + np.uint64(len(own))
    return int(text.signed(text.mix(np.array([total], dtype=np.uint64)))[0])


def _parity(own: np.ndarray, bits: int) -> np.ndarray:
    odd = np.bincount((own & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def sketch(own: np.ndarray) -> np.ndarray:
    """Parity of the shingles on each of 512 bits."""
    return _parity(own, SKETCH).view(np.int64)


def wide_sketch(own: np.ndarray) -> bytes | None:
    """Parity on the next power of two of bits, for sets that are too large for 512; its halves, one upon the other, are
    the sketch of half as many bits."""
    return _parity(own, 1 << (len(own) - 1).bit_length()).tobytes() if len(own) > SKETCH else None


def part_keys(own: np.ndarray, band: int, parts: int, spare: int) -> np.ndarray:
    """A key for each part's parity sketch, one bit of 2**32 flipped by each shingle; hashed to 64 bits.

    Parts are ranges of the hash, so a sorted set falls into runs. Flipping a bit flips that bit's random value in
    the key, so equal sketches have equal keys. Empty parts have keys only where there are too many of them.
    """
    part = ((own >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    bits = np.bitwise_xor.reduceat(text.mix(own * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)), starts)
    used = part[starts]
    if parts - len(used) > spare:
        empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), used)
        used, bits = np.concatenate([used, empty]), np.concatenate([bits, np.zeros(len(empty), dtype=np.uint64)])
    return text.mix(bits + text.mix(used + np.uint64(band << 40)))


def _facts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, classes, sketches, wide = [], [], [], []
            for _, _, words in text.word_slices(batch.column("text")):
                for own in shingles(words, length):
                    size.append(len(own))
                    classes.append(set_class(own) if len(own) else None)
                    sketches.append(sketch(own))
                    wide.append(wide_sketch(own))
            table = np.array(sketches, dtype=np.int64).reshape(-1, len(SKETCHES))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(size, pa.int64()),
                    pa.array(classes, pa.int64()),
                    *(pa.array(np.ascontiguousarray(table[:, k])) for k in range(len(SKETCHES))),
                    pa.array(wide, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "class", *SKETCHES, "wide"],
            )

    return run


def _keys(length: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            seen: set[int] = set()
            for _, _, words in text.word_slices(batch.column("text")):
                keys, classes, sizes = [], [], []
                for own in shingles(words, length):
                    if not len(own) or (cls := set_class(own)) in seen:
                        continue
                    seen.add(cls)
                    for band in bands.of(len(own)):
                        keys.append(part_keys(own, band, *bands.parts(band)))
                        classes.append(cls)
                        sizes.append(len(keys[-1]))
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(text.signed(np.concatenate(keys))),
                            pa.array(np.repeat(np.array(classes, dtype=np.int64), sizes)),
                        ],
                        names=["key", "class"],
                    )

    return run


def _near(percent: int):
    """Keep pairs whose wide sketches allow the similarity, and those with a set that has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("wide_a"), batch.column("wide_b")
            n = sum(batch.column(x).fill_null(0).to_numpy() for x in ("n_a", "n_b"))
            keep = np.ones(len(batch), dtype=bool)
            sizes = [pc.binary_length(x).fill_null(0).to_numpy() for x in (a, b)]
            for x, y in {*zip(*(s.tolist() for s in sizes), strict=True)}:
                if not x or not y:
                    continue
                at = np.flatnonzero((sizes[0] == x) & (sizes[1] == y))
                least = min(x, y)
                # Sketches of more bits are folded to as many as the other one has.
                sides = [
                    np.bitwise_xor.reduce(np.frombuffer(b"".join(c.take(pa.array(at)).to_pylist()), dtype=np.uint8).reshape(len(at), -1, least), axis=1)
                    for c in (a, b)
                ]
                distance = np.bitwise_count(sides[0] ^ sides[1]).sum(axis=1, dtype=np.int64)
                keep[at] = distance * (100 + percent) <= n[at] * (100 - percent)
            yield batch.select(["a", "b", "rep_a", "rep_b"]).filter(pa.array(keep))

    return run


def _verify(length: int, percent: int):
    """Keep pairs whose sets, made anew from their texts, are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def own_set(value: pa.StringScalar) -> np.ndarray:
            column = pa.array([value.as_py()], pa.string())
            return next(shingles(words, length)[0] for _, _, words in text.word_slices(column))

        centre, centre_set = None, None
        for batch in batches:
            keep = []
            for k in range(len(batch)):
                a, b = batch.column("a")[k].as_py(), batch.column("b")[k].as_py()
                mine = own_set(batch.column("text_a")[k])
                if b != centre:
                    centre, centre_set = b, own_set(batch.column("text_b")[k])
                    if set_class(centre_set) != b:  # another text with the same document id
                        centre = None
                if centre is None or set_class(mine) != a:
                    keep.append(False)
                    continue
                both = len(np.intersect1d(mine, centre_set, assume_unique=True))
                keep.append(100 * both >= percent * (len(mine) + len(centre_set) - both))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("a"), kept.column("b")], names=["a", "b"])

    return run


def _close(percent: int) -> Column:
    """Sizes and sketches allow the similarity; both are necessary conditions."""
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    distance = sum((F.bit_count(F.col(f"{s}_a").bitwiseXOR(F.col(f"{s}_b"))) for s in SKETCHES), F.lit(0))
    return (100 * small >= percent * large) & (distance * (100 + percent) <= (F.col("n_a") + F.col("n_b")) * (100 - percent))


def _side(classes: DataFrame, side: str) -> DataFrame:
    return classes.select(
        F.col("class").alias(side),
        F.col("n_shingles").alias(f"n_{side}"),
        F.col("rep").alias(f"rep_{side}"),
        *(F.col(s).alias(f"{s}_{side}") for s in SKETCHES),
    )


def near(pairs: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a, b, rep_a, rep_b`` that wide sketches don't rule out, so that few texts have to move."""
    for x in "ab":
        pairs = pairs.join(wide.toDF(x, f"n_{x}", f"wide_{x}"), x, "left")
    return pairs.mapInArrow(_near(percent), "a long, b long, rep_a long, rep_b long")


def verified(pairs: DataFrame, docs: DataFrame, length: int, percent: int) -> DataFrame:
    """Those of the pairs ``a, b, rep_a, rep_b`` that are similar enough. Texts follow their pair to the centre ``b``."""
    texts = docs.filter("text IS NOT NULL").select("doc_id", "text")
    wanted = pairs.select(F.col("rep_a").alias("doc_id")).union(pairs.select("rep_b")).distinct()
    if wanted.count() <= WANTED:
        texts = texts.join(F.broadcast(wanted), "doc_id", "left_semi")
    member = pairs.join(texts.select(F.col("doc_id").alias("rep_a"), F.col("text").alias("text_a")), "rep_a")
    both = member.join(texts.select(F.col("doc_id").alias("rep_b"), F.col("text").alias("text_b")), "rep_b")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_verify(length, percent), "a long, b long")


def classes_and_components(docs: DataFrame, length: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Per document ``doc_id, n_shingles, class``; per linked class ``class, component``."""
    session = docs.sparkSession
    steps = Steps(session, "shingles")
    facts = docs.mapInArrow(_facts(length), "doc_id long, n_shingles long, class long, " + ", ".join(f"{s} long" for s in SKETCHES) + ", wide binary")
    facts = steps.keep(facts, "facts")
    classes = (
        facts.filter("class IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("class")
        .agg(F.min("doc_id").alias("rep"), *(F.min(c).alias(c) for c in ["n_shingles", *SKETCHES]))
    )
    classes = steps.keep(classes, "classes")
    wide = facts.filter("wide IS NOT NULL AND doc_id IS NOT NULL").groupBy("class")
    wide = steps.keep(wide.agg(F.min("n_shingles").alias("n"), F.min("wide").alias("wide")), "wide")
    key = Window.partitionBy("key")
    rows = docs.filter("doc_id IS NOT NULL").mapInArrow(_keys(length, percent), "key long, class long")
    shared = rows.select("key", "class", F.min("class").over(key).alias("low"), F.max("class").over(key).alias("high"))
    shared = steps.keep(shared.filter("low < high").select("key", "class").distinct(), "shared")
    tidy(session)
    # Tables that no Python worker has to make.
    linked = session.range(0).select(F.col("id").alias("class"), F.col("id").alias("component"))
    tried = session.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))
    turn = 0
    while True:
        placed = shared.join(linked, "class", "left").select("key", "class", F.coalesce("component", "class").alias("component"))
        # Keys whose classes are all in one component have nothing to tell any more.
        ends = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        shared = steps.keep(placed.join(ends.filter("low < high").select("key"), "key", "left_semi"), "shared")
        if shared.isEmpty():
            break
        pairs, centres = _first(shared) if turn == 0 else _met(shared, classes, percent, turn)
        pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = pairs.join(_side(classes, "a"), "a").join(_side(classes, "b"), "b").filter(_close(percent))
        pairs = steps.keep(pairs.select("a", "b", "rep_a", "rep_b"), "pairs")
        likely = steps.keep(near(pairs, wide, percent), "near")
        more = steps.keep(verified(likely, docs, length, percent), "links")
        if not more.isEmpty():
            linked = steps.keep(_relabelled(linked, more), "linked")
        tried = steps.keep(tried.union(pairs.select("a", "b")), "tried")
        shared = shared.select("key", "class")
        if turn:
            # All classes of the key have been compared with its centres now.
            shared = shared.join(centres, ["key", "class"], "left_anti")
        turn += 1
        tidy(session)
    steps.forget("classes", "wide", "shared", "pairs", "near", "links", "tried")
    return facts.select("doc_id", "n_shingles", "class"), linked


def _first(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One candidate for each class, the smallest centre of its keys, which near copies of one text have in common."""
    centres = rows.groupBy("key").agg(F.min(F.struct("class", "component")).alias("centre"))
    met = rows.join(centres, "key").filter("component <> centre.component")
    return met.groupBy(F.col("class").alias("a")).agg(F.min("centre.class").alias("b")), centres


def _met(rows: DataFrame, classes: DataFrame, percent: int, turn: int) -> tuple[DataFrame, DataFrame]:
    """Close pairs of a key's classes and its centres in different components, and the centres.

    Other centres each time, so that what hung on an unlucky one finds its neighbours.
    """
    most = FACTOR ** max(0, turn - SINGLE + 1)
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("class", F.lit(turn)), "class"))
    sides = rows.join(_side(classes, "class").drop("rep_class"), "class")
    left, right = (
        sides.select(F.col("key").alias(f"key_{x}"), F.col("class").alias(x), F.col("component").alias(f"component_{x}"), F.col("n_class").alias(f"n_{x}"), *(F.col(f"{s}_class").alias(f"{s}_{x}") for s in SKETCHES))
        for x in "ab"
    )
    centres = rows.withColumn("place", place).filter(F.col("place") <= most).select("key", "class")
    right = right.join(centres.toDF("key_b", "b"), ["key_b", "b"], "left_semi")
    met = left.join(right, (F.col("key_a") == F.col("key_b")) & (F.col("component_a") != F.col("component_b")) & _close(percent))
    pairs = met.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    return pairs, centres


def _relabelled(linked: DataFrame, links: DataFrame) -> DataFrame:
    """Components ``class, component`` with the new links ``a, b``, of which only those between components count."""
    ends = links.select(F.col("a").alias("class")).union(links.select("b")).distinct()
    linked = linked.union(ends.join(linked, "class", "left_anti").select("class", F.col("class").alias("component")))
    pairs = links
    for x in "ab":
        pairs = pairs.join(linked.toDF(x, f"component_{x}"), x)
    pairs = pairs.select(F.col("component_a").alias("a"), F.col("component_b").alias("b")).distinct()
    joined = components(pairs).toDF("component", "joined")
    sizes = linked.groupBy("component").agg(F.count(F.lit(1)).alias("size")).join(joined, "component", "left")
    sizes = sizes.select("component", "size", F.coalesce("joined", "component").alias("joined"))
    return spread_join(linked, sizes, "component", "size", linked.count()).select("class", F.col("joined").alias("component"))


def join(docs: DataFrame, words: int = 5, percent: int = 80, id: str = "doc_id", texts: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_shingles, class, component_id``.

    ``class`` is equal for documents with equal sets of shingles of ``words`` words. ``component_id`` is the smallest
    id that links reach; documents link when ``100 * intersection >= percent * union`` of their sets.
    """
    docs = docs.select(F.col(id).cast("long").alias("doc_id"), F.col(texts).alias("text"))
    facts, linked = classes_and_components(docs, words, percent)
    classes = facts.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("size"))
    classes = written(classes, "classes")
    least = linked.join(classes, "class").groupBy("component").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("classes"))
    least = spread_join(linked, least, "component", "classes", linked.count()).select("class", "least")
    classes = classes.join(least, "class", "left").select("class", "size", F.coalesce("least", "rep").alias("least"))
    placed = spread_join(facts.filter("class IS NOT NULL"), classes, "class", "size", facts.count())
    placed = placed.unionByName(facts.filter("class IS NULL").withColumn("least", F.lit(None).cast("long")))
    shared = F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id"))
    return placed.select("doc_id", "n_shingles", "class", shared.alias("component_id"))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id: str = "doc_id", texts: str = "text") -> DataFrame:
    """One document of each component, the one with the smallest id, all columns kept.

    Rows without an id stay. Of rows that share an id one stays.
    """
    keep = join(docs, words, percent, id, texts).filter("component_id = doc_id").select(F.col("doc_id").alias(id)).distinct()
    place = f"place_{uuid.uuid4().hex}"
    own = Window.partitionBy(id).orderBy(F.xxhash64(texts))
    once = docs.filter(F.col(id).isNotNull()).join(keep, id, "left_semi").select(*docs.columns)
    once = once.withColumn(place, F.row_number().over(own)).filter(F.col(place) == 1).drop(place)
    return once.union(docs.filter(F.col(id).isNull()))
