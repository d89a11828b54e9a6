"""SentencePiece encoding as a relational lattice, and decoding.

Words are cut where no piece can cross: between two characters that no piece has side by side. Each different word is
encoded once. Its substrings of bounded length are exploded and joined with the piece table; the edges that match are
grouped by word, and a fold over the edges (``aggregate``) keeps, for each end, the best score and where its last piece
begins (Viterbi). A second fold walks back. Characters that no piece covers become their UTF-8 bytes' pieces.

The texts themselves travel as blocks: a task turns a batch of documents into the list of its different words and, for
each document, numbers into that list, compressed. Words are spread by their text, encodings come back by block, those of a task for a block as one compressed row. The
piece table is as large as the vocabulary, which is why it may be broadcast.

The best segmentation is the one with the highest sum of scores, of equal ones the one whose last piece is longest, as
a unigram model has it. Spaces are ``U+2581`` in the table; one is put before every text that is not empty.

A word of more than ``LONG`` bytes is named by its digest in the lattice and cut into overlapping parts, whose edges
come together again; the folds keep what they have finished in runs, so a word takes time in proportion to its length.
All edges of one word are in one group, some 300 bytes a character: a word of a million characters needs a large executor.

Null and empty texts have no pieces. Repeated rows are encoded alike, each on its own. Long texts are encoded whole.
Of equally good segmentations the rule above decides. Without a text and without documents there are no rows in the
lattice. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signwatch.llm import text

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
#: Bytes of text in a block; smaller Arrow batches share one.
BLOCK_BYTES = 12 << 20
#: Bytes whose words are found at once, and words that are put in place at once.
SLICE = 1 << 18
PLACED = 1 << 18
#: Encoded words that a task sends to their blocks at once.
SENT = 1 << 18
#: Documents that are decoded at once.
DECODED = 1_000
#: Bytes of a word that travels with its edges; longer ones are cut into parts of so many characters.
LONG = 256
#: Edges, and steps back, of a run of the folds.
RUN = 256


@dataclass
class Vocabulary:
    """Pieces with their scores, byte pieces, and which characters stand side by side in a piece."""

    pieces: list[tuple[str, int, float]]
    bytes_of: list[bytes]
    byte_ids: list[int]
    unknown: float
    longest: int
    classes: np.ndarray
    linked: np.ndarray

    @classmethod
    def of(cls, model: sentencepiece.SentencePieceProcessor) -> Vocabulary:
        pieces, bytes_of, byte_ids = [], [], [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(piece[3:-1], 16)] = i
                bytes_of.append(bytes([int(piece[3:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                bytes_of.append(b"")
            else:
                pieces.append((piece.replace(SPACE, " "), i, float(model.get_score(i))))
                bytes_of.append(pieces[-1][0].encode())
        # Only characters that stand beside others in a piece; the table has a place for each two of them.
        alphabet = sorted({c for p, _, _ in pieces if len(p) > 1 for c in p})
        classes = np.zeros(0x110000, dtype=np.int32)
        for k, c in enumerate(alphabet):
            classes[ord(c)] = k + 1
        size = len(alphabet) + 1
        linked = np.zeros(size * size, dtype=bool)
        for p, _, _ in pieces:
            for a, b in zip(p, p[1:], strict=False):
                linked[classes[ord(a)] * size + classes[ord(b)]] = True
        longest = max((len(p) for p, _, _ in pieces), default=1)
        return cls(pieces, bytes_of, byte_ids, min((s for _, _, s in pieces), default=0.0) - 10, longest, classes, linked)

    def reach(self) -> list[int]:
        """For each two ASCII characters the length of the longest piece that begins with them; 1 at least."""
        out = [1] * (128 * 128)
        for p, _, _ in self.pieces:
            if len(p) > 1 and p[0] < "\x80" and p[1] < "\x80":
                at = ord(p[0]) * 128 + ord(p[1])
                out[at] = max(out[at], len(p))
        return out

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        return cls.of(sentencepiece.SentencePieceProcessor(model_file=path))

    def words(self, texts: list[str]) -> text.Words:
        """Words of texts that already begin with their space."""
        joined = "".join(texts)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = self.classes[codes].astype(np.int64)
        cut = np.ones(len(codes), dtype=bool)
        cut[1:] = ~self.linked[kind[:-1] * int(len(self.linked) ** 0.5 + 0.5) + kind[1:]]
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        ends = np.cumsum(lengths)
        cut[(ends - lengths)[lengths > 0]] = True
        at = np.flatnonzero(cut)
        width = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
        place = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        first = np.searchsorted(at, np.concatenate([[0], ends]))
        return text.Words(data, place[at], np.append(place[at[1:]], len(data)) if len(at) else place[:0], first)


def _grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Different values, a place of each, for each place which of them it has, and how often each occurs."""
    by = np.argsort(values)
    ordered = values[by]
    new = np.ones(len(by), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    which = np.empty(len(by), dtype=np.int32)
    which[by] = np.cumsum(new, dtype=np.int32) - 1
    return ordered[new], by[new], which, np.diff(np.append(np.flatnonzero(new), len(by)))


def _gathered(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Stretches of ``data`` one after another."""
    ends = np.cumsum(size)
    return data[np.repeat(starts - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers under 2**32, first the lowest byte of all; zeros further up then compress to nothing."""
    return numbers.astype("<u4", copy=False).view(np.uint8).reshape(-1, 4).T.tobytes()


def _numbers(planes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel()


@dataclass
class Block:
    """A batch of documents as its different words, and for each document their numbers."""

    key: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    numbers: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, column: pa.Array | pa.ChunkedArray, vocabulary: Vocabulary) -> Block:
        data, sizes, hashes, often, places, counts = [], [], [], [], [], []
        digest = xxhash.xxh64()
        # Each slice keeps its different words only.
        chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
        for part in (c.slice(begin, end - begin) for c in chunks for begin, end in text.slices(c, SLICE)):
            texts = [" " + x.replace(SPACE, " ") if x else "" for x in part.to_pylist()]
            words = vocabulary.words(texts)
            counts.append(words.counts().astype(np.uint32))
            digest.update(words.data.tobytes())
            digest.update(counts[-1].tobytes())
            found, first, which, n = _grouped(words.hashes())
            hashes.append(found)
            often.append(n.astype(np.int32))
            places.append(which)
            size = words.ends[first] - words.starts[first]
            sizes.append(size.astype(np.int32))
            data.append(_gathered(words.data, words.starts[first], size))
            del words
        none = np.zeros(0, dtype=np.int64)
        _, first, which, _ = _grouped(np.concatenate([*hashes, none.astype(np.uint64)]))
        total = np.bincount(which, weights=np.concatenate([*often, none]), minlength=len(first))
        # Frequent words have small numbers, which pack well.
        order = np.argsort(-total, kind="stable")
        number = np.empty(len(first), dtype=np.uint32)
        number[order] = np.arange(len(first), dtype=np.uint32)
        number = number[which]
        numbers = np.empty(sum(map(len, places)), dtype=np.uint32)
        at = base = 0
        # Each slice's places go as soon as they are numbers.
        for found in hashes:
            own = places.pop(0)
            numbers[at : at + len(own)] = number[base : base + len(found)][own]
            at, base = at + len(own), base + len(found)
        size = np.concatenate([*sizes, none])
        ends = np.cumsum(size)
        chosen = first[order]
        key = int(text.signed(np.array([digest.intdigest()], dtype=np.uint64))[0])
        return cls(
            key,
            np.concatenate([*data, none.astype(np.uint8)]),
            (ends - size)[chosen],
            ends[chosen],
            numbers,
            np.concatenate([*counts, none.astype(np.uint32)]),
        )

    def words(self) -> pa.Array:
        """The different words, by number."""
        size = self.ends - self.starts
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        data = _gathered(self.data, self.starts, size)
        return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(data))

    def packed(self) -> bytes:
        return zstandard.ZstdCompressor(level=3).compress(self.counts.astype("<u4").tobytes() + _planes(self.numbers))

    @staticmethod
    def unpacked(packed: bytes, documents: int) -> tuple[np.ndarray, np.ndarray]:
        """Counts of words, and the words' numbers."""
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
        return raw[: 4 * documents].view("<u4").astype(np.int64), _numbers(raw[4 * documents :])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows with about ``BLOCK_BYTES`` of text. Small batches fill blocks together; those that hold a block or more are
    cut on their own, so none of them has to wait for a later one."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        offsets = text.texts_bytes(batch.column("text"))[1]
        large = offsets[-1] >= BLOCK_BYTES
        if large and held:
            yield pa.Table.from_batches(held)
            held, size = [], 0
        begin = 0
        while begin < len(batch):
            end = int(np.searchsorted(offsets, offsets[begin] + BLOCK_BYTES - size, side="right")) - 1
            # A longer text is a block of its own.
            end = max(end, begin + (not held))
            held.append(batch.slice(begin, end - begin))
            size += int(offsets[end] - offsets[begin])
            begin = end
            if large or begin < len(batch):
                yield pa.Table.from_batches(held)
                held, size = [], 0
                pa.default_memory_pool().release_unused()
    if held:
        yield pa.Table.from_batches(held)


def _named(words: pa.Array, size: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Short words as they are; for long ones a digest that is too long for a short word, and the word itself."""
    long = size > LONG
    if not long.any():
        return words, pa.nulls(len(words), pa.string())
    every = words.to_pylist()
    short = [hashlib.sha512(w.encode()).hexdigest() * 3 if x else w for w, x in zip(every, long, strict=True)]
    return pa.array(short, pa.string()), pa.array([w if x else None for w, x in zip(every, long, strict=True)], pa.string())


def _words(vocabulary: Vocabulary):
    """The different words of each block, with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            block = Block.of(batch.column("text"), vocabulary)
            n = len(block.starts)
            word, whole = _named(block.words(), block.ends - block.starts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block.key, dtype=np.int64)), pa.array(np.arange(n, dtype=np.int32)), word, whole],
                names=["block", "number", "word", "whole"],
            )

    return run


def _packed(vocabulary: Vocabulary):
    """Each block's documents, as numbers of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches):
            block = Block.of(batch.column("text"), vocabulary)
            ids = pa.ListArray.from_arrays(pa.array([0, len(batch)], pa.int32()), batch.column("doc_id").combine_chunks())
            yield pa.RecordBatch.from_arrays(
                [pa.array([block.key], pa.int64()), ids, pa.array([block.packed()], pa.binary())], names=["block", "ids", "packed"]
            )

    return run


def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Encoded words as one compressed row per block: their numbers, how many pieces each has, and the pieces."""

    def rows(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        block, number = table["block"].to_numpy(), table["number"].to_numpy()
        by = np.lexsort((number, block))
        block, number = block[by], number[by]
        lists = table["pieces"].combine_chunks().take(pa.array(by))
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        values = lists.flatten().to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])
        at = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1], [True]]))
        packed = []
        for x, y in zip(at[:-1], at[1:], strict=True):
            # Numbers go up, so their steps are small.
            raw = _planes(np.array([y - x])) + _planes(np.diff(number[x:y], prepend=0)) + _planes(size[x:y])
            packed.append(zstandard.ZstdCompressor(level=3).compress(raw + _planes(values[ends[x] : ends[y]])))
        return pa.RecordBatch.from_arrays([pa.array(block[at[:-1]]), pa.array(packed, pa.binary())], names=["block", "codes"])

    held, n = [], 0
    for batch in batches:
        if len(batch):
            held.append(batch)
            n += len(batch)
        if n >= SENT:
            yield rows(held)
            held, n = [], 0
    if held:
        yield rows(held)


def _codes(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each number of a word where its pieces begin and how many they are; and all pieces."""
    numbers, sizes, values = [], [], [np.zeros(0, dtype=np.uint32)]
    for row in packed:
        raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(row), dtype=np.uint8)
        n = int(_numbers(raw[:4])[0])
        numbers.append(np.cumsum(_numbers(raw[4 : 4 + 4 * n]), dtype=np.int64))
        sizes.append(_numbers(raw[4 + 4 * n : 4 + 8 * n]).astype(np.int64))
        values.append(_numbers(raw[4 + 8 * n :]))
    number = np.concatenate([*numbers, np.zeros(0, dtype=np.int64)])
    size = np.concatenate([*sizes, np.zeros(0, dtype=np.int64)])
    # A block that occurs twice has each word twice, encoded alike.
    begin, long = np.zeros((2, int(number.max(initial=-1)) + 1), dtype=np.int64)
    begin[number], long[number] = np.cumsum(size) - size, size
    return begin, long, np.concatenate(values).astype(np.int32)


def _assemble(kind: pa.DataType, vocabulary: Vocabulary | None):
    """Put the encodings of a block's words in place of their numbers.

    Given a vocabulary, the pieces are decoded again as well.
    """
    decoded = None if vocabulary is None else _decoded(vocabulary, "pieces")

    def schema(decoded) -> pa.Schema:
        fields = [("doc_id", kind), ("pieces", pa.list_(pa.int32())), ("text", pa.string())]
        return pa.schema(fields[:2] if decoded is None else fields)

    def run(blocks: pa.Table, codes: pa.Table) -> pa.Table:
        begin, size, values = _codes(codes["codes"].to_pylist())
        out = []
        for k in range(blocks.num_rows):
            ids = blocks["ids"][k].values
            counts, numbers = Block.unpacked(blocks["packed"][k].as_py(), len(ids))
            bounds = np.cumsum(counts)
            offsets = np.zeros(len(bounds) + 1, dtype=np.int32)
            flat, n, at = [], 0, 0
            for a in range(0, len(numbers), PLACED):
                own = numbers[a : a + PLACED]
                flat.append(_gathered(values, begin[own], size[own]))
                ends = np.concatenate([[0], np.cumsum(size[own])])
                # The documents that end among these words.
                end = int(np.searchsorted(bounds, a + len(own), side="right"))
                offsets[at + 1 : end + 1] = n + ends[np.maximum(bounds[at:end] - a, 0)]
                n, at = n + int(ends[-1]), end
            del numbers
            flat = np.concatenate([*flat, values[:0]])
            offsets[at + 1 :] = n
            pieces = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            table = pa.table({"doc_id": ids.cast(kind), "pieces": pieces})
            out.append(table if decoded is None else pa.Table.from_batches(decoded(iter(table.to_batches())), schema(decoded)))
        return pa.concat_tables(out) if out else schema(decoded).empty_table()

    return run


#: Best score, begin of the last piece and its id for each end, from edges sorted by end and begin. A run of edges looks
#: back at the last ``{longest}`` ends only; ``done`` begins with the end ``base``, earlier ones are in ``old``.
BEST = """
aggregate(sequence(0, size(edges) - 1, {run}),
  named_struct('old', cast(array() as array<array<struct<score: double, begin: int, id: int>>>),
               'now', named_struct('base', 0, 'done', array(named_struct('score', 0D, 'begin', 0, 'id', -1)), 'end', 0,
                                   'best', named_struct('score', 0D, 'begin', 0, 'id', -1))),
  (t, k) -> named_struct(
    'old', concat(t.old, array(slice(t.now.done, 1, greatest(size(t.now.done) - {longest}, 0)))),
    'now', aggregate(slice(edges, k + 1, {run}),
      named_struct('base', t.now.base + greatest(size(t.now.done) - {longest}, 0),
                   'done', slice(t.now.done, greatest(size(t.now.done) - {longest}, 0) + 1, {longest}),
                   'end', t.now.end, 'best', t.now.best),
      (s, e) -> if(e.end = s.end,
        if(s.done[e.begin - s.base].score + e.score > s.best.score,
           named_struct('base', s.base, 'done', s.done, 'end', s.end,
                        'best', named_struct('score', s.done[e.begin - s.base].score + e.score, 'begin', e.begin, 'id', e.id)),
           s),
        -- The first edge of the next end; before the first end there is nothing to keep.
        transform(array(if(s.end = 0, s.done, concat(s.done, array(s.best)))), done ->
          named_struct('base', s.base, 'done', done, 'end', e.end,
                       'best', named_struct('score', done[e.begin - s.base].score + e.score, 'begin', e.begin, 'id', e.id)))[0]))),
  t -> concat(flatten(t.old), t.now.done, array(t.now.best)))
"""

#: The ids on the best path, from its end; below zero stands a character without a piece.
BACK = """
transform(array(best), path ->
  reverse(aggregate(sequence(0, size(path) - 1, {run}),
    named_struct('old', cast(array() as array<array<int>>), 'now', named_struct('at', size(path) - 1, 'steps', cast(array() as array<int>))),
    (t, k) -> named_struct(
      'old', concat(t.old, array(t.now.steps)),
      'now', aggregate(slice(path, 1, {run}), named_struct('at', t.now.at, 'steps', cast(array() as array<int>)),
        (s, x) -> if(s.at = 0, s, named_struct('at', path[s.at].begin, 'steps', concat(s.steps, array(path[s.at].id)))))),
    t -> concat(flatten(t.old), t.now.steps))))[0]
"""


def lattice(words: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``word, pieces`` for each of the different words: ``word``, which stands for ``whole`` where that isn't null."""
    spark = words.sparkSession
    # Numbers are looked up faster than strings; the strings are compared as well.
    kinds = {"piece": pa.string(), "id": pa.int32(), "score": pa.float64()}
    table = pa.table({name: pa.array([p[k] for p in vocabulary.pieces], kind) for k, (name, kind) in enumerate(kinds.items())})
    table = spark.createDataFrame(table).withColumn("key", F.xxhash64("piece"))
    string = F.coalesce("whole", "word")
    cuts = F.sequence(F.lit(0), F.length(string) - 1, F.lit(LONG))
    cut = F.transform(cuts, lambda k: F.struct(k.alias("offset"), F.substring(string, k + 1, F.lit(LONG + vocabulary.longest - 1)).alias("part")))
    cut = F.when(F.col("whole").isNull(), F.array(F.struct(F.lit(0).alias("offset"), F.col("word").alias("part")))).otherwise(cut)
    parts = words.select("word", F.inline(cut))
    begins = parts.select("*", F.explode(F.sequence(F.lit(0), F.least(F.length("part"), F.lit(LONG)) - 1)).alias("begin"))
    # No piece that begins with these two characters is longer; only ASCII is looked up.
    two = F.substring("part", F.col("begin") + 1, F.lit(2))
    first, second = F.ascii(two), F.ascii(F.substring(two, 2, 1))
    reach = F.split(F.lit(",".join(map(str, vocabulary.reach()))), ",").cast("array<int>")
    most = F.when((first < 128) & (second < 128), F.element_at(reach, first * 128 + second + 1)).otherwise(vocabulary.longest)
    ends = begins.select("*", F.explode(F.sequence(F.col("begin") + 1, F.least(F.col("begin") + most, F.length("part")))).alias("end"))
    strings = ends.select(
        "word",
        (F.col("offset") + F.col("begin")).alias("begin"),
        (F.col("offset") + F.col("end")).alias("end"),
        F.substring("part", F.col("begin") + 1, F.col("end") - F.col("begin")).alias("part"),
    ).withColumn("part_key", F.xxhash64("part"))
    same = (F.col("part_key") == F.col("key")) & (F.col("part") == F.col("piece"))
    edges = strings.join(F.broadcast(table), same, "left").filter("id IS NOT NULL OR end = begin + 1")
    # A character without a piece has its code point as an id below zero.
    number = F.coalesce("id", -1 - F.ascii("part"))
    edge = F.struct("end", "begin", F.coalesce("score", F.lit(vocabulary.unknown)).alias("score"), number.alias("id"))
    # Rows are sorted by a number first, which is faster than by words.
    grouped = edges.withColumn("by", F.xxhash64("word")).groupBy("by", "word").agg(F.collect_list(edge).alias("edges"))
    sizes = {"run": RUN, "longest": vocabulary.longest}
    best = grouped.select("word", F.sort_array("edges").alias("edges")).select("word", F.expr(BEST.format(**sizes)).alias("best"))
    steps = best.select("word", F.expr(BACK.format(**sizes)).alias("steps"))
    byte_ids = F.split(F.lit(",".join(map(str, vocabulary.byte_ids))), ",").cast("array<int>")

    def pieces(id):
        code = -1 - id
        low = lambda shift: F.shiftright(code, shift).bitwiseAND(63) + 128
        raw = (
            F.when(code < 0x80, F.array(code))
            .when(code < 0x800, F.array(F.shiftright(code, 6) + 0xC0, low(0)))
            .when(code < 0x10000, F.array(F.shiftright(code, 12) + 0xE0, low(6), low(0)))
            .otherwise(F.array(F.shiftright(code, 18) + 0xF0, low(12), low(6), low(0)))
        )
        return F.when(id < 0, F.transform(raw, lambda b: F.element_at(byte_ids, b + 1))).otherwise(F.array(id))

    return steps.select("word", F.flatten(F.transform("steps", pieces)).alias("pieces"))


def encode(docs: DataFrame, vocabulary: Vocabulary, id: str = "doc_id", texts: str = "text", again: bool = False) -> DataFrame:
    """One row per document: ``doc_id, pieces`` (the ids); with ``again`` also the ``text`` that they decode to."""
    docs = docs.select(F.col(id).alias("doc_id"), F.col(texts).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    # Dealt once by word: for the lattice, and to be given their encodings.
    used = docs.mapInArrow(_words(vocabulary), "block long, number int, word string, whole string").repartition("word")
    # All columns are kept, or Spark would deal the words out a second time without them.
    once = used.groupBy("word", "whole").agg(F.min("block").alias("block"), F.min("number").alias("number"))
    once = once.filter("block IS NOT NULL AND number IS NOT NULL").select("word", "whole")
    encoded = used.join(lattice(once, vocabulary), "word")
    encoded = encoded.withColumn("pieces", F.coalesce("pieces", F.array(F.length("whole"))))
    sent = encoded.select("block", "number", "pieces").mapInArrow(_sent, "block long, codes binary")
    blocks = docs.mapInArrow(_packed(vocabulary), f"block long, ids array<{kind}>, packed binary")
    arrow = docs.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    both = blocks.groupBy("block").cogroup(sent.groupBy("block"))
    schema = f"doc_id {kind}, pieces array<int>" + ", text string" * again
    return both.applyInArrow(_assemble(arrow, vocabulary if again else None), schema)


def _decoded(vocabulary: Vocabulary, column: str):
    size = np.array([len(b) for b in vocabulary.bytes_of], dtype=np.int64)
    begin = np.cumsum(size) - size
    table = np.frombuffer(b"".join(vocabulary.bytes_of), dtype=np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), DECODED):
                batch = whole.slice(at, DECODED)
                lists, out = batch.column(column), []
                for k in range(len(batch)):
                    ids = lists[k].values
                    if ids is None:
                        out.append(None)
                        continue
                    ids = ids.to_numpy(zero_copy_only=False)
                    own = size[ids]
                    ends = np.cumsum(own)
                    data = table[np.repeat(begin[ids] - (ends - own), own) + np.arange(ends[-1] if len(ends) else 0)]
                    out.append(data.tobytes().decode("utf-8", "replace").removeprefix(" "))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], names=[*batch.schema.names, "text"])

    return run


def decode(encoded: DataFrame, vocabulary: Vocabulary, column: str = "pieces") -> DataFrame:
    """The rows with their ``text`` again; null for null. Bytes that aren't UTF-8 become replacement characters."""
    schema = encoded.drop("text")
    return schema.mapInArrow(_decoded(vocabulary, column), f"{schema.schema.simpleString()[7:-1]}, text string")


def vocabulary_of(spark: SparkSession, path: str | None = None) -> Vocabulary:
    """The vocabulary at ``path``, or where ``spark.signwatch.pieces`` says."""
    return Vocabulary.load(path or spark.conf.get("spark.signwatch.pieces", MODEL))
