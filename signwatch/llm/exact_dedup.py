"""Exact copies of texts by two passes over a Bloom filter, with DataFrame functions only.

Texts are equal when identical after lower-casing A-Z. Each row has a digest (SHA-256 of the lower-cased UTF-8 bytes), which
stands for its text. The first pass counts the filter's bits: a row sets ``BITS`` bits of one block, and a bit counts as
repeated when at least two rows set it. Rows of which every bit is repeated are possible copies, all others are the only
ones of their text. The second pass looks each row's block up; only possible copies shuffle, as digest and id, and the
rest goes straight through. False positives are groups of one row, so results are exact at any load of the filter.

The filter has ``bits_a_row`` bits a row and never more than ``most_bits``, 2**30 if not given: that is what may be broadcast, at
most 128 MB of bits. With far more rows than bits, more rows shuffle (a digest and an id each), and nothing else changes.

A group of copies may hold any share of the rows: bits and groups are counted before they shuffle, and groups with more
than one in 10,000 of the possible copies, of which there are under 10,000, reach their rows by a broadcast instead of a shuffle.

Null texts count as empty, and empty texts are copies of each other. Of equal texts the row with the largest id stays, a null
id being smaller than any other; of rows with equal text and id exactly one stays. Long texts are one digest like any other.
An empty table gives an empty result. Only the named columns are read, so other columns may have any name.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signwatch.llm.tables import written

#: Bits that a row sets, and 64-bit words of a block.
BITS, WORDS = 2, 16
BLOCK = 64 * WORDS

#: Groups with more than one row in so many possible copies are broadcast; there are fewer of them than this.
SHARE = 10_000


def digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z in lower case. ``lower`` does just that where there are only ASCII characters."""
    raw = F.coalesce(text, F.lit(""))
    lowered = F.when(F.length(raw) == F.octet_length(raw), F.lower(raw)).otherwise(
        F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.unhex(F.sha2(lowered, 256))


@dataclass
class Repeated:
    """The repeated bits of a filter: one row for each block that has any, with its words ``w0, w1, ...``."""

    words: DataFrame
    blocks: int

    def mark(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows with a ``digest``, and whether each may be a copy."""
        block, bits = _places(self.blocks)
        every = F.array(*(F.col(f"w{j}") for j in range(WORDS)))
        hit = [F.element_at(every, (bit / 64).cast("int") + 1).bitwiseAND(_one(bit)) != 0 for bit in bits]
        found = rows.withColumn("block", block).join(F.broadcast(self.words), "block", "left")
        possible = F.col("w0").isNotNull() & hit[0]
        for h in hit[1:]:
            possible = possible & h
        return found.withColumn(name, F.coalesce(possible, F.lit(False))).select(*rows.columns, name)


def _one(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (bit % 64).cast("int"))


def _places(blocks: int) -> tuple[Column, list[Column]]:
    """Block of a row, and its different bits in there."""
    more = F.xxhash64("digest", F.lit(1))
    bit = more.bitwiseAND(F.lit(BLOCK - 1))
    bits = [bit]
    for k in range(1, BITS):
        step = F.pmod(F.shiftrightunsigned(more, 10 * k), F.lit(BLOCK // BITS))
        bit = F.pmod(bit + 1 + step, F.lit(BLOCK))
        bits.append(bit)
    return F.pmod(F.xxhash64("digest"), F.lit(blocks)), bits


def repeated(rows: DataFrame, n: int, bits_a_row: int = 32, most_bits: int = 1 << 30) -> Repeated:
    """First pass over ``n`` rows with a ``digest``: the bits that at least two of them set."""
    blocks = max(1, min(-(-n * bits_a_row // BLOCK), most_bits // BLOCK))
    block, bits = _places(blocks)
    counted = rows.select(block.alias("block"), F.explode(F.array(*bits)).alias("bit")).groupBy("block", "bit").count()
    word = (F.col("bit") / 64).cast("int")
    words = (
        counted.filter("count > 1")
        .groupBy("block")
        .agg(*(F.coalesce(F.bit_or(F.when(word == j, _one(F.col("bit")))), F.lit(0).cast("long")).alias(f"w{j}") for j in range(WORDS)))
    )
    return Repeated(written(words, "repeated-bits"), blocks)


def _spread(rows: DataFrame, groups: DataFrame, n: int) -> DataFrame:
    """Rows joined with their group by ``digest``; the few groups that hold many of the ``n`` rows are broadcast."""
    large = F.broadcast(groups.filter(F.col("group_size") * SHARE > n))
    others = rows.join(large.select("digest"), "digest", "left_anti")
    return rows.join(large, "digest").unionByName(others.join(groups, "digest"))


def copies(docs: DataFrame, id: str = "doc_id", text: str = "text", bits_a_row: int = 32, most_bits: int = 1 << 30) -> DataFrame:
    """One row per document: ``id, keep_id`` (id of the row that stays), ``group_size, kept, digest`` (binary)."""
    rows = docs.select(F.col(id).alias("id"), digest(F.col(text)).alias("digest"), F.monotonically_increasing_id().alias("row"))
    rows = written(rows, "digests")  # rows keep their number from here on
    seen = repeated(rows, rows.count(), bits_a_row, most_bits)
    marked = seen.mark(rows, "possible")
    possible = written(marked.filter("possible").drop("possible"), "possible-copies")
    groups = possible.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max(F.struct("id", "row")).alias("keep"))
    grouped = _spread(possible, groups, possible.count())
    out = ["id", "keep_id", "group_size", "kept", "digest"]
    grouped = grouped.withColumn("keep_id", F.col("keep.id")).withColumn("kept", F.col("row") == F.col("keep.row"))
    alone = marked.filter(~F.col("possible")).withColumn("keep_id", F.col("id"))
    alone = alone.withColumn("group_size", F.lit(1).cast("long")).withColumn("kept", F.lit(True))
    return alone.select(*out).unionByName(grouped.select(*out))


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", bits_a_row: int = 32, most_bits: int = 1 << 30) -> DataFrame:
    """The rows that stay, with all their columns. Only the texts of possible copies that stay shuffle."""
    own = [f"copies_{name}" for name in ("digest", "possible", "id", "place")]
    rows = written(docs.select(F.col(id).alias("id"), digest(F.col(text)).alias("digest")), "digests")
    seen = repeated(rows, rows.count(), bits_a_row, most_bits)
    possible = seen.mark(rows, "possible").filter("possible").drop("possible")
    stay = possible.groupBy("digest").agg(F.max(F.struct("id")).alias("keep")).select("digest", F.col("keep.id").alias("id"))
    packed = docs.select(F.struct(*docs.columns).alias("whole"), F.col(id).alias("id"), digest(F.col(text)).alias("digest"))
    marked = seen.mark(packed, own[1])
    likely = marked.filter(F.col(own[1]))
    stay = stay.withColumnsRenamed({"id": own[2], "digest": own[0]})
    likely = likely.join(stay, (F.col("digest") == F.col(own[0])) & F.col("id").eqNullSafe(F.col(own[2])))
    # rows with equal text and id: the smallest hash of the text as it was written stays
    order = Window.partitionBy("digest", "id").orderBy(F.xxhash64(F.col("whole")[text]))
    likely = likely.withColumn(own[3], F.row_number().over(order)).filter(F.col(own[3]) == 1)
    left = marked.filter(~F.col(own[1])).select("whole").union(likely.select("whole"))
    return left.select("whole.*")
