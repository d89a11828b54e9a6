"""What each quality filter removes in every order of the filters.

A document has a mask: which filters it fails. In an order of the filters it is removed at the first step whose filter it
fails. Orders are numbered lexicographically (their Lehmer rank), so the orders that begin with the same letters are an
interval of ranks. A mask is removed at step ``s`` in just those intervals whose first ``s - 1`` letters it passes and
whose next one it fails. Counts of documents per part and mask are added at the begin of each interval and taken off at
its end; a prefix sum over the ranks then gives each order's removals per step.

The masks come from one pass over the texts. Whether an earlier document has the same text is found on digests (SHA-256)
per id; a text that many documents share is one row per id and part when it is joined, so no text or part is hot.

Null texts are empty. Only ids smaller than the own count as earlier: rows without an id have no earlier one and are none.
Rows with the same id have none of each other as earlier. Several labels of an id count as 1 if one of them is 1. A null part
is the empty string. An empty table gives no rows. Long texts are counted whole. Columns of other names aren't read.
"""

from __future__ import annotations

import itertools
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signwatch.llm.tables import written

#: The letters of the filters, in the order of their bits.
FILTERS = "ABCDE"

SEPARATORS = r"[\x20\x09-\x0D]+"
WEIGHTS = ["n", "good", "toxic"]


def failures(text: Column) -> list[Column]:
    """Failure conditions that the text alone decides: too short, repetitive, many capitals, odd signs."""
    raw = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(raw, SEPARATORS), lambda w: w != "")
    n = F.size(words)
    return [
        n < 200,
        F.size(F.array_distinct(words)) * 100 < n * 50,
        F.regexp_count(raw, F.lit("[A-Z]")) * 100 > F.length(raw) * 2,
        raw.rlike(r"[#$%&*|]"),
    ]


def orders(letters: str = FILTERS) -> list[str]:
    """All orders; the place in the list is the rank."""
    return ["".join(p) for p in itertools.permutations(letters)]


def rank(begin: str, letters: str = FILTERS) -> int:
    """Rank of the first order that begins so."""
    left, at = list(letters), 0
    for letter in begin:
        at += left.index(letter) * factorial(len(left) - 1)
        left.remove(letter)
    return at


def intervals(letters: str = FILTERS) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank after the last) of each interval in which the mask is removed at the step."""
    out = []
    for step in range(1, len(letters) + 1):
        width = factorial(len(letters) - step)
        for begin in itertools.permutations(letters, step):
            passed = sum(1 << letters.index(x) for x in begin[:-1])
            failed = 1 << letters.index(begin[-1])
            first = rank("".join(begin), letters)
            out += [(m, step, first, first + width) for m in range(1 << len(letters)) if m & failed and not m & passed]
    return out


def masks(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``part, mask, n, good, toxic``: documents of a part that fail just the filters in the mask, and the labelled ones of them."""
    bits = sum((F.when(c, 1 << k).otherwise(0) for k, c in enumerate(failures(F.col(text)))), F.lit(0))
    rows = docs.select(
        F.col(id).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("digest"),
        bits.alias("mask"),
    )
    rows = rows.groupBy("id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    first = rows.filter("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    rows = rows.join(first, ["id", "digest"], "left")
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    rows = rows.withColumn("mask", F.col("mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0))
    rows = rows.groupBy("id", "part", "mask").agg(F.sum("n").alias("n"))
    known = labels.groupBy(F.col(id).alias("id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    rows = rows.join(known.filter("id IS NOT NULL"), "id", "left")
    weight = lambda c: F.sum(F.col("n") * F.coalesce(F.col(c), F.lit(0)))
    return rows.groupBy("part", "mask").agg(F.sum("n").alias("n"), weight("good").alias("good"), weight("toxic").alias("toxic"))


def interactions(counts: DataFrame) -> DataFrame:
    """Per part, order and step what is kept, removed and lost, from the counts of ``masks``."""
    spark = counts.sparkSession
    letters, steps = FILTERS, len(FILTERS)
    n_orders = factorial(steps)
    ends = [(m, s, at, sign) for m, s, a, b in intervals() for at, sign in ((a, 1), (b, -1)) if at < n_orders]
    ends = F.broadcast(spark.createDataFrame(ends, "mask int, step int, rank int, sign int"))
    added = counts.join(ends, "mask").select("part", "step", "rank", *((F.col("sign") * F.col(w)).alias(w) for w in WEIGHTS))
    # every order and step has a row, also where nothing begins or ends
    grid = counts.select("part").distinct().select("part", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("step"))
    grid = grid.select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(n_orders - 1))).alias("rank"))
    grid = grid.select("*", *(F.lit(0).cast("long").alias(w) for w in WEIGHTS))
    steps_of = added.unionByName(grid).groupBy("part", "step", "rank").agg(*(F.sum(w).alias(w) for w in WEIGHTS))
    along = Window.partitionBy("part", "step").orderBy("rank")
    removed = steps_of.select("part", "step", "rank", *(F.sum(w).over(along).alias(w) for w in WEIGHTS))

    order = F.element_at(F.array(*map(F.lit, orders())), F.col("rank") + 1)
    removed = removed.withColumn("filter_order", order).withColumn("letter", F.substring(order, F.col("step"), F.lit(1)))
    bits = [1 << k for k in range(steps)]
    of = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    totals = counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.array(*(of(F.col("mask").bitwiseAND(b) != 0) for b in bits)).alias("failing"),
        F.array(*(of(F.col("mask") == b) for b in bits)).alias("only"),
    )
    own = F.instr(F.lit(letters), F.col("letter"))
    so_far = Window.partitionBy("part", "rank").orderBy("step")
    anywhere = Window.partitionBy("part", "letter")
    return removed.join(totals, "part").select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.sum("n").over(so_far)).alias("kept"),
        F.col("n").alias("removed"),
        (F.element_at("failing", own) - F.col("n")).alias("redundant"),
        F.element_at("only", own).alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(anywhere).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley``, zeros included."""
    return interactions(written(masks(docs, labels, id, text, part), "masks"))
