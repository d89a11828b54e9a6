"""Benchmark decontamination with suffix arrays over the training texts.

Every task turns its documents, slice by slice, into a suffix array of words: all word positions, sorted by the words
that follow, as deep as the longest test item reaches. No match ends deeper, so no deeper order is needed. Every test
suffix is then looked up by binary search, one word deeper at a time; the interval it has left is the set of places
where that many of its words stand verbatim. Documents never move, so nothing is shuffled and no key can be hot.

Test items are sent to the tasks in blocks of ``BLOCK_WORDS`` words at most. With more items there are more blocks,
each a further step over the same rows. Words are compared by 64-bit hashes.

Null or empty texts have no words and no hits. Items without words occur nowhere; an item without an id marks words
but is not listed. Equal rows are judged alike, each on its own. Without items nothing is marked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signwatch.llm import text

WINDOW = 10
BLOCK_WORDS = 2_000_000


@dataclass
class TestItems:
    """A block of test items: words one after another, for each word the words left in its item, and the items' ids."""

    words: np.ndarray
    left: np.ndarray
    item: np.ndarray
    ids: list[str | None]
    window: int
    #: Suffixes that are looked up, and the depth at which each is a whole window.
    suffixes: np.ndarray
    depth: np.ndarray

    @classmethod
    def of(cls, ids: list[str | None], texts: list[str | None], window: int) -> TestItems:
        words, item = [], []
        for begin, _, found in text.word_slices(pa.array(texts, pa.string()), text.SIGNS):
            words.append(found.hashes())
            item.append(found.documents() + begin)
        words = np.concatenate([*words, np.zeros(0, dtype=np.uint64)])
        item = np.concatenate([*item, np.zeros(0, dtype=np.int64)]).astype(np.int64)
        size = np.bincount(item, minlength=len(ids))
        place = np.arange(len(words)) - np.repeat(np.cumsum(size) - size, size)
        left = size[item] - place
        depth = np.minimum(size[item], window)
        suffixes = np.flatnonzero(left >= depth)
        return cls(words, left, item, ids, window, suffixes, depth[suffixes])


def blocks(items: DataFrame, id: str, texts: str, window: int, block_words: int = BLOCK_WORDS) -> Iterator[TestItems]:
    """The test items, some at a time; a block ends where its words reach the bound."""
    ids, kept, size = [], [], 0
    for row in items.select(F.col(id).cast("string"), F.col(texts)).toLocalIterator():
        ids.append(row[0])
        kept.append(row[1])
        size += len(row[1] or "") // 2 + 1
        if size >= block_words:
            yield TestItems.of(ids, kept, window)
            ids, kept, size = [], [], 0
    if ids:
        yield TestItems.of(ids, kept, window)


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``symbols`` in the order of the ``depth`` symbols from each on, by doubling.

    Each round sorts only positions that still tie, by the rank of what follows the part already compared.
    """
    n = len(symbols)
    order = np.argsort(symbols)
    ordered = symbols[order]
    new = np.ones(n + 1, dtype=bool)
    new[1:n] = ordered[1:] != ordered[:-1]
    rank = np.zeros(n, dtype=np.int64)
    heads = np.flatnonzero(new)
    rank[order] = np.repeat(heads[:-1], np.diff(heads))
    compared = 1
    while compared < depth:
        tied = np.flatnonzero(~(new[:-1] & new[1:]))
        if not len(tied):
            break
        at = order[tied]
        after = np.minimum(at + compared, n - 1)
        key = (rank[at] << 32) | np.where(at + compared < n, rank[after] + 1, 0)
        by = np.argsort(key)
        key, at = key[by], at[by]
        order[tied] = at
        fresh = np.ones(len(tied), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        new[tied] = fresh
        firsts = np.flatnonzero(fresh)
        rank[at] = np.repeat(tied[firsts], np.diff([*firsts, len(tied)]))
        compared *= 2
    return order


def bounds(
    symbols: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, deep: int, wanted: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Within each interval of equal prefixes, the part whose next symbol is the wanted one: two binary searches."""

    def search(above: bool) -> np.ndarray:
        a, b = low.copy(), high.copy()
        while len(open_ := np.flatnonzero(a < b)):
            middle = (a[open_] + b[open_]) // 2
            at = order[middle] + deep
            found = symbols[np.minimum(at, len(symbols) - 1)]
            lower = found <= wanted[open_] if above else found < wanted[open_]
            a[open_] = np.where(lower, middle + 1, a[open_])
            b[open_] = np.where(lower, b[open_], middle)
        return a

    return search(False), search(True)


def spans(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The numbers of all intervals one after another."""
    size = high - low
    return np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())


@dataclass
class Found:
    """What a slice of documents shares with a block of test items; words and lengths by position in the slice."""

    hit: np.ndarray
    longest: np.ndarray
    suffix: np.ndarray
    documents: np.ndarray
    items: np.ndarray


def occurrences(words: text.Words, tests: TestItems) -> Found:
    """Build the slice's suffix array, look every test suffix up, mark all places."""
    count = words.counts()
    documents = words.documents()
    # A zero, which is no word's hash, ends each document.
    place = np.arange(len(documents)) + documents
    symbols = np.zeros(len(documents) + len(count), dtype=np.uint64)
    symbols[place] = words.hashes()
    reach = int(tests.left.max(initial=1))
    order = suffix_array(symbols, reach)
    hit = np.zeros(len(symbols) + 1, dtype=np.int64)
    longest = np.zeros(len(symbols), dtype=np.int64)
    suffix = np.full(len(symbols), -1)
    pairs: list[np.ndarray] = []
    of = np.full(len(symbols), -1)
    of[place] = documents

    active = tests.suffixes
    window = tests.depth
    first = symbols[order]
    low = np.searchsorted(first, tests.words[active], "left")
    high = np.searchsorted(first, tests.words[active], "right")
    deep = 1
    while True:
        keep = low < high
        active, window, low, high = active[keep], window[keep], low[keep], high[keep]
        if not len(active):
            break
        if (whole := window == deep).any():
            starts, which = np.unique(low[whole], return_inverse=True)
            ends = np.zeros_like(starts)
            ends[which] = high[whole]
            where = order[spans(starts, ends)]
            np.add.at(hit, where, 1)
            np.add.at(hit, where + deep, -1)
            # Each document once for a window, then each of the window's items.
            owner = np.unique(np.repeat(np.arange(len(starts)), ends - starts) * len(count) + of[where])
            items = np.unique(which * len(tests.ids) + tests.item[active[whole]])
            begin = np.searchsorted(items, owner // len(count) * len(tests.ids))
            end = np.searchsorted(items, (owner // len(count) + 1) * len(tests.ids))
            pairs.append(
                np.unique(
                    np.repeat(owner % len(count), end - begin) * len(tests.ids) + items[spans(begin, end)] % len(tests.ids)
                )
            )
        if (enough := window <= deep).any():
            starts, which = np.unique(low[enough], return_index=True)
            where = spans(starts, high[enough][which])
            longest[order[where]] = deep
            suffix[order[where]] = np.repeat(active[enough][which], high[enough][which] - starts)
        longer = tests.left[active] > deep
        active, window, low, high = active[longer], window[longer], low[longer], high[longer]
        if not len(active):
            break
        low, high = bounds(symbols, order, low, high, deep, tests.words[active + deep])
        deep += 1
    both = np.unique(np.concatenate([*pairs, np.zeros(0, dtype=np.int64)])).astype(np.int64)
    number = max(len(tests.ids), 1)
    return Found(np.cumsum(hit)[place] > 0, longest[place], suffix[place], both // number, both % number)


MATCH = "struct<length: int, doc_word: int, item_id: string, item_word: int>"


def _annotate(tests: TestItems | None, texts: str):
    """Add to each document what this block finds: words hit, items, and the longest verbatim match with its places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(texts)
            n_words = np.zeros(len(batch), dtype=np.int64)
            hits = batch.column("hit_words").to_pylist()
            items = batch.column("items").to_pylist()
            best = batch.column("longest").to_pylist()
            for begin, _, words in text.word_slices(column, text.SIGNS):
                count = words.counts()
                n_words[begin : begin + len(count)] = count
                if tests is None or not len(tests.suffixes) or not len(words.starts):
                    continue
                found = occurrences(words, tests)
                for k in np.unique(words.documents()[found.hit]):
                    a, b = words.first[k], words.first[k + 1]
                    here = np.flatnonzero(found.hit[a:b])
                    hits[begin + k] = np.union1d(hits[begin + k], here).astype(np.int32).tolist()
                    p = int(found.longest[a:b].argmax())
                    length = int(found.longest[a + p])
                    if best[begin + k] is None or length > best[begin + k]["length"]:
                        s = found.suffix[a + p]
                        of = int(tests.item[s])
                        at = int(s - np.searchsorted(tests.item, of))
                        best[begin + k] = {"length": length, "doc_word": p, "item_id": tests.ids[of], "item_word": at}
                for k, item in zip(found.documents, found.items, strict=True):
                    if tests.ids[item] is not None and tests.ids[item] not in items[begin + k]:
                        items[begin + k].append(tests.ids[item])
            names = ["doc_id", texts, "n_words", "hit_words", "items", "longest"]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    column,
                    pa.array(n_words, pa.int64()),
                    pa.array(hits, pa.list_(pa.int32())),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(best, pa.struct([("length", pa.int32()), ("doc_word", pa.int32()), ("item_id", pa.string()), ("item_word", pa.int32())])),
                ],
                names=names,
            )

    return run


def search(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id: str = "doc_id",
    texts: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: ``doc_id, n_words, hit_words, items, longest``.

    ``hit_words`` are the numbers of the words inside an occurrence of ``window`` consecutive words of a test item
    (or of a whole shorter item), ``items`` the ids of items with such windows, ``longest`` the longest verbatim
    match: words, place in the document, item, place in the item.
    """
    kind = docs.schema[id].dataType.simpleString()
    schema = f"doc_id {kind}, text string, n_words long, hit_words array<int>, items array<string>, longest {MATCH}"
    state = docs.select(
        F.col(id).alias("doc_id"),
        F.col(texts).alias("text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("hit_words"),
        F.array().cast("array<string>").alias("items"),
        F.lit(None).cast(MATCH).alias("longest"),
    )
    several = [b for b in blocks(items, item_id, item_text, window, block_words)]
    for block in several or [None]:
        state = state.mapInArrow(_annotate(block, "text"), schema)
    return state.drop("text")


def _clean(tests: TestItems, texts: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(len(batch), dtype=bool)
            if len(tests.suffixes):
                for begin, _, words in text.word_slices(batch.column(texts), text.SIGNS):
                    if len(words.starts):
                        keep[begin + np.unique(words.documents()[occurrences(words, tests).hit])] = False
            yield batch.filter(pa.array(keep))

    return run


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    texts: str = "text",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents, all columns kept, without those that hold a window of a test item."""
    names = F.lit(None).cast("string").alias("item_id")
    for block in blocks(items.select(names, F.col(item_text).alias("text")), "item_id", "text", window, block_words):
        docs = docs.mapInArrow(_clean(block, texts), docs.schema)
    return docs
