"""Similarity join, removal of repeats, decontamination and top-k search against brute force."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import lower
from pyspark.sql import functions as F

from signwatch.llm import contamination, dedup, shingle_join, topk

SPACES, SIGNS = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def noisy(rnd, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rnd.randrange(len(words))] = rnd.choice("abcdefgh") * rnd.randint(1, 3)
    return words


def near_copies(seed, groups=12, most=9):
    rnd = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(rnd.choice([2, 8, 15, 40, 120]))]
        for _ in range(rnd.randint(1, most)):
            rows.append((rnd.randrange(10**6), " ".join(noisy(rnd, base, rnd.randint(0, 1 + len(base) // 12)))))
    return list({i: (i, t) for i, t in rows}.values())


def shingle_sets(rows, k):
    out = defaultdict(set)
    for i, raw in rows:
        words = re.findall(SPACES, lower(raw))
        own = {tuple(words[j : j + k]) for j in range(len(words) - k + 1)} or ({tuple(words)} if words else set())
        out[i] = own
    return out


def components_of(sets, percent):
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize(("seed", "k", "percent"), [(1, 3, 90), (2, 5, 80), (3, 1, 70)])
def test_components(docs_of, seed, k, percent):
    rows = near_copies(seed)
    sets = shingle_sets(rows, k)
    expected = components_of(sets, percent)
    found = {r["doc_id"]: r for r in shingle_join.join(docs_of(rows), k, percent).collect()}
    assert {i: (len(sets[i]), expected[i]) for i in sets} == {i: (r["n_shingles"], r["component_id"]) for i, r in found.items()}
    kept = {r["doc_id"] for r in shingle_join.drop_near_duplicates(docs_of(rows), k, percent).collect()}
    assert kept == set(expected.values())


@pytest.mark.parametrize(("single", "factor"), [(4, 2), (1, 3)])
def test_components_however_many_centres(docs_of, monkeypatch, single, factor):
    monkeypatch.setattr(shingle_join, "SINGLE", single)
    monkeypatch.setattr(shingle_join, "FACTOR", factor)
    rows = near_copies(4, groups=3, most=25)
    expected = components_of(shingle_sets(rows, 3), 85)
    assert {r["doc_id"]: r["component_id"] for r in shingle_join.join(docs_of(rows), 3, 85).collect()} == expected


@pytest.mark.parametrize("n", [100, 400])
def test_links_grow_with_the_classes_of_a_group(docs_of, monkeypatch, n):
    """Near copies of one text need a few links each, not one for every other copy."""
    rnd = random.Random(n)
    base = [f"w{k}" for k in range(200)]
    rows = [(i, " ".join(noisy(rnd, base, 2))) for i in range(n)]
    seen = []
    monkeypatch.setattr(shingle_join, "components", lambda links, run=shingle_join.components: seen.append(links.count()) or run(links))
    found = shingle_join.join(docs_of(rows), 3, 90).collect()
    assert {r["component_id"] for r in found} == {0} and max(seen) <= 5 * n


@pytest.mark.parametrize("percent", [60, 80, 90, 95])
def test_similar_sets_share_a_key(percent):
    rnd = np.random.default_rng(percent)
    bands = shingle_join.Bands(percent)
    for _ in range(300):
        n = int(rnd.integers(1, 400))
        a = np.unique(rnd.integers(0, 2**64, n, dtype=np.uint64))
        b = a.copy()
        while True:
            more = rnd.integers(0, 2**64, rnd.integers(0, 2), dtype=np.uint64)
            c = np.unique(np.append(np.delete(b, rnd.integers(len(b))), more)) if len(b) > 1 else b
            both = len(np.intersect1d(a, c))
            if 100 * both < percent * (len(a) + len(c) - both) or len(c) == len(b) == 1:
                break
            b = c
        if shingle_join.set_class(a) == shingle_join.set_class(b):
            continue
        keys = [{int(x) for band in bands.of(len(s)) for x in shingle_join.part_keys(s, band, *bands.parts(band))} for s in (a, b)]
        assert keys[0] & keys[1]
        different = len(np.setxor1d(a, b))
        distance = np.bitwise_count(shingle_join.sketch(a).view(np.uint64) ^ shingle_join.sketch(b).view(np.uint64)).sum()
        assert distance <= different


def test_wide_sketches_rule_out_no_similar_sets():
    rnd = np.random.default_rng(7)
    rows, similar = [], []
    for _ in range(400):
        size = int(rnd.integers(400, 5_000))
        a = np.unique(rnd.integers(0, 2**64, size, dtype=np.uint64))
        other = np.unique(rnd.integers(0, 2**64, int(size * rnd.choice([0, 0.1, 0.2, 0.3, 1])), dtype=np.uint64))
        b = np.union1d(a[: max(1, len(a) - int(len(other) * rnd.random()))], other)
        both = len(np.intersect1d(a, b))
        similar.append(100 * both >= 80 * (len(a) + len(b) - both))
        rows.append((len(a), len(b), shingle_join.wide_sketch(a), shingle_join.wide_sketch(b)))
    n_a, n_b, wide_a, wide_b = zip(*rows, strict=True)
    table = {x: range(len(rows)) for x in ("a", "b", "rep_a", "rep_b")} | {"n_a": n_a, "n_b": n_b, "wide_a": wide_a, "wide_b": wide_b}
    (found,) = shingle_join._near(80)(iter([pa.record_batch(table)]))
    kept = set(found["a"].to_pylist())
    assert all(k in kept for k, y in enumerate(similar) if y) and 50 < sum(similar) < 350
    assert all(k in kept for k, r in enumerate(rows) if r[2] is None or r[3] is None)
    assert len(kept) < sum(similar) + 100


def test_texts_of_unlike_documents_with_a_common_passage_stay(docs_of, monkeypatch):
    """512 bits can't tell long texts apart; only pairs that may be similar are given their texts."""
    rnd = random.Random(5)
    common = ["w%d" % rnd.randrange(10**6) for _ in range(300)]
    rows = [(i, " ".join(common + ["w%d" % rnd.randrange(10**6) for _ in range(2_500)])) for i in range(25)]
    rows += [(100 + i, rows[i][1] + " one more") for i in range(5)]
    seen = []
    monkeypatch.setattr(shingle_join, "verified", lambda pairs, *rest, run=shingle_join.verified: seen.append(pairs.count()) or run(pairs, *rest))
    found = {r["doc_id"]: r["component_id"] for r in shingle_join.join(docs_of(rows), 5, 80).collect()}
    assert found == {i: i % 100 for i, _ in rows}
    assert 5 <= sum(seen) <= 10


def test_join_odd_rows(docs_of, odd_rows):
    found = shingle_join.join(docs_of(odd_rows), 3, 90).collect()
    assert len(found) == len(odd_rows)
    by = defaultdict(set)
    for r in found:
        by[r["doc_id"]].add((r["n_shingles"], r["component_id"]))
    assert by[1] == {(0, 1)} and by[2] == {(0, 2)} and by[3] == {(0, 3)} and by[7] == {(1, 7)}
    assert by[8] == {(12, 5)} and by[5] == {(12, 5)} and {x[1] for x in by[None]} == {None}
    kept = shingle_join.drop_near_duplicates(docs_of(odd_rows), 3, 90)
    assert kept.columns == docs_of(odd_rows).columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 0, 1, 2, 3, 4, 5, 6, 7]
    assert shingle_join.join(docs_of([]), 3, 90).count() == 0


def removed_by_hand(rows, n):
    first = {}
    split = [(i, re.findall(SPACES, t or "")) for i, t in rows]
    for i, w in split:
        if i is not None:
            for k in range(len(w) - n + 1):
                key = tuple(w[k : k + n])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = {x for k in range(len(w) - n + 1) if i is not None and first[tuple(w[k : k + n])] < i for x in range(k, k + n)}
        out.append((i, len(w), sorted(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def removed(docs, n):
    return sorted((tuple(r) for r in dedup.remove_repeats(docs, n).collect()), key=str)


@pytest.mark.parametrize("n", [1, 5, 13, 20, 40])
def test_repeats(docs_of, n):
    rnd = random.Random(n)
    passages = [[rnd.choice("abcd") for _ in range(rnd.randint(n, 3 * n))] for _ in range(4)]
    rows = []
    for i in range(40):
        words = [rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(0, 30))]
        for _ in range(rnd.randint(0, 3)):
            at = rnd.randrange(len(words) + 1)
            words[at:at] = rnd.choice(passages)[: rnd.randint(1, 3 * n)]
        rows.append((rnd.randrange(1000) * 2 + i % 2, rnd.choice([" ", "  ", "\n"]).join(words)))
    rows = list({i: (i, t) for i, t in rows}.values())
    assert removed(docs_of(rows), n) == removed_by_hand(rows, n)


def test_repeats_odd_rows(docs_of, odd_rows):
    assert removed(docs_of(odd_rows), 13) == removed_by_hand(odd_rows, 13)
    assert removed(docs_of(odd_rows), 2) == removed_by_hand(odd_rows, 2)
    assert removed(docs_of([]), 13) == []


def hits_by_hand(raw, items, n):
    w = re.findall(SIGNS, lower(raw))
    hit, ids = set(), set()
    for item, t in items:
        v = re.findall(SIGNS, lower(t))
        m = min(n, len(v))
        for a in range(len(v) - m + 1 if m else 0):
            for k in range(len(w) - m + 1):
                if w[k : k + m] == v[a : a + m]:
                    hit |= set(range(k, k + m))
                    ids |= {str(item)} if item is not None else set()
    return len(w), sorted(hit), sorted(ids)


@pytest.mark.parametrize(("n", "block"), [(4, 10**6), (4, 5), (10, 10**6)])
def test_contamination(spark, docs_of, odd_rows, n, block):
    rnd = random.Random(n)
    rows = [(100 + k, " ".join(rnd.choice("abC") for _ in range(rnd.randint(0, 60)))) for k in range(40)] + odd_rows[:3] + odd_rows[4:]
    items = [(k, " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 14)))) for k in range(12)]
    items += [(None, "text under this"), (99, None), (98, rows[3][1]), (98, "a b")]
    table = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.search(docs_of(rows), table, n, block_words=block).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["hit_words"], sorted(r["items"])) for r in found), key=str)
    assert got == sorted(((i, *hits_by_hand(t, items, n)) for i, t in rows), key=str)
    for r in found:
        if r["longest"]:
            w = next(re.findall(SIGNS, lower(t)) for i, t in rows if i == r["doc_id"])
            a, size = r["longest"]["doc_word"], r["longest"]["length"]
            best = max(
                k
                for v in (re.findall(SIGNS, lower(t)) for _, t in items)
                for k in range(max(1, min(n, len(v))), 61)
                if any(v[x : x + k] == w[a : a + k] and len(w[a : a + k]) == k for x in range(60))
            )
            assert best == size
    clean = contamination.decontaminate(docs_of(rows), table, n, block_words=block)
    assert clean.columns == docs_of(rows).columns
    expected = sorted((i for i, t in rows if not hits_by_hand(t, items, n)[1]), key=str)
    assert sorted((r["doc_id"] for r in clean.collect()), key=str) == expected


def test_contamination_without_items(spark, docs_of, odd_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    assert contamination.decontaminate(docs_of(odd_rows), none).count() == len(odd_rows)
    assert contamination.search(docs_of(odd_rows), none).filter("size(hit_words) > 0").count() == 0
    assert contamination.search(docs_of([]), none).count() == 0


def test_suffix_array():
    rnd = np.random.default_rng(0)
    for depth in (1, 2, 3, 7, 16):
        symbols = rnd.integers(0, 3, 200).astype(np.uint64)
        order = contamination.suffix_array(symbols, depth)
        keys = [tuple(symbols[i : i + depth]) for i in order]
        assert keys == sorted(keys) and sorted(order) == list(range(200))


def test_topk(spark):
    rnd = random.Random(3)
    rows = [(k, [rnd.gauss(0, 0.2) for _ in range(8)], "x") for k in range(600)]
    rows += [(600 + k, rows[k][1], "copy") for k in range(50)] + [(700, rows[0][1], "x"), (700, rows[0][1], "x")]
    rows += [(800, None, "x"), (801, [None] * 8, "x"), (900, [float("nan")] * 8, "x"), (None, rows[0][1], "x"), (1000, [], "x")]
    rows += [(1100, [], "x"), (1101, [1.0, 2.0], "x"), (1200, [3e8, -1.0], "x"), (1201, [float("inf")] * 8, "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    whole = [
        (i, tuple(int(np.floor(1024 * x)) for x in v))
        for i, v, _ in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    expected = []
    for q, a in sorted(set(w for w in whole if w[0] % 100 == 0)):
        scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q and len(a) == len(b))
        expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:10])]
    found = sorted(tuple(r) for r in topk.search(table.repartition(3), F.col("vec_id") % 100 == 0).collect())
    assert found == expected
    assert topk.search(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_repeated_queries_take_no_place():
    rnd = np.random.default_rng(1)
    vectors = np.floor(1024 * rnd.normal(size=(200, 16)) / 4)
    ids = np.concatenate([np.arange(200), *[np.arange(20)] * 19])
    every = vectors[ids]
    best = topk.Best(np.arange(20), vectors[:20], 10)
    best.add(ids, every)
    for q in range(20):
        expected = sorted((-s, i) for i, s in zip(ids, every @ vectors[q], strict=True) if i != q)[:10]
        assert [(-s, i) for of, i, s in zip(*best.rows, strict=True) if of == q] == expected


def test_topk_stops_early():
    rnd = np.random.default_rng(1)
    vectors = np.floor(1024 * rnd.normal(size=(4096, 64)) / 8)
    at, _ = topk.Index(vectors).possible(vectors[:20], 10, np.full(20, -np.inf))
    assert len(at) < 0.02 * 4096 * 20
