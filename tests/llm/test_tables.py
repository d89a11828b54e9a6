"""Exact copies, the filter audit and whitening against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import lower
from pyspark.sql import functions as F

from signwatch.llm import audit, exact_dedup, whitening

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


# --- exact copies ------------------------------------------------------------------------------------------


def copies_of(rows):
    groups = defaultdict(list)
    for i, raw in rows:
        groups[lower(raw)].append(i)
    return groups


def expected_copies(rows):
    out = Counter()
    for raw, ids in copies_of(rows).items():
        last = max(ids, key=lambda i: (i is not None, i or 0))
        sha = hashlib.sha256(raw.encode()).hexdigest()
        left = True
        for i in ids:
            out[i, last, len(ids), i == last and left, sha] += 1
            left = left and i != last
    return out


def found_copies(df):
    return Counter((r.id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in df.collect())


@pytest.fixture(scope="module")
def many_rows():
    rnd = random.Random(3)
    texts = ["", "Straße", "STRASSE", "straße", "ÉTÉ été", "éTé éTé", "a b", "A B", "a  b"] + [f"text {k}" for k in range(400)]
    rows = [(i, rnd.choice(texts)) for i in range(600)] + [(1000 + i, "The Same" if i % 2 else "the same") for i in range(300)]
    return rows + [(2000, None), (2001, ""), (7, rows[7][1]), (7, rows[7][1].upper())]


def test_copies(docs_of, many_rows, odd_rows):
    for rows in (many_rows, odd_rows, [(None, "x"), (None, "X")]):
        assert found_copies(exact_dedup.copies(docs_of(rows))) == expected_copies(rows)


@pytest.mark.parametrize(("bits_a_row", "most_bits"), [(1, 1 << 30), (32, 1024), (64, 1 << 30)])
def test_copies_at_any_load_of_the_filter(docs_of, many_rows, bits_a_row, most_bits):
    assert found_copies(exact_dedup.copies(docs_of(many_rows), "doc_id", "text", bits_a_row, most_bits)) == expected_copies(many_rows)


def test_filter_finds_all_copies_and_few_others(spark):
    rows = spark.range(40_000).select(F.unhex(F.sha2(F.greatest("id", F.lit(4_000)).cast("string"), 256)).alias("digest"))
    marked = exact_dedup.repeated(rows, 40_000).mark(rows, "possible")
    by = {r.digest: (r["count"], r.possible) for r in marked.groupBy("digest").agg(F.count("*").alias("count"), F.first("possible").alias("possible")).collect()}
    assert all(possible for count, possible in by.values() if count > 1)
    assert sum(possible for count, possible in by.values() if count == 1) < 800
    assert marked.columns == ["digest", "possible"]


def test_large_groups_do_not_meet_in_a_task(spark, docs_of):
    """All rows of a large group reach their group by the broadcast, none by the shuffle."""
    rows = spark.range(30_000).select(F.unhex(F.sha2((F.col("id") % 3 * (F.col("id") % 2)).cast("string"), 256)).alias("digest"), F.col("id").alias("row"), "id")
    groups = rows.groupBy("digest").agg(F.count("*").alias("group_size"))
    joined = exact_dedup._spread(rows, groups, 30_000)
    assert joined.count() == 30_000 and joined.agg(F.sum("group_size")).first()[0] == sum(r.group_size**2 for r in groups.collect())


def test_drop_copies(docs_of, many_rows, odd_rows):
    for rows in (many_rows, odd_rows, []):
        docs = docs_of(rows)
        kept = exact_dedup.drop_copies(docs)
        assert kept.columns == docs.columns and kept.schema == docs.schema
        want = Counter((i, raw) for i, _, _, stays, raw in expected_copies(rows).elements() if stays)
        assert Counter((r.doc_id, hashlib.sha256(lower(r.text).encode()).hexdigest()) for r in kept.collect()) == want


def test_no_copies_of_nothing(docs_of):
    assert exact_dedup.copies(docs_of([])).collect() == []


# --- filter audit ------------------------------------------------------------------------------------------


def test_ranks_are_lexicographic():
    assert audit.orders() == sorted(audit.orders()) and len(set(audit.orders())) == 120
    for k, order in enumerate(audit.orders()):
        assert audit.rank(order) == k


def test_intervals_cover_each_order_once():
    seen = defaultdict(dict)
    for mask, step, begin, end in audit.intervals():
        for k in range(begin, end):
            assert k not in seen[mask]
            seen[mask][k] = step
    for mask in range(1, 32):
        failed = {x for k, x in enumerate("ABCDE") if mask >> k & 1}
        assert seen[mask] == {k: min(order.index(x) for x in failed) + 1 for k, order in enumerate(audit.orders())}
    assert 0 not in seen


def audit_by_hand(rows, labels):
    good, toxic = ({i for i, q, t in labels if i is not None and (q, t)[k] == 1} for k in range(2))
    facts = []
    for i, raw, part in rows:
        raw = raw or ""
        words = WORDS.findall(raw)
        failed = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in raw) > 2 * len(raw),
            "D": bool(re.search(r"[#$%&*|]", raw)),
            "E": i is not None and any(j is not None and j < i and (t or "") == raw for j, t, _ in rows),
        }
        facts.append((i, part or "", {x for x, yes in failed.items() if yes}))
    out = {}
    for part in {p for _, p, _ in facts}:
        own = [(i, failed) for i, p, failed in facts if p == part]
        total = Counter()
        for order in itertools.permutations("ABCDE"):
            kept = own
            for step, x in enumerate(order, 1):
                gone = [(i, f) for i, f in kept if x in f]
                kept = [(i, f) for i, f in kept if x not in f]
                total[x] += len(gone)
                out[part, "".join(order), step] = [
                    len(kept),
                    len(gone),
                    sum(x in f for _, f in own) - len(gone),
                    sum(f == {x} for _, f in own),
                    sum(i in good for i, _ in gone),
                    sum(i in toxic for i, _ in gone),
                ]
        for key, values in out.items():
            if key[0] == part:
                values.append(total[key[1][key[2] - 1]])
    return {k: tuple(v) for k, v in out.items()}


NAMES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audited(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, 2, "z") for r in rows], "doc_id long, text string, source string, n int, mask int, part string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = audit.audit(docs, marks).collect()
    assert len({(r.part, r.filter_order, r.step) for r in found}) == len(found)
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in NAMES) for r in found}


def test_audit(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(160):
        words = [rnd.choice(["mot", "Étoile", "wort", "Word", "x"]) + str(rnd.randrange(rnd.choice([3, 400]))) for _ in range(rnd.choice([5, 190, 230]))]
        words = [w.upper() if rnd.random() < rnd.choice([0, 0.3]) else w.lower() for w in words] + rnd.choice([[], [], ["#"], ["a|b"]])
        rows.append((i, " ".join(words), f"s{i % 3}"))
    rows += [(200 + i, rows[i * 3 % 50][1], rnd.choice(["s0", "s1", None])) for i in range(40)]
    rows += [(3, rows[5][1], "s0"), (3, rows[3][1], "s2"), (None, rows[1][1], "s1"), (None, None, None), (300, None, "s0"), (301, "", ""), (302, "", "s4")]
    rows += [(303, "a\x0bb c\x1cd e " * 100, "s4"), (303, "a\x0bb c\x1cd e " * 100, "s4")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1])) for i in range(0, 210, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    assert audited(spark, rows, labels) == audit_by_hand(rows, labels)


def test_audit_of_odd_tables(spark, odd_rows):
    rows = [(i, raw, "x" * (k % 2)) for k, (i, raw) in enumerate(odd_rows)]
    assert audited(spark, rows, []) == audit_by_hand(rows, [])
    assert audited(spark, [], [(1, 1, 1)]) == {}


# --- whitening ---------------------------------------------------------------------------------------------


def vectors_of(spark, rows):
    return spark.createDataFrame([(*r, 1.0, [2]) for r in rows], "vec_id long, embedding array<float>, whitened double, x array<int>")


def plain_whitening(rows, most=16):
    x = {i: np.floor(64 * np.array(v, dtype=np.float32).astype(float)).astype(np.int64) + 1_000_000 for i, v in rows}
    once = np.unique(np.array(list(x.values())), axis=0)
    n, sums = len(once), once.sum(axis=0)
    q, r = sums // n, sums % n / n
    away = (once - q) - r
    values, vectors = np.linalg.eigh(away.T @ away / n)
    order = np.argsort(-values)[:most]
    return x, n, sums, values[order], vectors[:, order], values.sum(), lambda v: (v - q) - r


@pytest.mark.parametrize(("rows", "dim"), [(300, 24), (40, 6), (12, 20)])
def test_whitening(spark, rows, dim):
    rng = np.random.default_rng(rows)
    mix = rng.standard_normal((dim, dim)) * np.linspace(3, 0.2, dim)
    data = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((rows, dim)) @ mix + 1)]
    data += [(1000 + i, v) for i, v in data[: rows // 3]]
    x, n, sums, values, vectors, trace, centred = plain_whitening(data)
    ints = whitening.integers(vectors_of(spark, data))
    model = whitening.fit(ints)
    k = min(16, dim, rows - 1)
    assert model.n == n and model.sums == sums.tolist() and len(model.eigenvalues) == k
    assert np.allclose(model.eigenvalues, values[:k], rtol=1e-11) and np.allclose(model.explained, values[:k] / trace, rtol=1e-11)
    assert model.identity_error < 1e-8
    assert np.allclose(np.abs(np.sum(model.components * vectors[:, :k], axis=0)), 1, atol=1e-12)
    sign = np.sign(np.sum(model.components * vectors[:, :k], axis=0))
    found = {r.id: r for r in whitening.transform(ints, model).collect()}
    assert set(found) == set(x)
    for i, v in x.items():
        assert found[i].deviation == sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums, strict=True))
        assert np.allclose(found[i].whitened, sign * (centred(v) @ vectors[:, :k]) / np.sqrt(values[:k]), atol=1e-8)


def test_whitening_with_equal_and_vanishing_deviations(spark):
    """A cross-polytope in four of six dimensions: four equal deviations, two of zero."""
    data = [(2 * k + s, [(1.0 if s else -1.0) * (k == d) for d in range(4)] + [0.5, 0.5]) for k in range(4) for s in range(2)]
    model = whitening.fit(whitening.integers(vectors_of(spark, data)))
    assert np.allclose(model.eigenvalues, [64**2 / 4] * 4) and model.identity_error < 1e-12
    assert np.allclose(model.components.T @ model.components, np.eye(4), atol=1e-14)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    fine = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [0.5, 0.25]), (None, [-1.0, 3.0]), (5, [-0.0, 1e-30])]
    odd = [(6, None), (7, []), (8, [nan, 1.0]), (9, [inf, 1.0]), (10, [1.0, -inf]), (11, [None, 1.0]), (12, [1.0]), (13, [1e38, 1.0])]
    ints = whitening.integers(vectors_of(spark, fine + odd))
    model = whitening.fit(ints)
    found = whitening.transform(ints, model).collect()
    assert model.n == 4 and sorted((r.id is None, r.id or 0) for r in found) == [(False, 1), (False, 1), (False, 2), (False, 5), (True, 0)]
    assert np.allclose(*(r.whitened for r in found if r.id == 1), atol=1e-12)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    ints = whitening.integers(vectors_of(spark, rows))
    found = whitening.transform(ints, whitening.fit(ints)).collect()
    assert [(r.deviation, r.whitened) for r in found] == [(0, [])] * sum(v is not None for _, v in rows)


def test_deviations_beyond_a_long():
    import pyarrow as pa

    away = np.array([[3, -4], [2**40, 1]])
    assert whitening._deviations(away, 10**6, np.array([1, 2])) == pa.array([(3 * 10**6 - 1) ** 2 + (4 * 10**6 + 2) ** 2, None])


def test_entry_queries_without_rows(spark, tmp_path):
    from signwatch.llm import queries

    spark.createDataFrame([], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    for name in ("op11_whitening", "op12_exact_dedup", "op13_filter_audit"):
        assert queries.QUERIES[name](spark, str(tmp_path)).collect() == []
