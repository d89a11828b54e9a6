"""Graph measures against plain loops, the forest's properties, and client training against a direct solver."""

from __future__ import annotations

from collections import deque
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from signwatch.operators import features, federated, forest, graph
from signwatch.plans import fixtures as fx
from signwatch.skew import salted_join

T0 = datetime(2024, 1, 1)


# --- graph -----------------------------------------------------------------------------------------------


def brute_force(pairs):
    """Closeness and betweenness by breadth-first search from every node and Brandes' backward pass."""
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    n, close, between = len(near), {}, dict.fromkeys(near, 0.0)
    for s in near:
        dist, sigma, order, queue = {s: 0}, dict.fromkeys(near, 0.0), [], deque([s])
        sigma[s] = 1.0
        while queue:
            v = queue.popleft()
            order.append(v)
            for w in near[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    queue.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
        reached, total = len(dist) - 1, sum(dist.values())
        close[s] = reached / total * reached / (n - 1) if total else 0.0
        share = dict.fromkeys(near, 0.0)
        for w in reversed(order):
            for v in near[w]:
                if dist[v] == dist[w] - 1:
                    share[v] += sigma[v] / sigma[w] * (1 + share[w])
            if w != s:
                between[w] += share[w]
    pairs_n = (n - 1) * (n - 2)
    return close, {v: x / pairs_n if pairs_n else x for v, x in between.items()}


RNG = np.random.default_rng(5)
GRAPHS = {
    "star": [("hub", f"leaf{i}") for i in range(6)],
    "path": [(str(i), str(i + 1)) for i in range(6)],
    "two parts": [("a", "b"), ("b", "c"), ("x", "y"), ("y", "z"), ("z", "x")],
    "square": [("a", "b"), ("b", "c"), ("c", "d"), ("d", "a")],
    "twins on both sides": [(u, i) for u in ("u1", "u2", "u3") for i in ("i1", "i2")] + [("u3", "i3"), ("u4", "i3"), ("u5", "i3")],
    "random": sorted({(f"n{a}", f"n{b}") for a, b in RNG.integers(0, 20, (45, 2)) if a < b}),
}


@pytest.mark.parametrize("name", GRAPHS)
def test_centrality_equals_brute_force(spark, name):
    pairs = GRAPHS[name]
    rows = graph.centrality(graph.both_ways(spark.createDataFrame(pairs, "src string, dst string"))).collect()
    close, between = brute_force(pairs)
    assert {r.node for r in rows} == set(close)
    for r in rows:
        assert r.closeness == pytest.approx(close[r.node])
        assert r.betweenness == pytest.approx(between[r.node])


@pytest.fixture(scope="module")
def wide_graph():
    """300 nodes: a ring of hubs with members of their own, some shared."""
    rnd = np.random.default_rng(8)
    pairs = {(f"h{a}", f"h{(a + 1) % 40}") for a in range(40)}
    pairs |= {(f"h{a}", f"n{b}") for a, b in zip(rnd.integers(0, 40, 420), rnd.integers(0, 260, 420), strict=True)}
    return sorted(pairs)


@pytest.mark.parametrize("name", ["two parts", "twins on both sides", "random", "wide"])
def test_closeness_from_bits_equals_brute_force(spark, wide_graph, name, monkeypatch):
    """One word is 64 sources, so the wide graph takes several batches; a level is never more than a row per class."""
    pairs = wide_graph if name == "wide" else GRAPHS[name]
    written = []
    monkeypatch.setattr(graph, "cut", lambda df, cut=graph.cut: written.append(cut(df)) or written[-1])
    rows = graph.closeness(graph.both_ways(spark.createDataFrame(pairs, "src string, dst string")), words=1).collect()
    assert {r.node: pytest.approx(r.closeness) for r in rows} == brute_force(pairs)[0]
    levels = [df for df in written if "f0" in df.columns]
    assert levels and max(df.count() for df in levels) <= len(rows)


def test_centrality_in_batches_of_sources(spark, wide_graph, monkeypatch):
    monkeypatch.setattr(graph, "LEAST_SOURCES", 100)
    seen = []
    monkeypatch.setattr(graph, "levels", lambda *a, levels=graph.levels: seen.append(a[2].count()) or levels(*a))
    rows = graph.centrality(graph.both_ways(spark.createDataFrame(wide_graph, "src string, dst string")), level_rows=1).collect()
    close, between = brute_force(wide_graph)
    assert {r.node: (pytest.approx(r.closeness), pytest.approx(r.betweenness)) for r in rows} == {v: (close[v], between[v]) for v in close}
    assert len(seen) > 1 and max(seen) <= 100


@pytest.mark.parametrize("pivots", [80, 10_000])
def test_betweenness_estimate_is_within_its_bound(spark, wide_graph, pivots):
    directed = graph.both_ways(spark.createDataFrame(wide_graph, "src string, dst string"))
    rows = graph.betweenness_estimate(directed, pivots, miss=1e-6).collect()
    _, between = brute_force(wide_graph)
    assert {r.node for r in rows} == set(between)
    assert all(abs(r.betweenness - between[r.node]) <= r.bound + 1e-12 for r in rows)
    assert {r.bound for r in rows} == {0.0} if pivots == 10_000 else all(0 < r.bound < 0.5 for r in rows)


@pytest.mark.parametrize("pivots", [10, 60_001])
def test_betweenness_estimate_of_more_pairs_than_an_int_counts(spark, pivots):
    """A star of 60,000 leaves: every path between two leaves goes through the hub."""
    ends = spark.range(60_000).select(F.lit("hub").alias("src"), F.concat(F.lit("leaf"), "id").alias("dst"))
    rows = graph.betweenness_estimate(graph.both_ways(ends), pivots, miss=1e-6)
    hub = rows.where("node = 'hub'").first()
    assert abs(hub.betweenness - 1) <= hub.bound + 1e-9 and hub.betweenness > 0.5
    assert rows.where("node <> 'hub' AND betweenness = 0").count() == 60_000


def test_nodes_with_equal_neighbours_share_a_class(spark):
    directed = graph.both_ways(spark.createDataFrame(GRAPHS["star"], "src string, dst string"))
    _, sizes, _ = graph.classes(directed)
    assert sorted(r.members for r in sizes.collect()) == [1, 6]


def test_clustering(spark):
    pairs = [("a", "b"), ("b", "c"), ("a", "c"), ("a", "d"), ("d", "e")]
    rows = graph.clustering(spark.createDataFrame(pairs, "src string, dst string")).collect()
    assert {r.node: r.clustering for r in rows} == pytest.approx({"a": 1 / 3, "b": 1, "c": 1, "d": 0, "e": 0})


def test_two_part_graphs_have_no_triangles(spark, sf_dir):
    pairs = graph.links(graph.user_ip_edges(fx.auth_events(spark, sf_dir)))
    assert graph.clustering(pairs).where("clustering <> 0").count() == 0


def test_hub_user_is_an_anomaly(spark):
    rows = []
    for i in range(12):
        for user in (f"user{i}", "hub"):
            rows.append((len(rows), T0 + timedelta(hours=len(rows)), user, f"10.0.0.{i}", "access"))
    events = spark.createDataFrame(rows, "event_id long, timestamp timestamp, username string, ip_address string, event_type string")
    found = graph.advanced_anomalies(events).where("method = 'graph_based'").collect()
    assert [(r.username, r.ip_address, r.severity) for r in found] == [("hub", "Unknown", "high")]
    assert found[0].timestamp == T0 + timedelta(hours=1)


# --- forest ----------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(rng.normal(size=(2000, 2)))]
    rows += [(2000 + i, 12.0 + i, -12.0 - i) for i in range(10)]
    return spark.createDataFrame(rows, "event_id long, a double, b double").repartition(4).cache()


def test_outliers_score_lowest(cloud):
    scored = forest.score(cloud, forest.fit(cloud, ["a", "b"]))
    lowest = scored.orderBy("anomaly_score").limit(10).collect()
    assert {r.event_id for r in lowest} == set(range(2000, 2010))
    share = scored.where("anomaly_score < 0").count() / 2010
    assert share == pytest.approx(0.1, abs=0.01)


def test_refit_is_identical(cloud):
    first = forest.score(cloud, forest.fit(cloud, ["a", "b"], trees=20))
    other = cloud.repartition(7)
    second = forest.score(other, forest.fit(other, ["a", "b"], trees=20))
    assert first.exceptAll(second).count() == 0


def test_sample_is_bounded_and_without_repeats(cloud):
    # 2 * 5 * 16 = 160 rows: the large-input branch, one tree per row
    sample = forest.sample_per_tree(cloud, ["a", "b"], trees=5, tree_rows=16)
    sizes = [r["count"] for r in sample.groupBy("tree").count().collect()]
    assert len(sizes) == 5 and max(sizes) <= 16 and min(sizes) >= 8
    assert sample.groupBy("tree", "row_id").count().where("count > 1").count() == 0


def test_too_few_rows_give_no_model(spark):
    rows = spark.createDataFrame([(i, float(i)) for i in range(10)], "event_id long, a double")
    assert forest.fit(rows, ["a"]) is None
    assert forest.fit(rows, ["a"], min_rows=10) is not None


def test_average_path():
    assert list(forest.average_path(np.array([1, 2]))) == [0.0, 1.0]
    exact = 2 * sum(1 / k for k in range(1, 256)) - 2 * 255 / 256
    assert forest.average_path(np.array([256]))[0] == pytest.approx(exact, rel=1e-3)


# --- clients ---------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def clients(spark):
    rng = np.random.default_rng(1)
    rows, i = [], 0
    for name, n in (("big", 300), ("small", 60)):
        for a, b in rng.normal(size=(n, 2)):
            rows.append((i, name, int(rng.random() < 1 / (1 + np.exp(-(a - b / 2)))), float(a), float(b)))
            i += 1
    return spark.createDataFrame(rows, "event_id long, client_id string, label long, a double, b double")


def solve(x, y, steps=50):
    """Ridge logistic regression (C = 1, free intercept) by plain Newton steps."""
    x = (x - x.mean(0)) / x.std(0)
    x = np.c_[x, np.ones(len(x))]
    ridge, w = np.array([1.0, 1.0, 0.0]), np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-x @ w))
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
    return w


def test_local_fit_is_the_optimum(clients):
    got = {(r.client_id, r.param): r.value for r in federated.local_fit(clients, ["a", "b"]).collect()}
    pdf = clients.toPandas()
    for name, part in pdf.groupby("client_id"):
        want = solve(part[["a", "b"]].to_numpy(), part["label"].to_numpy())
        assert [got[name, p] for p in ("a", "b", "intercept")] == pytest.approx(list(want), abs=1e-6)


def test_rounds_average_by_size(clients):
    params = federated.local_fit(clients, ["a", "b"])
    sizes = clients.groupBy("client_id").agg(F.count("*").alias("n"))
    model = federated.rounds(params, federated.participants(sizes, 2)).where("round = 2 and param = 'a'").first().value
    by_client = {r.client_id: r.value for r in params.where("param = 'a'").collect()}
    assert model == pytest.approx((300 * by_client["big"] + 60 * by_client["small"]) / 360)


def test_clients_per_round(clients):
    sizes = clients.groupBy("client_id").agg(F.count("*").alias("n"))
    drawn = federated.participants(sizes, 20, 1)
    assert drawn.groupBy("round").count().where("count <> 1").count() == 0
    assert drawn.select("client_id").distinct().count() == 2


def test_global_forest_takes_trees_from_every_client(spark, sf_dir):
    rows = features.client_features(fx.client_events(spark, sf_dir), "client_id", "label")
    model = federated.fit_forest(rows, trees=30)
    assert len(model.roots) == 30
    counts = federated.forest_counts(forest.score(rows, model)).first()
    assert counts.anomaly_count + counts.normal_count == rows.count()
    assert counts.anomaly_count / rows.count() == pytest.approx(0.1, abs=0.01)


def test_global_forest_with_more_clients_than_trees(spark):
    # sizes 20 to 2,000
    rows = spark.range(30 * 2000).selectExpr(
        "id AS event_id", "concat('c', id % 30) AS client_id", "cast(id div 30 AS long) AS nth", *[f"rand({i}) AS {c}" for i, c in enumerate(federated.CLIENT_COLUMNS)]
    ).where("nth < 20 * (1 + (cast(substring(client_id, 2) AS int) % 100) * 3)")
    sample = forest.sample_per_tree(rows, federated.CLIENT_COLUMNS, ["client_id"], trees=1)
    assert sample.select("client_id").distinct().count() == 30
    assert sample.groupBy("client_id", "tree").count().agg(F.max("count")).first()[0] <= 256
    model = federated.fit_forest(rows, trees=10)
    assert len(model.roots) == 30


def test_the_forest_draws_alike_at_every_size(spark):
    for n in (300, 1281, 20_000):
        rows = spark.range(n).selectExpr("id AS event_id", "rand(1) AS a")
        sample = forest.sample_per_tree(rows, ["a"], trees=10, tree_rows=64)
        per_tree = [r["count"] for r in sample.groupBy("tree").count().collect()]
        assert per_tree == [64] * 10
        assert sample.groupBy("row_id", "tree").count().where("count > 1").count() == 0


@pytest.mark.parametrize("most", [10, 1000])
def test_exact_quantile(spark, most):
    rng = np.random.default_rng(1)
    values = np.concatenate([rng.normal(size=400), np.full(200, 0.25)])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for share in (0.0, 0.1, 0.37, 0.6, 1.0):
        assert forest.exact_quantile(df, "v", share, most) == pytest.approx(np.quantile(values, share))


def test_no_rows(spark, sf_dir):
    assert graph.advanced_anomalies(fx.auth_events(spark, sf_dir).limit(0)).count() == 0
    rows = features.client_features(fx.client_events(spark, sf_dir), "client_id", "label").limit(0)
    assert federated.local_fit(rows, federated.CLIENT_COLUMNS).count() == 0 and federated.fit_forest(rows) is None


def test_evaluation(spark):
    cells = [(0, 0, 5), (0, 1, 1), (1, 0, 2), (1, 1, 2)]
    rows = [(a, b) for a, b, n in cells for _ in range(n)]
    row = federated.evaluate(spark.createDataFrame(rows, "label long, prediction long")).first()
    assert (row.accuracy, row.recall) == pytest.approx((0.7, 0.7))
    assert row.precision == pytest.approx(0.6 * 5 / 7 + 0.4 * 2 / 3)


def test_encrypted_parameters_differ_and_come_back(spark):
    params = spark.createDataFrame([("c", 3, "a", 0.25), ("c", 3, "b", -1.5)], "client_id string, n long, param string, value double")
    key = F.lit("0123456789abcdef").cast("binary")
    payloads = federated.encrypt_params(params, key)
    assert b"0.25" not in bytes(payloads.first().payload)
    back = {r.param: r.value for r in federated.decrypt_params(payloads, key).collect()}
    assert back == {"a": 0.25, "b": -1.5}


# --- label codes -----------------------------------------------------------------------------------------


def test_unseen_labels_get_the_next_code(spark):
    old = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "event_id long, username string")
    codes = features.label_codes(old, "username")
    assert {r.label: r.code for r in codes.collect()} == {"None": 0, "a": 1, "b": 2}
    new = spark.createDataFrame([(1, "a"), (2, "zed")], "event_id long, username string")
    got = features.encode(new, "username", "code_of", codes, max_rows=1)
    assert {r.username: r.code_of for r in got.collect()} == {"a": 1, "zed": 3}


def test_outer_join_keeps_rows_without_key(spark):
    big = spark.createDataFrame([(1, None), (2, "a"), (3, "a")], "event_id long, k string")
    small = spark.createDataFrame([("a", 7)], "k string, v long")
    got = salted_join(big, small, ["k"], "left", spread=["event_id"], max_rows=1)
    assert {r.event_id: r.v for r in got.collect()} == {1: None, 2: 7, 3: 7}
