"""The user-address graph: weights, degrees, centralities, clustering and the anomalies drawn from them.

Shortest paths run between *classes* of nodes with identical neighbours rather than between nodes. All users who
only ever sign in from one address are a single class, so a hub address costs one class instead of a pair of every
two users behind it, and the result is still exact: members of a class share distances, path counts and
centrality, and two members of one class are two steps apart.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signwatch.functions.scalars import fixed
from signwatch.lineage import cut
from signwatch.operators.detectors import sequential_timing
from signwatch.skew import HOT_ROWS, Timeline, micros, salted_join


def user_ip_edges(events: DataFrame) -> DataFrame:
    """(username, ip_address, weight): number of events per pair."""
    return (
        events.where(F.col("username").isNotNull() & F.col("ip_address").isNotNull())
        .groupBy("username", "ip_address")
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def links(edges: DataFrame) -> DataFrame:
    """(src, dst) in both directions; ``u:`` and ``i:`` keep a user and an address of the same text apart."""
    user = F.concat(F.lit("u:"), F.col("username"))
    ip = F.concat(F.lit("i:"), F.col("ip_address"))
    pairs = edges.select(F.explode(F.array(F.struct(user.alias("src"), ip.alias("dst")), F.struct(ip.alias("src"), user.alias("dst")))).alias("p"))
    return pairs.select("p.src", "p.dst")


def both_ways(pairs: DataFrame) -> DataFrame:
    """Distinct directed links of an undirected edge list (src, dst), without loops."""
    ends = F.array(
        F.struct(F.col("src").alias("a"), F.col("dst").alias("b")), F.struct(F.col("dst").alias("a"), F.col("src").alias("b"))
    )
    rows = pairs.where(F.col("src") != F.col("dst")).select(F.explode(ends).alias("p"))
    return rows.select(F.col("p.a").alias("src"), F.col("p.b").alias("dst")).distinct()


def degree(directed: DataFrame) -> DataFrame:
    return directed.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("degree"))


# --- classes ---------------------------------------------------------------------------------------------

PRINT = ["_d", "_x", "_s"]


def classes(directed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes (node, class), classes (class, members, degree) and links between classes (src, dst).

    Neighbour sets are compared by their size, the xor of one 64-bit hash and the sum of another.
    """
    marks = directed.groupBy(F.col("src").alias("node")).agg(
        F.count(F.lit(1)).alias("_d"),
        F.bit_xor(F.xxhash64("dst")).alias("_x"),
        F.sum(F.xxhash64(F.lit(1), "dst").cast("decimal(38,0)")).alias("_s"),
    )
    marks = cut(marks)
    groups = marks.groupBy(*PRINT).agg(F.min("node").alias("class"), F.count(F.lit(1)).alias("members"))
    nodes = cut(salted_join(marks, groups, PRINT, spread=["node"]).select("node", "class", "members", "_d"))
    sizes = nodes.where(F.col("node") == F.col("class")).select("class", "members", F.col("_d").alias("degree"))
    heads = sizes.select("class")
    between = (
        directed.join(heads.withColumnRenamed("class", "src"), "src", "left_semi")
        .join(heads.withColumnRenamed("class", "dst"), "dst", "left_semi")
        .select("src", "dst")
    )
    return nodes.select("node", "class"), sizes, cut(between)


#: Rows that one level of a search from many classes at once may have, and sources that are searched from in any case.
LEVEL_ROWS, LEAST_SOURCES = 20_000_000, 64


def batches(sources: DataFrame, most: int) -> list[DataFrame]:
    """The rows of ``sources`` (class, ...) in tables of at most ``most`` rows, numbered by ``place`` from 0.

    Classes are dealt out by hash and numbered within their share, so no task orders all of them.
    """
    n = sources.count()
    share = F.pmod(F.xxhash64("class"), F.lit(max(1, -(-n // most))))
    place = F.row_number().over(Window.partitionBy("_share").orderBy("class")) - 1
    placed = sources.withColumn("_share", share).withColumn("place", place).withColumn("_part", F.floor(F.col("place") / most))
    placed = cut(placed.withColumn("place", F.col("place") % most))
    # one row per batch
    parts = placed.select("_share", "_part").distinct().collect()
    return [placed.where((F.col("_share") == s) & (F.col("_part") == p)).drop("_share", "_part") for s, p in sorted(parts)]


# --- distances from many classes as bits -----------------------------------------------------------------


def _weighed(words: list[Column], weights: list[int]) -> Column:
    """Sum of the weights of the bits that are set: a bit count for each binary digit of the weights."""
    total = F.lit(0).cast("bigint")
    for w, word in enumerate(words):
        own = weights[64 * w : 64 * (w + 1)]
        for digit in range(max(own, default=0).bit_length()):
            mask = sum(1 << k for k, weight in enumerate(own) if weight >> digit & 1)
            mask -= (mask >> 63) << 64  # as a signed long
            if mask:
                total = total + F.lit(1 << digit).cast("bigint") * F.bit_count(word.bitwiseAND(F.lit(mask).cast("bigint")))
    return total


def _search(sizes: DataFrame, between: DataFrame, sources: DataFrame, words: int) -> DataFrame:
    """(class, _r, _sum): members of the sources a class is reached from, and the sum of their distances.

    A bit of a class's masks stands for a source that has reached it. A level is one row per class, however many sources.
    """
    # at most 64 bits a word
    weights = [0] * (64 * words)
    for place, members in sources.select("place", "members").collect():
        weights[place] = members
    seen, front, near = ([f"{x}{w}" for w in range(words)] for x in "sfn")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("place") % 64).cast("int"))
    own = [F.when(F.floor(F.col("place") / 64) == w, bit).otherwise(0).cast("bigint") for w in range(words)]
    state = sizes.select("class").join(sources.select("class", "place"), "class", "left")
    state = state.select(
        "class", *(o.alias(s) for o, s in zip(own, seen)), *(o.alias(f) for o, f in zip(own, front)),
        F.lit(0).cast("bigint").alias("_r"), F.lit(0).cast("bigint").alias("_sum"),
    )
    moving = F.greatest(*(F.col(f) != 0 for f in front)) if words > 1 else F.col(front[0]) != 0
    d = 0
    while d == 0 or not state.where(moving).isEmpty():
        d += 1
        ahead = state.where(moving).select(F.col("class").alias("src"), *front)
        reached = salted_join(between, ahead, ["src"], spread=["dst"], base=between)
        reached = reached.groupBy(F.col("dst").alias("class")).agg(*(F.bit_or(f).alias(n) for f, n in zip(front, near)))
        state = state.drop(*front).join(reached, "class", "left").fillna(0, near)
        new = {f: F.col(n).bitwiseAND(F.bitwise_not(F.col(s))) for f, n, s in zip(front, near, seen)}
        state = state.withColumns(new).withColumns({s: F.col(s).bitwiseOR(F.col(f)) for s, f in zip(seen, front)})
        found = _weighed([F.col(f) for f in front], weights)
        state = state.withColumn("_new", found).drop(*near)
        state = state.withColumns({"_r": F.col("_r") + F.col("_new"), "_sum": F.col("_sum") + F.col("_new") * d}).drop("_new")
        state = cut(state)
    return state.select("class", "_r", "_sum")


def _closeness(sums: DataFrame, sizes: DataFrame, n: Column) -> DataFrame:
    """Closeness from the members reached and the sum of their distances, scaled by the share of nodes reached."""
    others = F.col("members") - 1
    reached = F.col("_r") + others
    total = F.col("_sum") + 2 * others
    rows = sums.where(F.col("_r") > 0).join(sizes, "class")
    return rows.select("class", ((reached / total) * (reached / (n - 1))).alias("closeness"))


def closeness(directed: DataFrame, words: int = 16) -> DataFrame:
    """(node, closeness) of every node. Distances run both ways, so a class sums up those of the sources that reach it.

    Sources are searched from in batches of ``64 * words``; what is written per level is one row per class.
    """
    directed = cut(directed)
    nodes, sizes, between = classes(directed)
    total = None
    for sources in batches(sizes, 64 * words):
        sums = _search(sizes, between, sources, words)
        total = sums if total is None else total.unionByName(sums)
        total = cut(total.groupBy("class").agg(F.sum("_r").alias("_r"), F.sum("_sum").alias("_sum")))
    if total is None:
        return nodes.select("node", F.lit(0.0).alias("closeness"))
    n = sizes.agg(F.sum("members")).scalar()
    return salted_join(nodes, _closeness(total, sizes, n), ["class"], spread=["node"]).drop("class")


# --- shortest paths from a batch of classes --------------------------------------------------------------


def levels(sizes: DataFrame, between: DataFrame, sources: DataFrame) -> list[DataFrame]:
    """Breadth-first search from each of the sources at once: one table (source, node, paths) per distance.

    ``paths`` counts the shortest paths from one member of the source to one member of the node. Each level is written
    out, and only the two levels before are compared with, since a link never spans more.
    """
    start = sources.select(F.col("class").alias("source"), F.col("class").alias("node"), F.lit(1.0).alias("paths"))
    found = [cut(start)]
    members = sizes.select(F.col("class").alias("node"), "members")
    while True:
        here = found[-1]
        if len(found) > 1:
            here = here.join(members, "node").withColumn("paths", F.col("paths") * F.col("members"))
        reached = (
            here.join(between.withColumnRenamed("src", "node"), "node")
            .groupBy("source", F.col("dst").alias("node"))
            .agg(F.sum("paths").alias("paths"))
        )
        for seen in found[-2:]:
            reached = reached.join(seen.select("source", "node"), ["source", "node"], "left_anti")
        reached = cut(reached)
        if reached.isEmpty():
            return found
        found.append(reached)


def distances(sizes: DataFrame, found: list[DataFrame]) -> DataFrame:
    """(class, _r, _sum) of the sources: members they reach in other classes, and the sum of their distances."""
    members = sizes.select(F.col("class").alias("node"), "members")
    far = found[0].select("source", "node", F.lit(0).alias("d"))
    for d, level in enumerate(found[1:], 1):
        far = far.unionByName(level.select("source", "node", F.lit(d).alias("d")))
    reached = F.when(F.col("d") > 0, F.col("members")).otherwise(0)
    return (
        far.join(members, "node")
        .groupBy(F.col("source").alias("class"))
        .agg(F.sum(reached).alias("_r"), F.sum(F.col("members") * F.col("d")).alias("_sum"))
    )


def dependencies(sizes: DataFrame, between: DataFrame, found: list[DataFrame], weights: DataFrame) -> DataFrame:
    """(class, _sum): by how much the sources' shortest paths depend on a member, by Brandes' backward sums over the levels.

    ``weights`` (class, weight) says how many members a source stands for.
    """
    members = sizes.select(F.col("class").alias("node"), "members")
    back = between.select(F.col("dst").alias("node"), F.col("src").alias("before"))
    own = sizes.select(F.col("class").alias("source"), ((F.col("members") - 1) / F.col("degree")).alias("_twins"))
    weight = weights.select(F.col("class").alias("source"), "weight")
    total = sizes.select("class", F.lit(0.0).alias("_sum")).where(F.lit(False))
    ahead = None
    for d in range(len(found) - 1, 0, -1):
        level = found[d]
        if ahead is None:
            here = level.withColumn("share", F.lit(0.0))
        else:
            here = level.join(ahead, ["source", "node"], "left").fillna(0.0, ["share"])
        if d == 1:
            # the other members of the source's class end two steps away, behind its neighbours
            here = here.join(own, "source").withColumn("share", F.col("share") + F.col("_twins")).drop("_twins")
        here = cut(here)
        sums = here.join(weight, "source").groupBy(F.col("node").alias("class"))
        total = total.unionByName(sums.agg(F.sum(F.col("weight") * F.col("share")).alias("_sum")))
        if d > 1:
            passed = here.join(members, "node").withColumn(
                "_per_path", F.col("members") * (1 + F.col("share")) / F.col("paths")
            )
            previous = found[d - 1].select("source", F.col("node").alias("before"), F.col("paths").alias("_paths"))
            ahead = (
                passed.join(back, "node")
                .join(previous, ["source", "before"])
                .groupBy("source", F.col("before").alias("node"))
                .agg(F.sum(F.col("_paths") * F.col("_per_path")).alias("share"))
            )
    return cut(total.groupBy("class").agg(F.sum("_sum").alias("_sum")))


def _from_sources(sizes: DataFrame, between: DataFrame, sources: DataFrame, level_rows: int) -> tuple[DataFrame, DataFrame]:
    """Distances of the sources (class, weight), and what their paths add to each class, batch after batch."""
    most = max(LEAST_SOURCES, level_rows // max(1, sizes.count()))
    far, through = None, None
    for batch in batches(sources, most):
        found = levels(sizes, between, batch)
        own = cut(distances(sizes, found))
        sums = dependencies(sizes, between, found, batch)
        far = own if far is None else far.unionByName(own)
        through = sums if through is None else cut(through.unionByName(sums).groupBy("class").agg(F.sum("_sum").alias("_sum")))
    if far is None:
        far = sizes.selectExpr("class", "0L AS _r", "0L AS _sum").where(F.lit(False))
        through = sizes.select("class", F.lit(0.0).alias("_sum")).where(F.lit(False))
    return far, through


def _scaled(n: Column) -> Column:
    # as doubles: 46,342 nodes have more pairs than an int counts
    pairs = (n - 1).cast("double") * (n - 2).cast("double")
    return F.when(pairs > 0, F.col("_sum") / pairs).otherwise(F.col("_sum")).alias("betweenness")


def centrality(directed: DataFrame, level_rows: int = LEVEL_ROWS) -> DataFrame:
    """(node, degree, closeness, betweenness) of every node: exact, from all classes.

    Sources are taken in batches, as many as keep a level under ``level_rows`` rows, or ``LEAST_SOURCES``; a batch's levels are
    added up per class before the next one starts.
    """
    directed = cut(directed)
    nodes, sizes, between = classes(directed)
    far, through = _from_sources(sizes, between, sizes.withColumn("weight", F.col("members")), level_rows)
    n = sizes.agg(F.sum("members")).scalar()
    values = (
        sizes.select("class", "degree")
        .join(_closeness(far, sizes, n), "class")
        .join(through.select("class", _scaled(n)), "class", "left")
        .fillna(0.0, ["betweenness"])
    )
    return salted_join(nodes, values, ["class"], spread=["node"]).drop("class")


def betweenness_estimate(
    directed: DataFrame, pivots: int = 1000, miss: float = 0.01, seed: int = 0, level_rows: int = LEVEL_ROWS
) -> DataFrame:
    """(node, betweenness, bound): estimated from the paths of ``pivots`` nodes, the ones with the smallest hashes.

    A node's true value is within ``bound`` of the estimate with a probability of ``1 - miss`` (Hoeffding, for draws without
    replacement: a pivot's dependency is at most n - 2). With as many pivots as nodes the values are exact.
    """
    directed = cut(directed)
    nodes, sizes, between = classes(directed)
    drawn = nodes.orderBy(F.xxhash64(F.lit(seed), "node"), "node").limit(pivots)
    weights = cut(drawn.groupBy("class").agg(F.count(F.lit(1)).alias("weight")))
    total, used = sizes.agg(F.sum("members")).first()[0] or 0, weights.agg(F.sum("weight")).first()[0] or 1
    _, through = _from_sources(sizes, between, weights, level_rows)
    through = through.withColumn("_sum", F.col("_sum") * (total / used))
    bound = 0.0 if used >= total else total / (total - 1) * math.sqrt(math.log(2 / miss) / (2 * used))
    values = sizes.select("class").join(through.select("class", _scaled(F.lit(total))), "class", "left")
    values = values.fillna(0.0, ["betweenness"]).withColumn("bound", F.lit(bound))
    return salted_join(nodes, values, ["class"], spread=["node"]).drop("class")


def clustering(pairs: DataFrame) -> DataFrame:
    """(node, clustering): share of a node's neighbour pairs that are linked.

    Links point from the node of lower to that of higher degree, so no node has more than sqrt(2 x links) out-links,
    and triangles are found without pairing all neighbours of a hub.
    """
    directed = cut(both_ways(pairs))
    degrees = degree(directed)
    a = degrees.select(F.col("node").alias("src"), F.col("degree").alias("_ds"))
    b = degrees.select(F.col("node").alias("dst"), F.col("degree").alias("_dd"))
    ranked = salted_join(directed, a, ["src"], spread=["dst"])
    ranked = salted_join(ranked, b, ["dst"], spread=["src"], base=directed)
    up = cut(
        ranked.where(F.struct("_ds", "src") < F.struct("_dd", "dst")).select("src", "dst", F.col("_dd").alias("rank"))
    )
    one = up.select("src", F.col("dst").alias("b"), F.col("rank").alias("_rb"))
    two = up.select("src", F.col("dst").alias("c"), F.col("rank").alias("_rc"))
    wedges = one.join(two, "src").where(F.struct("_rb", "b") < F.struct("_rc", "c"))
    closing = up.select(F.col("src").alias("b"), F.col("dst").alias("c"))
    triangles = wedges.join(closing, ["b", "c"]).select(F.explode(F.array("src", "b", "c")).alias("node"))
    counts = triangles.groupBy("node").agg(F.count(F.lit(1)).alias("_t"))
    d = F.col("degree")
    share = F.when(d > 1, 2 * F.coalesce("_t", F.lit(0)) / (d * (d - 1))).otherwise(0.0)
    return degrees.join(counts, "node", "left").select("node", share.alias("clustering"))


def followers(events: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """(src, dst): users seen one right after the other on an address."""
    rows = events.where(F.col("username").isNotNull() & F.col("ip_address").isNotNull())
    line = Timeline(
        rows.select("event_id", "timestamp", "username", "ip_address"), ["ip_address"], ["event_id"], back=1, max_rows=max_rows
    )
    rows = line.finish(line.rows.withColumn("_prev", F.lag("username").over(line.window())))
    return (
        rows.where(F.col("_prev") != F.col("username"))
        .select(F.least("_prev", "username").alias("src"), F.greatest("_prev", "username").alias("dst"))
        .distinct()
    )


# --- anomalies -------------------------------------------------------------------------------------------


def graph_anomalies(nodes: DataFrame, limit: float = 2.0, high: float = 3.0) -> DataFrame:
    """Nodes whose betweenness or closeness is more than ``limit`` population deviations from the mean."""
    names = ["betweenness", "closeness"]
    stats = nodes.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in names],
            *[F.stddev_pop(c).alias(f"s_{c}") for c in names],
        )
    ).scalar()
    rows = nodes.withColumn("_s", stats)
    for c in names:
        std = F.col(f"_s.s_{c}")
        z = F.when(std > 0, (F.col(c) - F.col(f"_s.m_{c}")) / std).otherwise(0.0)
        rows = rows.withColumn(f"{c}_z", z)
    b, cl = F.abs("betweenness_z"), F.abs("closeness_z")
    kind = F.when(F.col("node").startswith("u:"), "user").otherwise("ip")
    name = F.substring("node", 3, 1 << 30)
    return rows.where((b > limit) | (cl > limit)).select(
        name.alias("node"),
        kind.alias("node_type"),
        "betweenness_z",
        "closeness_z",
        F.lit("graph_structure").alias("anomaly_type"),
        F.when((b > high) | (cl > high), "high").otherwise("medium").alias("severity"),
        F.concat(
            kind,
            F.lit(' "'),
            name,
            F.lit('" has unusual centrality (bet_z: '),
            fixed(F.col("betweenness_z"), 2),
            F.lit(", clo_z: "),
            fixed(F.col("closeness_z"), 2),
            F.lit(")"),
        ).alias("details"),
    )


def advanced_anomalies(events: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """Unusual user nodes, dated by the user's first event, and unusual gaps in event sequences; with ``method``."""
    nodes = centrality(links(user_ip_edges(events)))
    users = graph_anomalies(nodes).where(F.col("node_type") == "user")
    first = (
        events.where(F.col("username").isNotNull())
        .groupBy("username")
        .agg(F.min(F.struct(micros("timestamp").alias("us"), "event_id", "timestamp")).alias("_first"))
        .select("username", "_first.event_id", "_first.timestamp")
    )
    found = (
        users.withColumnRenamed("node", "username")
        .join(first, "username")
        .select(
            "event_id",
            "timestamp",
            "username",
            F.lit("Unknown").alias("ip_address"),
            F.lit(None).cast("string").alias("event_type"),
            "anomaly_type",
            "severity",
            "details",
            F.lit("graph_based").alias("method"),
        )
    )
    return found.unionByName(sequential_timing(events, max_rows=max_rows).withColumn("method", F.lit("sequential_pattern")))
