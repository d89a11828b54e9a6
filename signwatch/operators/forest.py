"""Isolation forest (Liu, Ting and Zhou, 2008) over numeric feature columns.

Fitting draws a bounded sample per tree with a hash of the row id, so it repeats exactly and its size does not
grow with the data; one small grouped task builds each tree. The node table (a few hundred rows per tree) is the
model; scoring sends it to the executors and walks all trees for a batch of rows at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signwatch.functions.scalars import fixed, score_severity, score_severity_three
from signwatch.lineage import cut
from signwatch.operators import features as feats
from signwatch.schema import ANOMALY_COLUMNS
from signwatch.skew import salted_join

# event columns carried along with the features
BASE = ("timestamp", "username", "ip_address", "event_type")
NODE_SCHEMA = "tree int, node int, feature int, split double, left int, right int, size bigint, depth int"


def sample_per_tree(
    rows: DataFrame,
    columns: list[str],
    groups: list[str] | None = None,
    trees: int = 100,
    tree_rows: int = 256,
    seed: int = 42,
    min_rows: int = 11,
    row_id: str = "event_id",
    base: DataFrame | None = None,
) -> DataFrame:
    """(groups, tree, row id, features): at most ``tree_rows`` distinct rows per tree.

    One rule for every size: a row is a candidate of a tree where the hash of seed, tree and row falls under the share
    that gives the tree twice the rows it needs, and the candidates with the smallest ranks are taken. Only candidates
    leave the scan. ``base`` is the table to count rows in, where ``rows`` is the outcome of a longer plan over it.
    """
    groups = groups or []
    base = rows if base is None else base
    ids = rows.select(*groups, row_id, F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))
    if groups:
        sizes = base.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
        ids = salted_join(ids, sizes, groups, spread=[row_id], base=base)
    else:
        ids = ids.withColumn("_n", base.agg(F.count(F.lit(1))).scalar())
    every_tree = F.sequence(F.lit(0), F.lit(trees - 1))
    draw = lambda t: F.pmod(F.xxhash64(F.lit(seed), t, F.col(row_id)), F.lit(1 << 30)) / (1 << 30)
    drawn = F.filter(every_tree, lambda t: draw(t) * F.col("_n") < 2 * tree_rows)
    spread = ids.where(F.col("_n") >= min_rows).withColumn("tree", F.explode(drawn))
    order = Window.partitionBy(*groups, "tree").orderBy(F.xxhash64(F.lit(seed + 2), "tree", row_id), row_id)
    return (
        spread.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= tree_rows)
        .select(*groups, "tree", F.col(row_id).alias("row_id"), "x")
    )


def build_tree(x: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    """Rows of (node, feature, split, left, right, size, depth); a leaf has feature -1."""
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    nodes, todo = [], [(0, np.arange(len(x)), 0)]
    used = 1
    while todo:
        node, members, depth = todo.pop()
        part = x[members]
        low, high = part.min(axis=0), part.max(axis=0)
        varying = np.flatnonzero(high > low)
        if depth >= limit or len(members) < 2 or len(varying) == 0:
            nodes.append((node, -1, 0.0, -1, -1, len(members), depth))
            continue
        feature = int(rng.choice(varying))
        split = float(rng.uniform(low[feature], high[feature]))
        below = part[:, feature] <= split
        nodes.append((node, feature, split, used, used + 1, len(members), depth))
        todo += [(used, members[below], depth + 1), (used + 1, members[~below], depth + 1)]
        used += 2
    return nodes


def fit_nodes(sample: DataFrame, groups: list[str] | None = None, seed: int = 42) -> DataFrame:
    """The node table of each tree, one bounded task per tree."""
    groups = groups or []
    types = dict(sample.dtypes)
    schema = ", ".join([f"{g} {types[g]}" for g in groups] + [NODE_SCHEMA])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row_id")
        tree = int(pdf["tree"].iloc[0])
        nodes = build_tree(np.vstack(pdf["x"].to_numpy()), np.random.default_rng([seed, tree]))
        out = pd.DataFrame(nodes, columns=["node", "feature", "split", "left", "right", "size", "depth"])
        out.insert(0, "tree", tree)
        for i, g in enumerate(groups):
            out.insert(i, g, pdf[g].iloc[0])
        return out

    return sample.groupBy(*groups, "tree").applyInPandas(fit, schema)


def average_path(size: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``size`` rows."""
    size = np.asarray(size, dtype=float)
    big = np.maximum(size, 3)
    harmonic = np.log(big - 1) + np.euler_gamma
    return np.where(size <= 1, 0.0, np.where(size == 2, 1.0, 2 * harmonic - 2 * (big - 1) / big))


@dataclass
class Forest:
    """All trees in flat arrays: a leaf points to itself and carries its path length.

    Node i has its right child at ``children[2 * i]`` and its left child, for values up to the split, after it.
    """

    columns: list[str]
    roots: np.ndarray
    feature: np.ndarray
    split: np.ndarray
    children: np.ndarray
    path: np.ndarray
    height: int
    sample: float
    offset: float = 0.0

    def depths(self, x: np.ndarray, chunk: int = 512) -> np.ndarray:
        """Mean path length per row; rows go through in chunks that fit the processor cache."""
        out = np.empty(len(x))
        for start in range(0, len(x), chunk):
            part = np.ascontiguousarray(x[start : start + chunk])
            values, base = part.ravel(), (np.arange(len(part), dtype=np.int32) * part.shape[1])[:, None]
            at = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(self.height):
                below = values.take(base + self.feature.take(at)) <= self.split.take(at)
                at = self.children.take(2 * at + below)
            out[start : start + chunk] = self.path.take(at).mean(axis=1)
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        """In [-1, 0); the lower, the more isolated."""
        return -np.power(2.0, -self.depths(x) / average_path(np.array([self.sample]))[0])


def assemble(nodes: DataFrame, columns: list[str], tree_key: list[str] | None = None) -> Forest | None:
    """Collect the node table (bounded: trees x twice the sample size) into one forest; None if it is empty."""
    key = tree_key or ["tree"]
    pdf = nodes.toPandas()
    if pdf.empty:
        return None
    pdf = pdf.sort_values([*key, "node"]).reset_index(drop=True)
    starts = pdf.index[pdf["node"] == 0].to_numpy()
    base = np.repeat(starts, np.diff(np.append(starts, len(pdf))))
    size, depth, feature = (pdf[c].to_numpy() for c in ("size", "depth", "feature"))
    leaf, here = feature < 0, np.arange(len(pdf))
    children = [np.where(leaf, here, base + pdf[side].to_numpy()) for side in ("right", "left")]
    return Forest(
        columns=columns,
        roots=starts.astype(np.int32),
        feature=np.maximum(feature, 0).astype(np.int32),
        split=pdf["split"].to_numpy(),
        children=np.stack(children, axis=1).ravel().astype(np.int32),
        path=depth + average_path(size),
        height=int(depth.max()),
        sample=float(size[starts].max()),
    )


def score(rows: DataFrame, forest: Forest) -> DataFrame:
    """``rows`` plus ``anomaly_score``: score minus the forest's offset."""
    shared = rows.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("double")
    def decide(x: pd.Series) -> pd.Series:
        model = shared.value
        return pd.Series(model.scores(np.vstack(x.to_numpy())) - model.offset)

    return rows.withColumn("anomaly_score", decide(F.array(*[F.col(c).cast("double") for c in forest.columns])))


def set_offset(forest: Forest, rows: DataFrame, contamination: float) -> Forest:
    """Put the zero of the score so that the given share of ``rows`` falls below it."""
    forest.offset += exact_quantile(score(rows, forest).select("anomaly_score"), "anomaly_score", contamination)
    return forest


def exact_quantile(rows: DataFrame, column: str, share: float, most: int = 100_000) -> float:
    """The interpolated quantile of all values, as a sort would give it.

    An estimate brackets the place, a count says how many values lie below, and only the values inside, at most
    ``most`` of them, are collected; a bracket with more is bracketed again.
    """
    values = cut(rows.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("v")))
    n = values.count()
    if not n:
        return 0.0
    place = share * (n - 1)
    low, high, below, inside = float("-inf"), float("inf"), 0, n

    def value(k: int) -> float:
        nonlocal low, high, below, inside
        part = values.where(F.col("v").between(low, high))
        while inside > most and low < high:
            middle = (k - below) / inside
            ends = [max(0.0, middle - 0.01), min(1.0, middle + 0.01)]
            a, b = part.agg(F.percentile_approx("v", F.array(*map(F.lit, ends)), 1_000)).first()[0]
            under, here = values.agg(F.count_if(F.col("v") < a), F.count_if(F.col("v").between(a, b))).first()
            if not under <= k < under + here or here == inside:
                # the estimate missed: halve around the middle value instead
                a = b = part.agg(F.percentile_approx("v", 0.5, 1_000)).first()[0]
                under, here = values.agg(F.count_if(F.col("v") < a), F.count_if(F.col("v") == a)).first()
                if k < under:
                    a, b = low, float(np.nextafter(a, -np.inf))
                elif k >= under + here:
                    a, b = float(np.nextafter(a, np.inf)), high
                under, here = values.agg(F.count_if(F.col("v") < a), F.count_if(F.col("v").between(a, b))).first()
            low, high, below, inside = a, b, under, here
            part = values.where(F.col("v").between(low, high))
        if low == high:
            return low
        return sorted(r[0] for r in part.collect())[k - below]

    first = value(int(place))
    if place == int(place):
        return first
    low, high, below, inside = float("-inf"), float("inf"), 0, n
    return first + (place - int(place)) * (value(int(place) + 1) - first)


def fit(
    rows: DataFrame,
    columns: list[str],
    contamination: float = 0.1,
    trees: int = 100,
    tree_rows: int = 256,
    seed: int = 42,
    min_rows: int = 11,
    row_id: str = "event_id",
    base: DataFrame | None = None,
) -> Forest | None:
    """A fitted forest, or None with fewer than ``min_rows`` rows."""
    sample = sample_per_tree(rows, columns, None, trees, tree_rows, seed, min_rows, row_id, base)
    forest = assemble(fit_nodes(sample, None, seed), columns)
    return forest and set_offset(forest, rows, contamination)


def anomalies(scored: DataFrame, kind: str, label: str, severity: Column | None = None) -> DataFrame:
    """Anomaly rows of the scored events below 0; the event columns travel with the features, so nothing is joined."""
    severity = score_severity("anomaly_score") if severity is None else severity
    details = F.concat(F.lit(f"{label} model detected anomaly with score "), fixed(F.col("anomaly_score"), 3))
    return (
        scored.where(F.col("anomaly_score") < 0)
        .withColumns({"anomaly_type": F.lit(kind), "severity": severity, "details": details})
        .select(*ANOMALY_COLUMNS, "anomaly_score")
    )


def detect(events: DataFrame, contamination: float = 0.1, min_rows: int = 11) -> DataFrame:
    """Fit on the events and report the most isolated share of them."""
    scored = _fit_and_score(feats.ml_features(events, keep=BASE), feats.ML_COLUMNS, events, contamination, min_rows)
    return anomalies(scored, "ml_detected", "ML")


def detect_simple(events: DataFrame, contamination: float = 0.1, min_rows: int = 10) -> DataFrame:
    """The six-column variant with three severity bands."""
    rows = feats.ml_features_simple(events, keep=BASE)
    scored = _fit_and_score(rows, feats.SIMPLE_COLUMNS, events, contamination, min_rows)
    return anomalies(scored, "ml_detected", "ML", score_severity_three("anomaly_score"))


def _fit_and_score(
    rows: DataFrame, columns: list[str], events: DataFrame, contamination: float, min_rows: int
) -> DataFrame:
    forest = fit(rows, columns, contamination, min_rows=min_rows, base=events)
    return score(rows, forest) if forest else rows.where(F.lit(False)).withColumn("anomaly_score", F.lit(0.0))
