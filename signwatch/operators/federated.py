"""Per-client training on private partitions, combined by weighted parameter averages.

Rows never leave their partition: a client contributes sums (mean, deviation, gradient, curvature), which Spark
combines before the shuffle. A client may therefore hold any share of the data. What travels afterwards is one row
of parameters per client.
"""

from __future__ import annotations

import warnings

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signwatch.lineage import cut
from signwatch.operators import forest as iforest
from signwatch.operators.features import CLIENT_COLUMNS
from signwatch.skew import salted_join

CLIENT = ["client_id"]


def weighted_mean(vectors: DataFrame, keys: list[str], value: str, weight: str | None = None) -> DataFrame:
    """Per key sum(weight * value) / sum(weight); without weights the plain mean."""
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    return vectors.groupBy(*keys).agg((F.sum(w * F.col(value)) / F.sum(w)).alias(value))


def scaled_by_client(rows: DataFrame, columns: list[str] = CLIENT_COLUMNS) -> DataFrame:
    """Each client's columns on its own mean and population deviation (1 where constant)."""
    stats = rows.groupBy(*CLIENT).agg(
        *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]
    )
    joined = salted_join(rows, stats, CLIENT, spread=["event_id"])
    spread = {c: F.when(F.col(f"s_{c}") == 0, 1.0).otherwise(F.col(f"s_{c}")) for c in columns}
    scaled = {c: (F.col(c) - F.col(f"m_{c}")) / spread[c] for c in columns}
    keep = [c for c in rows.columns if c not in columns]
    return joined.select(*keep, *[scaled[c].alias(c) for c in columns])


def linear(columns: list[str], weight) -> Column:
    """Intercept plus the weighted sum; ``weight(i)`` is the i-th coefficient, the last one the intercept."""
    total = weight(len(columns))
    for i, c in enumerate(columns):
        total = total + weight(i) * F.col(c)
    return total


def sigmoid(z: Column) -> Column:
    return 1 / (1 + F.exp(-z))


def gradient(rows: DataFrame, weights: list[float], columns: list[str] = CLIENT_COLUMNS) -> DataFrame:
    """(client_id, n, param, grad): the log-loss gradient of each client at the shared weights."""
    miss = sigmoid(linear(columns, lambda i: F.lit(float(weights[i])))) - F.col("label")
    sums = rows.withColumn("_miss", miss).groupBy(*CLIENT).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col("_miss") * F.col(c)).alias(c) for c in columns],
        F.sum("_miss").alias("intercept"),
    )
    return unpivot(sums, [*columns, "intercept"], "grad")


def unpivot(df: DataFrame, columns: list[str], value: str) -> DataFrame:
    return df.unpivot([*CLIENT, "n"], columns, "param", value)


def step(grads: DataFrame, rate: float) -> DataFrame:
    """Client parameters after one gradient step from zero: (client_id, n, param, value)."""
    return grads.select(*CLIENT, "n", "param", (-rate * F.col("grad") / F.col("n")).alias("value"))


def average(params: DataFrame, extra_keys: list[str] | None = None) -> DataFrame:
    """Size-weighted mean of the client parameters."""
    return weighted_mean(params, [*(extra_keys or []), "param"], "value", "n")


def local_fit(
    rows: DataFrame, columns: list[str] = CLIENT_COLUMNS, c: float = 1.0, max_steps: int = 20, tol: float = 1e-6
) -> DataFrame:
    """(client_id, n, param, value): each client's L2-regularised logistic regression on its scaled columns.

    Newton steps. Every step is one aggregation per client (gradient and curvature sums); the small linear system of
    each client is then solved from its single row of sums.
    """
    names = [*columns, "intercept"]
    k = len(names)
    base = scaled_by_client(rows, columns)
    weights = cut(
        rows.groupBy(*CLIENT).agg(F.count(F.lit(1)).alias("n")).withColumn("w", F.array(*[F.lit(0.0)] * k)).withColumn("moved", F.lit(1.0))
    )
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    @F.pandas_udf("w array<double>, moved double")
    def solve(w: pd.Series, grad: pd.Series, hess: pd.Series) -> pd.DataFrame:
        out = []
        for now, g, h in zip(w, grad, hess):
            now, matrix = np.asarray(now), np.zeros((k, k))
            for (i, j), value in zip(pairs, h):
                matrix[i, j] = matrix[j, i] = c * value
            ridge = np.append(np.ones(k - 1), 0.0)
            move = np.linalg.lstsq(matrix + np.diag(ridge), c * np.asarray(g) + ridge * now, rcond=None)[0]
            out.append((list(now - move), float(np.abs(move).max())))
        return pd.DataFrame(out, columns=["w", "moved"])

    if weights.isEmpty():
        max_steps = 0
    for _ in range(max_steps):
        joined = salted_join(base, weights.select(*CLIENT, "n", "w"), CLIENT, spread=["event_id"], base=rows)
        p = sigmoid(linear(columns, lambda i: F.col("w")[i]))
        joined = joined.withColumn("_p", p).withColumns({"_miss": F.col("_p") - F.col("label"), "_v": F.col("_p") * (1 - F.col("_p"))})
        x = [*[F.col(name) for name in columns], F.lit(1.0)]
        sums = joined.groupBy(*CLIENT).agg(
            F.first("n").alias("n"),
            F.first("w").alias("w"),
            *[F.sum(F.col("_miss") * x[i]).alias(f"g{i}") for i in range(k)],
            *[F.sum(F.col("_v") * x[i] * x[j]).alias(f"h{i}_{j}") for i, j in pairs],
        )
        sums = sums.select(
            *CLIENT,
            "n",
            solve("w", F.array(*[f"g{i}" for i in range(k)]), F.array(*[f"h{i}_{j}" for i, j in pairs])).alias("s"),
        )
        weights = cut(sums.select(*CLIENT, "n", "s.w", "s.moved"))
        if weights.agg(F.max("moved")).first()[0] <= tol:
            break
    else:
        if max_steps:
            far = weights.where(F.col("moved") > tol).count()
            warnings.warn(f"{far} clients still moved by more than {tol} after {max_steps} steps", stacklevel=2)
    return unpivot(
        weights.select(*CLIENT, "n", *[F.col("w")[i].alias(name) for i, name in enumerate(names)]), names, "value"
    )


def participants(clients: DataFrame, rounds: int, per_round: int | None = None, seed: int = 42) -> DataFrame:
    """(round, client_id, n): the clients taking part in each round, picked by a hash of seed, round and client."""
    numbers = F.sequence(F.lit(1).cast("bigint"), F.lit(rounds).cast("bigint"))
    drawn = clients.withColumn("round", F.explode(numbers))
    if per_round is None:
        return drawn.select("round", *CLIENT, "n")
    draw = F.md5(F.concat_ws("-", F.lit(seed), "round", "client_id"))
    w = Window.partitionBy("round").orderBy(draw, "client_id")
    return drawn.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= per_round).select("round", *CLIENT, "n")


def rounds(params: DataFrame, taking_part: DataFrame) -> DataFrame:
    """(round, param, value): the global model after each round.

    A client trains to its own optimum in every round it takes part in, whatever the global model was, so the local
    parameters are fitted once and the rounds differ only in who is averaged.
    """
    return average(params.join(taking_part.select("round", *CLIENT), "client_id"), ["round"])


def status(clients: DataFrame, taking_part: DataFrame) -> DataFrame:
    """Long form (section, key, value): clients, rounds, participants per round, mean data size, participation."""

    def row(section: str, key: Column, value: Column) -> list[Column]:
        return [F.lit(section).alias("section"), key.alias("key"), value.cast("double").alias("value")]

    totals = clients.agg(F.count(F.lit(1)).alias("c"), F.avg("n").alias("a"))
    per_round = taking_part.groupBy("round").agg(F.count(F.lit(1)).alias("c"))
    per_client = taking_part.groupBy(*CLIENT).agg(F.count(F.lit(1)).alias("c"))
    every_client = clients.join(per_client, "client_id", "left")
    return (
        totals.select(*row("total_clients", F.lit("all"), F.col("c")))
        .unionByName(totals.select(*row("average_data_size", F.lit("all"), F.col("a"))))
        .unionByName(per_round.agg(F.count(F.lit(1)).alias("c")).select(*row("completed_rounds", F.lit("all"), F.col("c"))))
        .unionByName(per_round.select(*row("participants", F.col("round").cast("string"), F.col("c"))))
        .unionByName(every_client.select(*row("participation", F.col("client_id"), F.coalesce("c", F.lit(0)))))
    )


def forest_params(configs: DataFrame) -> DataFrame:
    """One row: mean contamination, whole mean of the tree counts, the first client's sample size and seed."""
    return configs.agg(
        F.avg("contamination").alias("contamination"),
        F.floor(F.avg("n_estimators")).alias("n_estimators"),
        F.min_by("max_samples", "client_id").alias("max_samples"),
        F.min_by("random_state", "client_id").alias("random_state"),
    )


def predict(rows: DataFrame, params: DataFrame, columns: list[str] = CLIENT_COLUMNS) -> DataFrame:
    """Client-scaled rows plus ``prediction`` of the global model (param, value)."""
    # one row per parameter, a fixed number
    model = params.agg(F.map_from_entries(F.collect_list(F.struct("param", "value")))).scalar()
    names = [*columns, "intercept"]
    scaled = scaled_by_client(rows, columns).withColumn("_model", model)
    z = linear(columns, lambda i: F.col("_model")[names[i]])
    return scaled.withColumn("prediction", (z > 0).cast("bigint")).drop("_model")


def evaluate(predicted: DataFrame) -> DataFrame:
    """One row: accuracy and support-weighted precision and recall, from the confusion counts."""
    # one row per pair of classes, read several times below
    cells = cut(predicted.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("c")))
    total = cells.agg(F.sum("c")).scalar()
    hits = F.when(F.col("label") == F.col("prediction"), F.col("c")).otherwise(0)
    by_label = cells.groupBy(F.col("label").alias("class")).agg(F.sum("c").alias("support"), F.sum(hits).alias("hits"))
    by_guess = cells.groupBy(F.col("prediction").alias("class")).agg(F.sum("c").alias("guessed"))
    joined = by_label.join(by_guess, "class", "left").withColumn("total", total)
    precision = F.when(F.col("guessed") > 0, F.col("hits") / F.col("guessed")).otherwise(0.0)
    return joined.agg(
        (F.sum("hits") / F.max("total")).alias("accuracy"),
        F.sum(F.col("support") * precision / F.col("total")).alias("precision"),
        F.sum(F.col("hits") / F.col("total")).alias("recall"),
    )


def forest_counts(scored: DataFrame) -> DataFrame:
    """How many rows the forest calls anomalous and normal."""
    return scored.agg(
        F.count_if(F.col("anomaly_score") < 0).alias("anomaly_count"),
        F.count_if(F.col("anomaly_score") >= 0).alias("normal_count"),
    )


def fit_forest(rows: DataFrame, trees: int = 100, contamination: float = 0.1, seed: int = 42):
    """One forest of at least ``trees`` trees, as many from each client's own forest; None without data.

    Every client has at least one tree, so with more clients than ``trees`` the model has a tree per client.
    """
    clients = rows.select(*CLIENT).distinct().count()
    each = max(1, -(-trees // max(clients, 1)))
    sample = iforest.sample_per_tree(rows, CLIENT_COLUMNS, CLIENT, trees=each, seed=seed)
    nodes = cut(iforest.fit_nodes(sample, CLIENT, seed))
    model = iforest.assemble(nodes, CLIENT_COLUMNS, ["client_id", "tree"])
    return model and iforest.set_offset(model, rows, contamination)


def detect(rows: DataFrame, model: iforest.Forest) -> DataFrame:
    """Anomalies among client rows that carry the event columns."""
    return iforest.anomalies(iforest.score(rows, model), "federated_ml_detected", "Federated ML")


def encrypt_params(params: DataFrame, key: Column) -> DataFrame:
    """(client_id, payload): the parameters of a client as one encrypted JSON document."""
    document = F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("param", "value")))))
    return params.groupBy(*CLIENT).agg(document.alias("_json")).select(
        *CLIENT, F.aes_encrypt(F.col("_json").cast("binary"), key).alias("payload")
    )


def decrypt_params(payloads: DataFrame, key: Column) -> DataFrame:
    """(client_id, param, value) again."""
    document = F.aes_decrypt("payload", key).cast("string")
    return payloads.select(*CLIENT, F.explode(F.from_json(document, "map<string,double>")).alias("param", "value"))
