"""Each stage of the pipeline against a plain version of its decisions, on the stage's own input."""

from __future__ import annotations

import re

import corpus_pipeline
import pyarrow as pa
import pytest
from conftest import lower
from pyspark.sql import functions as F
from test_pairs import SIGNS, components_of, hits_by_hand, shingle_sets
from test_texts import secrets_by_hand

from signwatch.llm import pieces

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    tables = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], sf_dir).write.parquet(f"{folder}/{k}")
        tables.append(spark.read.parquet(f"{folder}/{k}"))
    return tables


def by_id(table):
    return {r["doc_id"]: r for r in table.collect()}


def test_all_but_the_last_keep_the_columns(stages):
    assert all(t.columns == COLUMNS for t in stages[:-1])


def test_toxic_documents_go(spark, sf_dir):
    more = sf_dir.replace("0.001", "0.01")  # eleven toxic rows are too few to learn from
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{more}/labels.parquet").collect()}
    kept = by_id(corpus_pipeline.drop_toxic(spark, spark.read.parquet(f"{more}/documents.parquet"), more))
    toxic = [i for i, y in labels.items() if y == 1]
    clean = [i for i, y in labels.items() if y == 0]
    assert sum(i in kept for i in toxic) <= 0.3 * len(toxic) and sum(i in kept for i in clean) >= 0.95 * len(clean)


def test_one_of_each_group_stays(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    assert set(by_id(stages[2])) == set(components_of(shingle_sets(rows, 5), 80).values())


def test_documents_with_benchmark_passages_go(spark, sf_dir, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    windows = {tuple(w[k : k + 10]) for _, t in items for w in [re.findall(SIGNS, lower(t))] for k in range(max(0, len(w) - 9))}
    short = [x for x in items if len(re.findall(SIGNS, lower(x[1]))) < 10]
    expected = set()
    for r in stages[2].collect():
        w = re.findall(SIGNS, lower(r["text"]))
        if not any(tuple(w[k : k + 10]) in windows for k in range(len(w))) and not hits_by_hand(r["text"], short, 10)[1]:
            expected.add(r["doc_id"])
    assert set(by_id(stages[3])) == expected


def test_secrets_are_replaced(stages):
    before, after = by_id(stages[3]), by_id(stages[4])
    assert set(before) == set(after)
    for i, r in after.items():
        assert r["n_chars"] == len(r["text"]) or r["text"] == before[i]["text"]
        assert (r["text"] != before[i]["text"]) == ("[SECRET]" in r["text"] and "[SECRET]" not in before[i]["text"])
        assert not secrets_by_hand(before[i]["text"]) or not secrets_by_hand(r["text"])


def test_the_last_stage_encodes_what_is_left(spark, stages):
    texts = {i: r["text"] for i, r in by_id(stages[4]).items()}
    again = pieces.decode(stages[5], pieces.vocabulary_of(spark))
    assert {r["doc_id"]: r["text"] for r in again.collect()} == texts


def test_stages_take_odd_rows(spark, sf_dir, odd_rows):
    table = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in odd_rows], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        for rows in (table, table.limit(0)):
            assert stage(spark, rows, sf_dir).agg(F.count(F.lit(1))).first()[0] <= len(odd_rows)


def test_workers_get_a_few_megabytes_at_a_time(spark, sf_dir):
    """Rows of 2 KB: Spark's own limits would put all of a task's rows, 16 MB, into one batch."""
    before = spark.conf.get(corpus_pipeline.BATCH, None)
    rows = spark.range(0, 8_000, 1, 1).select("id", F.repeat(F.lit("words "), 350).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch({"size": [batch.nbytes]})

    try:
        spark.conf.unset(corpus_pipeline.BATCH)
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.unset(corpus_pipeline.BATCH)
            stage(spark, docs, sf_dir)
            found = [r["size"] for r in rows.mapInArrow(sizes, "size long").collect()]
            assert max(found) < 1.1 * corpus_pipeline.BATCH_BYTES
        # A size that the user has set stays.
        spark.conf.set(corpus_pipeline.BATCH, "1m")
        corpus_pipeline.decontaminate(spark, docs, sf_dir)
        assert spark.conf.get(corpus_pipeline.BATCH) == "1m"
    finally:
        spark.conf.unset(corpus_pipeline.BATCH) if before is None else spark.conf.set(corpus_pipeline.BATCH, before)
