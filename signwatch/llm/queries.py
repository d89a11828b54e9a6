"""The registered queries of this subpackage: thin digests of the operators' results, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signwatch.llm import (
    audit,
    contamination,
    dedup,
    exact_dedup,
    language,
    licenses,
    pieces,
    pii,
    secrets,
    shingle_join,
    topk,
    toxicity,
    whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(parts: int, column: str = "doc_id") -> Column:
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(parts))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(_fold(4) != 2)
    found = toxicity.score(docs, toxicity.fit(docs, labels))
    return found.select(
        "doc_id", (_fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op2_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shingle_join.join(table(spark, sf_dir, "documents"), words=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learned = docs.filter(_fold(3) != 1)
    model = language.fit(learned, learned)
    return language.predict(docs, model).select("doc_id", (_fold(3) == 1).alias("held_out"), "lang_pred", "score")


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    joined = lambda labels: F.concat_ws(",", F.array_sort(F.array_distinct(labels)))
    base = F.col("places.label")
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").cast("long").alias("first_word"),
        F.array_max("places.word").cast("long").alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.col("notices.label"))).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(F.coalesce(F.array_max("notices.similarity"), F.lit(0.0))).alias("score"),
        F.size("notices").cast("long").alias("n_notices"),
        F.to_json("notices").alias("notices"),
    )


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.scan(docs, pii.fit(docs))
    number = lambda kind: F.size(F.filter("fixed", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    order = F.array(*map(F.lit, pii.KINDS))
    every = F.concat("fixed", "added")
    by_kind = F.transform(
        F.array_sort(F.transform(every, lambda s: F.struct(F.array_position(order, s["kind"]).alias("n"), s["begin"].alias("begin"), s["end"].alias("end"), s["kind"].alias("kind")))),
        lambda s: s,
    )
    return found.select(
        "doc_id", *(number(k) for k in pii.KINDS), F.sha2(_listed(F.col("fixed")), 256).alias("base_sha256"), _listed(by_kind).alias("spans")
    )


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_words",
        F.size("removed").cast("long").alias("n_removed"),
        F.sha2("kept_text", 256).alias("kept_sha256"),
    )


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encode(table(spark, sf_dir, "documents"), pieces.vocabulary_of(spark), again=True)
    return found.select("doc_id", F.size("pieces").cast("long").alias("n_pieces"), "pieces", F.sha2("text", 256).alias("decoded_sha256"))


def _listed(spans: Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit(docs))
    base = F.filter("spans", lambda s: s["kind"] != "random")
    number = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(number(k) for k in secrets.KINDS), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans")
    )


def op10_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.size("hit_words").cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = whitening.integers(table(spark, sf_dir, "embeddings"))
    model = whitening.fit(x)
    found = whitening.transform(x, model).select("id", "deviation", F.posexplode("whitened"))
    shares = F.array(*(F.lit(float(e)) for e in (model.explained if model else []))).cast("array<double>")
    return found.select(
        F.col("id").alias("vec_id"),
        (F.col("pos") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("long").alias("n"),
        "deviation",
        F.col("col").alias("whitened"),
        F.get(shares, F.col("pos")).alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.copies(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_shingle_join": op2_shingle_join,
    "op3_language": op3_language,
    "op4_topk": op4_topk,
    "op5_licenses": op5_licenses,
    "op6_pii": op6_pii,
    "op7_repeats": op7_repeats,
    "op8_pieces": op8_pieces,
    "op9_secrets": op9_secrets,
    "op10_contamination": op10_contamination,
    "op11_whitening": op11_whitening,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_filter_audit": op13_filter_audit,
}

#: Components as integers; vectors with a null or a component that is not finite are left out.
OP4_SQL = """
WITH parts AS (
  SELECT vec_id, embedding, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    coalesce(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]), 0) AS score
  FROM parts q JOIN parts c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10
"""

OP7_SQL = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, i, array_to_string(w[i:i+12], chr(1)) AS passage
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 11, 1))) AS i FROM words)
), first AS (
  SELECT doc_id, i, min(doc_id) OVER (PARTITION BY passage) AS earliest FROM windows
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM first WHERE earliest < doc_id
), places AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM words
), kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS kept, count(*) AS n
  FROM places p ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i GROUP BY p.doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.doc_id = k.doc_id
"""

#: Only A-Z are lower-cased.
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, unnest(list_distinct([array_to_string(w[i:i+2], chr(1)) FOR i IN range(1, greatest(len(w) - 1, 2))])) AS s
  FROM words WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared x JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * x.n >= 90 * (p.n + q.n - x.n)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reached r JOIN both_ways l ON r.b = l.a
), least_reached AS (
  SELECT a, min(b) AS b FROM reached GROUP BY a
)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, least(w.doc_id, coalesce(r.b, w.doc_id)) AS component_id
FROM words w LEFT JOIN sizes s ON s.doc_id = w.doc_id LEFT JOIN least_reached r ON r.a = w.doc_id
"""

OP10_SQL = f"""
WITH items AS (
  SELECT item_id, regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark
), words AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents
), item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i+n-1], ' ') AS passage
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), lengths AS (
  SELECT DISTINCT n FROM item_windows
), windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i+n-1], ' ') AS passage
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, lengths)
), found AS (
  SELECT doc_id, i, x.n AS n, item_id FROM windows x JOIN item_windows y ON x.n = y.n AND x.passage = y.passage
), hits AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hits h ON h.doc_id = w.doc_id LEFT JOIN listed l ON l.doc_id = w.doc_id
"""

OP12_SQL = f"""
WITH texts AS (SELECT doc_id, sha256({LOWERED}) AS h FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY h ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, h AS text_sha256
FROM texts WINDOW w AS (PARTITION BY h)
"""

OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), labelled AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
      len(w) < 200,
      100 * len(list_distinct(w)) < 50 * len(w),
      100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t),
      regexp_matches(t, '[#$%&*|]'),
      coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false)
    ] AS f
  FROM words LEFT JOIN labelled USING (doc_id)
), cases AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failing GROUP BY part, f
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 3, 4, 5]) AS i
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS o
  FROM letters a JOIN letters b ON b.i <> a.i JOIN letters c ON c.i NOT IN (a.i, b.i)
    JOIN letters d ON d.i NOT IN (a.i, b.i, c.i) JOIN letters e ON e.i NOT IN (a.i, b.i, c.i, d.i)
), steps AS (
  SELECT filter_order, o, unnest([1, 2, 3, 4, 5]) AS step FROM orders
), removals AS (
  SELECT part, filter_order, o, f, n, good, toxic, list_position([f[i] FOR i IN o], true) AS gone FROM cases, orders
), counted AS (
  SELECT r.part, filter_order, step, s.o[step] AS own,
    sum(CASE WHEN gone IS NULL OR gone = 0 OR gone > step THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN f[s.o[step]] AND gone < step THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN f[s.o[step]] AND len([x FOR x IN f IF x]) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS toxic_lost
  FROM steps s JOIN removals r USING (filter_order) GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM counted
"""

ORACLES: dict[str, str] = {
    "op2_shingle_join": OP2_SQL,
    "op4_topk": OP4_SQL,
    "op7_repeats": OP7_SQL,
    "op10_contamination": OP10_SQL,
    "op12_exact_dedup": OP12_SQL,
    "op13_filter_audit": OP13_SQL,
}
