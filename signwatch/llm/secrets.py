"""Secrets in documents: three fixed patterns, and character Markov models for random strings of any other form.

Only DataFrame functions are used. A pattern's matches and what stands between them give their positions, in code
points, as sums of lengths. Two first-order Markov models over ASCII characters, one of random strings and one of
ordinary identifiers, give every long token a log-likelihood ratio per character; tokens above a threshold are spans of
kind ``random``. Rows keep their place, so nothing but the small training counts is shuffled; training strings are written
once and removed after the fit.

Training counts come from the labelled strings of all documents: values that the fixed patterns find, and digests of the
ids in hexadecimal, base 64 and capitals, are random; shorter tokens than the models judge, and long identifiers put
together from a document's words, are ordinary. Long tokens outside the fixed patterns may be secrets or not, so they are
in neither class. A quarter of the strings is kept apart from the counts: the threshold is the fixed log-odds ``LEAST``,
or, if that is higher, the first score at which no larger a share of its ordinary strings is flagged than of its random
ones is missed. So it doesn't depend on how many secrets there are.

Null texts are empty and have no spans. A token that touches a span of a fixed pattern adds none. Repeated rows are
judged alike, and each counts. Documents without an id are scanned and trained on as well, but have no digest.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signwatch.lineage import remove, scratch

#: Length of a token that the models judge.
TOKEN = 20
LEAST = 0.25
#: Words of an identifier that is put together from a document's words, the marks between them, and steps of the score to one.
WORDS, MARKS, STEPS = 4, ("_", "-", "/", ""), 100
KINDS = ("assign", "access", "hex", "random")

#: The patterns, which group must be how long, and at least how long.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]+)"
HEX = r"([0-9a-f]{24,})"
PATTERNS = {"assign": (ASSIGN, 6), "access": (ACCESS, 20), "hex": (HEX, 24)}
TOKENS = f"([A-Za-z0-9+/_=-]{{{TOKEN},}})"

SPANS = "array<struct<begin: int, kind_no: int, kind: string, end: int, value: string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def positions(texts: Column, pattern: str, kind: str, least: int) -> Column:
    """The pattern's matches whose first group has ``least`` characters, with begin and end in code points."""
    number = KINDS.index(kind)
    whole = F.regexp_extract_all(texts, F.lit(pattern), F.lit(0))

    def placed(matches: Column) -> Column:
        gaps = F.transform(F.split(texts, pattern, -1), F.length)
        parts = F.arrays_zip(matches.alias("whole"), F.regexp_extract_all(texts, F.lit(pattern), F.lit(1)).alias("value"), F.slice(gaps, 1, F.size(matches)).alias("gap"))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

        def step(state: Column, part: Column) -> Column:
            begin = state["at"] + part["gap"]
            end = begin + F.length(part["whole"])
            span = F.struct(
                begin.alias("begin"), F.lit(number).alias("kind_no"), F.lit(kind).alias("kind"), end.alias("end"), part["value"].alias("value")
            )
            kept = F.when(F.length(part["value"]) >= least, F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
            return F.struct(end.alias("at"), kept.alias("spans"))

        return F.aggregate(parts, start, step, lambda state: state["spans"])

    return _let(whole, lambda matches: F.when(F.size(matches) > 0, placed(matches)).otherwise(F.array().cast(SPANS)))


@dataclass
class Model:
    """For each pair of ASCII characters the logarithm of how much likelier the second is in a random string."""

    ratios: list[float]
    threshold: float = LEAST

    def score(self, value: Column) -> Column:
        """Mean log-likelihood ratio per character; the start of the string counts as a zero character."""
        # One text that the optimizer turns into an array, instead of thousands of literals in the plan.
        table = F.split(F.lit(",".join(map(repr, self.ratios))), ",").cast("array<double>")
        codes = F.concat(F.array(F.lit(0)), F.transform(F.split(value, ""), F.ascii))

        def mean(c: Column) -> Column:
            total = F.aggregate(F.sequence(F.lit(1), F.size(c) - 1), F.lit(0.0), lambda s, i: s + F.element_at(table, F.element_at(c, i) * 128 + F.element_at(c, i + 1) + 1))
            return total / (F.size(c) - 1)

        return _let(codes, mean)


def base_spans(texts: Column) -> Column:
    """Spans of the fixed patterns, by begin, then kind."""
    found = [positions(texts, pattern, kind, least) for kind, (pattern, least) in PATTERNS.items()]
    return F.array_sort(F.concat(*found))


def samples(docs: DataFrame) -> DataFrame:
    """Labelled strings of all documents: ``value, random``."""
    text = F.coalesce("text", F.lit(""))
    matches = F.struct(*(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)).alias(kind) for kind, (pattern, _) in PATTERNS.items()))

    def ordinary(plain: Column) -> Column:
        tokens = F.regexp_extract_all(plain, F.lit(r"([A-Za-z0-9+/_=-]{8,})"), F.lit(1))
        words = F.regexp_extract_all(plain, F.lit(r"(?<![A-Za-z0-9+/_=-])([A-Za-z]{3,})(?![A-Za-z0-9+/_=-])"), F.lit(1))
        # All words of a document, some in each identifier, in one of five forms.
        form = F.length(text) % (len(MARKS) + 1)
        joined = F.concat(F.array_join(words, " "), F.lit(" "))
        joined = F.when(form == len(MARKS), F.initcap(joined)).otherwise(joined)
        groups = [mark.join(f"${k + 1}" for k in range(WORDS)) + " " for mark in (*MARKS, "")]
        group = F.element_at(F.array(*map(F.lit, groups)), form + 1)
        joined = F.regexp_replace(joined, F.lit("([A-Za-z]+) " * WORDS), group)
        return F.concat(tokens, F.filter(F.split(joined, " "), lambda x: F.length(x) >= TOKEN), rulers)

    def strings(found: Column) -> Column:
        # Between the fixed patterns' matches stands ordinary text. What is taken out joins nothing, so a pattern
        # without a match in the text has none later.
        plain = text
        for kind, (pattern, _) in PATTERNS.items():
            plain = F.when(F.size(found[kind]) > 0, F.regexp_replace(plain, pattern, " ")).otherwise(plain)
        random = F.concat(*(F.filter(found[kind], lambda v, n=least: F.length(v) >= n) for kind, (_, least) in PATTERNS.items()), made)
        return F.concat(labelled(random, True), labelled(_let(F.regexp_replace(plain, TOKENS, " "), ordinary), False))

    # Of many lengths, so that each character's are on both sides of the calibration.
    rulers = F.array(*(F.repeat(F.lit(c), F.lit(TOKEN) + F.length(text) % TOKEN) for c in "-=_+/"))
    digest = F.sha2(F.col("doc_id").cast("string"), 256)
    made = F.array(F.base64(F.unhex(digest)), digest, F.upper(F.substring(F.translate(F.base64(F.unhex(digest)), "+/=", "357"), 1, 20)))
    made = F.when(F.col("doc_id").isNull(), F.array().cast("array<string>")).otherwise(made)
    labelled = lambda values, random: F.transform(values, lambda v: F.struct(v.alias("value"), F.lit(random).alias("random")))
    # There are always some; a generator that keeps rows without any doesn't make them a second time for a filter.
    return docs.select(F.inline_outer(_let(matches, strings)))


def fit(docs: DataFrame) -> Model:
    """Train on ``docs`` (``doc_id, text``).

    The strings are written next to the checkpoints and read twice, so the patterns run over the texts once.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "secrets")
    samples(docs).write.parquet(folder)
    try:
        return _fitted(spark.read.parquet(folder))
    finally:
        remove(spark, folder)


def _fitted(strings: DataFrame) -> Model:
    """Counts from three quarters of the labelled strings, the threshold from the others."""
    strings = strings.withColumn("apart", F.pmod(F.xxhash64("value"), F.lit(4)) == 0)
    # Each two characters side by side; before the first one stands a zero character.
    twos = F.regexp_extract_all(F.concat(F.lit("\0"), F.col("value")), F.lit("(?=(..))"), F.lit(1))
    pairs = strings.filter(~F.col("apart")).select("random", F.explode_outer(twos).alias("two"))
    # At most two rows for each pair of characters.
    counts = {(r["random"], ord(r["two"][0]) * 128 + ord(r["two"][1])): r["count"] for r in pairs.groupBy("random", "two").count().collect()}
    model = Model(_ratios(counts))
    held = strings.filter(F.col("apart") & (F.length("value") >= TOKEN))
    held = held.select("random", F.floor(model.score(F.col("value")) * STEPS).cast("int").alias("step"))
    # Scores are means of logarithms of bounded ratios: a few thousand steps at most.
    steps = [(r["random"], r["step"], r["count"]) for r in held.groupBy("random", "step").count().collect()]
    return Model(model.ratios, max(LEAST, crossing(steps) / STEPS))


def crossing(steps: list[tuple[bool, int, int]]) -> int:
    """The first step from which on no larger a share of the ordinary strings lies than of the random ones lies below."""
    total = {c: sum(n for random, _, n in steps if random == c) for c in (False, True)}
    if not all(total.values()):
        return 0

    def difference(at: int) -> float:
        flagged = sum(n for random, step, n in steps if not random and step >= at) / total[False]
        missed = sum(n for random, step, n in steps if random and step < at) / total[True]
        return flagged - missed

    return next(at for at in range(min(s for _, s, _ in steps), max(s for _, s, _ in steps) + 2) if difference(at) <= 0)


def _ratios(counts: dict[tuple[bool, int], int]) -> list[float]:
    """Log-ratios of smoothed transition probabilities, each class's own single-character frequencies as backoff."""
    logs = {}
    for random in (False, True):
        single = [1.0] * 128
        after = [0.0] * 128
        for (r, pair), n in counts.items():
            if r == random:
                single[pair % 128] += n
                after[pair // 128] += n
        total = sum(single)
        logs[random] = [
            math.log((counts.get((random, a * 128 + b), 0) + 8 * single[b] / total) / (after[a] + 8)) for a in range(128) for b in range(128)
        ]
    return [x - y for x, y in zip(logs[True], logs[False], strict=True)]


def spans(docs: DataFrame, model: Model, texts: str, into: str) -> DataFrame:
    """The documents with a column of all spans: ``begin, kind_no, kind, end, value``, by begin, then kind."""
    base, tokens = (f"{x}_{uuid.uuid4().hex}" for x in ("base", "tokens"))
    value = F.coalesce(F.col(texts), F.lit(""))
    found = docs.withColumns({base: base_spans(value), tokens: positions(value, TOKENS, "random", TOKEN)})
    apart = lambda t: ~F.exists(F.col(base), lambda s: (s["begin"] < t["end"]) & (t["begin"] < s["end"]))
    added = F.filter(F.col(tokens), lambda t: (model.score(t["value"]) > model.threshold) & apart(t))
    return found.withColumn(into, F.array_sort(F.concat(F.col(base), added))).drop(base, tokens)


def scan(docs: DataFrame, model: Model, id: str = "doc_id", texts: str = "text") -> DataFrame:
    """One row per document: ``doc_id, spans``."""
    docs = docs.select(F.col(id).alias("doc_id"), F.col(texts).alias("text"))
    return spans(docs, model, "text", "spans").select("doc_id", "spans")


def redact(docs: DataFrame, model: Model, texts: str = "text", chars: str = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """The documents, all columns kept, with every span of the text replaced by ``mark`` and ``chars`` counted anew."""
    found = f"spans_{uuid.uuid4().hex}"

    def step(state: Column, span: Column) -> Column:
        between = F.substring(F.col(texts), state["at"] + 1, span["begin"] - state["at"])
        new = span["begin"] >= state["at"]
        # A span that begins inside the one before only makes that longer.
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.when(new, F.concat(state["out"], between, F.lit(mark))).otherwise(state["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    redacted = F.aggregate(F.col(found), start, step, lambda s: F.concat(s["out"], F.substring(F.col(texts), s["at"] + 1, F.length(texts))))
    changed = F.size(found) > 0
    new = {texts: F.when(changed, redacted).otherwise(F.col(texts))}
    out = spans(docs, model, texts, found).withColumns(new)
    if chars in docs.columns:
        kind = docs.schema[chars].dataType
        out = out.withColumn(chars, F.when(F.size(found) > 0, F.length(texts).cast(kind)).otherwise(F.col(chars)))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns))
