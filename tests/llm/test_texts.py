"""Classifiers, scans and the tokenizer on planted rows, brute force and round trips."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
from pathlib import Path

import pyarrow as pa
import pytest
import sentencepiece
from conftest import lower
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from signwatch.lineage import scratch
from signwatch.llm import language, licenses, pieces, pii, queries, secrets, text, toxicity

ODD = ["", " ", "\n", "a", "Ä é", "x" * 5000, "a b  c", "😀 z", "ab\tcd\r\nef"]


def test_words_and_hashes():
    rnd = random.Random(1)
    docs = [None, *ODD, *(" ".join(rnd.choice("abcé") * rnd.randint(1, 3) for _ in range(30)) for _ in range(100))]
    seen = {}
    for begin, end, words in text.word_slices(pa.array(docs), most=300):
        hashes = words.hashes()
        for k in range(begin, end):
            own = re.findall(r"[^\x20\x09-\x0D]+", lower(docs[k]))
            a, b = words.first[k - begin], words.first[k - begin + 1]
            assert [words.word(i).decode() for i in range(a, b)] == own
            assert all(seen.setdefault(w, h) == h for w, h in zip(own, hashes[a:b], strict=True))
        for length in (1, 3, 13):
            for i, h in zip(*words.windows(hashes, length), strict=True):
                assert seen.setdefault(tuple(words.word(j) for j in range(i, i + length)), h) == h
    assert len(set(seen.values())) == len(seen)


def toxic_rows(n=400):
    rnd = random.Random(2)
    plain = ["lorem", "ipsum", "dolor", "sit", "amet", "con", "sec", "tetur"]
    rows = []
    for i in range(n):
        words = [rnd.choice(plain) + rnd.choice(["", "s", "um"]) for _ in range(rnd.randint(20, 200))]
        if i % 5 == 0:
            for _ in range(4):
                words.insert(rnd.randrange(len(words)), "scoun" + rnd.choice(["drel", "dren", "di"]))
        rows.append((i, " ".join(words), int(i % 5 == 0)))
    return rows


def test_toxicity(spark, docs_of, odd_rows):
    rows = toxic_rows()
    docs = docs_of([(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 4] + [(3, None), (None, 1), (7, 0), (7, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [(i, y) for i, _, y in rows if i % 4 == 0]
    assert sum((scores[i] >= 0.3) == bool(y) for i, y in held) >= 0.97 * len(held)
    odd = toxicity.score(docs_of(odd_rows), model).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in odd)
    kept = toxicity.drop_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(s < 0.3 for s in scores.values())
    for few in (labels.limit(0), labels.filter("toxic = 0"), labels.filter("toxic = 1")):
        one = toxicity.score(docs, toxicity.fit(docs, few)).agg(F.min("score"), F.max("score")).first()
        assert 0 <= one[0] <= one[1] <= 1
    assert toxicity.score(docs_of([]), toxicity.fit(docs_of([]), labels)).count() == 0


def test_toxicity_beyond_marks_spaces_and_depth(spark, docs_of):
    rnd = random.Random(12)
    han = [chr(0x4E00 + k) for k in range(300)]
    rows = toxic_rows()
    for i in range(400, 800):
        letters = [rnd.choice(han) for _ in range(rnd.randint(40, 120))]
        if i % 5 == 0:
            for _ in range(4):
                letters.insert(rnd.randrange(10, len(letters)), "白痴")
        rows.append((i, "".join(letters), int(i % 5 == 0)))
    docs = docs_of([(i, t) for i, t, _ in rows])
    model = toxicity.fit(docs, spark.createDataFrame([(i, y) for i, _, y in rows if i % 4], "doc_id long, toxic int"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [(i, y) for i, _, y in rows if i % 4 == 0 and i >= 400]
    assert sum((scores[i] >= 0.3) == bool(y) for i, y in held) >= 0.95 * len(held)
    plain, *marked = model.features(pa.array(["lorem (scoundrel) sit", "lorem «scoundrel» sit", "lorem\u00a0“scoundrel”\u2014sit", None]))
    assert marked[0] == pytest.approx(plain) and marked[1] == pytest.approx(plain)
    late, none = model.features(pa.array(["x" * 20 + "scoundrel", "x" * 20 + "zzzzzzzzz"]))
    assert late[toxicity.FEATURES.index("top")] > none[toxicity.FEATURES.index("top")]


def test_language_learns_nothing_from_held_out_rows(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    other = docs.withColumn("text", F.when(held_out, F.concat(F.lit("zzz qqq "), "text")).otherwise(F.col("text")))
    for name, rows in (("a", docs), ("b", other)):
        rows.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    found = [queries.op3_language(spark, f"{tmp_path}/{name}").filter("NOT held_out").collect() for name in "ab"]
    assert sorted(found[0]) == sorted(found[1])


def test_a_rare_language_is_learned(spark):
    """One row in a thousand is of a language of its own."""
    rnd = random.Random(2)
    words = {"aa": ["krol", "zamek", "szczyt", "wrzos"], "bb": ["huone", "ikkuna", "saari", "kuu"]}
    rows = [(i, " ".join(rnd.choice(words["bb" if i % 1000 == 7 else "aa"]) for _ in range(12)), "bb" if i % 1000 == 7 else "aa") for i in range(12_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, docs.filter("doc_id % 3 <> 0"))
    found = language.predict(docs.filter("doc_id % 3 = 0"), model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == "bb" for r in found) >= 3 and all(r.lang == r.lang_pred for r in found)


def test_language(spark, sf_dir, odd_rows):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang")
    model = language.fit(docs, docs.filter("doc_id % 3 <> 1"))
    found = language.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter("doc_id % 3 = 1")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.98 and (model.weights == 0).mean() > 0.3
    odd = spark.createDataFrame([(i, t, "n") for i, t in [*odd_rows, (9, "123 !"), (10, "и")]], "doc_id long, text string, lang_pred string")
    rows = {r["doc_id"]: r for r in language.predict(odd, model).collect()}
    assert {rows[k]["lang_pred"] for k in (1, 2, 3, 9)} == {"und"} and rows[10]["lang_pred"] != "und"
    nothing = language.fit(docs.limit(0), docs.limit(0))
    assert {r["lang_pred"] for r in language.predict(docs.limit(5), nothing).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0


def test_fuzzy_notices():
    rnd = random.Random(3)
    for _ in range(300):
        notice, _ = rnd.choice(licenses.NOTICES)
        letters = list(notice)
        for _ in range(rnd.randint(0, licenses.edits(notice))):
            p = rnd.randrange(len(letters))
            letters[p : p + rnd.randint(0, 1)] = rnd.choice(["", "x", "y"])
        words = licenses.normal("foo bar " * rnd.randint(0, 5) + "".join(letters) + " baz baz")
        if licenses._pattern(notice).search(words):
            assert licenses.notices_in(words)
    assert licenses.notices_in("nothing of the kind") == [] == licenses.notices_in("")


def test_adjacent_notices_are_all_found():
    exact, near, far = "released under the mit license", "relesed under the mit license", "relesed undr the mit licens"
    for lines in ([near, exact], [exact, near], [far, near, exact], [far, exact, far, exact, near] * 40):
        found = licenses.notices_in(" ".join(lines))
        assert [x["label"] for x in found] == ["mit"] * len(lines)
        assert [x["edits"] for x in found] == [{exact: 0, near: 1, far: 3}[x] for x in lines]
    both = licenses.notices_in(f"{near} gnu lesser general public license all rights reservd")
    assert [(x["label"], x["edits"]) for x in both] == [("mit", 1), ("lgpl", 0), ("proprietary", 1)]


def test_licenses(docs_of, odd_rows):
    rows = [
        (20, "Under the MIT License, or the Apache-License; MIT\nlicense."),
        (21, "GNU General Public Licence"),
        (22, "released undr the MIT Licens"),
        (23, "License license MIT"),
        *odd_rows,
    ]
    found = {r["doc_id"]: r for r in licenses.scan(docs_of(rows)).collect()}
    assert [(p["word"], p["label"]) for p in found[20]["places"]] == [(2, "mit"), (6, "apache"), (8, "mit")]
    assert found[21]["places"] == [] and found[23]["places"] == []
    assert [(n["label"], n["first_word"], n["last_word"]) for n in found[22]["notices"]] == [("mit", 0, 4)]
    assert found[1]["n_words"] == 0 and found[4]["n_words"] == 60_000
    assert licenses.scan(docs_of(rows)).count() == len(rows) and licenses.scan(docs_of([])).count() == 0


def fixed_by_hand(raw):
    found = []
    for k, p in enumerate((pii.EMAIL, pii.IP, pii.CARD, pii.PHONE)):
        for m in p.finditer(raw):
            digits = re.sub("[^0-9]", "", m[0])
            good = (
                True,
                k != 1 or all(int(x) <= 255 for x in m[0].split(".")),
                16 <= len(digits) <= 19 and pii.luhn(digits),
                8 <= len(digits) <= 15,
            )
            if good[k]:
                found.append((k, *m.span()))
    return found


def test_fixed_personal_data():
    rnd = random.Random(5)
    parts = ["1", "23", "4.", " ", "-", "+", "(", ")", "@", "a", "b.", "@c.de", "255.", "9", "+1 ", "4111 1111 1111 1111", "é"]
    for _ in range(20_000):
        raw = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 14)))
        assert pii.fixed_spans(raw) == fixed_by_hand(raw)


def test_personal_data(spark, sf_dir, docs_of, odd_rows):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text")
    model = pii.fit(docs)
    assert model.trees.leaves
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in pii.scan(docs, model).collect():
        raw = texts[r["doc_id"]]
        assert [(pii.KINDS.index(s["kind"]), s["begin"], s["end"]) for s in r["fixed"]] == fixed_by_hand(raw)
        spans = sorted((s["begin"], s["end"]) for s in r["added"])
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert pii.scan(docs_of(odd_rows), model).filter("size(fixed) > 0").count() == 0
    assert pii.scan(docs_of([]), pii.fit(docs_of([]))).count() == 0


def test_other_forms_of_personal_data_are_added(spark, sf_dir, docs_of):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.1')}/documents.parquet").select("doc_id", "text")
    model = pii.fit(docs)
    planted = [("email", "john.miller (at) example (dot) com"), ("email", "ann.52[at]mail.example[dot]org"), ("phone", "(888) 555-6841"), ("phone", "0664 5551234")]
    ordinary = ["2021-03-04", "1998-2004", "3.1415926", "ann (at) noon. The", "4670349892180624"]
    lines = [f"the line onwh of {v} stands here" for v in [*(v for _, v in planted), *ordinary]]
    rows = {r["doc_id"]: r for r in pii.scan(docs_of(list(enumerate(lines))), model).collect()}
    assert all(r["fixed"] == [] for r in rows.values())
    added = [[(s["kind"], lines[k][s["begin"] : s["end"]]) for s in rows[k]["added"]] for k in range(len(lines))]
    assert added == [[x] for x in planted] + [[]] * len(ordinary)


def test_trees_learn():
    import numpy as np

    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    model = pii.Trees.fit(x[:1500], y[:1500])
    assert ((model.scores(x[1500:]) > 0.5) == y[1500:]).mean() > 0.95


def test_personal_data_are_learned_from_all_documents(spark):
    """On 27,000 proposals the trees are those of a fit on all of them at once."""
    import numpy as np

    rows = [(k, f"call +43 660 {k:07d} or write to ann.{k}@mail{k % 7}.org, not on 2021-03-{k % 28 + 1:02d}") for k in range(1_500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kinds = "features array<double>, label int, outside boolean, value string, apart boolean"
    found = {(r["value"], r["label"], r["outside"], r["apart"]): r["features"] for r in sorted(docs.select("text").mapInArrow(pii._labelled, kinds).collect(), key=lambda r: r["features"], reverse=True)}
    assert len(found) > 20_000
    x, y = np.array(list(found.values())), np.array([k[1] for k in found], dtype=np.float64)
    apart = np.array([k[3] for k in found])
    model, whole = pii.fit(docs), pii.Trees.fit(x[~apart], y[~apart])
    assert np.abs(model.trees.scores(x) - whole.scores(x)).max() < 1e-4


def secrets_by_hand(raw):
    found = []
    patterns = (re.compile(f"(?:{secrets.ASSIGN})"), re.compile(r"(AKIA[A-Z0-9]+)"), re.compile(r"([0-9a-f]+)"))
    for k, (p, least) in enumerate(zip(patterns, (6, 20, 24), strict=True)):
        found += [(m.start(), k, m.end()) for m in p.finditer(raw or "") if len(m[1]) >= least]
    return sorted(found)


@pytest.fixture(scope="module")
def secret_model(spark, sf_dir):
    return secrets.fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def test_secrets(docs_of, odd_rows, secret_model):
    rnd = random.Random(6)
    parts = ["token", "PassWord", "api_key", "apikey:", "=", ": ", "secret=", "'", '"', "abc", "AKIA", "ABCDEF0123456789", "é😀", "0a1b2c3d4e5f", " ", "x"]
    rows = [(100 + k, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))) for k in range(300)] + odd_rows
    found = secrets.scan(docs_of(rows), secret_model).collect()
    got = sorted(((r["doc_id"], [(s["begin"], s["kind_no"], s["end"]) for s in r["spans"] if s["kind"] != "random"]) for r in found), key=str)
    assert got == sorted(((i, secrets_by_hand(t)) for i, t in rows), key=str)
    assert secrets.scan(docs_of([]), secret_model).count() == 0


def test_random_strings(docs_of, secret_model):
    token = "q7Zx9KfP2mVt8LwRb3NsYh5D"
    rows = [(1, f"use {token} here"), (2, "an extraordinarilylongbutplainword stands here, internationalisationofthings"), (3, f"secret={token}")]
    spans = {r["doc_id"]: [(s["kind"], s["begin"], s["end"]) for s in r["spans"]] for r in secrets.scan(docs_of(rows), secret_model).collect()}
    assert spans == {1: [("random", 4, 4 + len(token))], 2: [], 3: [("assign", 0, 7 + len(token))]}
    out = {r["doc_id"]: r["text"] for r in secrets.redact(docs_of(rows), secret_model).collect()}
    assert out == {1: "use [SECRET] here", 2: rows[1][1], 3: "[SECRET]"}


def test_frequent_secrets_are_all_found(spark):
    rnd = random.Random(9)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    words = "the quick reader finds another interesting chapter about weather stations near northern harbours every summer".split()
    plain = [" ".join(rnd.choice(words) for _ in range(60)) for _ in range(400)]
    tokens = [("ghp_" if k % 2 else "") + "".join(rnd.choice(letters) for _ in range(36)) for k in range(400)]
    names = ["weather_stations_near_northern_harbours", "interestingChapterAboutWeather", "another/chapter/about-every-summer", "-" * 30]
    rows = [(k, f"{a} {b} {names[k % 4]} {a}") for k, (a, b) in enumerate(zip(plain, tokens, strict=True))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [[s["value"] for s in r["spans"] if s["kind"] == "random"] for r in secrets.scan(docs, secrets.fit(docs)).orderBy("doc_id").collect()]
    assert sum(t in f for t, f in zip(tokens, found, strict=True)) >= 0.99 * len(tokens)
    assert not any(n in f for f in found for n in names)


def test_secret_models_learn_from_all_documents(spark):
    names = [f"name{chr(97 + k // 26)}{chr(97 + k % 26)}s" for k in range(100)]
    rows = [(k, f"password=value{k:05d}") for k in range(2_500)] + [(None, "password=without_id " + " ".join(names))]
    strings = secrets.samples(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {f"value{k:05d}" for k in range(2_500)} | {"without_id"} <= {r["value"] for r in strings if r["random"]}
    ordinary = " ".join(r["value"].lower() for r in strings if not r["random"])
    assert all(n in ordinary for n in names)


def test_redaction(spark, odd_rows, secret_model):
    rows = [(i, t, 0 if t is None else len(t), "z") for i, t in odd_rows] + [(50, "é password=abcdef0123456789abcdef01234567 x AKIA" + "B" * 16, 0, "z")]
    table = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, begin string")
    out = secrets.redact(table, secret_model)
    assert out.schema["n_chars"].dataType == table.schema["n_chars"].dataType and out.columns == table.columns
    by = {(r["doc_id"], r["text"]): r["n_chars"] for r in out.collect()}
    assert by[50, "é [SECRET] x [SECRET]"] == 21 and len(out.collect()) == len(rows)
    assert {k for k in by if k[0] != 50} == {(i, t) for i, t in odd_rows}


@pytest.fixture(scope="module")
def unigram():
    proto = sentencepiece_model_pb2.ModelProto()
    with open(pieces.MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1  # the same pieces and scores, best path instead of merges
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def test_pieces(spark, docs_of, odd_rows, unigram):
    rnd = random.Random(8)
    vocabulary = pieces.vocabulary_of(spark)
    letters = "etaoin shrdlu éöñßç the ing qu"
    plain = [(100 + k, "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 60))).strip()) for k in range(60)]
    plain = [(i, re.sub(" +", " ", t)) for i, t in plain]
    rows = plain + odd_rows + [(300 + k, t) for k, t in enumerate(ODD)]
    found = pieces.encode(docs_of(rows), vocabulary)
    got = {}
    for r in pieces.decode(found, vocabulary).collect():
        got.setdefault(r["doc_id"], []).append((r["pieces"], r["text"]))
    for i, t in plain:
        assert got[i][0][0] == unigram.encode(t)
    assert sorted(((i, x[1]) for i, v in got.items() for x in v), key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    assert got[1][0][0] == [] and found.count() == len(rows) and pieces.encode(docs_of([]), vocabulary).count() == 0


def test_vocabulary_has_only_linked_characters_in_its_table(spark):
    vocabulary = pieces.vocabulary_of(spark)
    linked = {x for p, _, _ in vocabulary.pieces for x in zip(p, p[1:], strict=False)}
    size = int(len(vocabulary.linked) ** 0.5 + 0.5)
    table = vocabulary.linked.reshape(size, size)
    kind = lambda c: vocabulary.classes[ord(c)]
    # Each class but the one of all other characters has links, and they are those of the pieces.
    assert (table.any(axis=0) | table.any(axis=1))[1:].all() and not table[0].any() and not table[:, 0].any()
    assert table.sum() == len(linked) and all(table[kind(a), kind(b)] for a, b in linked)


def test_piece_queries_round_trip(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, sf_dir, "documents").collect()}
    for r in queries.op8_pieces(spark, sf_dir).collect():
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() and r["n_pieces"] == len(r["pieces"])


def test_pieces_of_a_long_word(spark, docs_of, unigram):
    rnd = random.Random(9)
    vocabulary = pieces.vocabulary_of(spark)
    for n in (pieces.LONG - 1, pieces.LONG, pieces.LONG + 1, 20_000):
        texts = ["a" * n, "".join(rnd.choice("etaoinshrdlu") for _ in range(n)), "é" * n, "x" + "é\U0001f600" * (n // 2)]
        found = pieces.decode(pieces.encode(docs_of(list(enumerate(texts + texts[:1]))), vocabulary), vocabulary).collect()
        for r in found:
            t = (texts + texts[:1])[r["doc_id"]]
            assert r["pieces"] == unigram.encode(t) and r["text"] == t
        assert len(found) == 5


def test_secrets_run_the_patterns_once(spark, docs_of, monkeypatch):
    """Training strings are written and removed: the documents are read by a single job, and no folder stays."""
    seen, folders = spark.sparkContext.accumulator(0), []
    rows = [(i, f"token: abcdef{i} and some plain identifiers_{i} of ordinary words") for i in range(40)]

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(secrets, "scratch", lambda s, name: folders.append(scratch(s, name)) or folders[-1])
    docs = docs_of(rows).select("doc_id", "text")
    model = secrets.fit(docs.mapInArrow(counted, docs.schema))
    assert seen.value == len(rows) and not any(Path(f.removeprefix("file:")).exists() for f in folders) and len(folders) == 1
    assert model == secrets._fitted(secrets.samples(docs))


def test_texts_are_copied_a_slice_at_a_time():
    """Twenty MB in one batch: numpy holds a slice's arrays, Arrow a slice's copies."""
    column = pa.array(["Some Words of a text, again and again. " * 256] * 2_000)
    before = pa.total_allocated_bytes()
    most = 0
    tracemalloc.start()
    try:
        for _, _, words in toxicity._words(column):
            words.hashes()
            most = max(most, pa.total_allocated_bytes() - before)
        assert tracemalloc.get_traced_memory()[1] < 80 << 20 and most < 5 << 20
    finally:
        tracemalloc.stop()


def test_a_block_holds_little_beside_its_numbers():
    """Twelve MB of text with many different words."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(30_000)]
    column = pa.array([" ".join(rnd.choices(words, k=700)) for _ in range(2_400)])
    vocabulary = pieces.Vocabulary.load()
    tracemalloc.start()
    try:
        block = pieces.Block.of(column, vocabulary)
        assert tracemalloc.get_traced_memory()[1] < 80 << 20
    finally:
        tracemalloc.stop()
    assert len(block.numbers) == block.counts.sum() >= 700 * 2_400


def test_small_batches_share_a_block():
    """Blocks are filled whatever the size of Arrow batches; each row is in one of them, in its place."""
    line = "word " * 200
    sizes = [300, 1, 0, 700, 20_000, 5, 5_000, 30_000, 300]
    rows = [[None if k % 50 == 0 else line[: 1 + k * 37 % 1000] for k in range(n)] for n in sizes]
    batches, at = [], 0
    for own in rows:
        batches.append(pa.record_batch({"doc_id": pa.array(range(at, at + len(own)), pa.int64()), "text": pa.array(own, pa.string())}))
        at += len(own)
    blocks = list(pieces._blocks(iter(batches)))
    assert [i for b in blocks for i in b["doc_id"].to_pylist()] == list(range(at))
    assert [t for b in blocks for t in b["text"].to_pylist()] == [t for own in rows for t in own]
    held = [sum(len(t or "") for t in b["text"].to_pylist()) for b in blocks]
    assert max(held) <= pieces.BLOCK_BYTES
    small = pa.record_batch({"doc_id": range(1_000), "text": [line] * 1_000})
    assert [b.num_rows for b in pieces._blocks(iter([small] * 26))] == [12_582, 12_582, 836]
    long = pa.record_batch({"doc_id": [1, 2, 3], "text": ["a", "b" * (pieces.BLOCK_BYTES + 1), "c"]})
    assert [b["doc_id"].to_pylist() for b in pieces._blocks(iter([small.slice(0, 1), long]))] == [[0], [1], [2], [3]]
    vocabulary = pieces.Vocabulary.load()
    two = pa.chunked_array([["one two", None], ["", "two three"]])
    assert pieces.Block.of(two, vocabulary).counts.tolist() == pieces.Block.of(two.combine_chunks(), vocabulary).counts.tolist()


def test_toxicity_looks_at_a_little_text_at_a_time():
    column = pa.array(["some words " * 100] * 3_000)
    parts = list(toxicity._words(column))
    assert max(len(words.data) for _, _, words in parts) <= 1 << 18
    assert [k for begin, end, _ in parts for k in range(begin, end)] == list(range(len(column)))
