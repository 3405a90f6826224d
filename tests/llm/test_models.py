"""Learned scores on planted data and held-out rows, archives, and the pipeline against a plain version of its stages."""

import hashlib
import random
from collections import Counter
from pathlib import Path

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from llm_cases import prose, table
from pyspark.sql import functions as F
from test_documents import plain_components, plain_fingerprint, plain_hits, plain_substring_dedup
from tokenizers import Tokenizer

from segmentry.llm import langid, quality, queries, toxicity, warc
from segmentry.llm.common import fold_of

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n"), (4, "12 34 !?"), (4, "12 34 !?"), (None, "words here"), (5, "word " * 40_000), (6, "x" * 100_000)]


# Languages


@pytest.fixture(scope="module")
def languages():
    rng = random.Random(1)
    letters = {"aa": "abcdefgh", "bb": "ijklmnop", "cc": "abijxyzw"}
    rows = [(i, prose(rng, 80, letters[lang]), lang) for i, lang in enumerate(list(letters) * 30)]
    mixed = [(1000, " ".join([prose(rng, 60, letters["aa"]), prose(rng, 40, letters["bb"])]), None)]
    return rows, mixed


def test_languages_are_told_on_new_texts(spark, languages):
    rows, mixed = languages
    model = langid.learn(table(spark, rows[:60] + [(2000, "no language", None)]))
    assert model.langs == ["aa", "bb", "cc"]
    found = {r.doc_id: r for r in langid.identify(table(spark, rows[60:] + mixed), model).collect()}
    assert all(found[i].lang_pred == lang and found[i].languages == [lang] and found[i].score == 1 for i, _, lang in rows[60:])
    both = found[1000]
    assert both.languages == ["aa", "bb"] and both.shares == pytest.approx([0.6, 0.4], abs=0.05) and both.score == both.shares[0]


def test_languages_of_odd_texts(spark, languages):
    model = langid.learn(table(spark, languages[0]))
    found = langid.identify(table(spark, ODD), model).collect()
    assert len(found) == len(ODD)
    for r in found:
        assert (r.lang_pred == "und") == (r.doc_id in {1, 2, 3, 4}) and 0 <= r.score <= 1
        assert (r.score, r.languages) == (0, []) if r.lang_pred == "und" else r.score > 0
    nothing = langid.learn(table(spark, []))
    assert [r.lang_pred for r in langid.identify(table(spark, [(1, "word")]), nothing).collect()] == ["und"]
    assert langid.identify(table(spark, []), model).isEmpty()


def test_trigram_counts_equal_single_counts(spark, languages):
    rows = [(1, "Ab ab, abc!", "x"), (2, "é 12 ab", "x"), (3, "zz", "y"), (4, None, "y")]
    got = {(r.lang, r.bucket): r.n for r in langid.count_trigrams(table(spark, rows)).collect()}
    expected = Counter()
    for lang, words in (("x", ["ab", "ab", "abc", "é", "ab"]), ("y", ["zz"])):
        for w in words:
            expected.update((lang, b) for b in langid.trigrams([w])[0].tolist())
    assert got == dict(expected)


def test_mixtures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(0)
    scores, counts = rng.random((30, 3)), rng.integers(1, 9, 30).astype(float)
    shares, kept = langid.mixtures(scores, counts, np.array([0, 7, 20]))
    for i, (a, b) in enumerate(((0, 7), (7, 20), (20, 30))):
        own, size = langid.mixtures(scores[a:b], counts[a:b], np.array([0]))
        assert own[0] == pytest.approx(shares[i]) and size[0] == kept[i]


# Toxicity


BAD = ["grumbol", "snarfit", "blorkus"]


def insulting(rng, is_toxic, n=60, bad=BAD):
    words = prose(rng, n).split()
    for _ in range(4 * is_toxic):
        words[rng.randrange(n)] = rng.choice(bad)
    return " ".join(words)


@pytest.fixture(scope="module")
def toxic_model(spark):
    rng = random.Random(2)
    rows = [(i, insulting(rng, i % 4 == 0)) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(600)] + [(7, 5), (None, 1), (9999, 0)], "doc_id long, toxic int")
    return toxicity.learn(table(spark, rows), labels, sample_rows=400)


def test_toxic_texts_are_told_on_new_texts(spark, toxic_model):
    rng = random.Random(3)
    rows = [(i, insulting(rng, i % 2)) for i in range(100)] + [(200 + i, insulting(rng, 1, bad=["grumboll", "snarfitt", "bloorkus"])) for i in range(40)]
    found = {r.doc_id: r.score for r in toxicity.score(table(spark, rows), toxic_model).collect()}
    assert all((found[i] >= 0.7) == bool(i % 2) for i in range(100))
    clean = np.mean([found[i] for i in range(0, 100, 2)])
    assert np.mean([found[200 + i] for i in range(40)]) > 10 * clean  # unseen misspellings share n-grams


def test_toxicity_of_odd_texts_and_labels(spark, toxic_model):
    found = toxicity.score(table(spark, ODD), toxic_model).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.n_words == 0}) == 1
    no_labels = toxicity.learn(table(spark, ODD), spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.score < 1e-9 for r in toxicity.score(table(spark, ODD), no_labels).collect())
    one_class = toxicity.learn(table(spark, ODD), spark.createDataFrame([(3, 1), (3, 0)], "doc_id long, toxic int"))
    assert all(r.score > 0.999 for r in toxicity.score(table(spark, ODD), one_class).collect())
    assert toxicity.score(table(spark, []), toxic_model).isEmpty()


def test_training_is_the_same_on_every_run(spark, toxic_model):
    texts = [insulting(random.Random(i), i % 2) for i in range(40)]
    labels = np.arange(40) % 2
    one, two = (toxicity.train(texts, labels, np.ones(40)) for _ in range(2))
    assert np.array_equal(one.rows, two.rows) and one.bias == two.bias
    again = toxicity.Model.from_bytes(one.to_bytes())
    assert again.rows == pytest.approx(one.rows, rel=1e-6)


def test_gradient_of_the_rows(monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_USE", 1)
    bags = toxicity.Bags(["one two two", "", "three one"])
    rng = np.random.default_rng(0)
    rows, pull = rng.random(len(bags.used)), rng.random(3)
    gradient = bags.row_gradient(pull)
    for i in range(0, len(rows), 5):
        moved = rows.copy()
        moved[i] += 1e-4
        assert (pull @ (bags.logits(moved) - bags.logits(rows))) / 1e-4 == pytest.approx(gradient[i], rel=1e-4, abs=1e-9)


# Quality


def junk(rng):
    kind = rng.randrange(3)
    words = prose(rng, 80).split()
    return " | ".join(words) if kind == 0 else (words[0] + " ") * 80 if kind == 1 else " ".join(w.upper() + "!!" for w in words)


def test_quality_from_positives_and_unlabelled_text(spark):
    rng = random.Random(5)
    rows = [(i, junk(rng) if i % 4 == 0 else prose(rng, 80)) for i in range(1200)]
    labels = [(i, 1) for i in range(800) if i % 4] + [(0, 0), (4, None)]
    model = quality.learn(table(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert model.prior == pytest.approx(0.75, abs=0.08)
    fresh = [(i, junk(rng) if i % 2 else prose(rng, 80)) for i in range(200)]
    found = {r.doc_id: r.score for r in quality.score(table(spark, fresh), model).collect()}
    assert sum((found[i] >= 0.5) == (i % 2 == 0) for i in range(200)) >= 196
    odd = quality.score(table(spark, ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert len({r.score for r in odd if r.doc_id in {1, 2}}) == 1
    assert quality.score(table(spark, []), model).isEmpty()


def test_no_positive_labels_score_nothing(spark):
    model = quality.learn(table(spark, ODD), spark.createDataFrame([(3, 0)], "doc_id long, quality int"))
    assert all(r.score < 1e-9 for r in quality.score(table(spark, ODD), model).collect())


@pytest.mark.parametrize("share", [0.3, 0.7])
def test_the_prior_is_the_share_of_positives(share):
    rng = np.random.default_rng(1)
    positive = rng.normal(1.5, 1, (1500, 4))
    unlabelled = np.where(rng.random((3000, 1)) < share, rng.normal(1.5, 1, (3000, 4)), rng.normal(-1.5, 1, (3000, 4)))
    assert quality.class_prior(positive, unlabelled) == pytest.approx(share, abs=0.07)


def test_quality_is_fitted_on_all_documents_in_groups(spark):
    """The model is the mean of plain fits of the groups; moments are those of all documents; no repeated row counts twice."""
    rng = random.Random(6)
    texts = [junk(rng) if i % 3 == 0 else prose(rng, 60) for i in range(600)]
    rows = [*enumerate(texts), *[(7, texts[7])] * 50, *[(None, texts[3])] * 40]
    labels = spark.createDataFrame([(i, 1) for i in range(300) if i % 3], "doc_id long, quality int")
    model = quality.learn(table(spark, rows), labels, group_rows=150)
    x = {r: quality.features(r[1].encode(), {}) for r in rows}
    every = np.array(list(x.values()), np.float64)
    assert len(every) == 601
    assert model.mean == pytest.approx(every.mean(0), abs=1e-6) and model.scale == pytest.approx(every.std(0) + 1e-3, abs=1e-6)
    positive = np.array([x[i, texts[i]] for i in range(300) if i % 3])
    hashed = spark.createDataFrame([(i, v.tobytes()) for (i, _), v in x.items()], "doc_id long, x binary")
    groups = {}
    for r in sorted(hashed.selectExpr("doc_id", "x", "pmod(xxhash64(doc_id, x), 4) g").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        groups.setdefault(r.g, []).append(np.frombuffer(bytes(r.x), np.float32))
    fits = [quality.train(positive, np.array(g), model.mean, model.scale) for g in groups.values()]
    assert len(fits) == 4 and model.prior == pytest.approx(np.mean([m.prior for m in fits]), abs=1e-6)
    assert model.weights == pytest.approx(np.mean([m.weights for m in fits], axis=0), abs=1e-4)
    assert model.bias == pytest.approx(np.mean([m.bias for m in fits]), abs=1e-4)


# Archives


PAGES = [
    (3, "http://a/ü b\r\nx", "<p>" + "same " * 40), (1, None, "<p>" + "same " * 40), (2, "http://b", "<p>" + "same " * 40), (4, "u", None),
    (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (8, "u", "ü" * 50), (9, "u", "ü" * 50), (None, "u", "<p>" + "same " * 40),
    (10, "u", "WARC/1.1\r\n\r\nx\r\n\r\n" * 9), (11, "u", "long " * 200_000), (1, None, "<p>" + "same " * 40), (None, None, "alone " * 30),
]


def pages_table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, digest string, payload string")


def test_archives_read_back_what_was_written(spark, monkeypatch):
    bundled = warc.bundles(warc.typed_pages(pages_table(spark, PAGES)))
    found = warc.read_bundles(bundled).collect()
    assert len(found) == len(PAGES)
    text = {r[0]: (r[2] or "").encode() for r in PAGES if r[0] is not None}
    for r in found:
        payload = text[r.page_id] if r.page_id is not None else None
        if payload is not None:
            assert (r.payload_bytes, r.payload_digest) == (len(payload), hashlib.sha256(payload).hexdigest())
            expected = {2: 1, 3: 1, 9: 8}.get(r.page_id)
            assert (r.record_type, r.refers_to) == (("response", None) if expected is None else ("revisit", expected))
            assert (bytes(r.payload) if r.payload is not None else None) == (None if expected else payload)
    assert {r.url for r in found if r.page_id == 3} == {"http://a/ü b\r\nx"} and {r.url for r in found if r.page_id == 1} == {None}
    missing = Counter((r.record_type, r.refers_to) for r in found if r.page_id is None)
    assert missing == {("revisit", 1): 1, ("response", None): 1}
    assert warc.read_bundles(warc.bundles(warc.typed_pages(pages_table(spark, [])))).isEmpty()


def test_single_records_and_files(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"<p>page {i} " + "z" * (i * 997 % 5000)) for i in range(300)]
    bundled = warc.bundles(warc.typed_pages(pages_table(spark, rows)).repartition(2))
    kept = bundled.collect()
    frames = 0
    for b in kept:
        table_ = warc.seek_table(bytes(b.archive))
        frames += len(table_)
        for place in b.records[::37]:
            got = warc.read_record(bytes(b.archive), place.asDict())
            assert f"urn:page:{got['page_id']}" == place.record_id and got["payload"].decode() == rows[got["page_id"]][2]
    assert frames > 2 and sum(len(b.records) for b in kept) == 300
    written = warc.export(bundled, str(tmp_path / "out")).collect()
    assert sum(r.n_records for r in written) == 300
    import zstandard

    for r in written:
        raw = Path(r.path).read_bytes()
        with zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True) as plain:
            assert plain.read().count(b"WARC/1.1\r\n") == r.n_records


# Queries and pipeline


def test_queries_cover_their_tables(spark):
    n = duckdb.sql(f"SELECT count(*) FROM '{SF}/documents.parquet'").fetchall()[0][0]
    pages = duckdb.sql(f"SELECT count(*) FROM '{SF}/pages.parquet'").fetchall()[0][0]
    for name in ("op3_toxicity", "op8_quality", "op10_language", "op7_warc"):
        rows = queries.QUERIES[name](spark, SF).collect()
        assert len(rows) == (pages if name == "op7_warc" else n), name
        if name != "op7_warc":
            folds, held = (5, 0) if name == "op10_language" else (3, 1)
            assert all(r.held_out == (fold_of(r.doc_id, folds) == held) and 0 <= r.score <= 1 for r in rows)


def test_held_out_languages_and_quality(spark):
    known = {r[0]: r[1:] for r in duckdb.sql(
        f"SELECT doc_id, lang, quality FROM '{LARGER}/documents.parquet' LEFT JOIN '{LARGER}/labels.parquet' USING (doc_id)").fetchall()}
    found = [r for r in queries.QUERIES["op10_language"](spark, LARGER).collect() if r.held_out]
    assert np.mean([r.lang_pred == known[r.doc_id][0] for r in found]) > 0.95
    found = [r for r in queries.QUERIES["op8_quality"](spark, LARGER).collect() if r.held_out and known[r.doc_id][1] is not None]
    assert np.mean([r.predicted == known[r.doc_id][1] for r in found]) > 0.95


def plain_pipeline(rows, items):
    """The stages in plain Python: text by id."""
    texts = {i: t for i, t in rows.items() if any(map(str.isalpha, t or ""))}
    ids = sorted(texts)
    roots = plain_components([plain_fingerprint(texts[i]) for i in ids], 2)
    texts = {ids[r]: texts[ids[r]] for r in set(roots)}
    texts = {i: kept[3].decode("utf-8", "ignore") for i, kept in plain_substring_dedup(list(texts.items()), 100).items()}
    hits = plain_hits(list(texts.items()), items, 10)
    return {i: t for i, t in texts.items() if not hits[i][1]}


def test_pipeline_equals_the_plain_stages(spark):
    rows = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    library = Tokenizer.from_file(queries.vocabulary_path())
    found = corpus_pipeline.run(spark, SF).collect()
    expected = plain_pipeline(rows, items)
    assert len(found) == len(expected) < len(rows)
    for r in found:
        ids = library.encode(expected[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_rows_and_empty_tables(spark, number):
    name, stage = corpus_pipeline.STAGES[number]
    rng = random.Random(9)
    prose_row = prose(rng, 50)
    rows = [*ODD, (7, prose_row), (8, prose_row), (9, prose_row + " é" * 60), (9, prose_row + " é" * 60), (None, None)]
    docs = table(spark, rows).withColumn("lang", F.when(F.col("doc_id") > 4, "en"))
    out = stage(spark, docs, SF)
    got = out.collect()
    if number + 1 < len(corpus_pipeline.STAGES):
        assert out.columns == docs.columns and out.schema["text"].dataType == docs.schema["text"].dataType
    kept = Counter(r.doc_id for r in got)
    if name == "language":
        assert kept == {None: 1, 5: 1, 6: 1, 7: 1, 8: 1, 9: 2}
    elif name == "near_duplicates":
        assert kept[7] == 1 and kept[8] == 0 and kept[9] == 1 and kept[4] == 1
    elif name == "repeated_strings":
        assert kept == Counter(r[0] for r in rows)
        assert all(r.n_chars == len(r.text) for r in got if r.text is not None)
        assert {r.doc_id: r.text for r in got}[8] == "" or len({r.doc_id: r.text for r in got}[8]) < len(prose_row)
    else:
        assert kept == Counter(r[0] for r in rows)
    assert stage(spark, docs.limit(0), SF).isEmpty()


def test_the_last_stage_gives_tokens_and_all_others_documents():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "repeated_strings", "decontaminate", "tokenize"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_language_stage_keeps_clean_documents_if_no_language_is_named(spark):
    rows = [(1, "plain words", None), (2, "日本語", None), (3, "123 - 45", None), (4, None, None), (5, "", None), (None, "no id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.language(spark, docs, SF).collect()
    assert sorted((r.text, r.doc_id) for r in kept) == [("no id", None), ("plain words", 1), ("日本語", 2)]
