"""The pipeline against a brute-force version, on a small fixture."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from fimloom.llm import quality, queries

from .conftest import DE, EN, words
from .test_dedup import brute_components, brute_fingerprint
from .test_filters import brute_counts

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    rows = []
    for i in range(150):
        of, lang = ((EN, "en"), (DE, "de"))[i % 2]
        rows.append([i, words(rng, of, rng.randint(60, 400)), lang])
    rows += [[200 + i, rows[4][1], "en"] for i in range(20)]                              # exact copies
    base = words(rng, EN, 5000)
    rows += [[300, base, "en"], [301, base + " more", "en"], [302, "one " + base, "en"]]       # near copies
    rows += [[400, None, "en"], [401, "", "de"], [402, "12 34 !", None], [403, "too short", "en"], [404, "again and again " * 60, "en"],
             [405, " ".join(w + "***" for w in words(rng, EN, 90).split()), "en"], [None, words(rng, DE, 80), "de"]]
    path = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame([(*r, "s", len(r[1] or "")) for r in rows], COLUMNS).repartition(4).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(150)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows


def test_stages_and_run(spark, corpus):
    path, rows = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    left = rows
    after = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, path), "test-stage")
        assert docs.schema.simpleString() == spark.createDataFrame([], COLUMNS).schema.simpleString()
        after[name] = sorted((r["doc_id"] for r in docs.collect()), key=str)

    left = [r for r in left if any(map(str.isalpha, r[1] or ""))]
    assert after["language_id"] == sorted((r[0] for r in left), key=str)
    left = [r for r in left if brute_counts(r[1])[0] >= 50 and 100 * brute_counts(r[1])[4] <= 50 * brute_counts(r[1])[0]]
    assert after["quality_rules"] == sorted((r[0] for r in left), key=str)                 # too few labels for thresholds
    least = {}
    for r in sorted(left, key=lambda r: (r[0] is None, r[0])):
        least.setdefault(r[1], r)
    left = list(least.values())
    assert after["exact_dedup"] == sorted((r[0] for r in left), key=str)
    of = brute_components([brute_fingerprint(r[1], 3) for r in left], 2)
    least = {}
    for r in sorted(left, key=lambda r: (r[0] is None, r[0])):
        least.setdefault(of[brute_fingerprint(r[1], 3)], r)
    left = list(least.values())
    assert after["simhash_near_dedup"] == sorted((r[0] for r in left), key=str)

    library = Tokenizer.from_file(queries.vocabulary())
    got = defaultdict(int)
    for r in corpus_pipeline.run(spark, path).collect():
        got[r["doc_id"]] += r["length"]
    assert got == {r[0]: len(library.encode(r[1], add_special_tokens=False).ids) + 1 for r in left}


def test_thresholds_reject_in_the_stage(spark, corpus, monkeypatch):
    path, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    monkeypatch.setattr(quality, "thresholds", lambda *a, **k: {"*": {"symbol_rate": 0.5}})
    kept = {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, path).collect()}
    assert 405 not in kept and set(range(150)) <= kept


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
