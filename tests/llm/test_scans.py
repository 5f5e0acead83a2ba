from __future__ import annotations

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fimloom.llm import hmm_lm, license_scan, sharding

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_base(text):
    words = WORD.findall(lower(text))
    places, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = [
    "Released under the MIT License.\nMIT license again; CC-BY", "GNU General Public License v3, gnu  general\tpublic\nlicense", "cc by cc by cc",
    "Licensed under CC BY-NC 4.0.", "mit éLicense mit license", "K mit\u212alicense", "apache", "the apache license" * 2, "İ apache license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and the associated documentation files",
    "Permission is hereby granted free of any charge to a person obtaining copy of this software",
    "redistribution and use " * 5, "GNU Lesser General Public License", "x " * 3000 + "mozilla public license",
]


def test_base_scan_equals_brute_force(spark, odd, odd_rows):
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    rows = [(r["doc_id"], r["text"]) for r in odd_rows] + [(1000 + i, t) for i, t in enumerate(TEXTS)]
    got = license_scan.scan(odd).collect() + license_scan.scan(more).collect()
    key = lambda x: str(x)
    assert sorted([(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got], key=key) \
        == sorted([(i, *brute_base(t)) for i, t in rows], key=key)
    for r in got:
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert r["labels"] == ",".join(sorted(set(filter(None, r["labels"].split(",")))))


def test_templates_are_found_with_changes(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.scan(df).collect()}
    assert got[3]["labels"] == "cc-by,cc-by-nc"
    assert got[9]["labels"] == "mit" and 0.75 <= got[9]["score"] < 1          # a word put in: two diagonals, one span
    assert got[10]["labels"] == ""                                             # too little is left
    assert got[11]["labels"] == "" and got[12]["labels"] == "lgpl" and got[13]["labels"] == "mpl"


def test_templates_that_repeat_close_together(spark):
    texts = {"BSD License / BSD License": "bsd", "Mozilla Public License (Mozilla Public License)": "mpl", "CC BY-SA, CC BY-SA": "cc-by,cc-by-sa",
             "CC BY-NC, CC BY-NC": "cc-by,cc-by-nc", "BSD License\n" * 1000: "bsd"}
    got = license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in got} == {i: (x, 1.0) for i, x in enumerate(texts.values())}


def test_sql_finds_templates_that_repeat_close_together(spark, tmp_path):
    import duckdb

    from fimloom.llm import sql
    texts = ["BSD License / BSD License", "Mozilla Public License (Mozilla Public License)", "CC BY-SA, CC BY-SA", "CC BY-NC, CC BY-NC", None, "", *TEXTS]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = license_scan.scan(df)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({sql.license_scan()})").fetchall()
    norm = lambda rows: sorted([(*x[:-1], round(x[-1], 9)) for x in map(tuple, rows)])
    assert norm(got.collect()) == norm(want)


def test_license_words_only_run_together_in_order(spark):
    whole = license_scan.TEMPLATES["bsd"][0]
    turned = " ".join(reversed(whole.split()))
    df = spark.createDataFrame([(0, whole), (1, turned), (2, "lead " * 7 + whole.upper().replace(" ", ", ") + " tail")], "doc_id long, text string")
    assert {r["doc_id"]: r["labels"] for r in license_scan.scan(df).collect()} == {0: "bsd", 1: "", 2: "bsd"}


# ---------------------------------------------------------------- sharding

def brute_shard(key, weights):
    def score(s):
        u = (int(hashlib.md5(f"{s}|{key}".encode()).hexdigest()[:13], 16) + 0.5) / 2 ** 52
        return weights[s] / -math.log(u)
    return max(range(len(weights)), key=lambda s: (score(s), -s))


def test_sharding_equals_brute_force(odd, odd_rows):
    weights = [1.0, 2.0, 0.5, 1.0]
    got = sharding.shard(odd, weights, [*weights, 1.5], buckets=4).collect()
    key = lambda x: str(x)
    name = lambda i: "null" if i is None else str(i)
    want = [(r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode()), brute_shard(name(r["doc_id"]), weights),
             brute_shard(name(r["doc_id"]), [*weights, 1.5])) for r in odd_rows]
    assert sorted([(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["grown_shard"]) for r in got], key=key) == sorted(want, key=key)
    slots = defaultdict(list)
    for r in got:
        assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 4)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_shards_follow_their_weights(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    weights = [1.0, 3.0, 2.0]
    n = Counter(r["shard"] for r in sharding.shard(df, weights).select("shard").collect())
    assert all(abs(n[s] / 20000 - w / 6) < 0.015 for s, w in enumerate(weights))


def test_a_third_of_the_rows_are_equal(spark):
    """A hot group of equal rows is split by salt, and its slots are still those of the whole order."""
    same = spark.range(2000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("copy").alias("text"))
    none = spark.range(500).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    df = spark.range(3500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text")).unionByName(same).unionByName(none)
    out = sharding.shard(df.repartition(4), [1.0] * 4)
    rows = out.collect()
    assert len(rows) == 6000
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r["shard"]].append(r)
    for part in by_shard.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
        hot = sorted(r["slot"] for r in part if r["doc_id"] == 7 and r["size"] == 5)
        assert not hot or hot == list(range(hot[0], hot[0] + 2000))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert all("salt" in x for x in re.findall(r"Window \[row_number[^\n]*", plan))


def test_weights_must_be_positive(odd):
    for bad in ([], [1.0, 0.0]):
        with pytest.raises(ValueError):
            sharding.shard(odd, bad)


# ---------------------------------------------------------------- language model

def tiny(states=3):
    return hmm_lm.Parameters([(b"a", 5), (b"bb", 3), (b"c", 1)], 12, 4, 3, np.ones(16), np.ones(16), states, 2)


def path_probability(p, row, z):
    q = p.start[z[0]] * p.emit[z[0], row[0]]
    for i in range(1, len(row)):
        q *= p.move[z[i - 1], z[i]] * p.emit[z[i], row[i]]
    return q


def test_forward_and_counts_equal_all_paths():
    p, rng = tiny(), np.random.default_rng(0)
    rows = [rng.integers(0, p.size, n) for n in (5, 1, 4, 3, 5, 2)]
    start, move, emit, logs = np.zeros(3), np.zeros((3, 3)), np.zeros((3, p.size)), []
    for r in rows:
        paths = {z: path_probability(p, r, z) for z in itertools.product(range(3), repeat=len(r))}
        total = sum(paths.values())
        logs.append(math.log(total))
        for z, q in paths.items():
            start[z[0]] += q / total
            for i, s in enumerate(z):
                emit[s, r[i]] += q / total
                if i:
                    move[z[i - 1], s] += q / total
    assert np.allclose(hmm_lm.forward(p, rows), logs)
    got = hmm_lm.forward(p, rows, keep=True)
    for a, b in zip(got, (logs, start, move, emit)):
        assert np.allclose(a, b)


def test_rounds_raise_the_likelihood(spark, odd):
    """Baum-Welch over partitions raises the likelihood of what it is trained on."""
    counts = hmm_lm.word_counts(odd).cache()
    total = [hmm_lm.score(odd, hmm_lm.train(odd, counts, states=3, symbols=30, rounds=r), counts).agg(F.sum("score")).first()[0] for r in (0, 1, 4)]
    assert total[0] < total[1] < total[2]


def test_training_beats_the_unigram(spark):
    """Trained until it settles, the model gains over 0.4 ln a token (one state: the unigram over the same symbols)."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = hmm_lm.word_counts(docs).cache()
    six, one = (hmm_lm.score(docs, hmm_lm.train(docs, counts, states=k), counts).agg(F.sum("score") / F.sum("n_tokens")).first()[0] * math.log(10)
                for k in (hmm_lm.STATES, 1))
    assert six > one + 0.4


def test_scores_equal_brute_force(spark, odd, odd_rows):
    """Base scores by hand, and the model's by one long forward pass per text, for a small head."""
    learn = hmm_lm.training_rows(odd)
    counts = hmm_lm.word_counts(learn).cache()
    p = hmm_lm.train(learn, counts, states=3, symbols=10, rounds=1, head=20)
    c = Counter()
    ends = 0
    for r in odd_rows:
        if r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1:
            c.update((r["text"] or "").encode().lower().split())
            ends += 1
    n, v = sum(c.values()) + ends, len(c) + 1
    want = []
    for r in odd_rows:
        words = (r["text"] or "").encode().lower().split()
        base = sum(math.log10((k + 0.5) / (n + 0.5 * (v + 1))) for k in [c[w] for w in words] + [ends])
        alpha, model = p.start, 0.0
        ids = [p.symbol[w] if w in p.symbol else p.first_class + min(len(w), 16) - 1 for w in words] + [p.end]
        for t, s in enumerate(ids):
            alpha = (alpha @ p.move if t else alpha) * p.emit[:, s]
            model += math.log10(alpha.sum())
            alpha = alpha / alpha.sum()
        others = [w for w in c if w not in p.symbol]
        for w in words:
            if w not in p.symbol:
                same = [x for x in others if min(len(x), 16) == min(len(w), 16)]
                model += math.log10((c[w] + 0.5) / (sum(c[x] for x in same) + 0.5 * (len(same) + 1)))
        want.append((r["doc_id"], len(words) + 1, sum(c[w] > 0 for w in words) + 1, n, base, model))
    got = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in hmm_lm.score(odd, p, counts).collect()]
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[4])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9) and math.isclose(a[5], b[5], rel_tol=1e-9)


def test_words_equal_pythons_split():
    texts = [None, "", " ", "\x1f a\x0bB\x0c\u00a0b\r\n\u2003 \u00c9\u212a ", "x", "A\x00a  a\tA\u0085", "\n\nz " * 5]
    n, codes, different = hmm_lm.words_of(pa.array(texts))
    want = [(t or "").encode().lower().split() for t in texts]
    assert n.tolist() == [len(w) for w in want]
    assert [different[i].as_py() for i in codes.tolist()] == [x for w in want for x in w]
    assert hmm_lm.words_of(pa.array([None, "  "], pa.string()))[0].tolist() == [0, 0]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_of_part_of_a_batch(kind):
    """A large Arrow batch is worked on in slices: the words of each are its own, without null texts too."""
    texts = ["First text ", "the  Second", "", "third\tONE  \u00c9", "x"]
    for i, k in itertools.combinations(range(len(texts) + 1), 2):
        n, codes, different = hmm_lm.words_of(pa.array(texts, kind).slice(i, k - i))
        want = [t.encode().lower().split() for t in texts[i:k]]
        assert n.tolist() == [len(w) for w in want]
        assert [different[c].as_py() for c in codes.tolist()] == [x for w in want for x in w]


def test_base_scores_of_batches_in_slices(spark):
    """Exact columns over an Arrow batch of more bytes than a task works on at once, none of its texts null."""
    rows = [(i, " ".join(f"w{i * j % 11}" + "x" * 200_000 * (j == 3) for j in range(1, 9))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    counts = Counter(w for _, t in rows for w in t.split())
    total = sum(counts.values()) + len(rows)
    found = {bytes(r["word"]).decode(): r["c"] for r in hmm_lm.word_counts(docs).collect()}
    assert found == counts
    model = hmm_lm.train(docs, hmm_lm.word_counts(docs), states=2, symbols=3, rounds=1, head=5)
    got = {r["doc_id"]: r for r in hmm_lm.score(docs, model, hmm_lm.word_counts(docs)).collect()}
    for i, t in rows:
        c = [counts[w] for w in t.split()] + [len(rows)]
        want = sum(math.log10((x + 0.5) / (total + 0.5 * (len(counts) + 2))) for x in c)
        assert (got[i]["n_tokens"], got[i]["n_known"], got[i]["train_tokens"]) == (len(c), len(c), total)
        assert got[i]["base_score"] == pytest.approx(want, rel=1e-12)


def test_blocks_of_steps_change_nothing(monkeypatch):
    """A long row is scored block by block of its steps, with the likelihood of one pass."""
    p, rng = tiny(), np.random.default_rng(1)
    rows = [rng.integers(0, p.size, n).astype("<u2") for n in (3000, 1, 700, 700, 2)]
    whole = hmm_lm.forward(p, rows)
    monkeypatch.setattr(hmm_lm, "BLOCK_TOKENS", 97)
    assert np.allclose(hmm_lm.forward(p, rows), whole, rtol=1e-12)
    assert np.allclose(whole, hmm_lm.forward(p, rows, keep=True)[0], rtol=1e-12)


def test_a_frequent_long_word_is_in_the_head(spark):
    """A word over HEAD_BYTES is no join key if it is frequent; longer ones than LONG_BYTES are joined."""
    long, longest = "u" * 100, "v" * (hmm_lm.LONG_BYTES + 1)
    docs = spark.createDataFrame([(i, f"{long} {longest} w{i}") for i in range(10)], "doc_id int, text string")
    counts = hmm_lm.word_counts(docs).cache()
    p = hmm_lm.train(docs, counts, states=2, symbols=1, rounds=1, head=3)
    assert long.encode() in p.words.to_pylist() and longest.encode() not in p.words.to_pylist()
    assert {r["n_known"] for r in hmm_lm.score(docs, p, counts).collect()} == {4}


def test_frequent_words(spark):
    """All words down to a bound, never more than asked for, whatever ties there are."""
    rows = [(f"w{i}", c) for i, c in enumerate([1] * 50 + [2] * 10 + [3, 3, 4096, 4097, 1 << 40])]
    counts = spark.createDataFrame(rows, "word string, c long")
    got = {most: sorted(r["c"] for r in hmm_lm.frequent(counts, most).collect()) for most in (0, 1, 2, 4, 5, 14, 15, 64, 65)}
    every = sorted(c for _, c in rows)
    assert {k: len(v) for k, v in got.items()} == {0: 0, 1: 1, 2: 1, 4: 3, 5: 5, 14: 5, 15: 15, 64: 15, 65: 65}
    assert all(v == every[len(every) - len(v):] for v in got.values())


def test_a_model_sums_to_one():
    """All texts of up to a few symbols and the end: with the end absorbing, probabilities add up."""
    p = tiny()
    one = np.exp(hmm_lm.forward(p, [np.array(x) for x in itertools.product(range(p.size), repeat=2)])).sum()
    assert math.isclose(one, 1.0, rel_tol=1e-9)


def test_empty_tables(empty, odd):
    assert license_scan.scan(empty).collect() == []
    assert sharding.shard(empty, [1.0, 1.0]).collect() == []
    counts = hmm_lm.word_counts(empty)
    p = hmm_lm.train(empty, counts)
    assert hmm_lm.score(empty, p, counts).collect() == []
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in hmm_lm.score(odd, p, counts).collect())
