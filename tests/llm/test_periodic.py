from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from fimloom.llm import periodic, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """(start, length, period) of all runs, by start, then period."""
    out = []
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q) and not any(all(w[k] == w[k + r] for k in range(i, j + q - r)) for r in range(1, q)):
                out.append((i, j + q - i, q))
            i = max(i + 1, j)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def made_up(rng):
    letters = rng.choice(["a", "ab", "ab", "abc", "abcde", "abcdefghijklmnopqrstuvwxyz"])
    w = [rng.choice(letters) for _ in range(rng.randint(0, 120))]
    for _ in range(rng.randint(0, 3)):
        u = [rng.choice("abc") for _ in range(rng.randint(1, 15))]
        at = rng.randint(0, len(w))
        w[at:at] = (u * rng.randint(2, 9))[:rng.randint(1, 130)]
    return w


@pytest.mark.parametrize("seed", range(8))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(25):
        texts = [made_up(rng) for _ in range(rng.randint(1, 9))]
        got, _ = periodic.find_runs([" ".join(t) for t in texts])
        assert [[(s, e - s, q) for s, e, q in g.tolist()] for g in got] == [brute(t) for t in texts]


def words_of_fibonacci(n):
    a, b = ["a"], ["a", "b"]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def test_runs_of_special_words():
    nested = (["x"] * 7 + ["y"]) * 9
    for w in (words_of_fibonacci(600), ["w"] * 500, ["w"] * 5, ["w"] * 6, nested, nested + ["x"] * 40, ["a", "b"] * 3, ["a", "b"] * 4, ["a", "b"] * 4 + ["a"]):
        got, _ = periodic.find_runs([" ".join(w)])
        assert [(s, e - s, q) for s, e, q in got[0].tolist()] == brute(w)


def test_long_periods_cross_split_transforms():
    rng = np.random.RandomState(3)
    for q in (300, 511, 512, 513, 1000, 2500):
        w = rng.randint(0, 50, 4 * q + 3000)
        w[700:700 + 4 * q + 5] = np.resize(w[700:700 + q], 4 * q + 5)
        got, _ = periodic.find_runs([" ".join(map(str, w))])
        (s, e, p), = [r for r in got[0].tolist() if r[2] > 20]
        assert p == q and s <= 700 and e >= 700 + 4 * q + 5


def test_transform_is_a_convolution():
    rng = np.random.RandomState(1)
    for n in (2, 64, 512, 1024, 4096):
        x = rng.randint(0, periodic.PRIME, (2, n)).astype(float)
        product = periodic.transform(periodic.residues(periodic.transform(x[:1]) * periodic.transform(x[1:])), inverse=True) % periodic.PRIME
        product = product.astype(np.int64)[0] * pow(n, periodic.PRIME - 2, periodic.PRIME) % periodic.PRIME
        a, b = x.astype(object)
        for i in (0, 1, n - 1, n // 2):
            assert product[i] == int(sum(a[j] * b[(i - j) % n] for j in range(n))) % periodic.PRIME


def test_blocks_beyond_the_largest_transform(monkeypatch):
    rng = np.random.RandomState(2)
    w = rng.randint(0, 30, 3000)
    w[300:2300] = np.resize(w[300:700], 2000)
    before = [r.tolist() for r in periodic.find_runs([" ".join(map(str, w))])[0]]
    monkeypatch.setattr(periodic, "LARGEST", 128)
    assert [r.tolist() for r in periodic.find_runs([" ".join(map(str, w))])[0]] == before and before[0][-1][2] == 400


def test_sums_that_vanish_modulo_the_prime_are_no_runs():
    codes = np.array([0, periodic.PRIME] * 6 + [3, 3 + periodic.PRIME, 3, 3 + 2 * periodic.PRIME] * 4, np.int64)
    got = periodic.runs_of(codes, len(codes))
    assert sorted((s, e - s, q) for s, e, q in got.tolist()) == sorted(brute(codes.tolist()))


def test_a_long_text():
    unit = " ".join(f"w{i}" for i in range(700))
    text = "head " * 3 + f"{unit} " * 200 + "tail"
    (runs,), (words,) = periodic.find_runs([text])
    assert [tuple(r) for r in runs.tolist()] == [(3, 3 + 140000, 700)]
    assert periodic.collapsed(words, runs) == "head head head " + unit + " tail"


def expected(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(brute_collapse(w, runs)))


def test_query_equals_brute_force(spark, odd, empty, tmp_path):
    rng = random.Random(9)
    rows = [(1000 + i, " ".join(made_up(rng))) for i in range(150)] + [(1500, "a\x1cb " * 9), (1501, "\x0b\x0ca \t b\r\n" * 9), (1502, "𝒳 é " * 8)]
    short = odd.where("length(text) < 3000 OR text IS NULL").select("doc_id", "text")
    df = spark.createDataFrame(rows, "doc_id long, text string").unionByName(short)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_periodic_runs(spark, str(tmp_path)).collect()
    want = [expected(r["doc_id"], r["text"]) for r in df.collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sum(r["n_runs"] > 0 for r in got) > 50 and any(zlib.crc32(str(r["doc_id"]).encode()) % 10 == 0 for r in got)
    assert periodic.periodic_runs(empty).collect() == []


def test_operator_returns_runs_and_texts(spark, odd):
    got = periodic.periodic_runs(odd).collect()
    assert len(got) == odd.count()
    whole = [r for r in got if r["collapsed"] == "word"]
    assert whole and [tuple(x) for x in whole[0]["runs"]] == [(0, 300, 1)] and whole[0]["n_words"] == 300
    best = spark.createDataFrame([([(0, 8, 2), (3, 12, 3), (9, 13, 3), (9, 26, 6)],), ([],)], f"runs {periodic.RUNS}").select(
        periodic.strongest(F.col("runs")).alias("b")).collect()
    assert tuple(best[0]["b"]) == (9, 13, 3) and best[1]["b"] is None
