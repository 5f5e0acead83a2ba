from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from fimloom.llm import exact_dedup, simhash


def brute_groups(rows, keep):
    groups = defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (max if keep == "largest" else min)(known) if known else None
        out += [(i, best, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(odd, odd_rows, keep, weak):
    """A weak hash puts different texts under one hash: comparing bytes must part them."""
    hash128 = (lambda t: F.substring(F.md5(t), 1, 1)) if weak else exact_dedup.md5_128
    got = exact_dedup.exact_groups(odd, keep=keep, hash128=hash128).collect()
    assert sorted([(r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got], key=str) == brute_groups(odd_rows, keep)
    kept = defaultdict(list)
    for r in got:
        if r["kept"]:
            kept[r["text_sha256"]].append((r["doc_id"], r["keep_id"]))
    assert len(kept) == len({r["text"] or "" for r in odd_rows})
    assert all(len(x) == 1 and x[0][0] == x[0][1] for x in kept.values())


def test_drop_copies(odd, odd_rows):
    got = exact_dedup.drop_copies(odd)
    assert got.columns == odd.columns
    texts = [r["text"] or "" for r in got.collect()]
    assert len(texts) == len(set(texts)) and set(texts) == {r["text"] or "" for r in odd_rows}


def brute_fingerprint(text, k):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(values, max_bits):
    values = sorted(set(values))
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(values):
        for y in values[:i]:
            if (x ^ y).bit_count() <= max_bits:
                root[max(find(x), find(y))] = min(find(x), find(y))
    return {v: find(v) for v in values}


@pytest.mark.parametrize("shingle", [3, 1])
def test_near_duplicates(odd, odd_rows, shingle):
    got = sorted([(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(odd, shingle, 2).collect()], key=str)
    prints = [(r["doc_id"], brute_fingerprint(r["text"], shingle)) for r in odd_rows]
    of = brute_components([f for _, f in prints], 2)
    least = defaultdict(list)
    for i, f in prints:
        least[of[f]] += [] if i is None else [i]
    want = sorted([(i, f"{f:016x}", min(least[of[f]], default=None)) for i, f in prints], key=str)
    assert got == want
    assert shingle != 3 or len(set(of.values())) < len(of)            # some different fingerprints are linked


@pytest.mark.parametrize("max_bits", [0, 1, 2])
@pytest.mark.parametrize("pair_limit", [1, 4, 64])
def test_links_of_dense_fingerprints(spark, max_bits, pair_limit):
    """Chains and balls around a few centres, and far ones: pairs and shared pivots give the same components."""
    rng = random.Random(7)
    values = {rng.getrandbits(64) for _ in range(150)}
    for _ in range(3):
        x = rng.getrandbits(64)
        for _ in range(50):
            values.add(x)
            y = x
            for b in rng.sample(range(64), rng.randint(1, 3)):
                y ^= 1 << b
            values.add(y)
            x = y if rng.random() < 0.3 else x
    df = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long")
    got = {r["node"] % 2 ** 64: r["root"] % 2 ** 64 for r in simhash.components(simhash.links(df, max_bits, pair_limit)).collect()}
    want = brute_components(values, max_bits)
    mine, theirs = defaultdict(set), defaultdict(set)
    for v in values:
        mine[got.get(v, v)].add(v)
        theirs[want[v]].add(v)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_pivots_tell_the_bits():
    """The coordinates of a block (less the distance to zero) differ for any two values of its bits."""
    block = simhash.pivots()[1]
    bits = np.arange(1 << 16, dtype=np.uint64) << np.uint64(16)
    table = np.stack([np.bitwise_count(bits ^ np.uint64(p)).astype(int) - np.bitwise_count(bits) for p in block], axis=1)
    assert len(np.unique(table, axis=0)) == 1 << 16


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 200) if i % 50] + [(7, 7)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert all(root == (node - 1) // 50 * 50 + 1 for node, root in got.items() if node % 50 != 0) and len(got) == 200 - 4


def test_drop_near_copies(odd, odd_rows):
    got = simhash.drop_near_copies(odd)
    assert got.columns == odd.columns
    prints = [brute_fingerprint(r["text"], 3) for r in odd_rows]
    of = brute_components(prints, 2)
    kept = [of[brute_fingerprint(r["text"], 3)] for r in got.collect()]
    assert sorted(kept) == sorted(set(of.values()))


def test_empty_tables(empty):
    assert exact_dedup.exact_groups(empty).collect() == []
    assert exact_dedup.drop_copies(empty).collect() == []
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.drop_near_copies(empty).collect() == []
