from __future__ import annotations

import hashlib
import random
import subprocess
import sys
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fimloom.llm import bpe, packing
from fimloom.llm.common import ROOT

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def as_bytes(ids) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


ALPHABET = ["a", "b", "the", " ", "  ", "    ", "\n", "\t", "\x1c", "\xa0", "'s", "'ll", "é", "ß", "日本", "²", "½", "_", "1", "23", "!", "...",
            "<|endoftext|>", "😀", "Ⅷ", "λ", "Ж", "Zürich", "qzx", "aaaaaaaaaaaaaaa"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.one_of(st.sampled_from(ALPHABET), st.text(max_size=3)), max_size=25).map("".join), max_size=6))
def test_encode_equals_library(texts):
    own, lib = bpe.load(PATH), Tokenizer.from_file(PATH) if not hasattr(test_encode_equals_library, "lib") else test_encode_equals_library.lib
    test_encode_equals_library.lib = lib
    for enc in (own, packing.load(PATH)):
        got = enc.encode(texts)
        want = [x.ids for x in lib.encode_batch(texts, add_special_tokens=False)] if texts else []
        assert got == [as_bytes(x) for x in want]
        assert [enc.decode(x) for x in got] == [lib.decode(x, skip_special_tokens=False) for x in want]


def test_pair_check_equals_merging():
    """A pair is compatible exactly when merging the two tokens' bytes gives the two tokens back."""
    b, rng = bpe.load(PATH), random.Random(3)
    tokens = [i for t, i in b.vocab.items() if len(t) <= 12]
    pairs = [(rng.choice(tokens), rng.choice(tokens)) for _ in range(4000)]
    # pairs that a cut inside a token gives often clash
    for t in rng.sample(tokens, 2000):
        raw = b.bytes_of[t]
        k = rng.randint(1, len(raw))
        if raw[:k] in b.vocab and raw[k:] in b.vocab:
            pairs.append((b.vocab[raw[:k]], b.vocab[raw[k:]]))
    good = b.compatible(np.array([x * b.size + y for x, y in pairs], dtype=np.int64))
    assert good.tolist() == [b.merge(b.bytes_of[x] + b.bytes_of[y]) == [x, y] for x, y in pairs]
    assert 0 < good.sum() < len(pairs)


def test_round_trip_digests(odd, odd_rows, library):
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.round_trip_digests(odd, PATH).collect()}
    want = set()
    for r in odd_rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        want.add((r["doc_id"], len(ids), hashlib.sha256(as_bytes(ids)).hexdigest(),
                  hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert got == want


def test_encode_then_decode_documents(odd, odd_rows):
    back = bpe.decode_documents(bpe.encode_documents(odd, PATH), PATH)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted([(r["doc_id"], r["text"]) for r in back.collect()], key=key) == sorted([(r["doc_id"], r["text"] or "") for r in odd_rows], key=key)


def test_small_caches_change_nothing(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    b, rng = bpe.Bpe(PATH), random.Random(1)
    for _ in range(30):
        texts = [" ".join("".join(rng.choice("abcde") for _ in range(rng.randint(1, 9))) for _ in range(8)) for _ in range(4)]
        assert b.encode(texts) == [as_bytes(x.ids) for x in library.encode_batch(texts, add_special_tokens=False)]


WORKER = """
import random, resource, sys
from fimloom.llm import bpe, packing
b, rng = packing.LibraryIds(sys.argv[1]), random.Random(4)
words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 8))) for _ in range(400_000)]
start = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
for _ in range(5):
    part = " ".join(rng.choices(words, k=bpe.ENCODED_AT_ONCE // 6))
    assert sum(map(len, b.encode([part[i:i + 3000] for i in range(0, len(part), 3000)])))
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - start) // 1024)
"""


def test_memory_of_a_worker_is_bounded():
    """Slices and caches of one worker take less than 350 MB beside its tables, however much it has encoded."""
    run = subprocess.run([sys.executable, "-c", WORKER, PATH], capture_output=True, text=True, timeout=300, check=True, cwd=ROOT)
    assert int(run.stdout) < 350


@pytest.mark.parametrize("group_tokens", [1 << 21, 2000])
def test_pack_holds_every_token_once(odd, odd_rows, library, group_tokens):
    capacity = 256
    rows = packing.pack(odd, PATH, capacity=capacity, group_tokens=group_tokens).collect()
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append(r)
        by_doc[r["doc_id"]].append(r)
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= capacity
    total = sum(r["length"] for r in rows)
    want = defaultdict(list)
    for r in odd_rows:
        want[r["doc_id"]].append([*library.encode(r["text"] or "", add_special_tokens=False).ids, 0])
    assert total == sum(len(x) for xs in want.values() for x in xs)
    assert set(by_doc) == set(want)
    for i, docs in want.items():
        if len(docs) > 1:       # repeated ids: each is a document of its own
            assert sum(r["length"] for r in by_doc[i]) == sum(map(len, docs))
            continue
        ids, at = docs[0], 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(as_bytes(ids[at:at + r["length"]]))
            at += r["length"]
        assert at == len(ids)
    if group_tokens > total:
        assert len(sequences) == -(-total // capacity)


def test_balance_takes_the_cheapest_sequence_with_room():
    lengths = np.array([9, 8, 3, 3, 2, 1])
    pieces = packing.balance(lengths, 13, 4)
    fill, cost = [0, 0], [0.0, 0.0]
    for (i, start, n, s, offset), length in zip(pieces, lengths):
        room = [k for k in (0, 1) if fill[k] + length <= 13]
        assert (start, n, offset) == (0, length, fill[s]) and s == min(room, key=lambda k: (cost[k], k))
        fill[s] += n
        cost[s] += n + n * n / 4
    assert packing.balance(np.array([7, 7, 7]), 10, 4)[2:] == [(2, 0, 7, 2, 0)]
    assert sorted(x[2] for x in packing.balance(np.array([7, 7, 6]), 10, 4)) == [3, 3, 7, 7]


def test_empty_tables(empty):
    assert bpe.round_trip_digests(empty, PATH).collect() == []
    assert packing.pack(empty, PATH).collect() == []
