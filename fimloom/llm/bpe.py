"""Byte-level BPE encoding and decoding by speculation and verification.

Greedy longest match proposes the tokens of a word.  A proposal is the BPE encoding exactly when no
two neighbouring tokens would have merged across their border, so all neighbouring pairs of a batch
are tested together in numpy; only the words with a failing pair go through exact merging.

Cases: a null text is empty (no ids); empty table: no rows; repeated rows and ids are each encoded;
texts of any length are encoded whole (words of any length, the exact merge is O(n log n)); other
columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import re
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_slices, with_worker_path

# The pre-token pattern of byte-level BPE, for texts of SAFE characters only (there
# [^\W\d_] are the letters and \d the numbers).  Other texts are cut by the library's pre-tokenizer.
SAFE_PATTERN = r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
UNSAFE = "[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-ɏЀ-ҁ–—‘-”…€]"

#: Entries from which a cache of a worker is full (the next slice begins a new one), and the longest string that is
#: cached (a full cache becomes the old one, from which what is still used moves back).
CACHE_ENTRIES, CACHE_CHARS = 50_000, 128
#: Characters of text encoded together: the more, the fewer different words among them.  A worker keeps what this takes
#: also while later stages run in it, beside an executor's heap and the other workers.
ENCODED_AT_ONCE = 6 << 20
#: Begins a mark among the parts of safe texts, in which it does not occur.
MARK = "\ue000"
#: Words of up to so many bytes are merged together in numpy, longer ones by a heap each.
SHORT = 64
NEVER = np.iinfo(np.int64).max


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in character of each byte in the vocabulary file."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Bpe:
    """Tables of one vocabulary file, with the caches of a worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        self.vocab = {bytes(alphabet[c] for c in tok): i for tok, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_rx = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.size = 1 + max([*self.vocab.values(), *self.special.values()])
        self.longest = ahocorasick.Automaton()      # of tokens as ISO-8859-1 characters
        for tok, i in self.vocab.items():
            self.longest.add_word(tok.decode("latin-1"), i)
        self.longest.make_automaton()
        self.bytes_of = [b""] * self.size
        for tok, i in self.vocab.items():
            self.bytes_of[i] = tok
        for tok, i in self.special.items():
            self.bytes_of[i] = tok.encode()
        self.byte_id = [self.vocab[bytes([b])] for b in range(256)]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        self.left, self.right = np.full(self.size, -1), np.full(self.size, -1)
        self.rank = np.full(self.size, -1)
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = (self.vocab[bytes(alphabet[c] for c in x)] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            made = self.vocab[self.bytes_of[a] + self.bytes_of[b]]
            self.merges[a, b] = (r, made)
            if self.rank[made] < 0:
                self.left[made], self.right[made], self.rank[made] = a, b, r
        keys = np.array([a * self.size + b for a, b in self.merges], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.merges.values()], dtype=np.int64)[order]
        self.made_by = np.array([made for _, made in self.merges.values()], dtype=np.int64)
        self.byte_ids = np.array(self.byte_id, dtype=np.int64)
        self.pre_tokenizer = Tokenizer.from_file(path).pre_tokenizer
        self.split = re.compile(SAFE_PATTERN).findall
        self.unsafe = re.compile(UNSAFE).search
        # white space whose run crosses a cut at spaces: such texts are matched as a whole
        self.crossing = re.compile(r"\s (?:\s|\Z)").search
        self.words: dict[str, bytes] = {}          # pre-token -> ids
        self.spaced: dict[str, bytes] = {}         # what follows a space, up to the next one -> ids with that space
        self.old_words: dict[str, bytes] = {}
        self.old_spaced: dict[str, bytes] = {}
        self.known_pairs = np.empty(0, dtype=np.int64)
        self.known_good = np.empty(0, dtype=bool)
        self.whole: dict[int, bool] = {}           # token -> its own bytes encode to it

    # ---------------------------------------------------------------- words

    def greedy(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, number of tokens per word) of all words, each cut into longest matches from its start on.

        The words go through the automaton as one string, with a character between them that no token holds; as
        every byte is a token, the leftmost longest match begins where the one before it ended."""
        joined = "\u0100".join([w.decode("latin-1") for w in raw])
        pairs = np.fromiter(itertools.chain.from_iterable(self.longest.iter_long(joined)), dtype=np.int64)
        ends, tokens = pairs[::2], pairs[1::2]
        first = np.cumsum([0] + [len(w) + 1 for w in raw])
        return tokens, np.diff(np.searchsorted(ends, first))

    def merge(self, word: bytes) -> list[int]:
        """Exact BPE: the lowest-ranked pair merges first, the leftmost of equals first."""
        ids = [self.byte_id[b] for b in word]
        n, merges = len(ids), self.merges
        prev, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(m[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = merges[a, b][1], -1
            after[i] = after[j]
            if after[j] >= 0:
                prev[after[j]] = i
                if m := merges.get((ids[i], ids[after[i]])):
                    heapq.heappush(heap, (m[0], i, ids[i], ids[after[i]]))
            if prev[i] >= 0 and (m := merges.get((ids[prev[i]], ids[i]))):
                heapq.heappush(heap, (m[0], prev[i], ids[prev[i]], ids[i]))
        return [t for t in ids if t >= 0]

    def merge_many(self, words: list[bytes]) -> list[bytes]:
        """Exact BPE of many short words: each round does the next merge of every word."""
        out = [b""] * len(words)
        ids = self.byte_ids[np.frombuffer(b"".join(words), dtype=np.uint8)]
        owner = np.repeat(np.arange(len(words)), [len(w) for w in words])
        rank = np.full(len(ids), NEVER)

        def rerank(at: np.ndarray) -> None:
            at = at[(at >= 0) & (at < len(ids) - 1)]
            same = owner[at] == owner[at + 1]
            rank[at] = np.where(same, self.pair_rank(ids[at], ids[at + 1]), NEVER)

        rerank(np.arange(len(ids)))
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            sizes = np.diff(np.append(starts, len(ids)))
            least = np.minimum.reduceat(rank, starts)
            done = least == NEVER
            if done.any():
                raw = ids.astype("<u4").tobytes()
                for w, s, n in zip(owner[starts[done]].tolist(), starts[done].tolist(), sizes[done].tolist()):
                    out[w] = raw[4 * s:4 * (s + n)]
                live = np.repeat(~done, sizes)
                ids, owner, rank, least, sizes = ids[live], owner[live], rank[live], least[~done], sizes[~done]
                if not len(ids):
                    break
            at = np.flatnonzero(rank == np.repeat(least, sizes))
            at = at[np.concatenate([[True], owner[at][1:] != owner[at][:-1]])]
            ids[at] = self.made_by[rank[at]]
            kept = np.ones(len(ids), dtype=bool)
            kept[at + 1] = False
            ids, owner, rank = ids[kept], owner[kept], rank[kept]
            at -= np.arange(len(at))
            rank[at] = NEVER
            rerank(at)
            rerank(at - 1)
        return out

    def is_whole(self, token: int) -> bool:
        if (ok := self.whole.get(token)) is None:
            ok = self.whole[token] = self.merge(self.bytes_of[token]) == [token]
        return ok

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NEVER)

    def compatible(self, keys: np.ndarray) -> np.ndarray:
        """Whether the two tokens of each pair stay apart when their bytes are encoded together.

        Undoes the two tokens' merges in falling order of rank, which visits every pair of symbols that
        ever face each other at the border; such a pair merges if its rank comes before the merge that
        takes its left symbol, and not after the one that takes its right symbol."""
        a, b = keys // self.size, keys % self.size
        good = np.ones(len(keys), dtype=bool)
        idx = np.arange(len(keys))
        end_a, end_b = np.full(len(keys), NEVER), np.full(len(keys), NEVER)
        while len(idx):
            r = self.pair_rank(a, b)
            bad = (r < end_a) & (r <= end_b) & (r != NEVER)
            good[idx[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            live = ~bad & ((ra >= 0) | (rb >= 0))
            undo_a = ra > rb
            end_a, end_b = np.where(undo_a, ra, end_a)[live], np.where(undo_a, end_b, rb)[live]
            a, b = np.where(undo_a, self.right[a], a)[live], np.where(undo_a, b, self.left[b])[live]
            idx = idx[live]
        return good

    def pairs_good(self, keys: np.ndarray) -> np.ndarray:
        unique, back = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self.known_pairs, unique)
        new = np.ones(len(unique), dtype=bool)
        inside = at < len(self.known_pairs)
        new[inside] = self.known_pairs[at[inside]] != unique[inside]
        good = np.empty(len(unique), dtype=bool)
        good[~new] = self.known_good[at[~new]]
        if new.any():
            good[new] = self.compatible(unique[new])
            if len(self.known_pairs) > 4 * CACHE_ENTRIES:
                self.known_pairs, self.known_good = self.known_pairs[:0], self.known_good[:0]
            keys_ = np.concatenate([self.known_pairs, unique[new]])
            order = np.argsort(keys_)
            self.known_pairs = keys_[order]
            self.known_good = np.concatenate([self.known_good, good[new]])[order]
        return good[back]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """ids (little-endian unsigned 32-bit) of each word: speculate, verify, repair."""
        raw = [w.encode() for w in words]
        flat, counts = self.greedy(raw)
        fails = np.zeros(len(words), dtype=bool)
        if len(flat) > 1:
            owner = np.repeat(np.arange(len(words)), counts)
            inner = owner[1:] == owner[:-1]
            keys = (flat[:-1] * self.size + flat[1:])[inner]
            fails[owner[1:][inner][~self.pairs_good(keys)]] = True
        ended = np.cumsum(counts)
        ids = flat.astype("<u4").tobytes()
        out = [ids[4 * (e - c):4 * e] for e, c in zip(ended.tolist(), counts.tolist())]
        odd = [t for t in np.unique(flat).tolist() if not self.is_whole(t)]
        if odd:
            fails[np.repeat(np.arange(len(words)), counts)[np.isin(flat, odd)]] = True
        redo = np.flatnonzero(fails).tolist()
        short = [i for i in redo if len(raw[i]) <= SHORT]
        for i, ids in zip(short, self.merge_many([raw[i] for i in short])):
            out[i] = ids
        for i in redo:
            if len(raw[i]) > SHORT:
                out[i] = np.array(self.merge(raw[i]), dtype="<u4").tobytes()
        return out

    # ---------------------------------------------------------------- texts

    def pre_tokens(self, text: str) -> list[str]:
        if not self.unsafe(text):
            return self.split(text)
        return [text[a:b] for _, (a, b) in self.pre_tokenizer.pre_tokenize_str(text)]

    def ids_of(self, words: list[str]) -> dict[str, bytes]:
        """ids of each of some different pre-tokens."""
        known, old, parts = self.words, self.old_words, self.spaced
        out, new = {}, []
        for w in words:
            if (x := known.get(w) or old.get(w) or (parts.get(w[1:]) if w[0] == " " else None)) is not None:
                out[w] = x
            else:
                new.append(w)
        fresh = dict(zip(new, self.encode_words(new)))
        known.update((w, x) for w, x in (out | fresh).items() if len(w) <= CACHE_CHARS)
        return out | fresh

    def ids_of_lists(self, lists: list[list[str]]) -> list[bytes]:
        """ids of each list of pre-tokens."""
        ids = self.ids_of(list({w for x in lists for w in x}))
        return [ids[x[0]] if len(x) == 1 else b"".join([ids[w] for w in x]) for x in lists]

    def encode_spaced(self, parts: list[str]) -> list[bytes]:
        """ids of each of some different parts of a text together with the space before it."""
        lists = [self.split(" " + c) for c in parts]
        alone = [x[0] for x in lists if len(x) == 1]           # kept with the parts, not once more as words
        ids = dict(zip(alone, self.encode_words(alone)))
        several = iter(self.ids_of_lists([x for x in lists if len(x) > 1]))
        return [ids[x[0]] if len(x) == 1 else next(several) for x in lists]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """ids of each text as little-endian unsigned 32-bit bytes, as the tokenizers library gives them.

        A text is cut at its spaces, each space going with what follows it; what stands between two
        spaces is encoded once per worker while it stays in the cache."""
        if len(self.spaced) > CACHE_ENTRIES:
            self.spaced, self.old_spaced = {}, self.spaced
        if len(self.words) > CACHE_ENTRIES:
            self.words, self.old_words = {}, self.words
        units: list[str] = []                       # what stands after a space, and marks of other strings
        ends: list[int] = []                        # of each text in units
        fixed: list[bytes | None] = []              # ids of the marked strings
        whole: list[tuple[int, str]] = []           # marked strings that are cut by the pattern alone

        def mark(ids: bytes | None, part: str = "") -> None:
            if ids is None:
                whole.append((len(fixed), part))
            units.append(MARK + str(len(fixed)))
            fixed.append(ids)

        for text in texts:
            for k, part in enumerate(self.special_rx.split(text or "") if self.special_rx else [text or ""]):
                if k % 2:
                    mark(np.array([self.special[part]], dtype="<u4").tobytes())
                elif part and (self.unsafe(part) or self.crossing(part)):
                    mark(None, part)
                elif part:
                    first, *rest = part.split(" ")
                    if first:
                        mark(None, first)
                    units += rest
            ends.append(len(units))
        for (n, _), x in zip(whole, self.ids_of_lists([self.pre_tokens(w) for _, w in whole])):
            fixed[n] = x
        coded = pa.array(units, pa.large_string()).dictionary_encode()
        codes, different = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
        spaced, old = self.spaced, self.old_spaced
        found = [fixed[int(c[1:])] if c[:1] == MARK else x if (x := spaced.get(c)) is not None else old.get(c) for c in different]
        new = [i for i, x in enumerate(found) if x is None]
        for i, x in zip(new, self.encode_spaced([different[i] for i in new])):
            found[i] = x
        spaced.update((c, x) for c, x in zip(different, found) if len(c) <= CACHE_CHARS and c[:1] != MARK)
        # the ids of every unit in a row: gathered from those of the different ones
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        begins = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(found), dtype="<u4")
        n = sizes[codes]
        after = np.cumsum(n)
        raw = flat[np.repeat(begins[codes] - (after - n), n) + np.arange(int(n.sum()))].tobytes()
        cuts = np.concatenate([[0], after])[[0, *ends]] * 4
        return [raw[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def decode(self, ids: bytes) -> str:
        table = self.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """The vocabulary at ``path``, read once per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ids (binary, little-endian unsigned 32-bit) for every row; see the module's cases."""
    with_worker_path(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for part, texts in text_slices(batches, "text", ENCODED_AT_ONCE):
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(bpe.encode(texts), pa.binary())],
                                             names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(run, f"{id_col} {kind}, ids binary")


def decode_documents(encoded: DataFrame, vocabulary: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, text for every row of ids (binary; null: empty)."""
    with_worker_path(encoded.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for part, ids in text_slices(batches, "ids"):
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array([bpe.decode(x or b"") for x in ids], pa.string())],
                                             names=[id_col, "text"])

    kind = encoded.schema[id_col].dataType.simpleString()
    return encoded.select(encoded[id_col].alias("id"), encoded["ids"]).mapInArrow(run, f"{id_col} {kind}, text string")


def round_trip_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text encoded, its ids decoded again."""
    with_worker_path(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(vocabulary)
        for part, texts in text_slices(batches, "text", ENCODED_AT_ONCE):
            ids = bpe.encode(texts)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(bpe.decode(x).encode()).hexdigest() for x in ids], pa.string()),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
