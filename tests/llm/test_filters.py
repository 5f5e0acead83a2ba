from __future__ import annotations

import math
import random
import re
from collections import Counter
from urllib.parse import urlsplit

import numpy as np
import pytest
from pyspark.sql import functions as F

from fimloom.llm import langid, quality, queries, url_rules

# ---------------------------------------------------------------- URL rules

URLS = [
    None, "", "no scheme", "http://", "http://org", "http://A.Example.ORG/es/1", "https://example.org/es/", "http://example.org/en/12?q=1",
    "http://example.org/en/2", "http://xexample.org/es/1", "https://m.a.com/fr/3#x", "https://com/de/1", "https://b.com/de/4.html?ref=x&page=2",
    "https://b.com/de", "https://b.net/de/9", "ftp://b.net?x=/org/", "a://b://c.org/z", "http://c.org", "http://ÄB.org/x\ny?z",
]


def brute_rule(url):
    if not url or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), v, h + p) for h, p, v in queries.LISTED if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, verdict, rule = max(fit, default=(0, None, None))
    return host, path, rule, verdict


def test_listed_rules(spark):
    pages = spark.createDataFrame([(i, u, "h", "clash") for i, u in enumerate(URLS)] + [(1, URLS[5], "h", "clash")],
                                  "page_id long, url string, html string, host string")
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"] if r["rule"] else None) for r in url_rules.judge(pages, queries.LISTED).collect())
    want = sorted([(i, *brute_rule(u)) for i, u in enumerate(URLS)] + [(1, *brute_rule(URLS[5]))])
    assert got == want


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        seg, host = rng.choice(["shop", "news", "win"]), rng.choice(["a", "b", "spam"])
        bad = seg == "win" or host == "spam" and seg == "shop"
        rows.append((f"http://{host}.site.{rng.choice(['net', 'biz'])}/{seg}/{rng.randint(1, 9)}", "block" if bad else "allow"))
    rows += [(None, "block"), ("http://x.net/win/1", None)]
    labelled = spark.createDataFrame(rows, "url string, label string")
    tokens = {u: t for u, t in spark.createDataFrame([(u,) for u, _ in rows], "url string").select("url", url_rules.tokens_of(F.col("url"))).collect()}
    rules = url_rules.mine(labelled, support=0.02, confidence=0.95).collect()
    baskets = [(set(tokens[u]), y) for u, y in rows if u and y]
    for r in rules:
        n = sum(set(r["tokens"]) <= t for t, _ in baskets)
        hit = sum(set(r["tokens"]) <= t and y == r["label"] for t, y in baskets)
        assert math.isclose(r["confidence"], hit / n) and hit / n >= 0.95 and hit / len(baskets) >= 0.02
    found = {(r["label"], tuple(r["tokens"])) for r in rules}
    assert ("block", ("path:win",)) in found
    assert ("block", ("host:spam", "path:shop")) in found
    assert not any(r["label"] == "block" and "path:win" in r["tokens"] and len(r["tokens"]) > 1 for r in rules)     # pruned

    urls = [u for u, _ in rows] + ["http://spam.site.net/shop/77", "http://spam.other.org/news/77"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = {r["url"]: (r["mined_label"], r["mined_tokens"]) for r in url_rules.match(df, spark.createDataFrame(rules, "rule_id long, label string, tokens array<string>, confidence double, support double, lift double")).collect()}
    for u in set(urls) - {None}:
        t = set(tokens.get(u) or spark.createDataFrame([(u,)], "url string").select(url_rules.tokens_of(F.col("url"))).first()[0])
        fit = [(r["confidence"], r["support"], r["label"], r["tokens"]) for r in rules if set(r["tokens"]) <= t]
        assert got.get(u) == (max(fit)[2:] if fit else None)


def test_long_repeated_urls_are_mined(spark):
    """Tokens that always stand together are mined as one, and each of them makes its rules all the same."""
    long = "http://long.site.net/" + "/".join(f"s{i}" for i in range(24))
    rows = [(long, "block")] * 20 + [(f"http://h{i % 7}.other.net/p{i % 3}/{i}", "allow") for i in range(300)]
    rows += [(f"http://h1.far.net/{'/'.join(f'x{i}y{k}' for k in range(12))}", "block") for i in range(4)]      # too rare
    rules = url_rules.mine(spark.createDataFrame(rows, "url string, label string")).collect()
    found = {(r["label"], tuple(r["tokens"])) for r in rules}
    assert {("block", (f"path:s{i}",)) for i in range(24)} | {("block", ("site:site.net",)), ("block", ("host:long",))} <= found
    assert len(found) == len(rules) and all(len(t) == 1 for y, t in found if y == "block")
    assert not any("x0y0" in x for _, t in found for x in t)


def test_tokens_alike_equal_mining_without_stand_ins(spark, monkeypatch):
    rng = random.Random(5)
    rows = []
    for _ in range(300):
        a, b = rng.choice("uvw"), rng.choice("kl")
        rows.append((f"http://{a}1.{a}2.{b}.net/{b}/{rng.choice('mn')}", "block" if a == "u" and b == "k" or rng.random() < 0.03 else "allow"))
    labelled = spark.createDataFrame(rows, "url string, label string")

    def mined():
        return sorted((r["label"], r["tokens"], round(r["confidence"], 9), round(r["support"], 9), round(r["lift"], 9))
                      for r in url_rules.mine(labelled, support=0.02, confidence=0.8).collect())
    joint = mined()
    monkeypatch.setattr(url_rules, "stand_ins", lambda rows: rows.select("token", F.col("token").alias("stand_in")).distinct())
    assert joint == mined() and any(len(r[1]) > 1 for r in joint)


def test_the_query_takes_rules_of_few_rows(spark, tmp_path):
    """Under 2,500 labelled URLs the support of 0.002 is fewer than five rows: the query and its SQL have no other bound."""
    import duckdb

    urls = [f"http://a{i}.example.org/es/rare" for i in range(2)] + [f"http://h{i % 5}.org/p{i % 4}/x" for i in range(40)]
    urls += ["http://b.net/rare", "http://b.net/p1", None]
    pages = str(tmp_path / "pages.parquet")
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(pages)
    got = sorted(map(tuple, queries.op1_url_rules(spark, str(tmp_path)).collect()))
    assert got[42][4:6] == ("block", "path:rare") and got[43][4] == "allow"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{pages}/*.parquet')")
    assert got == sorted(con.sql(queries.oracle_sql()["op1_url_rules"]).fetchall())


def test_url_rules_without_rows_or_labels(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge(none, queries.LISTED).collect() == []
    one = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    assert [r["verdict"] for r in url_rules.judge(one, queries.LISTED).collect()] == ["allow"]


# ---------------------------------------------------------------- quality

def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    covered = set()
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(windows)
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_counts_equal_brute_force(odd, odd_rows):
    got = sorted([(r["doc_id"], *(r[c] for c in quality.COUNTS[:5])) for r in quality.measured(odd, stratum=odd["lang"]).collect()], key=str)
    assert got == sorted([(r["doc_id"], *brute_counts(r["text"])) for r in odd_rows], key=str)


def test_dup_lines_keep_their_blanks():
    assert quality.measure("a \na\na \n \n \n a")[3] == brute_counts("a \na\na \n \n \n a")[3] == 1


@pytest.mark.parametrize("n, p", [(10, 0.1), (50, 0.02), (3, 0.5)])
def test_binomial_is_exact(n, p):
    for k in range(n):
        want = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert math.isclose(quality.at_most(k, n, p), want, rel_tol=1e-9)


def measures(spark, rows):
    cols = ", ".join(f"{m} double" for m in quality.MEASURES)
    return spark.createDataFrame(rows, f"doc_id long, stratum string, {cols}")


def test_thresholds_equal_brute_force(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(6000):
        s = rng.choice(["a", "a", "b", None])
        good = rng.random() < 0.9
        value = rng.random() * (0.1 if good else 1.0) + (0.2 if good and rng.random() < 0.001 else 0)
        rows.append((i, s, value, 0.0, 0.0, 0.0, 0.0))
        labels.append((i, int(good)))
    risk, delta = 0.02, 0.05
    got = quality.thresholds(measures(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int"), risk=risk, delta=delta)
    assert set(got) == {"*", "a", "b"}
    level = delta / (3 * len(quality.MEASURES))
    for s in got:
        values = [r[2] for r, (_, y) in zip(rows, labels) if y and s in ("*", r[1])]
        best = None
        for step in range(quality.GRID, -1, -1):
            k = sum(math.ceil(v * quality.GRID) > step for v in values)
            if quality.at_most(k, len(values), risk / len(quality.MEASURES)) > level:
                break
            best = step / quality.GRID
        assert got[s].get("symbol_rate") == best
        assert s == "b" or best is not None           # b has too few labels
        assert best is None or sum(math.ceil(v * quality.GRID) > best * quality.GRID for v in values) <= risk * len(values)


def test_false_rejections_are_controlled(spark):
    """Over many draws of the holdout, a cutoff breaks its risk no more often than promised."""
    rng, broken = random.Random(8), 0
    risk = 0.05
    for _ in range(300):
        values = sorted(rng.random() for _ in range(400))
        allowed = quality.most_allowed(400, risk, 0.05)
        cutoff = math.ceil(values[-allowed - 1] * 200) / 200
        broken += 1 - cutoff > risk
    assert broken <= 300 * 0.05 * 1.6


def test_few_labels_reject_nothing(spark, odd):
    rows = quality.measured(odd, stratum=odd["lang"])
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, quality int")
    cut = quality.thresholds(rows, labels)
    assert cut == {"*": {}}
    got = quality.judged(rows, cut).collect()
    assert all(r["kept"] != r["base_failed"] for r in got) and len(got) == odd.count()


def test_strata_without_cutoffs_reject_nothing(spark):
    """A small, a null and an unlabelled stratum of high rates beside 33 large ones keep all; the large ones each have cutoffs."""
    large = [f"s{i:02}" for i in range(33)]
    risk = 0.2
    rows = [(s, 0.01) for s in large for _ in range(300)] + [("rare", 0.9)] * 10 + [(None, 0.9)] * 10
    rows = [(i, s, v, 0.0, 0.0, 0.0, 0.0) for i, (s, v) in enumerate(rows)]
    labels = spark.createDataFrame([(r[0], 1) for r in rows], "doc_id long, quality int")
    bad = [(-1, "s00", 0.9, 0.0, 0.0, 0.0, 0.0), (-2, "s32", 0.9, 0.0, 0.0, 0.0, 0.0), (-3, "unlabelled", 0.9, 0.0, 0.0, 0.0, 0.0)]
    df = measures(spark, rows + bad).withColumns({"n_words": F.lit(100), "n_repeat_words": F.lit(0)})
    cut = quality.thresholds(df, labels, risk=risk)
    assert set(cut) == {quality.POOLED, *large} and all(cut[s]["symbol_rate"] == 0.01 for s in cut)
    assert sorted(r["doc_id"] for r in quality.judged(df, cut).where("risk_failed").collect()) == [-2, -1]
    few = quality.thresholds(df, labels, risk=risk, least_labels=301)
    assert few == {quality.POOLED: {}}


def test_kept_documents_have_their_columns(spark, odd):
    out = quality.kept_documents(odd, {"*": {"symbol_rate": 0.5}}, stratum=odd["lang"])
    assert out.columns == odd.columns
    want = [r for r in odd.collect() if not (lambda c: c[0] < 50 or 100 * c[4] > 50 * c[0] or c[2] / c[0] > 0.5)(brute_counts(r["text"]))]
    assert sorted(map(str, out.collect())) == sorted(map(str, want))


# ---------------------------------------------------------------- language ID

def test_long_texts_are_scored_by_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    table = np.concatenate([rng.random((256, 3)), np.zeros((1, 3))]).astype(np.float32)
    texts = ["", "a", "ab", None, "grüße " * 40, "x" * 500, "é", "word and word"]
    raw, starts = langid.joined(texts)
    whole = langid.summed(raw, starts, table)
    for i, t in enumerate(texts):
        assert np.allclose(whole[i], sum(table[b].astype(float) for b in brute_bins(t or "", 256)))
    for chunk in (1, 2, 7, 100):
        monkeypatch.setattr(langid, "CHUNK", chunk)
        assert np.allclose(langid.summed(raw, starts, table), whole)


def test_memory_of_a_long_text_does_not_grow_with_the_languages():
    """8 MB (shorter than real giants, to keep the test short): chunks of the score, not all of it."""
    import tracemalloc
    table = np.zeros((257, 64), dtype=np.float32)
    raw, starts = langid.joined(["some words of a text " * 400_000])
    tracemalloc.start()
    langid.summed(raw, starts, table)
    assert tracemalloc.get_traced_memory()[1] < 900_000_000 and len(raw) * 64 * 4 > 2_000_000_000
    tracemalloc.stop()


def test_more_languages_than_the_matrix_holds(spark):
    df = spark.range(70).select(F.concat(F.lit("l"), F.col("id").cast("string")).alias("lang"), F.lit("some text").alias("text"))
    assert len(langid.train(df, df["lang"], bins=256)[0]) == 70
    with pytest.raises(ValueError):
        langid.train(df, df["lang"], bins=256, max_languages=69)


def test_language_model_equals_brute_force(odd, odd_rows):
    langs, matrix = langid.train(odd, odd["lang"], bins=256)
    assert langs == ["de", "en"]
    counts = {x: Counter() for x in langs}
    for r in odd_rows:
        if r["text"] is not None and r["lang"]:
            counts[r["lang"]].update(brute_bins(r["text"], 256))
    for j, x in enumerate(langs):
        total = sum(counts[x].values()) + 0.5 * 256
        for b in range(256):
            assert math.isclose(matrix[b, j], math.log((counts[x][b] + 0.5) / total), rel_tol=1e-4)
    got = sorted([(r["doc_id"], r["lang_pred"], round(r["score"], 4)) for r in langid.predict(odd, (langs, matrix), carry=["doc_id"]).collect()], key=str)
    want = []
    for r in odd_rows:
        if not any(map(str.isalpha, r["text"] or "")):
            want.append((r["doc_id"], "und", 0.0))
            continue
        bins = brute_bins(r["text"], 256)
        sums = [sum(float(matrix[b, j]) for b in bins) for j in range(2)]
        size = len(r["text"].encode()) + 3
        best = max(range(2), key=lambda j: (sums[j], -j))
        want.append((r["doc_id"], langs[best], round(1 / sum(math.exp(4 * (x - sums[best]) / size) for x in sums), 4)))
    assert [x[:2] for x in got] == [x[:2] for x in sorted(want, key=str)]
    assert all(abs(a[2] - b[2]) < 2e-3 for a, b in zip(got, sorted(want, key=str)))


def brute_bins(text, bins):
    raw = b" " + text.encode().lower() + b"  "
    out = []
    shift = 32 - (bins.bit_length() - 1)
    for n, mix in zip((1, 2, 3), langid.MIX):
        for i in range(len(raw) - n + 1):
            h = int.from_bytes(raw[i:i + n], "big") * mix & 0xFFFFFFFF
            out.append((h ^ (n * 0x9E3779B9 & 0xFFFFFFFF)) * langid.MIX[0] % 2 ** 32 >> shift)
    return out


def test_languages_of_held_out_documents(spark):
    """Accuracy on the quarter of the documents that training never saw."""
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r for r in queries.op6_language_id(spark, sf).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in rows) >= 0.98 * len(rows) > 0


def test_language_without_training(empty, odd):
    assert langid.predict(empty, langid.train(empty, empty["lang"]), carry=["doc_id"]).collect() == []
    assert {r["lang_pred"] for r in langid.predict(odd, langid.train(empty, empty["lang"]), carry=["doc_id"]).collect()} == {"und"}
    assert quality.measured(empty).collect() == []
