from __future__ import annotations

import hashlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from fimloom.llm import manifest, queries, sql

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in FIELDS])


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def beside(tree, at):
    out = []
    for level in tree[:-1]:
        block = at // 8 * 8
        out.append(("".join(level[block:at]), "".join(level[at + 1:block + 8])))
        at //= 8
    return out


def brute(rows):
    """(root, {group: subroot}, {(group, rank): (leaf, proof)})"""
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    trees = {g: levels([leaf(r) for r in sorted(rs, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))]) for g, rs in groups.items()}
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    top = levels([trees[g][-1][0] for g in order])
    proofs = {(g, i): (x, beside(trees[g], i) + beside(top, order.index(g))) for g in groups for i, x in enumerate(trees[g][0])}
    return top[-1][0], {g: t[-1][0] for g, t in trees.items()}, proofs


def built(df, **kw):
    return manifest.build(df, manifest.leaf_digest(*[df[c] for c in FIELDS]), df["lang"], df["doc_id"], **kw)


def many(odd):
    """The odd rows, and so many more that trees are three levels high, with many groups of their own."""
    n = F.col("id")
    more = odd.sparkSession.range(700).select(
        F.lit(None).cast("string").alias("_"), (n * 7 % 300).alias("doc_id"), F.concat(F.lit("text "), (n % 11).cast("string")).alias("text"),
        F.when(n % 10 == 0, F.concat(F.lit("z"), (n % 70).cast("string"))).otherwise("en").alias("lang"), F.lit("s").alias("source"),
        F.lit(None).cast("long").alias("n_chars"))
    same = odd.sparkSession.range(500).select(F.lit(-5).cast("long").alias("doc_id"), F.lit("copy").alias("text"), F.lit("en").alias("lang"),
                                              F.lit("hot").alias("source"), F.lit(4).cast("long").alias("n_chars"))
    return odd.select(*FIELDS).unionByName(more.select(*FIELDS)).unionByName(same.select(*FIELDS)).repartition(5)


def test_tree_and_proofs_equal_brute_force(spark, odd):
    df = many(odd).cache()
    root, subroots, proofs = brute(df.collect())
    m = built(df)
    assert m.root == root
    assert {r["grp"]: r["digest"] for r in m.roots.collect()} == subroots
    got = manifest.prove(m).collect()
    assert {(r["grp"], r["rank"]): (r["digest"], [tuple(s) for s in r["proof"]]) for r in got} == proofs
    assert len(got) == len(proofs) and all(r["subroot"] == subroots[r["grp"]] for r in got)
    folded = manifest.prove(m).select(manifest.fold(F.col("digest"), F.col("proof")).alias("f")).distinct().collect()
    assert [r["f"] for r in folded] == [root]


def test_requests_descend_alone(spark, odd):
    df = many(odd).cache()
    _, _, proofs = brute(df.collect())
    asked = [("en", 0), ("en", 9), ("en", 700), (None, 1), ("z0", 3), ("de", 2), ("de", 2), ("none", 0), ("en", 10 ** 6)]
    requests = spark.createDataFrame(asked, "grp string, rank long")
    got = manifest.prove(built(df), requests).collect()
    assert {(r["grp"], r["rank"]): (r["digest"], [tuple(s) for s in r["proof"]]) for r in got} == {k: proofs[k] for k in set(asked) if k in proofs}
    assert len(got) == 6


def test_equal_subtrees_have_one_record(spark):
    df = spark.range(128).select(F.lit(1).cast("long").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"),
                                 F.lit(1).cast("long").alias("n_chars"))
    m = built(df)
    assert [s.count() for s in m.stores] == [1, 1, 1]
    assert {r["f"] for r in manifest.prove(m).select(manifest.fold(F.col("digest"), F.col("proof")).alias("f")).collect()} == {m.root}


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 65])
def test_sizes(spark, odd, n):
    df = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"),
                               F.lit(1).cast("long").alias("n_chars"))
    m = built(df)
    got = manifest.prove(m).collect()
    assert len(got) == n
    if n:
        root, _, proofs = brute(df.collect())
        assert m.root == root and {(r["grp"], r["rank"]): (r["digest"], [tuple(s) for s in r["proof"]]) for r in got} == proofs
    else:
        assert m.root is None


def test_tampering_is_found(spark, odd, empty):
    def lowered(t):
        return F.lower(t)
    rows = manifest.verify(odd, FIELDS, lowered, "lang", "doc_id").collect()
    changed = sum(r["text"] is not None and r["text"].lower() != r["text"] for r in odd.collect())
    assert len(rows) == odd.count() and sum(not r["verified"] for r in rows) == changed > 0
    assert all((r["folded_root"] == r["root"]) == r["verified"] for r in rows)
    assert manifest.verify(empty, FIELDS, lowered, "lang", "doc_id").collect() == []


def test_query_equals_sql_with_nulls_and_ties(spark, odd, tmp_path):
    many(odd).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    got = queries.op11_merkle_manifest(spark, str(tmp_path))
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({sql.manifest()})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
