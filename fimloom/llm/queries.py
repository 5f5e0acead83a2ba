"""The queries ``opN_<name>`` of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, exact_dedup, hmm_lm, langid, license_scan, manifest, packing, periodic, quality, secrets, sharding, simhash, sql,
               url_rules)
from .common import crc_mod, documents, id_crc

# The listed URL rules (host, path, verdict).
LISTED = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return url_rules.judge(pages, LISTED, least_rows=1).withColumn("mined_tokens", F.array_join("mined_tokens", " "))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary())


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir), keep="largest").drop("row_number")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), words_per_shingle=3, max_bits=2)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.train(langid.training_rows(docs), F.col("lang"))
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out")
    return langid.predict(docs.select("doc_id", held_out, "text"), model, carry=["doc_id", "held_out"])


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(documents(spark, sf_dir), vocabulary())


def op8_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    learn = hmm_lm.training_rows(docs)
    counts = hmm_lm.written(hmm_lm.word_counts(learn), "word-counts")
    model = hmm_lm.train(learn, counts)
    held_out = F.coalesce(crc_mod("doc_id", 5) == 1, F.lit(False)).alias("held_out")
    return hmm_lm.score(docs.select("doc_id", held_out, "text"), model, counts, carry=["held_out"])


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), [1.0] * 16, [1.0] * 17)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = quality.written(quality.measured(docs, stratum=docs["lang"]), "measures")
    cutoffs = quality.thresholds(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judged(rows, cutoffs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                                "base_failed", "kept", "stratum", *quality.MEASURES, "risk_failed")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)

    def lowered(text: Column) -> Column:
        return F.when(crc_mod(docs["doc_id"], 3) == 0, F.translate(text, string.ascii_uppercase, string.ascii_lowercase)).otherwise(text)

    return manifest.verify(docs, ["doc_id", "source", "lang", "n_chars", "text"], lowered, "lang", "doc_id")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    crc = id_crc(docs["doc_id"])
    text = F.when(crc % 10 == 0, periodic.with_planted_period(docs["text"], crc)).otherwise(docs["text"])
    found = periodic.periodic_runs(docs, text).withColumn("best", periodic.strongest(F.col("runs")))
    return found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
                        F.sha2(periodic.run_lines(F.col("runs")), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir))
    kinds = secrets.KINDS[:secrets.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def n(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *map(n, kinds), F.sha2(secrets.written_spans(base), 256).alias("base_sha256"), secrets.written_spans(F.col("spans")).alias("spans"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_url_rules, op2_packing, op3_exact_dedup, op4_simhash, op5_license_scan, op6_language_id,
                                    op7_bpe, op8_hmm_lm, op9_sharding, op10_quality_rules, op11_merkle_manifest, op12_periodic_runs,
                                    op13_secret_scan)}


def oracle_sql() -> dict[str, str]:
    """The other queries train a model, tokenize, hash by XXH64 or find runs: tests hold them against brute force."""
    return {"op1_url_rules": sql.url_rules(LISTED), "op3_exact_dedup": sql.EXACT_DEDUP, "op5_license_scan": sql.license_scan(),
            "op9_sharding": sql.sharding(), "op11_merkle_manifest": sql.manifest(), "op13_secret_scan": sql.secret_scan()}
