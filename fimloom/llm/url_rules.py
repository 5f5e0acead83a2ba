"""URL filters: listed rules, and association rules mined from labelled URLs.

A URL becomes a set of tokens (host labels, registered name, path segments, extension, query keys).
Spark's FP-growth mines token sets of the labelled URLs; sets that imply a label with enough
confidence, support and lift become rules.  An inverted index (token -> rules with it) matches them:
tokens of the different URLs are joined with the index and a rule holds for a URL that has all its
tokens.  Different URLs are judged once and joined back, so a hot URL costs one judgement; the index
is broadcast by Spark only if its measured size allows it.

Listed rules (host, path) fit their host and its subdomains if the path starts with theirs; the longest
wins, "block" on a tie.

Cases: a null URL or one without "://" has an empty host and path, no tokens, no rule and is allowed;
repeated rows are each judged; an empty table gives no rows, and without labels no rule is mined; a URL
labelled both ways counts with each label; other columns of the input are kept out.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Listed rules are a configuration: an upper bound for their number.
MAX_LISTED = 10_000
LABEL = "label="


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to "?", "#" or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def listed_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct(rule, verdict) of the longest listed rule (host, path, verdict) that fits, else null."""
    if len(rules) > MAX_LISTED:
        raise ValueError(f"more than {MAX_LISTED} listed rules")
    fits = [F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
                   F.struct(F.lit(len(h + p)).alias("n"), F.lit(v).alias("verdict"), F.lit(h + p).alias("rule")))
            for h, p, v in rules]
    return F.array_max(F.array_compact(F.array(*fits)))


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL."""
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    segments = F.array_remove(F.split(path, "/"), "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.array_remove(F.split(query, "&"), ""), lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1)))
    extension = F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1)
    named = F.concat(
        F.transform(F.array_remove(labels, ""), lambda x: F.concat(F.lit("host:"), x)),
        F.when(F.size(labels) >= 2, F.array(F.concat(F.lit("site:"), F.array_join(F.slice(labels, -2, 2), ".")))).otherwise(F.array()),
        F.transform(segments, lambda x: F.when(x.rlike("^[0-9]+"), F.lit("path:#")).otherwise(F.concat(F.lit("path:"), x))),
        F.when(extension != "", F.array(F.concat(F.lit("ext:"), extension))).otherwise(F.array()), keys)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(named))


def stand_ins(rows: DataFrame) -> DataFrame:
    """token, stand_in: the first of the tokens that stand in exactly the same rows (columns row, token).

    Rows are compared by their number and two sums of hashes, gathered with partial aggregation."""
    same = rows.groupBy("token").agg(F.count("*").alias("n"), F.sum(F.xxhash64("row").cast("decimal(20,0)")).alias("a"),
                                     F.bit_xor(F.xxhash64("row", F.lit(1))).alias("b"))
    first = same.groupBy("n", "a", "b").agg(F.min("token").alias("stand_in"))
    return same.join(first, ["n", "a", "b"]).select("token", "stand_in")


def mine(labelled: DataFrame, support: float = 0.002, confidence: float = 0.9, lift: float = 1.1, most_tokens: int = 4,
         least_rows: int = 5) -> DataFrame:
    """Rules (rule_id, label, tokens, confidence, support, lift) from rows of url and label.

    A rule holds for ``least_rows`` rows and the share ``support`` of them; it has up to ``most_tokens`` tokens.  One that
    holds whenever a shorter one of the same label and no less confidence holds is pruned.  Tokens that always stand
    together (the segments of one repeated long URL) are mined as one and put back into the rules: two of them in one rule are
    redundant, so nothing is lost, and sets of them are never listed."""
    baskets = written(labelled.where("url is not null and label is not null").select(
        F.monotonically_increasing_id().alias("row"), F.concat(F.lit(LABEL), F.col("label")).alias("label"),
        tokens_of(F.col("url")).alias("tokens")), "baskets")
    number = baskets.count()
    if not number:
        return labelled.sparkSession.createDataFrame(
            [], "rule_id bigint, label string, tokens array<string>, confidence double, support double, lift double")
    rows = baskets.select("row", F.explode("tokens").alias("token"))
    # only tokens frequent enough for a rule: at most tokens a row / support of them
    least = max(support, (least_rows - 0.5) / number)
    often = rows.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") >= least * number).select("token")
    tokens = written(rows.join(often, "token").join(stand_ins(rows), "token"), "tokens")
    items = tokens.where("token = stand_in").groupBy("row").agg(F.collect_list("token").alias("items"))
    items = baskets.join(items, "row", "left").select(
        F.array_append(F.coalesce("items", F.array().cast("array<string>")), F.col("label")).alias("items"))
    found = FPGrowth(itemsCol="items", minSupport=least, minConfidence=confidence).fit(items).associationRules
    rules = written(found.where(F.startswith(F.col("consequent")[0], F.lit(LABEL)) & (F.size("antecedent") <= most_tokens)
                                & (F.col("lift") >= lift)).select(
        F.expr(f"substring(consequent[0], {len(LABEL) + 1})").alias("label"), F.array_sort("antecedent").alias("tokens"),
        "confidence", "support", "lift"), "mined")
    # a rule is redundant if one of its shorter versions (a token left out, down to one) is as good
    short = rules.select(F.col("label").alias("l"), F.col("tokens").alias("t"), F.col("confidence").alias("c"))
    parts = rules.select("label", "tokens", "confidence", F.explode(
        F.flatten(F.transform(F.col("tokens"), lambda x: F.array(F.array(x), F.array_remove(F.col("tokens"), x))))).alias("part"))
    redundant = parts.where(F.col("part") != F.col("tokens")).join(
        short, (F.col("part") == F.col("t")) & (F.col("label") == F.col("l")) & (F.col("c") >= F.col("confidence"))).select("label", "tokens")
    kept = rules.join(redundant, ["label", "tokens"], "left_anti")
    # every choice of the tokens that a rule's stand-ins are for
    alike = tokens.select("stand_in", "token").distinct().groupBy("stand_in").agg(F.collect_list("token").alias("alike"))
    choices = kept.select("*", F.posexplode("tokens").alias("at", "stand_in")).join(
        alike, "stand_in").groupBy("label", "tokens", "confidence", "support", "lift").agg(
        F.array_sort(F.collect_list(F.struct("at", "alike"))).alias("choices"))
    chosen = choices.withColumn("tokens", F.array().cast("array<string>"))
    for i in range(most_tokens):
        chosen = chosen.withColumn("one", F.explode(F.coalesce(F.get("choices", F.lit(i))["alike"], F.array(F.lit(None).cast("string"))))
                                   ).withColumn("tokens", F.array_compact(F.array_append("tokens", F.col("one"))))
    kept = chosen.select("label", F.array_sort("tokens").alias("tokens"), "confidence", "support", "lift")
    return written(kept.withColumn("rule_id", F.monotonically_increasing_id()), "rules").select(
        "rule_id", "label", "tokens", "confidence", "support", "lift")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """url, mined_label, mined_tokens, mined_confidence of every different URL (column url) that a rule holds for.

    The most confident rule decides, then the one with more support, then the label and tokens in order."""
    index = rules.select("rule_id", "label", "tokens", "confidence", "support", F.size("tokens").alias("needed"),
                         F.explode("tokens").alias("token"))
    seen = urls.select("url").distinct().select("url", F.explode(tokens_of(F.col("url"))).alias("token"))
    # the rule goes along once it is complete: only its number is counted
    held = (seen.join(index.select("rule_id", "token", "needed"), "token").groupBy("url", "rule_id", "needed").count()
            .where("count = needed").join(rules, "rule_id"))
    best = held.groupBy("url").agg(F.max(F.struct("confidence", "support", "label", "tokens")).alias("best"))
    return best.select("url", F.col("best.label").alias("mined_label"), F.col("best.tokens").alias("mined_tokens"),
                       F.col("best.confidence").alias("mined_confidence"))


def judge(pages: DataFrame, listed: list[tuple[str, str, str]], labelled: DataFrame | None = None, id_col: str = "page_id",
          url_col: str = "url", **mining: float) -> DataFrame:
    """One row per row: id, host, path, rule (listed, else null), verdict, mined_tokens, mined_confidence.

    ``labelled`` (url, label: allow or block) is mined; unless given, the URLs that listed rules decide
    are, so that the mined rules carry their decisions over to the others."""
    url = pages[url_col]
    rows = pages.select(pages[id_col].alias(id_col), url.alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("listed", listed_rule(F.col("host"), F.col("path"), listed))
    if labelled is None:
        labelled = rows.where("listed is not null").select("url", F.col("listed.verdict").alias("label"))
    mined = match(rows.where("listed is null and host != ''"), mine(labelled, **mining))
    return rows.join(mined, "url", "left").select(
        id_col, "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce("listed.verdict", "mined_label", F.lit("allow")).alias("verdict"), "mined_tokens", "mined_confidence")
