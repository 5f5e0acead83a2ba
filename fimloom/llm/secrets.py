"""Secret scans with multipart credential linking.

The base scan reports strong candidates by their form alone: assigned secrets, access key identifiers and long
hexadecimal strings.  Weak candidates are parts of a credential that say little alone: settings named like
an identifier, a secret or an endpoint, URLs, and long mixed tokens.  They are reported only when complementary
parts co-occur: in the same scope (text without a blank line) and with at most ``REACH`` code points between
the two intervals, a secret needs an identifier (a named one, an endpoint will do), and an identifier or endpoint
needs a secret.  Strong candidates are complements too.

The interval join is a sweep: parts sorted by their start carry the last end of each role before them and
the first start after them, so a part meets its nearest complement on each side, and no pairs are made.  A weak part
that overlaps a part that starts earlier, or a strong one, is the same string again and is no candidate.

Matches are counted off from the lengths of the text between them, so places are code points.  All by Spark's
own functions; texts never leave their task, a row's parts do, keyed by a number of the row.

Cases: a null text is empty and has no spans; null ids and repeated rows are scanned as rows of their own;
texts are scanned whole; parts that tie in their start go by the order of KINDS; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import named


def either_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


# The base scan.  A match is kept if its value (group 1 of ASSIGN, else all) is long enough.
ASSIGN = ("(?:" + "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key"))) + ")"
          r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = "AKIA[A-Z0-9]+"
# Runs that hold at least 24; shorter runs would be dropped.
HEX = "[0-9a-f]{24,}"
LEAST_ASSIGN, LEAST_ACCESS = 6, 20

#: Weak parts: settings (name, value), classed by their name; URLs of services; runs of mixed characters.
SETTING = r"""[A-Za-z0-9_]+["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.:=@-]+"""
SETTING_START = "(?<![A-Za-z0-9_])"                       # else Java tries every letter of a long word
NAMES = {
    "secret": "(secret|private|passphrase|credential|passw|pwd|pass$|auth$|token)|(^|_)(secret_?)?key$",
    "identifier": "(^|_)(user|user_?name|login|account|account_?id|client_?id|key_?id|access_?key|access_?key_?id)$",
    "endpoint": "(^|_)(host|host_?name|server|endpoint|base_?url|url|uri|bucket|database)$",
}
URL = r"""(?:https?|ftps?|sftp|ssh|jdbc:[a-z0-9]{1,20}|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|rediss?|amqps?|s3)://[^\x00-\x20"'<>]+"""
MIXED = "[A-Za-z0-9+/_-]{20,}"
LEAST_VALUE = 3
#: A blank line ends a scope.
BLANK = r"\n[\x20\t\r]*\n"
#: Code points between two parts at most.
REACH = 200

#: Kinds in the order of spans that start together; the first three are the base scan's.
KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint", "token")
BASE = 3
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "identifier": "identifier", "secret": "secret",
        "endpoint": "endpoint", "token": "secret"}
BREAK = len(KINDS)


def matches(text: Column, pattern: str, kind) -> Column:
    """All matches, in order: (gap, len, kind) with ``kind(match)`` the number of a kind, or null for none."""
    found = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"))
    found = F.transform(F.slice(found, 1, F.size(found) - 1), lambda m: F.struct(
        F.length(m["gap"]).alias("gap"), F.length(m["match"]).alias("len"), kind(m["match"]).cast("int").alias("kind")))
    return F.when(text.rlike(pattern), found)


def setting_kind(match: Column) -> Column:
    name = F.lower(F.regexp_extract(match, "^[A-Za-z0-9_]+", 0))
    value = F.length(F.regexp_extract(match, r"""^[A-Za-z0-9_]+["']?\x20*[:=]\x20*["']?(.*)$""", 1))
    out = F.when(value < LEAST_VALUE, F.lit(None))
    for role, rx in NAMES.items():
        out = out.when(name.rlike(rx), KINDS.index(role))
    return out


def candidates(text: Column) -> list[Column]:
    """The matches of each pattern, as arrays."""
    mixed = lambda m: F.when(m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]"), KINDS.index("token"))
    return [
        matches(text, ASSIGN, lambda m: F.when(F.length(F.regexp_extract(m, ASSIGN, 1)) >= LEAST_ASSIGN, 0)),
        matches(text, ACCESS, lambda m: F.when(F.length(m) >= LEAST_ACCESS, 1)),
        matches(text, HEX, lambda m: F.lit(2)),
        matches(text, SETTING_START + SETTING, setting_kind),
        matches(text, URL, lambda m: F.lit(KINDS.index("endpoint"))),
        matches(text, MIXED, mixed),
    ]


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per match that is a part or ends a scope: row, id, kind, st, en; a row without any has nulls there.

    Partitioned by row."""
    text = F.coalesce(docs[named(text_col)], F.lit(""))
    lists = docs.select(F.monotonically_increasing_id().alias("row"), docs[named(id_col)].alias("id"), text.alias("text"),
                        *[c.alias(f"m{i}") for i, c in enumerate(candidates(text))])
    weak = F.exists(F.concat(*[F.coalesce(F.col(f"m{i}"), F.array()) for i in (3, 4, 5)]), lambda m: m["kind"].isNotNull())
    lists = lists.withColumn("m6", F.when(weak, matches(F.col("text"), BLANK, lambda m: F.lit(BREAK))))
    some = F.filter(F.array(*[F.struct(F.lit(i).alias("pattern"), F.col(f"m{i}").alias("found")) for i in range(7)]),
                    lambda x: F.exists(x["found"], lambda m: m["kind"].isNotNull()))
    exploded = lists.select("row", "id", F.explode_outer(some).alias("x")).select(
        "row", "id", "x.pattern", F.posexplode_outer("x.found").alias("i", "m")).select("row", "id", "pattern", "i", "m.*")
    before = Window.partitionBy("row", "pattern").orderBy("i")
    counted = exploded.repartition("row").withColumn("en", F.sum(F.col("gap") + F.col("len")).over(before))
    return counted.where("kind IS NOT NULL OR pattern IS NULL").select(
        "row", "id", "kind", (F.col("en") - F.col("len")).alias("st"), "en")


def linked(found: DataFrame, reach: int = REACH) -> DataFrame:
    """The rows of ``parts`` that are reported: strong parts, and weak ones with a complement; a row without any keeps one
    row of nulls."""
    order = ["st", "kind", "en"]
    ahead = Window.partitionBy("row").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("row").orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    strong, part = F.col("kind") < BASE, F.col("kind") < BREAK
    swept = found.select(
        "*", F.max(F.when(part, F.col("en"))).over(ahead).alias("_covered"),
        F.count(F.when(F.col("kind") == BREAK, 1)).over(ahead).alias("scope")).withColumn(
        "_next_strong", F.min(F.when(strong, F.col("st"))).over(back))
    again = ~strong & ((F.col("_covered") > F.col("st")) | (F.col("_next_strong") < F.col("en")))
    kept = swept.where("kind IS NULL OR NOT " + f"kind = {BREAK}").where(F.col("kind").isNull() | ~F.coalesce(again, F.lit(False)))

    def role(*names: str) -> Column:
        return F.col("kind").isin(*[i for i, k in enumerate(KINDS) if ROLE[k] in names])

    ahead = Window.partitionBy("row", "scope").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    back = Window.partitionBy("row", "scope").orderBy(*[F.desc(c) for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    roles = ("secret", "identifier", "endpoint")
    near = kept.select("*", *[F.max(F.when(role(r), F.col("en"))).over(ahead).alias(f"_end_{r}") for r in roles])
    near = near.select("*", *[F.min(F.when(role(r), F.col("st"))).over(back).alias(f"_start_{r}") for r in roles])

    def beside(r: str) -> Column:
        return F.coalesce(F.col("st") - F.col(f"_end_{r}") <= reach, F.lit(False)) | F.coalesce(F.col(f"_start_{r}") - F.col("en") <= reach, F.lit(False))

    kind = {k: F.col("kind") == i for i, k in enumerate(KINDS)}
    complete = ((kind["secret"] & (beside("identifier") | beside("endpoint"))) | (kind["token"] & beside("identifier"))
                | ((kind["identifier"] | kind["endpoint"]) & beside("secret")))
    return near.select("row", "id", "st", "en", F.when(strong | complete, F.col("kind")).alias("kind"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """One row per row: id, spans (kind, start, end; by start, then kind) of the strong parts and the linked weak ones."""
    names = F.array(*map(F.lit, KINDS))
    spans = F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull(), F.struct(F.col("st").alias("start"), "kind", F.col("en").alias("end")))))
    rows = linked(parts(docs, id_col, text_col), reach).groupBy("row", "id").agg(spans.alias("spans"))
    return rows.select(F.col("id").alias(id_col), F.transform("spans", lambda s: F.struct(
        F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def written_spans(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
