"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import secrets
from .license_scan import COVERED, LEAST_VOTES, NEIGHBOUR, PHRASES, STRETCH, TEMPLATES
from .sharding import BUCKETS

CUT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


# The value of a setting.
VALUE = r"""^[A-Za-z0-9_]+["']?\x20*[:=]\x20*["']?(.*)$"""


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


EXACT_DEDUP = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS n FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT t.doc_id, g.keep_id, g.group_size,
       row_number() OVER (PARTITION BY t.text ORDER BY t.doc_id DESC NULLS LAST, t.n) = 1 AS kept, sha256(t.text) AS text_sha256
FROM t JOIN g ON t.text = g.text
"""


def crc32(hex_digits: str) -> str:
    """crc32 of the bytes written as hex digits: the bytes drive the table of 256 remainders."""
    byte = f"CAST(('0x' || substr({hex_digits}, 2 * i + 1, 2)) AS BIGINT)"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length({hex_digits}) // 2), lambda i: {byte})), "
            f"lambda c, b: xor(c >> 8, remainders[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)")


CRC_TABLE = ("SELECT list_transform(range(256), lambda b: list_reduce([b::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], "
             "lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END)) AS remainders")


def manifest(fan: int = 8) -> str:
    """Built and folded from the leaves up (the query descends from the root)."""
    def leaf(text: str) -> str:
        fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}) || ':' || {x} END" for x in fields) + ")"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def levels(name: str, leaves: str) -> str:
        return f"""
{name} AS (SELECT g, 0 AS h, idx, n, digest FROM {leaves}
  UNION ALL SELECT g, h + 1, idx // {fan}, (n + {fan - 1}) // {fan}, sha256(string_agg(digest, '' ORDER BY idx)) FROM {name} WHERE n > 1
  GROUP BY g, h, idx // {fan}, n),
{name}_runs AS (SELECT g, h, idx // {fan} AS block, list(digest ORDER BY idx) AS run FROM {name} WHERE n > 1 GROUP BY g, h, idx // {fan})"""

    def folds(name: str, start: str, tree: str) -> str:
        left, right = f"array_to_string(run[1:idx % {fan}], '')", f"array_to_string(run[idx % {fan} + 2:{fan}], '')"
        return f"""
{name} AS (SELECT r, g, 0 AS h, idx, n, path, digest FROM {start}
  UNION ALL SELECT f.r, f.g, f.h + 1, f.idx // {fan}, (f.n + {fan - 1}) // {fan}, f.path || {left} || {right}, sha256({left} || f.digest || {right})
  FROM {name} f JOIN {tree}_runs t ON f.g = t.g AND f.h = t.h AND f.idx // {fan} = t.block WHERE f.n > 1)"""

    return f"""
WITH RECURSIVE crc_table AS ({CRC_TABLE}),
d AS (SELECT row_number() OVER () AS r, * FROM documents),
c AS (SELECT *, {crc32("hex(encode(CAST(doc_id AS VARCHAR)))")} AS crc FROM d, crc_table),
l AS (SELECT r, doc_id, lang, {leaf('text')} AS leaf, CASE WHEN crc % 3 = 0 THEN {leaf(low)} ELSE {leaf('text')} END AS checked FROM c),
leaves AS (SELECT r, doc_id, leaf AS digest, checked, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g, count(*) OVER (PARTITION BY lang) AS n,
                  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS idx FROM l),{levels('nodes', 'leaves')},
subroots AS (SELECT g AS idx, 0 AS g, count(*) OVER () AS n, digest FROM nodes WHERE n = 1),{levels('tops', 'subroots')},
first_fold AS (SELECT r, g, idx, n, '' AS path, checked AS digest FROM leaves),{folds('up', 'first_fold', 'nodes')},
second_fold AS (SELECT r, 0 AS g, g AS idx, (SELECT count(*) FROM subroots) AS n, path, digest FROM up WHERE n = 1),{folds('over', 'second_fold', 'tops')},
roots AS (SELECT digest AS root FROM tops WHERE n = 1)
SELECT doc_id, l.digest AS leaf, s.digest AS subroot, root, sha256(path) AS proof_sha256, o.digest AS folded_root, o.digest = root AS verified
FROM leaves l JOIN subroots s ON l.g = s.idx JOIN over o ON o.r = l.r AND o.n = 1, roots
"""


def sharding(shards: int = 16) -> str:
    def score(s: int) -> str:
        return f"1.0 / -ln((CAST(('0x' || substr(md5('{s}|' || key), 1, 13)) AS BIGINT)::DOUBLE + 0.5) / 4503599627370496.0)"

    def best(n: int) -> str:
        return f"list_position(scores[1:{n}], list_max(scores[1:{n}])) - 1"

    return f"""
WITH crc_table AS ({CRC_TABLE}),
t AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'null') AS key, coalesce(text, '') AS text FROM documents),
h AS (SELECT doc_id, key, hex(encode(text)) AS digits, strlen(text) + 1 AS size FROM t),
c AS (SELECT doc_id, key, size, {crc32('digits')} AS text_crc32, [{', '.join(score(s) for s in range(shards + 1))}] AS scores FROM h, crc_table),
s AS (SELECT doc_id, key, size, text_crc32, {best(shards)} AS shard, {best(shards + 1)} AS grown_shard,
             floor((CAST(('0x' || substr(md5(key || '|' || CAST(text_crc32 AS VARCHAR)), 1, 13)) AS BIGINT)::DOUBLE + 0.5)
                   / 4503599627370496.0 * {BUCKETS}) AS bucket FROM c)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       CAST(grown_shard AS INTEGER) AS grown_shard
FROM s
"""


def license_scan() -> str:
    texts = [(label, True, p) for p, label in PHRASES.items()] + [(label, False, t) for label, ts in TEMPLATES.items() for t in ts]
    rows = ", ".join(f"({n}, {q(label)}, {base}, {q(t)})" for n, (label, base, t) in enumerate(texts))
    return f"""
WITH templates(template, label, base, txt) AS (VALUES {rows}),
tw AS (SELECT template, label, base, string_split(txt, ' ') AS tw FROM templates),
pairs AS (SELECT template, label, base, len(tw) - 1 AS pairs, i - 1 AS spot, tw[i] AS a, tw[i + 1] AS b
          FROM (SELECT *, unnest(range(1, len(tw))) AS i FROM tw)),
d AS (SELECT row_number() OVER () AS rid, doc_id,
             list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               {q(CUT)}), lambda x: x <> '') AS w FROM documents),
two AS (SELECT rid, pos - 1 AS pos, w[pos] AS a, w[pos + 1] AS b FROM (SELECT rid, w, unnest(range(1, len(w))) AS pos FROM d)),
votes AS (SELECT rid, template, label, base, pairs, pos - spot AS diagonal, count(*) AS votes, bit_or(1::BIGINT << spot) AS covers,
                 min(pos) AS low, max(pos) AS high
          FROM two JOIN pairs USING (a, b) GROUP BY ALL),
places AS (SELECT rid, count(*) AS n, min(diagonal) AS first_word, max(diagonal) AS last_word, list(DISTINCT label) AS labels
           FROM votes WHERE base AND votes = pairs GROUP BY rid),
strong AS (SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY rid, template ORDER BY diagonal) AS gap
           FROM votes WHERE NOT base AND votes >= least(pairs, {LEAST_VOTES})),
spans AS (SELECT rid, template, label, pairs, max(bit_count(covers)) / pairs AS alone, bit_count(bit_or(covers)) / pairs AS share, min(low) AS low, max(high) AS high
          FROM (SELECT *, sum(CASE WHEN gap <= {NEIGHBOUR} THEN 0 ELSE 1 END) OVER (PARTITION BY rid, template ORDER BY diagonal) AS span FROM strong)
          GROUP BY rid, template, label, pairs, span),
found AS (SELECT rid, max(share) AS share, list(DISTINCT label) FILTER (alone >= {COVERED} OR share >= {COVERED} AND high - low + 1 <= ceil(pairs * {STRETCH})) AS labels
          FROM spans GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, first_word, last_word,
       array_to_string(list_sort(coalesce(p.labels, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(coalesce(p.labels, []) || coalesce(f.labels, []))), ',') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(share, 0.0) END AS score
FROM d LEFT JOIN places p USING (rid) LEFT JOIN found f USING (rid)
"""


def url_rules(listed: list[tuple[str, str, str]], support: float = 0.002, confidence: float = 0.9, lift: float = 1.1, most: int = 4) -> str:
    rules = ", ".join(f"({q(h)}, {q(p)}, {q(v)})" for h, p, v in listed)
    # token sets of up to four of a URL's tokens, in order
    sets = " UNION ALL ".join(
        f"SELECT url, verdict, [{', '.join(f't{i}.token' for i in range(n))}] AS tokens FROM tok t0 "
        + " ".join(f"JOIN tok t{i} ON t{i}.n = t0.n AND t{i}.token > t{i - 1}.token" for i in range(1, n)).replace("ON t", "ON t")
        for n in range(1, most + 1)).replace("SELECT url, verdict", "SELECT t0.n, t0.verdict")
    return f"""
WITH listed(h, p, v) AS (VALUES {rules}),
u AS (SELECT page_id, row_number() OVER () AS n, url,
             translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
             regexp_extract(coalesce(url, ''), '(?s)\\?([^#]*)', 1) AS query FROM pages),
r AS (SELECT *, (SELECT max({{'n': length(h || p), 'verdict': v, 'rule': h || p}}) FROM listed
                 WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best FROM u),
named AS (SELECT *, string_split(host, '.') AS labels, regexp_extract(path, '\\.([A-Za-z0-9]{{1,8}})$', 1) AS ext FROM r WHERE host <> ''),
tok0 AS (SELECT n, url, best.verdict AS verdict, list_distinct(
    list_transform(list_filter(labels, lambda x: x <> ''), lambda x: 'host:' || x)
    || CASE WHEN len(labels) >= 2 THEN ['site:' || labels[-2] || '.' || labels[-1]] ELSE [] END
    || list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: CASE WHEN regexp_matches(x, '^[0-9]+') THEN 'path:#' ELSE 'path:' || x END)
    || CASE WHEN ext <> '' THEN ['ext:' || ext] ELSE [] END
    || list_transform(list_filter(string_split(query, '&'), lambda x: x <> ''), lambda x: 'query:' || string_split(x, '=')[1])) AS tokens FROM named),
tok AS (SELECT n, verdict, unnest(tokens) AS token FROM tok0 WHERE verdict IS NOT NULL),
total AS (SELECT count(*) AS n FROM tok0 WHERE verdict IS NOT NULL),
share AS (SELECT verdict AS v, count(*) / (SELECT n FROM total) AS p FROM tok0 WHERE verdict IS NOT NULL GROUP BY verdict),
sets AS ({sets}),
counted AS (SELECT tokens, verdict, count(*) AS c, sum(count(*)) OVER (PARTITION BY tokens) AS c_all FROM sets GROUP BY tokens, verdict),
mined AS (SELECT tokens, verdict AS label, c / c_all AS confidence, c / (SELECT n FROM total) AS support
          FROM counted JOIN share ON v = verdict
          WHERE c >= ceil({support} * (SELECT n FROM total)) AND c / c_all >= {confidence} AND c / c_all / p >= {lift}),
parts AS (SELECT tokens, label, confidence, unnest(list_transform(tokens, lambda x: [x]) || list_transform(tokens, lambda x: list_filter(tokens, lambda y: y <> x))) AS part
          FROM mined WHERE len(tokens) > 1),
kept AS (SELECT m.* FROM mined m WHERE NOT EXISTS (SELECT 1 FROM parts x JOIN mined s ON s.tokens = x.part AND s.label = x.label AND s.confidence >= x.confidence
                                                   WHERE x.tokens = m.tokens AND x.label = m.label)),
held AS (SELECT t.n, max({{'confidence': k.confidence, 'support': k.support, 'label': k.label, 'tokens': k.tokens}}) AS m
         FROM tok0 t JOIN kept k ON list_has_all(t.tokens, k.tokens) WHERE t.verdict IS NULL GROUP BY t.n)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, m.label, 'allow') AS verdict, array_to_string(m.tokens, ' ') AS mined_tokens, m.confidence AS mined_confidence
FROM r LEFT JOIN held USING (n)
"""


def secret_scan() -> str:
    """Links by a join of intervals (the query sweeps); base matches by the patterns of the contract."""
    kinds = secrets.KINDS
    patterns = [
        (secrets.ASSIGN, f"CASE WHEN length(regexp_extract(x, {q(secrets.ASSIGN)}, 1)) >= {secrets.LEAST_ASSIGN} THEN 0 END"),
        (secrets.ACCESS, f"CASE WHEN length(x) >= {secrets.LEAST_ACCESS} THEN 1 END"),
        ("[0-9a-f]+", "CASE WHEN length(x) >= 24 THEN 2 END"),
        (secrets.SETTING, f"CASE WHEN length(regexp_extract(x, {q(VALUE)}, 1)) < {secrets.LEAST_VALUE} THEN NULL "
         + " ".join(f"WHEN regexp_matches(lower(regexp_extract(x, '^[A-Za-z0-9_]+')), {q(rx)}) THEN {kinds.index(role)}"
                    for role, rx in secrets.NAMES.items()) + " END"),
        (secrets.URL, str(kinds.index("endpoint"))),
        (secrets.MIXED, f"CASE WHEN regexp_matches(x, '[0-9]') AND regexp_matches(x, '[a-z]') AND regexp_matches(x, '[A-Z]') THEN {kinds.index('token')} END"),
        (secrets.BLANK, str(secrets.BREAK)),
    ]
    scans = "\nUNION ALL ".join(f"""SELECT r, {kind} AS kind, sum(g + length(x)) OVER (PARTITION BY r ORDER BY i) - length(x) AS st, length(x) AS len
FROM (SELECT r, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS x, unnest(list_transform(gaps[1:len(m)], lambda s: length(s))) AS g
      FROM (SELECT r, regexp_extract_all(txt, {q(rx)}) AS m, regexp_split_to_array(txt, {q(rx)}) AS gaps FROM d WHERE regexp_matches(txt, {q(rx)})))"""
                                 for rx, kind in patterns)
    role = "CASE " + " ".join(f"WHEN p.kind = {i} THEN {q(secrets.ROLE[k])}" for i, k in enumerate(kinds)) + " END"
    number = {k: i for i, k in enumerate(kinds)}
    names = "[" + ", ".join(map(q, kinds)) + "]"
    joined = f"string_agg({names}[kind + 1] || ':' || st || ':' || en, ',' ORDER BY st, kind)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS txt FROM documents),
found AS (SELECT r, kind, CAST(st AS BIGINT) AS st, CAST(st + len AS BIGINT) AS en FROM ({scans}) WHERE kind IS NOT NULL),
scoped AS (SELECT *, count(*) FILTER (kind = {secrets.BREAK}) OVER (PARTITION BY r ORDER BY st, kind, en ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS scope,
                  max(en) FILTER (kind < {secrets.BREAK}) OVER (PARTITION BY r ORDER BY st, kind, en ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS covered FROM found),
parts AS (SELECT p.*, {role} AS role FROM scoped p WHERE kind < {secrets.BASE} OR kind < {secrets.BREAK} AND coalesce(covered, 0) <= st
          AND NOT EXISTS (SELECT 1 FROM found b WHERE b.r = p.r AND b.kind < {secrets.BASE} AND b.st >= p.st AND b.st < p.en)),
kept AS (SELECT * FROM parts p WHERE kind < {secrets.BASE} OR EXISTS (SELECT 1 FROM parts c WHERE c.r = p.r AND c.scope = p.scope
           AND (c.en <= p.st AND p.st - c.en <= {secrets.REACH} OR c.st >= p.en AND c.st - p.en <= {secrets.REACH})
           AND CASE WHEN p.kind = {number['secret']} THEN c.role IN ('identifier', 'endpoint')
                    WHEN p.kind = {number['token']} THEN c.role = 'identifier' ELSE c.role = 'secret' END)),
spans AS (SELECT r, {", ".join(f"count(*) FILTER (kind = {i}) AS n_{k}" for i, k in enumerate(kinds[:secrets.BASE]))},
                 {joined.replace("ORDER BY st, kind)", "ORDER BY st, kind) FILTER (kind < " + str(secrets.BASE) + ")")} AS base, {joined} AS spans FROM kept GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in kinds[:secrets.BASE])}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN spans USING (r)
"""
