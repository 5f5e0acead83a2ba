"""DuckDB twins of the registered queries (the driver's correctness gate).

Each query is a chain of CTEs over the pre-registered views (``documents``, ``pages``).  The SQL is
written against DuckDB's dialect: RE2 regexes (no possessive loops), 1-based lists, ``lambda`` syntax.
"""

from __future__ import annotations

from .functions.draws import DEFAULT_SEED
from .sources.corpus import DIRS, FILE_HEAD, FILE_TAIL, FORMS, N_TEMPLATES, RET_TYPES, STATEMENTS, split_template

# The token pattern of ``operators.tokens.TOKEN_RX`` in RE2 syntax.
TOKEN_RX_RE2 = (
    r"[ \t\n\x0b\x0c\r]*(?:"
    r'extern[ \t\n\x0b\x0c\r]*"C"[ \t\n\x0b\x0c\r]*\{'
    r"|/\*(?s:.*?)(?:\*/|\z)"
    r"|//[^\\\n]*(?:\\(?s:.)[^\\\n]*)*"
    r'|"[^"\\\n]*(?:\\(?s:.)[^"\\\n]*)*"?'
    r"|'[^'\\\n]*(?:\\(?s:.)[^'\\\n]*)*'?"
    r'|#[^\n\\/"]*(?:(?://[^\\\n]*(?:\\(?s:.)[^\\\n]*)*|/\*(?s:.*?)(?:\*/|\z)|"[^"\\\n]*(?:\\(?s:.)[^"\\\n]*)*"?'
    r'|\\(?s:.)|/)[^\n\\/"]*)*'
    r"|[A-Za-z_][A-Za-z0-9_]*"
    r"|\.?[0-9](?:[eEpP][+-]|[0-9A-Za-z_.])*"
    r"|<<=|>>=|\.\.\.|->|\+\+|--|<<|>>|<=|>=|==|!=|&&|\|\||[-+*/%&^|]=|##"
    r"|(?s:.))"
    r"|[ \t\n\x0b\x0c\r]+"
)
DIRECTIVE_RE2 = (r'//[^\\\n]*(?:\\(?s:.)[^\\\n]*)*|/\*(?s:.*?)(?:\*/|\z)|"[^"\\\n]*(?:\\(?s:.)[^"\\\n]*)*"?'
                 r'|\\(?s:.)|[^/"\\]+|(?s:.)')
BLANKS_SQL = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
LB_RE2 = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
PY_SPACE_RE2 = r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SEED = DEFAULT_SEED


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def _render(t: str, values: dict[str, str]) -> str:
    parts = [q(x) if kind == "lit" else f"({values[x]})" for kind, x in split_template(t)]
    return "(" + " || ".join(parts) + ")"


def draw(key: str, salt: str, extra: str | None = None) -> str:
    parts = [q(str(SEED)), key, q(salt)]
    if extra is not None:
        parts.append(f"CAST({extra} AS VARCHAR)")
    return f"('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 15))::BIGINT"


def splitlines(x: str) -> str:
    a = f"regexp_split_to_array({x}, {q(LB_RE2)})"
    return f"(CASE WHEN {a}[-1] = '' THEN {a}[1:len({a}) - 1] ELSE {a} END)"


def py_strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + PY_SPACE_RE2 + '+|' + PY_SPACE_RE2 + '+' + chr(92) + 'z')}, '', 'g')"


def sl(s: str, i: str | None = None, j: str | None = None) -> str:
    """Python s[i:j] with 0 <= i, j <= len(s)."""
    i = "0" if i is None else i
    if j is None:
        return f"substring({s}, CAST(({i}) + 1 AS BIGINT))"
    return (f"(CASE WHEN ({j}) > ({i}) THEN substring({s}, CAST(({i}) + 1 AS BIGINT), CAST(({j}) - ({i}) AS BIGINT)) "
            f"ELSE '' END)")


# ---------------------------------------------------------------- corpus


def corpus_cte() -> str:
    c = "replace(l, '*/', '* /')"
    s = "replace(replace(l, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"')"
    k = "CAST(length(l) AS VARCHAR)"
    cases = " ".join(f"WHEN {n} THEN {_render(t, {'c': c, 's': s, 'k': k})}" for n, t in enumerate(STATEMENTS))
    stmt = f"CASE (doc_id + i - 1) % {N_TEMPLATES} {cases} END"
    ret = "[" + ", ".join(q(r) for r in RET_TYPES) + "][doc_id % 3 + 1]"
    vals = {"id": "CAST(doc_id AS VARCHAR)", "r": ret, "m": "CAST(doc_id % 100 AS VARCHAR)"}
    dirs = "[" + ", ".join(q(d) for d in DIRS) + "][doc_id % 7 + 1]"
    ext = "CASE WHEN doc_id % 11 = 0 THEN '.h' WHEN doc_id % 11 = 1 THEN '.C' ELSE '.c' END"
    body = f"array_to_string(list_transform(string_split(coalesce(text, ''), chr(10)), lambda l, i: {stmt}), '')"
    return f"""corpus AS (
  SELECT '/corpus/' || source || '/' || {dirs} || '/doc_' || CAST(doc_id AS VARCHAR) || {ext} AS file_path,
         doc_id,
         {_render(FILE_HEAD, vals)} || {body} || {_render(FILE_TAIL, vals)}
           || [{', '.join(_render(t, vals) for t in FORMS)}][doc_id % {len(FORMS)} + 1] AS text
  FROM documents
)"""


# ---------------------------------------------------------------- tokens / structure / blocks


def tokens_cte(name: str, src: str, keys: list[str], text: str = "text") -> str:
    k = ", ".join(keys)
    pk = ", ".join(keys)
    kind = """CASE WHEN starts_with(tok, '/*') OR starts_with(tok, '//') THEN 'comment'
                WHEN starts_with(tok, 'extern') AND ends_with(tok, '{{') THEN 'pp'
                WHEN left(tok, 1) = '"' THEN 'str'
                WHEN left(tok, 1) = '''' THEN 'chr'
                WHEN left(tok, 1) = '#' THEN 'pp'
                WHEN regexp_matches(tok, '^[A-Za-z_]') THEN 'id'
                WHEN regexp_matches(tok, '^\\.?[0-9]') THEN 'num'
                WHEN tok = chr(10) THEN 'nl'
                WHEN regexp_matches(tok, '^[ \\t\\x0b\\x0c\\r]') THEN 'ws'
                ELSE 'op' END"""
    return f"""{name}_raw AS (
  SELECT {k}, unnest(t) AS mtext, unnest(range(len(t))) AS pos
  FROM (SELECT {k}, regexp_extract_all({text}, {q(TOKEN_RX_RE2)}, 0) AS t FROM {src})
),
{name}_l AS (
  SELECT *, length(mtext) - length(tok) AS lead,
         length(substring(mtext, 1, length(mtext) - length(tok)))
           - length(translate(substring(mtext, 1, length(mtext) - length(tok)), chr(10) || chr(13) || chr(11) || chr(12), ''))
           AS lead_nb
  FROM (SELECT *, ltrim(mtext, {BLANKS_SQL}) AS tok FROM {name}_raw) WHERE tok <> ''
),
{name}_k AS (
  SELECT *, lead_nb + CASE WHEN kind = 'nl' THEN 1 WHEN kind IN ('id', 'num') THEN 0
                           ELSE len(regexp_split_to_array(tok, {q(LB_RE2)})) - 1 END AS row_nb
  FROM (SELECT *, {kind} AS kind FROM {name}_l)
),
{name} AS (
  SELECT {k}, pos, tok, kind,
    CAST(coalesce(sum(length(mtext)) OVER (PARTITION BY {pk} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         + lead AS BIGINT) AS st,
    CAST(coalesce(sum(row_nb) OVER (PARTITION BY {pk} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         + lead_nb AS BIGINT) AS nb,
    CAST(coalesce(sum(length(mtext)) OVER (PARTITION BY {pk} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
         + lead + length(tok) AS BIGINT) AS en
  FROM {name}_k
)"""


TYPE_KW_SQL = ("('char','const','double','enum','float','int','long','short','signed','struct','union',"
               "'unsigned','void','volatile','_Bool','_Complex')")
C_KEYWORDS_SQL = ("('auto','break','case','char','const','continue','default','do','double','else','enum','extern',"
                  "'float','for','goto','if','inline','int','long','register','restrict','return','short','signed',"
                  "'sizeof','static','struct','switch','typedef','union','unsigned','void','volatile','while',"
                  "'_Bool','_Complex','_Imaginary')")


def comments_cte(name: str, toks: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""{name}_p AS (
  SELECT {k}, pos, st, unnest(p) AS part, unnest(range(len(p))) AS i
  FROM (SELECT *, regexp_extract_all(tok, {q(DIRECTIVE_RE2)}, 0) AS p FROM {toks} WHERE kind = 'pp')
),
{name} AS (
  SELECT {k}, st, en FROM {toks} WHERE kind = 'comment'
  UNION ALL
  SELECT {k}, s0 AS st, s0 + length(part) AS en
  FROM (SELECT *, CAST(st + coalesce(sum(length(part)) OVER (PARTITION BY {k}, pos ORDER BY i
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s0 FROM {name}_p)
  WHERE starts_with(part, '/*') OR starts_with(part, '//')
)"""


QUALIFIERS_SQL = "('const', 'volatile', 'restrict')"
TAGS_SQL = "('struct', 'union', 'enum')"
NO_TYPES_SQL = "('break', 'case', 'continue', 'default', 'do', 'else', 'for', 'goto', 'if', 'return', 'sizeof', 'switch', 'while')"
ATTRIBUTES_SQL = "('__attribute__', '__attribute', '__declspec', '__asm__', '__asm', 'asm', '_Alignas', 'alignas')"


def views_cte(name: str, toks: str, keys: list[str], inside: bool = False) -> str:
    """Tokens per view: without those of the branches that a view does not take of an unbalanced group."""
    k = ", ".join(keys)
    cond = f"""CASE WHEN kind <> 'pp' THEN NULL WHEN regexp_matches(tok, '^#[ \\t]*(if|ifdef|ifndef)([^A-Za-z0-9_]|$)') THEN 'if'
       WHEN regexp_matches(tok, '^#[ \\t]*(elif|elifdef|elifndef|else)([^A-Za-z0-9_]|$)') THEN 'el'
       WHEN regexp_matches(tok, '^#[ \\t]*endif([^A-Za-z0-9_]|$)') THEN 'endif' END"""
    first = f"SELECT DISTINCT {k}, -1 AS pos, 'if' AS cond, 0 AS delta FROM {toks} UNION ALL " if inside else ""
    return f"""{name}_c AS (SELECT *, {cond} AS cond FROM {toks}),
{name}_e AS ({first}SELECT {k}, pos, cond, CASE WHEN tok = '{{' THEN 1 WHEN tok = '}}' THEN -1 ELSE 0 END AS delta FROM {name}_c),
{name}_l AS (SELECT *, sum(delta) OVER w AS s, sum(CASE cond WHEN 'if' THEN 1 WHEN 'endif' THEN -1 ELSE 0 END) OVER w + CASE WHEN cond = 'endif' THEN 1 ELSE 0 END AS level
  FROM {name}_e WINDOW w AS (PARTITION BY {k} ORDER BY pos)),
{name}_d AS (SELECT *, count(*) FILTER (cond = 'if') OVER (PARTITION BY {k}, level ORDER BY pos) AS grp,
                    lead(s) OVER (PARTITION BY {k}, level ORDER BY pos) - s AS net FROM {name}_l WHERE cond IS NOT NULL),
{name}_g AS (SELECT *, row_number() OVER w - 1 AS nth, lead(pos) OVER w AS until FROM {name}_d WHERE grp > 0 WINDOW w AS (PARTITION BY {k}, level, grp ORDER BY pos)),
{name}_o AS (SELECT {k}, level, grp, count(*) FILTER (cond <> 'endif') AS n FROM {name}_g GROUP BY ALL
  HAVING count(*) FILTER (cond <> 'endif') > 1 AND max(abs(net)) FILTER (cond <> 'endif') > 0),
{name}_b AS (SELECT {k}, grp, level, g.pos AS lo, g.nth, coalesce(g.until, 9223372036854775807) AS hi FROM {name}_g g JOIN {name}_o USING ({k}, level, grp)
  WHERE g.cond <> 'endif'),
{name}_w AS (SELECT {", ".join("e." + c for c in keys)}, e.lo, any_value(e.nth) AS nth, any_value(e.hi) AS hi, list(a.nth ORDER BY a.lo) AS path
  FROM {name}_b e JOIN {name}_b a ON {" AND ".join(f"a.{c} = e.{c}" for c in keys)} AND a.lo <= e.lo AND e.lo < a.hi GROUP BY {", ".join("e." + c for c in keys)}, e.lo),
{name}_u AS (SELECT DISTINCT {k}, path FROM {name}_w WHERE nth > 0 UNION SELECT DISTINCT {k}, []::BIGINT[] FROM {name}_w),
{name}_v AS (SELECT {k}, path, row_number() OVER (PARTITION BY {k} ORDER BY path) - 1 AS view FROM {name}_u),
{name}_x AS (SELECT {k}, view, w.lo, w.hi FROM {name}_w w JOIN {name}_v v USING ({k}) WHERE w.nth <> coalesce(v.path[len(w.path)], 0)),
{name} AS (SELECT {", ".join("t." + c for c in keys)}, coalesce(v.view, 0) AS view, t.pos, t.tok, t.kind, t.st, t.nb, t.en FROM {name}_c t LEFT JOIN {name}_v v USING ({k})
  WHERE t.cond IS NOT NULL OR NOT EXISTS (SELECT 1 FROM {name}_x x WHERE {" AND ".join(f"x.{c} = t.{c}" for c in keys)} AND x.view = v.view AND t.pos > x.lo AND t.pos < x.hi))"""


def structure_cte(name: str, toks: str, keys: list[str], clamp: bool = False) -> str:
    k = ", ".join(keys)
    bd_expr = (f"bd_raw - least(0, min(bd_raw) OVER (PARTITION BY {k} ORDER BY pos "
               f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))") if clamp else "bd_raw"
    return f"""{name}_p AS (
  SELECT {k}, pos, tok, kind, st, nb,
    lag(tok, 1) OVER w AS prev_tok, lag(kind, 1) OVER w AS prev_kind, lag(tok, 2) OVER w AS prev2_tok,
    last_value(CASE WHEN tok NOT IN {QUALIFIERS_SQL} THEN tok END IGNORE NULLS)
      OVER (PARTITION BY {k} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) AS real2,
    lead(tok, 1) OVER w AS next_tok,
    last_value(CASE WHEN kind <> 'pp' OR ends_with(tok, '{{') THEN {{'tok': tok, 'pos': pos}} END IGNORE NULLS)
      OVER (PARTITION BY {k} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS sig
  FROM {toks} WHERE kind IN ('id', 'num', 'op', 'str', 'chr', 'pp')
  WINDOW w AS (PARTITION BY {k} ORDER BY pos)
),
{name}_a AS (
  SELECT *,
    CAST(sum(CASE WHEN tok = '{{' THEN 1 WHEN tok = '}}' THEN -1 ELSE 0 END) OVER wr AS BIGINT) AS bd_raw,
    CAST(sum(CASE WHEN tok = '(' THEN 1 WHEN tok = ')' THEN -1 ELSE 0 END) OVER wr AS BIGINT) AS pd
  FROM {name}_p
  WINDOW wr AS (PARTITION BY {k} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
{name}_a2 AS (
  SELECT *, {bd_expr} AS bd
  FROM {name}_a
),
{name}_b AS (
  SELECT *, CASE WHEN tok = '{{' THEN bd - 1 ELSE bd END AS depth,
            (CASE WHEN tok = '(' THEN pd - 1 ELSE pd END)
              - coalesce(last_value(CASE WHEN tok IN ('{{', '}}') THEN pd END IGNORE NULLS)
                           OVER (PARTITION BY {k} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS pdepth
  FROM {name}_a2
),
{name}_b2 AS (
  SELECT *, last_value(CASE WHEN prev_tok IS NULL OR prev_tok IN (';', '{{', '}}') OR prev_kind = 'pp' THEN st END IGNORE NULLS) OVER wr AS nstart,
         last_value(CASE WHEN tok = '{{' AND depth = 0 THEN coalesce(prev_tok IN {TAGS_SQL} OR prev_tok = '='
                           OR (prev_kind = 'id' AND prev2_tok IN {TAGS_SQL}), false) END IGNORE NULLS) OVER wr AS typed
  FROM {name}_b
  WINDOW wr AS (PARTITION BY {k} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
{name}_c AS (
  SELECT *, coalesce(lag((depth = 0 AND (tok = ';' OR tok = '}}' AND NOT coalesce(typed, false))) OR kind = 'pp', 1) OVER (PARTITION BY {k} ORDER BY pos), true)
            AND kind <> 'pp' AND NOT coalesce(tok = '{{' AND prev_kind = 'pp' AND sig.tok = ')', false) AS is_start
  FROM {name}_b2
),
{name}_d AS (
  SELECT *, last_value(CASE WHEN is_start THEN st END IGNORE NULLS)
              OVER (PARTITION BY {k} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fstart
  FROM {name}_c
),
{name}_e AS (
  SELECT *,
    CASE WHEN tok = ')' AND lag(tok) OVER wp = '(' THEN lag(prev_tok) OVER wp END AS hdr,
    CASE WHEN tok = ')' AND lag(tok) OVER wp = '(' THEN lag(prev_kind) OVER wp END AS hdr_kind,
    CASE WHEN tok = ')' AND lag(tok) OVER wp = '(' THEN lag(real2) OVER wp END AS hdr2,
    CASE WHEN tok = ')' AND lag(tok) OVER wp = '(' THEN lag(next_tok) OVER wp END AS open_next
  FROM {name}_d
  WINDOW wp AS (PARTITION BY {k}, tok IN ('(', ')'), pdepth ORDER BY pos)
),
{name}_e2 AS (
  SELECT *, coalesce(tok = ')' AND hdr_kind IS NOT NULL
                     AND NOT ((hdr_kind IN ('id', 'num', 'str', 'chr') AND hdr NOT IN ('return', 'case', 'else', 'do'))
                              OR hdr IN (')', ']'))
                     AND (open_next IN {TYPE_KW_SQL} OR prev_tok = '*'), false) AS cast_close
  FROM {name}_e
),
{name}_f AS (
  SELECT *,
    last_value(CASE WHEN tok = ')' AND depth = 0 AND pdepth = 0 AND hdr_kind = 'id' AND hdr NOT IN {C_KEYWORDS_SQL}
                         AND hdr NOT IN {ATTRIBUTES_SQL}
                    THEN {{'pos': pos, 'hdr': hdr, 'hdr2': hdr2, 'fstart': fstart, 'nxt': next_tok}} END IGNORE NULLS)
      OVER (PARTITION BY {k} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS head,
    CASE WHEN tok = '{{' AND lead(tok) OVER wb = '}}' THEN lead(st) OVER wb + 1 END AS close_en,
    CASE WHEN tok = '{{' AND lead(tok) OVER wb = '}}' THEN lead(nb) OVER wb END AS close_nb
  FROM {name}_e2
  WINDOW wb AS (PARTITION BY {k}, tok IN ('{{', '}}'), depth ORDER BY pos)
),
{name} AS (
  SELECT *, lag(hdr) OVER w AS phdr, lag(hdr_kind) OVER w AS phdr_kind, lag(hdr2) OVER w AS phdr2
  FROM {name}_f
  WINDOW w AS (PARTITION BY {k} ORDER BY pos)
)"""


def blocks_cte(name: str, struct: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    hkind = f"""CASE WHEN depth = 0 AND head IS NOT NULL THEN
         CASE WHEN ((prev_tok = ')' AND phdr IN {ATTRIBUTES_SQL}) OR (prev_kind = 'id' AND prev_tok NOT IN {C_KEYWORDS_SQL}
                       AND coalesce(prev2_tok, '') NOT IN {TAGS_SQL})
                    OR (prev_kind = 'pp' AND sig.tok = ')' AND sig.pos = head.pos))
                   AND head.fstart = fstart THEN 'late'
              WHEN prev_tok = ';' AND regexp_matches(head.nxt, '^[A-Za-z_]') THEN 'old' END END"""
    bkind = f"""CASE WHEN hkind IS NOT NULL THEN 'function'
       WHEN prev_tok = ')' THEN
         CASE WHEN phdr IN ('if', 'for', 'while', 'switch') THEN phdr
              WHEN phdr_kind = 'id' AND phdr NOT IN {C_KEYWORDS_SQL} AND NOT (depth = 0 AND phdr IN {ATTRIBUTES_SQL}) THEN CASE WHEN depth = 0 OR regexp_matches(phdr2, '^[A-Za-z_]') AND phdr2 NOT IN {NO_TYPES_SQL} OR phdr2 = '*' THEN 'function' ELSE 'macro' END
              WHEN depth = 0 AND phdr = ')' THEN 'function'
              ELSE 'other' END
       WHEN prev_tok = 'else' THEN 'else'
       WHEN prev_tok = 'do' THEN 'do'
       WHEN depth > 0 AND prev_tok IN (';', '{{', '}}', ':', '(') THEN 'bare'
       ELSE 'other' END"""
    return f"""{name}_h AS (SELECT *, CASE WHEN tok = '{{' THEN {hkind} END AS hkind FROM {struct}),
{name}_a AS (
  SELECT * REPLACE (CASE WHEN hkind IS NULL THEN phdr_kind ELSE 'id' END AS phdr_kind,
                    CASE WHEN hkind IS NULL THEN phdr2 ELSE head.hdr2 END AS phdr2,
                    CASE WHEN hkind IS NOT NULL THEN head.fstart WHEN depth > 0 THEN nstart ELSE fstart END AS fstart,
                    CASE WHEN hkind IS NULL THEN phdr ELSE head.hdr END AS phdr),
         CASE WHEN tok = '{{' AND close_en IS NOT NULL THEN {bkind} END AS bkind FROM {name}_h
),
{name}_b AS (
  SELECT *, unnest(CASE WHEN tok = '{{' THEN [{{'x': depth + 1, 'role': 0}}, {{'x': depth, 'role': 1}}]
                        ELSE [{{'x': depth, 'role': 2}}] END) AS e
  FROM {name}_a
  WHERE (tok = '{{' AND bkind <> 'other') OR tok IN ('case', 'default')
),
{name}_c AS (
  SELECT *,
    last_value(CASE WHEN e.role = 0 THEN bkind END IGNORE NULLS) OVER w AS parent_kind,
    last_value(CASE WHEN e.role = 0 THEN pos END IGNORE NULLS) OVER w AS parent_pos,
    last_value(CASE WHEN e.role = 2 THEN pos END IGNORE NULLS) OVER w AS case_pos
  FROM {name}_b
  WINDOW w AS (PARTITION BY {k}, e.x ORDER BY pos, e.role ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
{name} AS (
  SELECT {k}, st, close_en AS en, depth,
    CASE WHEN bkind = 'bare' AND parent_kind = 'switch' AND case_pos > parent_pos THEN 'case' ELSE bkind END AS kind,
    parent_kind, close_nb - nb + 1 AS n_lines,
    CASE WHEN bkind = 'function' AND phdr_kind = 'id' AND phdr NOT IN {C_KEYWORDS_SQL}
              AND coalesce(phdr2, '') <> '*' THEN phdr END AS name,
    fstart, prev2_tok
  FROM {name}_c WHERE e.role = 1
)"""


def function_spans_ctes() -> list[str]:
    """ftok -> fspan(file_path, func_index, st, en, func_name)."""
    by_view = ["file_path", "view"]
    return [
        views_cte("fview", "ftok", ["file_path"]),
        structure_cte("fsig", "fview", by_view, clamp=True),
        blocks_cte("fblk", "fsig", by_view),
        """fspan AS (
  SELECT file_path, row_number() OVER (PARTITION BY file_path ORDER BY fstart, en) - 1 AS func_index, fstart AS st, en, func_name
  FROM (SELECT file_path, fstart, en, arg_min(name, view) FILTER (name IS NOT NULL) AS func_name FROM fblk WHERE kind = 'function' GROUP BY file_path, fstart, en)
)""",
    ]


def functions_ctes(source_filter: str | None = None) -> str:
    """corpus [-> ftab_in (filtered)] -> ftab(file_path, func_index, func_name, func_def)."""
    src = "ftab_in" if source_filter else "corpus"
    ctes = [corpus_cte()] + ([source_filter] if source_filter else [])
    return ",\n".join(ctes + [
        tokens_cte("ftok", src, ["file_path"]),
        *function_spans_ctes(),
        f"""ftab AS (
  SELECT s.file_path, s.func_index, s.func_name, {sl('c.text', 's.st', 's.en')} AS func_def
  FROM fspan s JOIN {src} c USING (file_path)
)""",
    ])


def with_(ctes: str, final: str) -> str:
    return f"WITH {ctes}\n{final}"


# ---------------------------------------------------------------- statements / binary expressions

STMT_KW_SQL = "('return','goto','break','continue','case','default','if','for','while','do','switch','else')"
DECL_KW_SQL = ("('auto','char','const','double','enum','extern','float','inline','int','long','register','restrict',"
               "'short','signed','static','struct','union','unsigned','void','volatile','_Bool','_Complex',"
               "'_Imaginary','typedef')")
DECL_FOLLOW_SQL = "('=', ';', ',', '[', ')')"
OPERAND_START_SQL = "('(', '-', '+', '!', '~', '*', '&', '++', '--', 'sizeof')"
BOUNDARY_SQL = "(',', ';', '?', ':', '=', '+=', '-=', '*=', '/=', '%=', '&=', '^=', '|=', '<<=', '>>=', '{', '}', 'return', 'case')"
PREC_SQL = ("CASE tok WHEN '*' THEN 10 WHEN '/' THEN 10 WHEN '%' THEN 10 WHEN '+' THEN 9 WHEN '-' THEN 9 "
            "WHEN '<<' THEN 8 WHEN '>>' THEN 8 WHEN '<' THEN 7 WHEN '<=' THEN 7 WHEN '>' THEN 7 WHEN '>=' THEN 7 "
            "WHEN '==' THEN 6 WHEN '!=' THEN 6 WHEN '&' THEN 5 WHEN '^' THEN 4 WHEN '|' THEN 3 WHEN '&&' THEN 2 "
            "WHEN '||' THEN 1 END")
BINOPS_SQL = "('*','/','%','+','-','<<','>>','<','<=','>','>=','==','!=','&','^','|','&&','||')"


def statements_cte(name: str, sig: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    w = f"(PARTITION BY {k} ORDER BY pos)"
    wr = f"(PARTITION BY {k} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    named = "(kind = 'id' AND tok NOT IN {kw})".format(kw=C_KEYWORDS_SQL)
    named1 = "(k1 = 'id')"
    decl = (f"(tok IN {DECL_KW_SQL} OR ({named} AND ({named1} "
            f"OR (t1 = '*' AND k2 = 'id' AND t3 IN {DECL_FOLLOW_SQL}) "
            f"OR (t1 = '*' AND t2 = '*' AND k3 = 'id' AND t4 IN {DECL_FOLLOW_SQL}))))")
    return f"""{name}_0 AS (
  SELECT *, ((tok = ';' AND pdepth = 0) OR tok IN ('{{', '}}', 'else', 'do')
             OR (tok = ')' AND hdr IN ('if', 'for', 'while', 'switch')) OR kind = 'pp') AS b1,
            (tok = ':' AND pdepth = 0) AS colon0,
            tok IN ('=', '(', '[') AS eqish
  FROM {sig}
),
{name}_a AS (
  SELECT *, coalesce(lag(b1, 1) OVER {w}, true) AS after_b1,
    CAST(sum(CAST(colon0 AS INTEGER)) OVER {wr} AS BIGINT) AS cc,
    CAST(sum(CAST(eqish AS INTEGER)) OVER {wr} AS BIGINT) AS eqc,
    lag(pos, 1) OVER {w} AS prev_pos,
    lead(tok, 1) OVER {w} AS t1, lead(kind, 1) OVER {w} AS k1,
    lead(tok, 2) OVER {w} AS t2, lead(kind, 2) OVER {w} AS k2,
    lead(tok, 3) OVER {w} AS t3, lead(kind, 3) OVER {w} AS k3,
    lead(tok, 4) OVER {w} AS t4
  FROM {name}_0
),
{name}_b AS (
  SELECT *,
    last_value(CASE WHEN st1 THEN tok END IGNORE NULLS) OVER {wr} AS s1_tok,
    last_value(CASE WHEN st1 THEN cc - CAST(colon0 AS INTEGER) END IGNORE NULLS) OVER {wr} AS s1_cc,
    last_value(CASE WHEN st1 THEN pos END IGNORE NULLS) OVER {wr} AS s1_pos
  FROM (SELECT *, (after_b1 OR tok IN ('case', 'default')) AND kind <> 'pp' AS st1 FROM {name}_a)
),
{name}_c AS (
  SELECT *, b1 OR (colon0 AND ((s1_tok IN ('case', 'default') AND cc = s1_cc + 1)
                 OR (prev_kind = 'id' AND prev_tok NOT IN {C_KEYWORDS_SQL} AND prev_pos = s1_pos))) AS b2
  FROM {name}_b
),
{name}_d AS (
  SELECT *, last_value(CASE WHEN st2 THEN {{'st': st, 'tok': tok, 'kind': kind, 'decl': {decl},
                                             'eq': eqc - CAST(eqish AS INTEGER)}} END IGNORE NULLS) OVER {wr} AS s
  FROM (SELECT *, (coalesce(lag(b2, 1) OVER {w}, true) OR tok IN ('case', 'default')) AND kind <> 'pp' AS st2
        FROM {name}_c)
),
{name} AS (
  SELECT *, s.st AS s_st, s.tok AS s_tok, s.kind AS s_kind, s.decl AS s_decl,
         (tok = '*' AND s.decl AND eqc = s.eq) AS pointer_star
  FROM {name}_d
)"""


def exprstmt_cte(name: str, stmts: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    return f"""{name} AS (
  SELECT {k}, s_st AS st, st + 1 AS en FROM {stmts}
  WHERE tok = ';' AND pdepth = 0 AND s_tok <> ';' AND s_kind <> 'pp' AND s_tok NOT IN {STMT_KW_SQL}
    AND s_tok NOT IN {DECL_KW_SQL} AND s_tok NOT IN ('{{', '}}') AND NOT s_decl
)"""


def binary_cte(name: str, stmts: str, keys: list[str]) -> str:
    k = ", ".join(keys)
    w = f"(PARTITION BY {k} ORDER BY pos)"
    wr = f"(PARTITION BY {k} ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    wl = f"(PARTITION BY {k}, seg, x ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    wrr = f"(PARTITION BY {k}, seg, x ORDER BY pos DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    prev_operand = (f"((prev_kind IN ('id', 'num', 'str', 'chr') AND prev_tok NOT IN {C_KEYWORDS_SQL}) "
                    f"OR prev_tok IN (']', '++', '--') "
                    f"OR (prev_tok = ')' AND NOT coalesce(phdr IN ('if', 'for', 'while', 'switch'), false) "
                    f"AND NOT coalesce(prev_cast, false)))")
    next_operand = f"(k1 IN ('id', 'num', 'str', 'chr') OR t1 IN {OPERAND_START_SQL})"
    binop = (f"(tok IN {BINOPS_SQL} AND depth >= 1 AND {next_operand} AND NOT pointer_star "
             f"AND (tok NOT IN ('*', '&', '-', '+') OR {prev_operand}))")
    bnd = f"(tok IN {BOUNDARY_SQL} OR kind = 'pp')"
    lefts = ",\n    ".join(
        f"last_value(CASE WHEN tok IN ('(', '[') OR {bnd} OR (binop AND prec < {q}) THEN next_st END IGNORE NULLS) OVER {wl} AS l{q}"
        for q in range(1, 11))
    rights = ",\n    ".join(
        f"last_value(CASE WHEN tok IN (')', ']') OR {bnd} OR (binop AND prec <= {q}) THEN prev_en END IGNORE NULLS) OVER {wrr} AS r{q}"
        for q in range(1, 11))
    larr = "[" + ", ".join(f"l{q}" for q in range(1, 11)) + "]"
    rarr = "[" + ", ".join(f"r{q}" for q in range(1, 11)) + "]"
    return f"""{name}_n AS (
  SELECT *, CAST(sum(CASE WHEN tok IN ('(', '[') THEN 1 WHEN tok IN (')', ']') THEN -1 ELSE 0 END) OVER {wr} AS BIGINT) AS nd_raw,
         CAST(sum(CASE WHEN tok IN ('{{', '}}') THEN 1 ELSE 0 END) OVER {wr} AS BIGINT) AS seg,
         lead(st, 1) OVER {w} AS next_st, lag(st + length(tok), 1) OVER {w} AS prev_en,
         lag(cast_close, 1) OVER {w} AS prev_cast
  FROM {stmts}
),
{name}_x AS (
  SELECT *, CASE WHEN tok IN ('(', '[', ')', ']') THEN nd + 1 ELSE nd END AS x,
         {binop} AS binop, CASE WHEN {binop} THEN {PREC_SQL} END AS prec
  FROM (SELECT *, CASE WHEN tok IN ('(', '[') THEN nd_raw - 1 ELSE nd_raw END AS nd FROM {name}_n)
),
{name}_l AS (SELECT *, {lefts} FROM {name}_x),
{name}_r AS (SELECT *, {rights} FROM {name}_l),
{name} AS (
  SELECT {k}, {larr}[prec] AS st, {rarr}[prec] AS en, tok AS op FROM {name}_r
  WHERE binop AND {larr}[prec] IS NOT NULL AND {rarr}[prec] IS NOT NULL
)"""


# ---------------------------------------------------------------- FIM strategies

BODY_LINE_RE2 = r'(?s)(?:[^"\\\n]+|\\.|\\\z|"[^"\\]*(?:\\.[^"\\]*)*(?:"|\\?\z))+|\n'
MIXTURE_SQL = [("single_line", 5), ("expression", 4), ("binary", 1), ("comment", 2), ("if", 2), ("loop", 3),
               ("switch", 1), ("empty", 2)]
K2 = ["file_path", "func_index", "strategy", "key"]


def strategy_sql(strategy: str | None) -> str:
    if strategy:
        return q(strategy)
    acc, whens = 0, []
    for name, w in MIXTURE_SQL:
        acc += w
        whens.append(f"WHEN {draw('key', 'strategy')} % 20 < {acc} THEN {q(name)}")
    return (f"CASE WHEN n_lines <= 20 AND {draw('key', 'short')} % 10 < 1 THEN 'short' "
            f"ELSE CASE {' '.join(whens)} END END")


def rint(salt: str, lo: str, hi: str) -> str:
    return f"(({lo}) + {draw('key', salt)} % greatest(({hi}) - ({lo}) + 1, 1))"


def fim_ctes(src: str, strategy: str | None = None) -> str:
    """src(file_path, func_index, func_name, func_def) -> fim(file_path, func_index, func_name, prefix,
    middle, suffix, flag, strategy)."""
    s = "func_def"
    kk = ", ".join(K2)
    parts = [f"""fs AS (
  SELECT *, {strategy_sql(strategy)} AS strategy
  FROM (SELECT *, file_path || '#' || CAST(func_index AS VARCHAR) AS key, len({splitlines('func_def')}) AS n_lines
        FROM {src})
)""",
             """fsyn AS (SELECT * FROM fs WHERE strategy IN ('short', 'expression', 'binary', 'comment', 'if', 'loop', 'switch'))""",
             tokens_cte("gtok", "fsyn", K2, "func_def"),
             comments_cte("gcom", "gtok", K2),
             """gtok_nc AS (SELECT * FROM gtok WHERE strategy <> 'comment')""",
             structure_cte("gsig", "gtok_nc", K2),
             """gsel_blk AS (SELECT * FROM gsig WHERE strategy IN ('short', 'if', 'loop', 'switch'))""",
             blocks_cte("gblk", "gsel_blk", K2),
             """gsel_e AS (SELECT * FROM gsig WHERE strategy = 'expression')""",
             statements_cte("gst_e", "gsel_e", K2),
             exprstmt_cte("gexpr", "gst_e", K2),
             """gsel_x AS (SELECT * FROM gsig WHERE strategy = 'binary')""",
             statements_cte("gst_x", "gsel_x", K2),
             binary_cte("gbin", "gst_x", K2),
             f"""cands AS (
  SELECT {kk}, 'comment' AS ctype, st, en, CAST(NULL AS BIGINT) AS n_lines FROM gcom WHERE strategy = 'comment'
  UNION ALL
  SELECT * FROM (
    SELECT {kk}, CASE WHEN strategy = 'short' AND kind = 'function' AND depth = 0 THEN 'body'
                      WHEN strategy = 'if' AND (kind = 'if' OR (kind = 'else' AND prev2_tok = '}}')) THEN 'ifelse'
                      WHEN strategy = 'switch' AND kind = 'case' THEN 'case'
                      WHEN strategy = 'loop' AND kind IN ('for', 'while', 'macro', 'bare') THEN 'loop' END AS ctype,
           st, en, n_lines FROM gblk) WHERE ctype IS NOT NULL
  UNION ALL
  SELECT {kk}, 'expr', st, en, CAST(NULL AS BIGINT) FROM gexpr
  UNION ALL
  SELECT {kk}, 'binary', st, en, CAST(NULL AS BIGINT) FROM gbin
)""",
             f"""pk0 AS (
  SELECT file_path, func_index, count(*) AS n_c,
    min(CASE WHEN h0 IS NOT NULL THEN {{'h': h0, 'st': st, 'en': en, 'n_lines': n_lines}} END) AS p0,
    min(CASE WHEN h1 IS NOT NULL THEN {{'h': h1, 'st': st, 'en': en, 'n_lines': n_lines}} END) AS p1,
    min(CASE WHEN h2 IS NOT NULL THEN {{'h': h2, 'st': st, 'en': en, 'n_lines': n_lines}} END) AS p2
  FROM (SELECT *, CASE WHEN ctype = 'body' THEN st ELSE {draw('key', 'node', "concat_ws(':', st, en)")} END AS h0,
               CASE WHEN strategy = 'loop' THEN {draw('key', 'try1', "concat_ws(':', st, en)")} END AS h1,
               CASE WHEN strategy = 'loop' THEN {draw('key', 'try2', "concat_ws(':', st, en)")} END AS h2
        FROM cands)
  GROUP BY file_path, func_index
)""",
             f"""pbig AS (SELECT file_path, func_index, p0.st AS o_st, p0.en AS o_en FROM pk0 WHERE p0.n_lines > 5)""",
             f"""pnest AS (
  SELECT c.file_path, c.func_index,
    min({{'h': {draw('c.key', 'node2', "concat_ws(':', c.st, c.en)")}, 'st': c.st, 'en': c.en, 'n_lines': c.n_lines}}) AS pn
  FROM cands c JOIN pbig b ON c.file_path = b.file_path AND c.func_index = b.func_index
  WHERE c.ctype = 'ifelse' AND c.st > b.o_st AND c.en < b.o_en
  GROUP BY c.file_path, c.func_index
)""",
             """pk AS (SELECT * FROM pk0 LEFT JOIN pnest USING (file_path, func_index))"""]
    # line pick
    b0 = f"instr({s}, '{{')"
    b1 = f"(CASE WHEN instr({s}, '}}') > 0 THEN length({s}) - 1 - length(regexp_extract({s}, '[^}}]*\\z', 0)) ELSE -1 END)"
    body = f"(CASE WHEN {b1} > {b0} THEN substring({s}, {b0} + 1, {b1} - {b0}) ELSE '' END)"
    parts.append(f"""j0 AS (
  SELECT fs.*, pk.n_c, pk.p0, pk.p1, pk.p2, pk.pn,
    regexp_extract_all({body}, {q(BODY_LINE_RE2)}, 0) AS segs, {b0} AS b0
  FROM fs LEFT JOIN pk USING (file_path, func_index)
)""")
    parts.append(f"""j1 AS (
  SELECT *, list_filter(list_transform(segs, lambda x, i: {{'x': x, 'i': i - 1}}),
                        lambda e: e.x <> chr(10) AND length({py_strip('e.x')}) > 1) AS elig
  FROM j0
)""")
    parts.append(f"""j2 AS (
  SELECT *, CASE WHEN len(elig) > 0 THEN elig[{draw('key', 'line')} % greatest(len(elig), 1) + 1] END AS ch FROM j1
)""")
    parts.append(f"""j3 AS (
  SELECT *, {py_strip('ch.x')} AS line,
    CASE WHEN ch.i = 0 THEN 0 ELSE b0 + CAST(coalesce(list_sum(list_transform(segs[1:ch.i], lambda x: length(x))), 0) AS BIGINT) END AS lstart
  FROM j2
)""")
    parts.append(f"""j4 AS (
  SELECT *, CASE WHEN ch IS NOT NULL THEN {{'p': lp_p, 'snip': lp_p + {rint('chars', '1', 'length(line)')} - 1,
                                           'line_end': lp_p + length(line)}} END AS lp
  FROM (SELECT *, lstart + instr(substring({s}, lstart + 1), line) - 1 AS lp_p FROM j3)
)""")
    fits = lambda p: f"({p}.n_lines <= 20)"
    tries = "least(3, n_c)"
    loop = (f"CASE WHEN {fits('p0')} THEN p0 WHEN {tries} >= 2 AND {fits('p1')} THEN p1 "
            f"WHEN {tries} >= 3 AND {fits('p2')} THEN p2 WHEN {tries} >= 3 THEN p2 WHEN {tries} = 2 THEN p1 ELSE p0 END")
    if_ = "CASE WHEN p0.n_lines <= 5 THEN p0 ELSE coalesce(pn, p0) END"
    parts.append(f"""j5 AS (
  SELECT *, CASE WHEN strategy = 'if' THEN {if_} WHEN strategy = 'loop' THEN {loop} ELSE p0 END AS blk,
    len(list_filter({splitlines(s)}, lambda l: {py_strip('l')} <> '')) >= 5 AS ml_ok
  FROM j4
)""")
    eff = ("CASE WHEN strategy IN ('expression', 'binary') THEN CASE WHEN coalesce(n_c, 0) > 0 THEN strategy "
           "WHEN lp IS NOT NULL THEN 'single_line' ELSE 'useless' END "
           "WHEN strategy IN ('comment', 'if', 'loop', 'switch') THEN CASE WHEN coalesce(n_c, 0) > 0 THEN strategy "
           "WHEN ml_ok THEN 'multi_line' ELSE 'useless' END "
           "WHEN strategy = 'short' THEN CASE WHEN coalesce(n_c, 0) > 0 THEN strategy ELSE 'useless' END "
           "WHEN strategy IN ('single_line', 'empty') THEN CASE WHEN lp IS NOT NULL THEN strategy ELSE 'useless' END "
           "WHEN strategy = 'multi_line' THEN CASE WHEN ml_ok THEN 'multi_line' ELSE 'useless' END "
           "ELSE strategy END")
    parts.append(f"""j6 AS (SELECT *, {eff} AS eff FROM j5)""")
    coin = f"({draw('key', 'trim')} % 10 < 5)"
    part_end = (f"(blk.st + length(array_to_string({splitlines(sl(s, 'blk.st', 'blk.en'))}[1:{rint('longn', '3', '10')}], chr(10))))")
    inner0 = f"(blk.st + 1 + length(regexp_extract(substring({s}, blk.st + 2), '^[ \\t\\n]*', 0)))"
    parts.append(f"""j7 AS (
  SELECT *, eff IN ('if', 'loop', 'switch') AND blk.n_lines > 20 AS long_,
    {coin} AS coin, {part_end} AS part_end, {inner0} AS inner0
  FROM j6
)""")
    blk_i1 = ("CASE WHEN long_ THEN CASE WHEN NOT coin AND inner0 < part_end THEN inner0 ELSE blk.st END "
              "ELSE CASE WHEN coin AND inner0 < blk.en - 1 THEN inner0 ELSE blk.st END END")
    blk_i2 = ("CASE WHEN long_ THEN part_end "
              "ELSE CASE WHEN coin AND inner0 < blk.en - 1 THEN blk.en - 1 ELSE blk.en END END")
    parts.append(f"""j8 AS (
  SELECT *,
    CASE WHEN eff = 'single_line' THEN lp.snip WHEN eff IN ('expression', 'binary', 'short') THEN p0.st
         WHEN eff IN ('if', 'loop', 'switch') THEN {blk_i1} END AS i1,
    CASE WHEN eff = 'single_line' THEN lp.line_end WHEN eff IN ('expression', 'binary', 'short') THEN p0.en
         WHEN eff IN ('if', 'loop', 'switch') THEN {blk_i2} END AS i2
  FROM j7
)""")
    # T4
    lines = f"list_filter({splitlines(s)}, lambda l: {py_strip('l')} <> '')"
    parts.append(f"""m0 AS (SELECT *, {lines} AS nbl FROM j8)""")
    parts.append(f"""m1 AS (SELECT *, {rint('start', '1', 'len(nbl) - 3')} AS ml_start FROM m0)""")
    parts.append(f"""m2 AS (SELECT *, {rint('n', '2', 'least(6, len(nbl) - ml_start)')} AS ml_n FROM m1)""")
    parts.append(f"""m3 AS (SELECT *, nbl[ml_start + 1] AS ml_first, regexp_extract(nbl[ml_start + 1], '^[ \\t]*', 0) AS ml_ind FROM m2)""")
    ml_p = "array_to_string(nbl[1:ml_start], chr(10)) || chr(10) || ml_ind"
    ml_m = "substring(ml_first, length(ml_ind) + 1) || chr(10) || array_to_string(nbl[ml_start + 2:ml_start + ml_n], chr(10))"
    ml_s = "chr(10) || array_to_string(nbl[ml_start + ml_n + 1:len(nbl)], chr(10))"
    # T10
    em_pre = sl(s, "0", "lp.line_end")
    em_ind = f"regexp_extract(regexp_extract({em_pre}, '[^\\n]*\\z', 0), '^[ \\t]*', 0)"
    em_p = f"CASE WHEN {draw('key', 'nl')} % 10 < 7 THEN {em_pre} || chr(10) || {em_ind} ELSE {em_pre} END"
    em_s = sl(s, "lp.line_end")
    # T5
    parts.append(f"""c0 AS (SELECT *, {splitlines(sl(s, 'p0.en + 1'))} AS rl FROM m3)""")
    parts.append("""c1 AS (SELECT *, CASE WHEN coalesce(list_position(rl, ''), 0) > 0 THEN list_position(rl, '') - 1 ELSE 0 END AS bi FROM c0)""")
    parts.append("""c2 AS (SELECT *, array_to_string(rl[1:bi], chr(10)) AS cm_mid0 FROM c1)""")
    parts.append("""c3 AS (SELECT *, length(regexp_extract(cm_mid0, '^[ \\t]*', 0)) AS off FROM c2)""")
    cm_p = f"{sl(s, '0', 'p0.en')} || chr(10) || {sl('cm_mid0', '0', 'off')}"
    cm_m = sl("cm_mid0", "off")
    cm_s = "chr(10) || array_to_string(rl[bi + 1:len(rl)], chr(10))"

    def pick3(cut, ml, em, cm):
        return (f"CASE WHEN eff = 'multi_line' THEN {ml} WHEN eff = 'empty' THEN {em} WHEN eff = 'comment' THEN {cm} "
                f"WHEN eff = 'useless' THEN '' ELSE {cut} END")

    flag = ("CASE eff WHEN 'single_line' THEN 'RANDOM_SINGLE_LINE' WHEN 'expression' THEN 'EXPRESSION_STATEMENT' "
            "WHEN 'binary' THEN 'BINARY_EXPRESSION' WHEN 'useless' THEN 'USELESS' WHEN 'multi_line' THEN 'RANDOM_MULTI_LINE' "
            "WHEN 'empty' THEN 'EMPTY' WHEN 'short' THEN 'SHORT_FUNCTION' WHEN 'comment' THEN 'COMMENT_BLOCK' "
            "WHEN 'if' THEN CASE WHEN long_ THEN 'IF_BLOCK_LONG' ELSE 'IF_BLOCK' END "
            "WHEN 'switch' THEN CASE WHEN long_ THEN 'SWITCH_CASE_LONG' ELSE 'SWITCH_CASE' END "
            "WHEN 'loop' THEN CASE WHEN long_ THEN 'LOOP_BLOCK_LONG' ELSE 'LOOP_BLOCK' END END")
    parts.append(f"""fim AS (
  SELECT file_path, func_index, func_name,
    {pick3(sl(s, '0', 'i1'), ml_p, em_p, cm_p)} AS prefix,
    {pick3(sl(s, 'i1', 'i2'), ml_m, "''", cm_m)} AS middle,
    {pick3(f"CASE WHEN eff = 'short' THEN '' ELSE {sl(s, 'i2')} END", ml_s, em_s, cm_s)} AS suffix,
    {flag} AS flag, strategy
  FROM c3
)""")
    return ",\n".join(parts)


def manifest_cte() -> str:
    dirs = "[" + ", ".join(q(d) for d in DIRS) + "][doc_id % 7 + 1]"
    ext = "CASE WHEN doc_id % 11 = 0 THEN '.h' WHEN doc_id % 11 = 1 THEN '.C' ELSE '.c' END"
    return f"""man AS (
  SELECT '/corpus/' || source || '/' || {dirs} || '/doc_' || CAST(doc_id AS VARCHAR) || {ext} AS file_path, doc_id
  FROM documents
)"""


def rfind_sql(s: str, ch: str) -> str:
    return f"(CASE WHEN instr({s}, {q(ch)}) > 0 THEN length({s}) - 1 - length(regexp_extract({s}, {q('[^' + ch + ']*' + chr(92) + 'z')}, 0)) ELSE -1 END)"


def skip_blank_sql(s: str, i: str) -> str:
    """First index >= i whose char is not space, tab or newline."""
    return f"(({i}) + length(regexp_extract(substring({s}, CAST(({i}) + 1 AS BIGINT)), '^[ \t\n]*', 0)))"
