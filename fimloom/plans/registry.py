"""Registered queries (one per operator of the inventory) and their DuckDB twins.

Every query reads the driver tables: the C corpus is rendered from ``documents`` (one file per
document, ``sources.corpus``), path operators run on paths derived from ``documents`` and ``pages``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import Window

from .. import oracle as O
from ..functions import text as T
from ..functions.draws import bernoulli, choice_index, fkey, randint
from ..operators import lines as L
from ..operators import nodes as N
from ..operators.extract import by_key, file_blocks, function_spans, function_table
from ..operators.strategies import fim, with_strategy
from ..operators.tokens import tokenize
from ..session import decoding, scratch_path
from ..sources import files as S
from ..sources.corpus import corpus, load_documents, render_paths
from ..sources.decode import decode_files, decode_text, encoding_of
from ..sources.jsonl import FIM_SCHEMA, FUNC_SCHEMA, read_jsonl, write_jsonl
from .collect import collect_frame, select_c_sources
from .process import random_select

Query = Callable[[SparkSession, str], DataFrame]
FIM_COLS = ["file_path", "func_index", "func_name", "prefix", "middle", "suffix", "flag"]


def c_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rendered file, whatever its directory and suffix (which files the collect step takes is the
    work of S1-S3 and X4 alone)."""
    return corpus(spark, sf_dir)


_COLLECTED: dict[tuple[str, str], str] = {}


def functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The collect step's output, written once per session and input folder to the checkpoint folder
    (as the reference writes its JSONL between the two stages) and read back by every stage-2 query,
    so stage 2 never recomputes stage 1."""
    k = (spark.sparkContext.applicationId, sf_dir)
    path = _COLLECTED.get(k)
    if path is not None:
        try:
            return spark.read.parquet(path)
        except Exception:          # the folder was cleaned up: write it again
            _COLLECTED.pop(k, None)
    path = scratch_path(spark, "functions")
    function_table(c_files(spark, sf_dir)).write.mode("overwrite").parquet(path)
    _COLLECTED[k] = path
    return spark.read.parquet(path)


def functions_lazy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return function_table(c_files(spark, sf_dir))


# ------------------------------------------------------------------ Spark side

def q_extract_functions(spark, sf_dir):
    return functions_lazy(spark, sf_dir)


def q_function_name(spark, sf_dir):
    return functions_lazy(spark, sf_dir).select("file_path", "func_index", "func_name")


def q_function_process(spark, sf_dir):
    return fim(functions(spark, sf_dir)).select(*FIM_COLS)


def q_strategy_mixture(spark, sf_dir):
    return with_strategy(functions(spark, sf_dir)).select("file_path", "func_index", "n_lines", "strategy")


def _forced(strategy: str) -> Query:
    def run(spark, sf_dir):
        return fim(functions(spark, sf_dir), strategy=strategy).select(*FIM_COLS)
    run.__name__ = f"q_fim_{strategy}"
    return run


FORCED = {
    "fim_single_line": "single_line",
    "fim_expression_statement": "expression",
    "fim_binary_expression": "binary",
    "fim_multi_line": "multi_line",
    "fim_comment_block": "comment",
    "fim_if_block": "if",
    "fim_switch_case": "switch",
    "fim_loop_block": "loop",
    "fim_short_function": "short",
    "fim_empty": "empty",
}




# ------------------------------------------------------------------ sources

# Patterns used by the path queries.
FIND_RX = r"/corpus/src1[0-9]/src/"
PAGE_INCLUDE_RX = r"https://"
PAGE_EXCLUDE_RX = r".*[.]org/"
WALK_ROOT = "/corpus"
WALK_EXCLUDE_RX = r".*/(?:resource|webplugin)$"
WALK_DEPTH = 3


def manifest(spark, sf_dir):
    return render_paths(load_documents(spark, sf_dir))


def q_scan_c_sources(spark, sf_dir):
    return select_c_sources(manifest(spark, sf_dir)).select("file_path")


def q_scan_c_and_headers(spark, sf_dir):
    return select_c_sources(manifest(spark, sf_dir), suffixes=(".c", ".h")).select("file_path")


def q_skip_dirs(spark, sf_dir):
    return manifest(spark, sf_dir).select("file_path", S.in_skipped_dir(F.col("file_path")).alias("skipped"))


def q_find_files_regex(spark, sf_dir):
    return manifest(spark, sf_dir).filter(S.regex_match(F.col("file_path"), FIND_RX)).select("file_path")


def q_path_skip_predicate(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return pages.select("page_id", "url", S.should_skip(F.col("url"), PAGE_INCLUDE_RX, PAGE_EXCLUDE_RX).alias("skip"))


def q_find_files_depth(spark, sf_dir):
    return S.find_files_depth(manifest(spark, sf_dir), WALK_ROOT, None, WALK_EXCLUDE_RX, WALK_DEPTH)


# What un-normalised paths begin and end with, by page_id.
PATH_HEADS = ["../../", "//", "/../data/", "/data/./", "s3a://bucket/./x/../", "hdfs://nn:8020/../", "file:///srv//"]
PATH_TAILS = ["", "/..", "/."]


def raw_page_paths(pages: DataFrame) -> DataFrame:
    """Un-normalised paths that hold a page's whole URL after its scheme: '//', '.', '..', relative forms
    and cluster paths by page_id."""
    url = F.regexp_replace(F.coalesce("url", F.lit("")), "^[a-z]+://", "")
    pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.pmod("page_id", F.lit(len(xs))) + 1).cast("int"))
    return pages.select("page_id", F.concat(pick(PATH_HEADS), url, pick(PATH_TAILS)).alias("raw_path"))


def q_normalize_path(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    r = raw_page_paths(pages)
    return r.select("page_id", "raw_path", S.normalize_path(F.col("raw_path")).alias("path"))


def encoded_documents(spark, sf_dir):
    """Documents as bytes: UTF-8, UTF-8 with a BOM, or GB18030 by doc_id % 3."""
    d = load_documents(spark, sf_dir)
    m = F.pmod("doc_id", F.lit(3))
    content = (F.when(m == 0, F.encode("text", "UTF-8"))
               .when(m == 1, F.concat(F.unhex(F.lit("EFBBBF")), F.encode("text", "UTF-8")))
               .otherwise(F.encode("text", "GB18030")))
    with decoding(spark):
        return d.select("doc_id", content.alias("content"))


def q_decode_text(spark, sf_dir):
    e = encoded_documents(spark, sf_dir)
    with decoding(spark):
        return e.select("doc_id", decode_text(F.col("content")).alias("text"))


# Bytes (hex) whose charset is known, by doc_id % 16; they follow the document's text in hex digits.
ENCODED_SAMPLES = [
    ("C3A9E4B8AD", "utf-8"),            # e acute, a Chinese character
    ("", "utf-8"),
    ("D6D0CEC4", "gb2312"),             # two characters of the first level
    ("E946", "gbk"),                    # a character that GBK adds
    ("95328236", "gb18030"),            # four bytes: only GB18030 has it
    ("636166E920", "windows-1252"),     # "caf" and e acute
    ("FF81", None),                     # no charset of the chain has it
    ("204DFC6C6C6572", "windows-1252"),  # Western words that are clean GBK too: "Mueller" with u umlaut
    ("20FC626572", "windows-1252"),     # "ueber"
    ("20E974617420", "windows-1252"),   # "etat"
    ("206E61EF7665", "windows-1252"),   # "naive"
    ("207365F16F72", "windows-1252"),   # "senor"
    ("206372E9E965", "windows-1252"),   # "creee", two accents side by side
    ("B1E4C1BF2078", "gb2312"),         # a Chinese word before a letter
    ("D7D6B7FB814181428144", "gbk"),    # of GB2312 and of GBK's own
    ("", "utf-16"),                     # the whole file in UTF-16 with its mark
]


def q_decode_encoding(spark, sf_dir):
    """S9 on bytes of known charsets: every member of the chain, and one that nothing decodes."""
    d = load_documents(spark, sf_dir)
    m = F.pmod("doc_id", F.lit(len(ENCODED_SAMPLES)))
    whole = F.hex(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    sample = F.element_at(F.array(*[F.lit(x) for x, _ in ENCODED_SAMPLES]), (m + 1).cast("int"))
    content = F.when(m == len(ENCODED_SAMPLES) - 1, F.concat(F.unhex(F.lit("FFFE")), F.encode(whole, "UTF-16LE"))).otherwise(
        F.concat(F.encode(whole, "UTF-8"), F.unhex(sample)))
    with decoding(spark):
        return d.select("doc_id", content.alias("content")).select("doc_id", encoding_of(F.col("content")).alias("encoding"))


def q_drop_empty_files(spark, sf_dir):
    d = load_documents(spark, sf_dir)
    m = F.pmod("doc_id", F.lit(9))
    content = (F.when(m == 0, F.unhex(F.lit("")))
               .when(m == 1, F.concat(F.unhex(F.lit("FF81")), F.encode("text", "UTF-8")))
               .otherwise(F.encode("text", "UTF-8")))
    files = d.select(F.col("doc_id").cast("string").alias("file_path"), content.alias("content"))
    return decode_files(files).select(F.col("file_path").cast("long").alias("doc_id"))


def q_write_jsonl(spark, sf_dir):
    """FIM rows written as JSON lines to the checkpoint folder, read back with the fixed schema."""
    path = scratch_path(spark, "fim-jsonl")
    write_jsonl(fim(functions(spark, sf_dir)).select("file_path", "func_name", "prefix", "middle", "suffix",
                                                      "flag", "func_index"), path)
    return read_jsonl(spark, path, FIM_SCHEMA).select(*FIM_COLS)


def q_read_jsonl(spark, sf_dir):
    """The function table as JSON lines (nulls kept), read back with the fixed schema."""
    path = scratch_path(spark, "func-jsonl")
    write_jsonl(functions_lazy(spark, sf_dir).select("func_name", "file_path", "func_def", "func_index"), path)
    return read_jsonl(spark, path, FUNC_SCHEMA).select("file_path", "func_index", "func_name", "func_def")


def q_collect_functions(spark, sf_dir):
    """X4 end to end on the rendered corpus: S1+S3 on the manifest, bytes -> decode -> extract -> JSONL."""
    files = select_c_sources(corpus(spark, sf_dir)).select("file_path", F.encode("text", "UTF-8").alias("content"))
    funcs = function_table(decode_files(files))
    path = scratch_path(spark, "collect-jsonl")
    write_jsonl(funcs.select("func_name", "file_path", "func_def", "func_index"), path)
    return read_jsonl(spark, path, FUNC_SCHEMA).select("file_path", "func_index", "func_name", "func_def")


# ------------------------------------------------------------------ tokens, blocks, nodes

FKEYS = ["file_path", "func_index"]


def q_c_tokens(spark, sf_dir):
    files = by_key(c_files(spark, sf_dir).select("file_path", "text"), ["file_path"])
    return tokenize(files, ["file_path"], "text").select("file_path", "pos", "tok", "kind", "st", "en")


def q_c_blocks(spark, sf_dir):
    files = by_key(c_files(spark, sf_dir).select("file_path", "text"), ["file_path"])
    return file_blocks(files).select("file_path", "st", "en", "depth", "kind", "parent_kind", "n_lines")


def q_nodes_function_definition(spark, sf_dir):
    files = by_key(c_files(spark, sf_dir).select("file_path", "text"), ["file_path"])
    return function_spans(files).select("file_path", "func_index", "st", "en", "func_name")


def _nodes(fn, cols, table=functions_lazy):
    def run(spark, sf_dir):
        return fn(table(spark, sf_dir)).select(*cols)
    return run


q_nodes_comment = _nodes(N.nodes_comment, FKEYS + ["st", "en"])
q_nodes_expression_statement = _nodes(N.nodes_expression_statement, FKEYS + ["st", "en"])
q_nodes_binary_expression = _nodes(N.nodes_binary_expression, FKEYS + ["st", "en", "op"])
q_nodes_if_else_block = _nodes(N.nodes_if_else_block, FKEYS + ["st", "en", "kind", "n_lines"])
q_nodes_case_block = _nodes(N.nodes_case_block, FKEYS + ["st", "en", "n_lines"])
q_nodes_compound = _nodes(N.nodes_compound, FKEYS + ["st", "en", "kind", "n_lines"])
# it reads its functions twice (for their branches and for their texts): they are written once
q_nodes_function_body = _nodes(N.nodes_function_body, FKEYS + ["st", "en"], functions)


# ------------------------------------------------------------------ text primitives

def _fk(spark, sf_dir):
    return functions_lazy(spark, sf_dir).withColumn("key", fkey())


def _braces(df):
    s = F.col("func_def")
    return df.withColumn("bi", F.instr(s, "{") - 1).withColumn("bj", T.rfind(s, "}") + 1)


def q_fim_span(spark, sf_dir):
    d = _braces(_fk(spark, sf_dir))
    p, m, x = T.cut(F.col("func_def"), F.col("bi"), F.col("bj"))
    return d.select(*FKEYS, p.alias("prefix"), m.alias("middle"), x.alias("suffix"))


def q_fim_span_inner(spark, sf_dir):
    d = _braces(_fk(spark, sf_dir))
    p, m, x = T.cut_inner(F.col("func_def"), F.col("bi"), F.col("bj"))
    return d.select(*FKEYS, p.alias("prefix"), m.alias("middle"), x.alias("suffix"))


def q_fim_span_half(spark, sf_dir):
    d = _braces(_fk(spark, sf_dir))
    p, m, x = T.cut_half(F.col("func_def"), F.col("bi"), F.col("bj") - 1)
    return d.select(*FKEYS, p.alias("prefix"), m.alias("middle"), x.alias("suffix"))


def q_split_body_lines(spark, sf_dir):
    """C6 exploded, offsets by a running sum over the segments (no per-row quadratic work)."""
    d = by_key(functions_lazy(spark, sf_dir).select(*FKEYS, "func_def"), FKEYS)
    s = F.col("func_def")
    seg = d.select(*FKEYS, L.body_start(s).alias("b0"), F.posexplode(L.body_segments(s)).alias("i", "x"))
    w = Window.partitionBy(*FKEYS).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.withColumn("before", F.coalesce(F.sum(F.length("x")).over(w), F.lit(0)))
    ok = (F.col("x") != "\n") & (F.length(T.py_strip(F.col("x"))) > 1)
    start = F.when(F.col("i") == 0, F.lit(0)).otherwise(F.col("b0") + F.col("before"))
    return seg.filter(ok).select(*FKEYS, F.col("i").alias("seg_no"), T.py_strip(F.col("x")).alias("line"),
                                 start.cast("long").alias("start"))


def q_pick_line_cut(spark, sf_dir):
    d = L.with_line_pick(_fk(spark, sf_dir), "func_def", "key", 42)
    return d.select(*FKEYS, F.col("lp.p").alias("p"), F.col("lp.snip").alias("snip"), F.col("lp.line_end").alias("line_end"))


def q_leading_indent(spark, sf_dir):
    d = functions_lazy(spark, sf_dir)
    e = d.select(*FKEYS, F.posexplode(T.splitlines(F.col("func_def"))).alias("line_no", "line"))
    return e.select(*FKEYS, "line_no", T.leading_indent(F.col("line")).alias("indent"))


def q_nonblank_lines(spark, sf_dir):
    d = functions_lazy(spark, sf_dir)
    nb = T.nonblank_lines(F.col("func_def"))
    return d.select(*FKEYS, F.size(nb).alias("n_nonblank"), F.array_join(nb, "\n").alias("joined"))


def q_line_count(spark, sf_dir):
    d = functions_lazy(spark, sf_dir)
    return d.select(*FKEYS, T.line_count(F.col("func_def")).alias("n_lines"))


# ------------------------------------------------------------------ sampling and draws (M1, M2, M5-M8)

def q_random_select(spark, sf_dir):
    f = functions(spark, sf_dir)
    n = f.count() // 2
    return random_select(f, n).select(*FKEYS, "func_name")


def q_fim_record(spark, sf_dir):
    """M5 over an M1 sample of half the functions: the reference's record fields (+ func_index)."""
    f = functions(spark, sf_dir)
    n = f.count() // 2
    return fim(random_select(f, n)).select(*FIM_COLS)


def q_short_function_gate(spark, sf_dir):
    d = _fk(spark, sf_dir).withColumn("n_lines", T.line_count(F.col("func_def")))
    gate = (F.col("n_lines") <= 20) & bernoulli(F.col("key"), "short", 1)
    return d.select(*FKEYS, "n_lines", gate.alias("short"))


def q_draw_choice(spark, sf_dir):
    d = _fk(spark, sf_dir).withColumn("n_lines", T.line_count(F.col("func_def")))
    return d.select(*FKEYS, choice_index(F.col("key"), "line", F.col("n_lines")).alias("choice"))


def q_draw_range(spark, sf_dir):
    d = _fk(spark, sf_dir).withColumn("n_lines", T.line_count(F.col("func_def")))
    return d.select(*FKEYS, randint(F.col("key"), "start", F.lit(1), F.col("n_lines")).alias("value"))


def q_draw_bernoulli(spark, sf_dir):
    d = _fk(spark, sf_dir)
    k = F.col("key")
    return d.select(*FKEYS, bernoulli(k, "trim", 5).alias("half"), bernoulli(k, "nl", 7).alias("seven"),
                    bernoulli(k, "short", 1).alias("tenth"))


def q_function_table(spark, sf_dir):
    """Bytes -> decode -> functions, paths normalised."""
    files = c_files(spark, sf_dir).select("file_path", F.encode("text", "UTF-8").alias("content"))
    return collect_frame(decode_files(files))


def _long(strategy: str, flag: str) -> Query:
    """T6L / T7L / T8L: the rows of a forced block strategy whose block is over 20 lines."""
    def run(spark, sf_dir):
        return fim(functions(spark, sf_dir), strategy=strategy).filter(F.col("flag") == flag).select(*FIM_COLS)
    run.__name__ = f"q_fim_{strategy}_long"
    return run


EXTRA = {
    "scan_c_sources": q_scan_c_sources,
    "scan_c_and_headers": q_scan_c_and_headers,
    "skip_dirs": q_skip_dirs,
    "find_files_regex": q_find_files_regex,
    "path_skip_predicate": q_path_skip_predicate,
    "find_files_depth": q_find_files_depth,
    "normalize_path": q_normalize_path,
    "decode_text": q_decode_text,
    "decode_encoding": q_decode_encoding,
    "drop_empty_files": q_drop_empty_files,
    "read_jsonl": q_read_jsonl,
    "write_jsonl": q_write_jsonl,
    "collect_functions": q_collect_functions,
    "c_tokens": q_c_tokens,
    "c_blocks": q_c_blocks,
    "nodes_function_definition": q_nodes_function_definition,
    "nodes_function_body": q_nodes_function_body,
    "nodes_expression_statement": q_nodes_expression_statement,
    "nodes_binary_expression": q_nodes_binary_expression,
    "nodes_if_else_block": q_nodes_if_else_block,
    "nodes_case_block": q_nodes_case_block,
    "nodes_comment": q_nodes_comment,
    "nodes_compound": q_nodes_compound,
    "fim_span": q_fim_span,
    "fim_span_inner": q_fim_span_inner,
    "fim_span_half": q_fim_span_half,
    "split_body_lines": q_split_body_lines,
    "pick_line_cut": q_pick_line_cut,
    "leading_indent": q_leading_indent,
    "nonblank_lines": q_nonblank_lines,
    "line_count": q_line_count,
    "random_select": q_random_select,
    "fim_record": q_fim_record,
    "short_function_gate": q_short_function_gate,
    "draw_choice": q_draw_choice,
    "draw_range": q_draw_range,
    "draw_bernoulli": q_draw_bernoulli,
    "function_table": q_function_table,
    "nodes_function_name": q_function_name,
    "fim_if_block_long": _long("if", "IF_BLOCK_LONG"),
    "fim_switch_case_long": _long("switch", "SWITCH_CASE_LONG"),
    "fim_loop_block_long": _long("loop", "LOOP_BLOCK_LONG"),
}


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "extract_functions": q_extract_functions,
        "function_name": q_function_name,
        "function_process": q_function_process,
        "strategy_mixture": q_strategy_mixture,
    }
    for name, strategy in FORCED.items():
        q[name] = _forced(strategy)
    q.update(EXTRA)
    return q


# ------------------------------------------------------------------ DuckDB side

def _c_files_filter() -> str:
    return ("ftab_in AS (SELECT * FROM corpus WHERE suffix(file_path, '.c') AND NOT list_has_any(string_split(file_path, '/'), "
            "['grpcplugin', 'resource', 'webplugin', 'verifysuite']))")




SKIP_SQL = "['grpcplugin', 'resource', 'webplugin', 'verifysuite']"


def _skip(col: str) -> str:
    return f"list_has_any(string_split({col}, '/'), {SKIP_SQL})"


def _rx(col: str, rx: str) -> str:
    return f"regexp_matches({col}, {O.q('^(?:' + rx + ')')})"


def _sources_sql() -> dict[str, str]:
    man = O.manifest_cte()
    out = {
        "scan_c_sources": O.with_(man, f"SELECT file_path FROM man WHERE suffix(file_path, '.c') AND NOT {_skip('file_path')}"),
        "scan_c_and_headers": O.with_(man, "SELECT file_path FROM man WHERE (suffix(file_path, '.c') OR suffix(file_path, '.h')) "
                                           f"AND NOT {_skip('file_path')}"),
        "skip_dirs": O.with_(man, f"SELECT file_path, {_skip('file_path')} AS skipped FROM man"),
        "find_files_regex": O.with_(man, f"SELECT file_path FROM man WHERE {_rx('file_path', FIND_RX)}"),
        "path_skip_predicate": (f"SELECT page_id, url, (NOT {_rx('url', PAGE_INCLUDE_RX)} OR {_rx('url', PAGE_EXCLUDE_RX)}) AS skip "
                                "FROM pages"),
    }
    root = WALK_ROOT
    walk = f"""{man},
wm AS (SELECT file_path, string_split(substring(file_path, {len(root) + 2}), '/') AS rel FROM man
       WHERE starts_with(file_path, {O.q(root + '/')})),
wp AS (SELECT list_transform(range(1, least(len(rel), {WALK_DEPTH}) + 1),
                             lambda i: {O.q(root + '/')} || array_to_string(rel[1:i], '/')) AS prefixes FROM wm)"""
    out["find_files_depth"] = O.with_(walk, "SELECT DISTINCT prefixes[-1] AS path FROM wp WHERE "
                                            f"list_bool_and(list_transform(prefixes, lambda x: NOT {_rx('x', WALK_EXCLUDE_RX)}))")
    pick = lambda xs: f"[{', '.join(O.q(x) for x in xs)}][page_id % {len(xs)} + 1]"
    step = ("CASE WHEN x = '..' AND acc <> '' AND NOT (acc = '..' OR ends_with(acc, '/..')) THEN "
            "CASE WHEN contains(acc, '/') THEN regexp_replace(acc, '/[^/]*$', '') ELSE '' END "
            "WHEN x = '..' AND acc = '' AND absolute THEN acc "
            "WHEN acc = '' THEN x ELSE acc || '/' || x END")
    norm = f"""raw AS (SELECT page_id, {pick(PATH_HEADS)} || regexp_replace(coalesce(url, ''), '^[a-z]+://', '') || {pick(PATH_TAILS)} AS raw_path
              FROM pages),
n0 AS (SELECT *, regexp_extract(p, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*') AS store
       FROM (SELECT *, regexp_replace(raw_path, '^file:', '') AS p FROM raw)),
n1 AS (SELECT page_id, raw_path, store, store <> '' OR starts_with(r, '/') AS absolute,
              store = '' AND starts_with(r, '//') AND NOT starts_with(r, '///') AS two,
              list_filter(string_split(r, '/'), lambda x: x <> '' AND x <> '.') AS parts
       FROM (SELECT *, substr(p, length(store) + 1) AS r FROM n0)),
n2 AS (SELECT *, list_reduce(list_prepend('', parts), lambda acc, x: {step}) AS body FROM n1),
n3 AS (SELECT page_id, raw_path, (CASE WHEN store <> '' AND body = '' THEN store WHEN store <> '' THEN store || '/'
                                       WHEN two THEN '//' WHEN absolute THEN '/' ELSE '' END) || body AS out FROM n2)"""
    out["normalize_path"] = O.with_(norm, "SELECT page_id, raw_path, CASE WHEN out = '' THEN '.' ELSE out END AS path FROM n3")
    known = " ".join(f"WHEN {i} THEN {O.q(name) if name else 'NULL'}" for i, (_, name) in enumerate(ENCODED_SAMPLES))
    out["decode_encoding"] = f"SELECT doc_id, CASE doc_id % {len(ENCODED_SAMPLES)} {known} END AS encoding FROM documents"
    out["decode_text"] = "SELECT doc_id, regexp_replace(text, '\r\n?', chr(10), 'g') AS text FROM documents"
    out["drop_empty_files"] = ("SELECT doc_id FROM documents WHERE doc_id % 9 NOT IN (0, 1) "
                               "AND length(regexp_replace(text, '\r\n?', chr(10), 'g')) > 0")
    return out


def _syntax_sql() -> dict[str, str]:
    funcs = O.functions_ctes()
    fk = ["file_path", "func_index"]
    node = ",\n".join([funcs, O.tokens_cte("ntok", "ftab", fk, "func_def"), O.structure_cte("nsig", "ntok", fk),
                       O.blocks_cte("nblk", "nsig", fk)])
    stm = ",\n".join([funcs, O.tokens_cte("ntok", "ftab", fk, "func_def"), O.structure_cte("nsig", "ntok", fk),
                      O.statements_cte("nst", "nsig", fk)])
    whole = ",\n".join([O.corpus_cte(), O.tokens_cte("wtok", "corpus", ["file_path"]),
                        O.structure_cte("wsig", "wtok", ["file_path"], clamp=True), O.blocks_cte("wblk", "wsig", ["file_path"])])
    body = ",\n".join([funcs, O.tokens_cte("ntok", "ftab", fk, "func_def"), O.views_cte("vtok", "ntok", fk, inside=True),
                       O.structure_cte("vsig", "vtok", [*fk, "view"]), O.blocks_cte("vblk", "vsig", [*fk, "view"])])
    fi = "file_path, CAST(func_index AS INTEGER) AS func_index"
    return {
        "c_tokens": O.with_(funcs, "SELECT file_path, CAST(pos AS INTEGER) AS pos, tok, kind, st, en FROM ftok"),
        "c_blocks": O.with_(whole, "SELECT file_path, st, en, depth, kind, parent_kind, n_lines FROM wblk"),
        "nodes_function_definition": O.with_(funcs, f"SELECT {fi}, st, en, func_name FROM fspan"),
        "nodes_function_body": O.with_(body, f"SELECT {fi}, b.st AS st, b.en AS en FROM (SELECT file_path, func_index, "
                                             "min({'st': st, 'en': en}) AS b FROM vblk WHERE kind = 'function' AND depth = 0 "
                                             "GROUP BY file_path, func_index)"),
        "nodes_expression_statement": O.with_(stm + ",\n" + O.exprstmt_cte("nexpr", "nst", fk), f"SELECT {fi}, st, en FROM nexpr"),
        "nodes_binary_expression": O.with_(stm + ",\n" + O.binary_cte("nbin", "nst", fk), f"SELECT {fi}, st, en, op FROM nbin"),
        "nodes_if_else_block": O.with_(node, f"SELECT {fi}, st, en, kind, n_lines FROM nblk "
                                             "WHERE kind = 'if' OR (kind = 'else' AND prev2_tok = '}')"),
        "nodes_case_block": O.with_(node, f"SELECT {fi}, st, en, n_lines FROM nblk WHERE kind = 'case'"),
        "nodes_compound": O.with_(node, f"SELECT {fi}, st, en, kind, n_lines FROM nblk "
                                        "WHERE kind IN ('for', 'while', 'macro', 'bare')"),
        "nodes_comment": O.with_(",\n".join([funcs, O.tokens_cte("ntok", "ftab", fk, "func_def"), O.comments_cte("ncom", "ntok", fk)]),
                                 f"SELECT {fi}, st, en FROM ncom"),
    }


def _text_sql() -> dict[str, str]:
    funcs = O.functions_ctes()
    fi = "file_path, CAST(func_index AS INTEGER) AS func_index"
    s = "func_def"
    br = f"""{funcs},
fb AS (SELECT *, instr({s}, '{{') - 1 AS bi, {O.rfind_sql(s, '}')} + 1 AS bj FROM ftab),
fb2 AS (SELECT *, {O.skip_blank_sql(s, 'bi + 1')} AS i1 FROM fb)"""
    cut = lambda a, b: f"{O.sl(s, '0', a)} AS prefix, {O.sl(s, a, b)} AS middle, {O.sl(s, b)} AS suffix"
    body = (f"(CASE WHEN {O.rfind_sql(s, '}')} > instr({s}, '{{') THEN substring({s}, instr({s}, '{{') + 1, "
            f"{O.rfind_sql(s, '}')} - instr({s}, '{{')) ELSE '' END)")
    seg = f"""{funcs},
sg0 AS (SELECT file_path, func_index, instr({s}, '{{') AS b0, regexp_extract_all({body}, {O.q(O.BODY_LINE_RE2)}, 0) AS sg FROM ftab),
sg1 AS (SELECT file_path, func_index, b0, unnest(sg) AS x, unnest(range(len(sg))) AS i FROM sg0),
sg2 AS (SELECT *, coalesce(sum(length(x)) OVER (PARTITION BY file_path, func_index ORDER BY i
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sg1)"""
    return {
        "fim_span": O.with_(br, f"SELECT {fi}, {cut('bi', 'bj')} FROM fb2"),
        "fim_span_inner": O.with_(br, f"SELECT {fi}, {cut('a', 'b')} FROM (SELECT *, CASE WHEN i1 < bj - 1 THEN i1 ELSE bi END AS a, "
                                      "CASE WHEN i1 < bj - 1 THEN bj - 1 ELSE bj END AS b FROM fb2)"),
        "fim_span_half": O.with_(br, f"SELECT {fi}, {cut('a', 'b')} FROM (SELECT *, CASE WHEN i1 < bj - 1 THEN i1 ELSE bi END AS a, "
                                     "bj - 1 AS b FROM fb2)"),
        "split_body_lines": O.with_(seg, f"SELECT {fi}, CAST(i AS INTEGER) AS seg_no, {O.py_strip('x')} AS line, "
                                         "CAST(CASE WHEN i = 0 THEN 0 ELSE b0 + before END AS BIGINT) AS start FROM sg2 "
                                         f"WHERE x <> chr(10) AND length({O.py_strip('x')}) > 1"),
        "pick_line_cut": O.with_(funcs + ",\n" + O.fim_ctes("ftab", "single_line"),
                                 f"SELECT {fi}, lp.p AS p, lp.snip AS snip, lp.line_end AS line_end FROM j4"),
        "leading_indent": O.with_(funcs, f"SELECT {fi}, CAST(i AS INTEGER) AS line_no, regexp_extract(l, '^[ \t]*', 0) AS indent "
                                         f"FROM (SELECT file_path, func_index, unnest({O.splitlines(s)}) AS l, "
                                         f"unnest(range(len({O.splitlines(s)}))) AS i FROM ftab)"),
        "nonblank_lines": O.with_(funcs, f"SELECT {fi}, CAST(len(nb) AS INTEGER) AS n_nonblank, array_to_string(nb, chr(10)) AS joined "
                                         f"FROM (SELECT *, list_filter({O.splitlines(s)}, lambda l: {O.py_strip('l')} <> '') AS nb FROM ftab)"),
        "line_count": O.with_(funcs, f"SELECT {fi}, CAST(len({O.splitlines(s)}) AS INTEGER) AS n_lines FROM ftab"),
    }


def _sample_sql(funcs: str) -> str:
    return funcs + f""",
fsample AS (
  SELECT file_path, func_index, func_name, func_def FROM (
    SELECT *, row_number() OVER (ORDER BY {O.draw('key', 'sample')}, key) AS rn, count(*) OVER () AS cnt
    FROM (SELECT *, file_path || '#' || CAST(func_index AS VARCHAR) AS key FROM ftab))
  WHERE rn <= cnt // 2
)"""


def _draw_sql() -> dict[str, str]:
    funcs = O.functions_ctes()
    fi = "file_path, CAST(func_index AS INTEGER) AS func_index"
    fk = f"""{funcs},
fk AS (SELECT *, file_path || '#' || CAST(func_index AS VARCHAR) AS key, CAST(len({O.splitlines('func_def')}) AS INTEGER) AS n_lines
       FROM ftab)"""
    sample = _sample_sql(funcs)
    return {
        "random_select": O.with_(sample, f"SELECT {fi}, func_name FROM fsample"),
        "fim_record": O.with_(sample + ",\n" + O.fim_ctes("fsample"), f"SELECT {fi}, func_name, prefix, middle, suffix, flag FROM fim"),
        "short_function_gate": O.with_(fk, f"SELECT {fi}, n_lines, n_lines <= 20 AND {O.draw('key', 'short')} % 10 < 1 AS short FROM fk"),
        "draw_choice": O.with_(fk, f"SELECT {fi}, {O.draw('key', 'line')} % greatest(n_lines, 1) AS choice FROM fk"),
        "draw_range": O.with_(fk, f"SELECT {fi}, 1 + {O.draw('key', 'start')} % greatest(n_lines, 1) AS value FROM fk"),
        "draw_bernoulli": O.with_(fk, f"SELECT {fi}, {O.draw('key', 'trim')} % 10 < 5 AS half, {O.draw('key', 'nl')} % 10 < 7 AS seven, "
                                      f"{O.draw('key', 'short')} % 10 < 1 AS tenth FROM fk"),
    }


def oracle_sql() -> dict[str, str]:
    funcs = O.functions_ctes()
    fcols = "file_path, CAST(func_index AS INTEGER) AS func_index, func_name"
    out = {
        "extract_functions": O.with_(funcs, f"SELECT {fcols}, func_def FROM ftab"),
        "function_name": O.with_(funcs, f"SELECT {fcols} FROM ftab"),
        "function_process": O.with_(funcs + ",\n" + O.fim_ctes("ftab"),
                                    f"SELECT {fcols}, prefix, middle, suffix, flag FROM fim"),
        "strategy_mixture": O.with_(funcs + ",\n" + O.fim_ctes("ftab"),
                                    "SELECT file_path, CAST(func_index AS INTEGER) AS func_index, CAST(n_lines AS INTEGER) AS n_lines, strategy FROM fs"),
    }
    for name, strategy in FORCED.items():
        out[name] = O.with_(funcs + ",\n" + O.fim_ctes("ftab", strategy),
                            f"SELECT {fcols}, prefix, middle, suffix, flag FROM fim")
    ftab_sel = f"SELECT {fcols}, func_def FROM ftab"
    out["read_jsonl"] = O.with_(funcs, ftab_sel)
    out["collect_functions"] = O.with_(O.functions_ctes(source_filter=_c_files_filter()), ftab_sel)
    out["write_jsonl"] = out["function_process"]
    out.update(_sources_sql())
    out.update(_syntax_sql())
    out.update(_text_sql())
    out.update(_draw_sql())
    out["function_table"] = O.with_(funcs, ftab_sel)
    out["nodes_function_name"] = out["function_name"]
    for name, strategy, flag in (("fim_if_block_long", "if", "IF_BLOCK_LONG"),
                                 ("fim_switch_case_long", "switch", "SWITCH_CASE_LONG"),
                                 ("fim_loop_block_long", "loop", "LOOP_BLOCK_LONG")):
        out[name] = O.with_(funcs + ",\n" + O.fim_ctes("ftab", strategy),
                            f"SELECT {fcols}, prefix, middle, suffix, flag FROM fim WHERE flag = {O.q(flag)}")
    return out
