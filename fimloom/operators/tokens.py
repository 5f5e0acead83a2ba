"""C lexical structure as tables: tokens, structural tokens, brace blocks.

Everything here is keyed by ``keys`` (a file, or a function) and assumes the input is already
hash-partitioned on those keys (``operators.extract.by_key``): ``posexplode`` keeps that partitioning
and every window below partitions by ``keys`` (+ more), so no further shuffle happens.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import LINE_BREAK_RX

# Blank characters, and the covering token pattern (Java regex, possessive loops keep
# the stack flat).  Each match is a run of blanks (newlines included) followed by one token:
# `extern "C" {` (one token: the linkage brace does not nest) | block comment | line comment (with
# continuations) | string | char | preprocessor line (with continuations, and whole with its comments) |
# identifier | number | multi-char operator | any other char;  trailing blanks form a last match.
BLANKS = " \t\n\x0b\x0c\r"
TOKEN_RX = (
    r"[ \t\n\x0b\x0c\r]*+(?:"
    r'extern[ \t\n\x0b\x0c\r]*+"C"[ \t\n\x0b\x0c\r]*+\{'
    r"|/\*(?s:.*?)(?:\*/|\z)"
    r"|//[^\\\n]*+(?:\\(?s:.)[^\\\n]*+)*+"
    r'|"[^"\\\n]*+(?:\\(?s:.)[^"\\\n]*+)*+"?'
    r"|'[^'\\\n]*+(?:\\(?s:.)[^'\\\n]*+)*+'?"
    r'|#[^\n\\/"]*+(?:(?://[^\\\n]*+(?:\\(?s:.)[^\\\n]*+)*+|/\*(?s:.*?)(?:\*/|\z)|"[^"\\\n]*+(?:\\(?s:.)[^"\\\n]*+)*+"?'
    r'|\\(?s:.)|/)[^\n\\/"]*+)*+'
    r"|[A-Za-z_][A-Za-z0-9_]*+"
    r"|\.?[0-9](?:[eEpP][+-]|[0-9A-Za-z_.])*+"
    r"|<<=|>>=|\.\.\.|->|\+\+|--|<<|>>|<=|>=|==|!=|&&|\|\||[-+*/%&^|]=|##"
    r"|(?s:.))"
    r"|[ \t\n\x0b\x0c\r]++"
)

# What one token may be, but for braces, parens, ``;`` and preprocessor lines (as in TOKEN_RX).
_BLANK_OR_NOTE = r"[ \t\n\x0b\x0c\r]++|/\*(?s:.*?)(?:\*/|\z)|//[^\\\n]*+(?:\\(?s:.)[^\\\n]*+)*+"
_LINKAGE = r'extern[ \t\n\x0b\x0c\r]*+"C"[ \t\n\x0b\x0c\r]*+\{'
_WORD = f"(?!{_LINKAGE})[A-Za-z_][A-Za-z0-9_]*+"
_PLAIN = (f"{_BLANK_OR_NOTE}" r'|"[^"\\\n]*+(?:\\(?s:.)[^"\\\n]*+)*+"?' r"|'[^'\\\n]*+(?:\\(?s:.)[^'\\\n]*+)*+'?"
          f"|{_WORD}" r"|\.?[0-9](?:[eEpP][+-]|[0-9A-Za-z_.])*+")


# The rest of a preprocessor line, as in TOKEN_RX.
_DIRECTIVE_REST = (r'[^\n\\/"]*+(?:(?://[^\\\n]*+(?:\\(?s:.)[^\\\n]*+)*+|/\*(?s:.*?)(?:\*/|\z)|"[^"\\\n]*+(?:\\(?s:.)[^"\\\n]*+)*+"?'
                   r'|\\(?s:.)|/)[^\n\\/"]*+)*+')


def _group(parens: int = 4) -> str:
    """Parens and what stands in them, followed ``parens`` levels deep: no brace, no preprocessor line."""
    group = rf"\((?:{_PLAIN}|[^{{}}()#\"'A-Za-z_])*+\)"
    for _ in range(parens - 1):
        group = rf"\((?:{_PLAIN}|{group}|[^{{}}()#\"'A-Za-z_])*+\)"
    return group


def _thin_rx(parens: int = 4, blocks: int = 4, braces: int = 3) -> str:
    """A ``{`` with the statements and blocks after it that define no function, or what stands between two of those.

    Groups of parens, blocks and initialisers are followed ``parens``, ``blocks`` and ``braces`` levels deep; deeper
    ones end the match."""
    group = _group(parens)
    gap = rf"(?:{_BLANK_OR_NOTE})*+"
    # an initialiser: no paren group stands before a brace in it, as before a function's body
    value = rf"\{{(?:{_PLAIN}|{_group(2)}(?!{gap}\{{)|[^{{}}();#\"'A-Za-z_])*+\}}"
    for _ in range(braces - 1):
        value = rf"\{{(?:{_PLAIN}|{_group(2)}(?!{gap}\{{)|{value}|[^{{}}();#\"'A-Za-z_])*+\}}"
    code = rf"(?:{_PLAIN}|{group}|={gap}{value}|[^{{}}();#\"'A-Za-z_])*+"
    label = rf"(?:{_PLAIN}|{group}|[^{{}}();:#\"'A-Za-z_])*+:"
    word_end = "(?![A-Za-z0-9_])"
    # before a block, at the start of an item: a control keyword or a macro with parens, else, do, labels, nothing
    head = rf"{gap}(?:else{word_end}{gap}(?:if{gap}{group})?+|do{word_end}|{_WORD}{gap}{group}|(?:{label})*+){gap}"
    items = f"(?:{code};)*+"
    for _ in range(blocks):
        items = rf"(?:{head}\{{{items}{gap}\}}|{code};)*+"
    between = rf"""(?:{_PLAIN}|#{_DIRECTIVE_REST}|[^{{#\"'A-Za-z_])++"""
    return rf"{_LINKAGE}|\{{{items}|{between}|(?s:.)"


THIN_RX = _thin_rx()


def thinned(text: Column | str) -> Column:
    """``text`` for the search of function definitions alone: what a ``{`` is followed by is blanked, up to the first
    brace that may be a function's, an unbalanced paren, a preprocessor line or an unfinished statement.

    Nothing moves (a blank for every character), and the spans of functions are the same: inside braces a
    function's header begins after a ``;`` or brace, and the ``{`` that is kept stands for the blanked ones.
    Line breaks are blanked too."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(THIN_RX), 0), lambda p: F.when(
        p.startswith("{") & (F.length(p) > 1), F.concat(F.lit("{"), F.repeat(F.lit(" "), F.length(p) - 1))).otherwise(p)), "")


# A pair of parens that holds no paren, ``;`` or literal, or what stands between two of those.
ARGUMENTS_RX = (r"""\([^{}();#"'/]*+\)|""" + rf"""(?:{_PLAIN}|#{_DIRECTIVE_REST}|[^(#\"'A-Za-z_])++|(?s:.)""")


def without_arguments(text: Column | str) -> Column:
    """``text`` for the search of function definitions alone: what stands in innermost parens is blanked.

    Nothing moves, and no token in there names a function or ends an item."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(ARGUMENTS_RX), 0), lambda p: F.when(
        p.startswith("(") & p.endswith(")"), F.concat(F.lit("("), F.repeat(F.lit(" "), F.length(p) - 2), F.lit(")"))).otherwise(p)), "")


def _plain_run_rx() -> str:
    """The text before the first ``{``, a ``;`` or brace with the statements after it that hold no block and no case
    label, or what stands between two of those.  A ``{`` right after such statements leaves them as they are (outside all
    braces they may be declarations of parameters)."""
    group = _group()
    gap = rf"(?:{_BLANK_OR_NOTE})*+"
    plain = rf"(?!(?:case|default)(?![A-Za-z0-9_]))(?:{_PLAIN})"
    value = rf"\{{(?:{_PLAIN}|{group}|[^{{}}();#\"'A-Za-z_])*+\}}"
    code = rf"(?:{plain}|{group}|={gap}{value}|[^{{}}();#\"'A-Za-z_])*+"
    before = rf"""(?:{_PLAIN}|#{_DIRECTIVE_REST}|[^{{#\"'A-Za-z_])++"""
    between = rf"""(?:{_PLAIN}|#{_DIRECTIVE_REST}|[^;{{}}#\"'A-Za-z_])++"""
    return rf"\A(?![;}}]){before}|{_LINKAGE}|[;{{}}](?:{code};)++(?!{gap}\{{)|{between}|(?s:.)"


PLAIN_RUN_RX = _plain_run_rx()


def without_statements(text: Column | str) -> Column:
    """``text`` of a function for the search of its blocks alone: of statements in a row that hold no block the last
    ``;`` stays, the rest is blanked.

    Places and line breaks are kept (in number: they come first), and so is the token before every other one."""
    def blanked(p: Column) -> Column:
        breaks = F.regexp_count(p, F.lit(r"[\n\x0b\x0c]"))
        gone = F.concat(F.left(p, F.lit(1)), F.repeat(F.lit("\n"), breaks), F.repeat(F.lit(" "), F.length(p) - 2 - breaks), F.lit(";"))
        # breaks that are counted otherwise among blanks than in a token
        return F.when((F.length(p) > 1) & p.rlike(r"\A[;{}]") & ~p.rlike(r"[\r\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"), gone).otherwise(p)

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(PLAIN_RUN_RX), 0), blanked), "")


# A comment, a preprocessor line, or all that stands between two of those (as TOKEN_RX takes them).
COMMENT_RX = (r"/\*(?s:.*?)(?:\*/|\z)|//[^\\\n]*+(?:\\(?s:.)[^\\\n]*+)*+" f"|#{_DIRECTIVE_REST}"
              r"""|(?:[^/"'#]++|"[^"\\\n]*+(?:\\(?s:.)[^"\\\n]*+)*+"?|'[^'\\\n]*+(?:\\(?s:.)[^'\\\n]*+)*+'?|/(?![/*]))++""")

#: Code points from which a text is cut into runs before it is tokenised, and the tokens of a run (every
#: run but the last has exactly so many, which keeps positions consecutive).
LARGE_TEXT, RUN_TOKENS = 1 << 20, 256

# The pieces of a preprocessor line (comment, string, run, any other char).
DIRECTIVE_RX = (r'//[^\\\n]*+(?:\\(?s:.)[^\\\n]*+)*+|/\*(?s:.*?)(?:\*/|\z)|"[^"\\\n]*+(?:\\(?s:.)[^"\\\n]*+)*+"?'
                r'|\\(?s:.)|[^/"\\]++|(?s:.)')

# C keywords that never name a function or a macro.
C_KEYWORDS = (
    "auto", "break", "case", "char", "const", "continue", "default", "do", "double", "else", "enum",
    "extern", "float", "for", "goto", "if", "inline", "int", "long", "register", "restrict", "return",
    "short", "signed", "sizeof", "static", "struct", "switch", "typedef", "union", "unsigned", "void",
    "volatile", "while", "_Bool", "_Complex", "_Imaginary",
)
HEADER_KEYWORDS = ("if", "for", "while", "switch")
# Keywords before a name that are no type.
NO_TYPES = ("break", "case", "continue", "default", "do", "else", "for", "goto", "if", "return", "sizeof", "switch", "while")
SKELETON_TOKENS = ("{", "}", "(", ")", ";", "case", "default")
# Keywords that start a type name, and keywords after which '(' may open a cast.
TYPE_KEYWORDS = ("char", "const", "double", "enum", "float", "int", "long", "short", "signed", "struct",
                 "union", "unsigned", "void", "volatile", "_Bool", "_Complex")
CAST_BEFORE_OK = ("return", "case", "else", "do")
# What stands before a name without naming, what opens a type's body, and paren groups that name
# no function.
QUALIFIERS = ("const", "volatile", "restrict")
TAG_KEYWORDS = ("struct", "union", "enum")
ATTRIBUTES = ("__attribute__", "__attribute", "__declspec", "__asm__", "__asm", "asm", "_Alignas", "alignas")
STRUCTURAL_KINDS = ("id", "num", "op", "str", "chr", "pp")


def _kind(tok: Column) -> Column:
    """Token kind from its first characters (code-point comparisons, no regex)."""
    c = F.ascii(tok)                       # code of the first character
    c2 = F.ascii(F.substring(tok, 2, 1))
    digit = lambda x: (x >= 48) & (x <= 57)
    return (
        F.when(tok.startswith("/*") | tok.startswith("//"), "comment")
        .when(tok.startswith("extern") & tok.endswith("{"), "pp")
        .when(c == 34, "str")
        .when(c == 39, "chr")
        .when(c == 35, "pp")
        .when(((c >= 65) & (c <= 90)) | ((c >= 97) & (c <= 122)) | (c == 95), "id")
        .when(digit(c) | ((c == 46) & digit(c2)), "num")
        .when(c == 10, "nl")
        .when(c.isin(32, 9, 11, 12, 13), "ws")
        .otherwise("op")
    )


# Single characters that str.splitlines() treats as line breaks (besides \n, \r, \v, \f).
OTHER_BREAKS = ("\x1c", "\x1d", "\x1e", "\x85", "\u2028", "\u2029")


def _breaks(tok: Column, kind: Column) -> Column:
    """Number of str.splitlines() line breaks inside one token."""
    return (
        F.when(kind == "nl", 1)
        .when(kind.isin("id", "num"), 0)
        .when(kind == "ws", F.length(tok) - F.length(F.translate(tok, "\r\x0b\x0c", "")))
        .when(kind == "op", F.when(tok.isin(*OTHER_BREAKS), 1).otherwise(0))
        .otherwise(F.size(F.split(tok, LINE_BREAK_RX, -1)) - 1)
    )


def _matches(df: DataFrame, keys: list[str], text: str, rx: str) -> DataFrame:
    """(keys, pos, full) for every match of ``rx``; a text over LARGE_TEXT is matched in runs."""
    whole = F.col(text)
    runs = F.when(F.length(whole) > LARGE_TEXT, F.regexp_extract_all(whole, F.lit(f"(?:{rx}){{1,{RUN_TOKENS}}}+"), 0))
    t = df.select(*keys, F.posexplode(runs.otherwise(F.array(whole))).alias("_run", "_text"))
    t = t.select(*keys, "_run", F.posexplode(F.regexp_extract_all("_text", F.lit(rx), 0)).alias("_at", "full"))
    return t.select(*keys, (F.col("_run") * RUN_TOKENS + F.col("_at")).alias("pos"), "full")


def tokenize(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """c_tokens: (keys, pos, tok, kind, st, en, nb) with ``nb`` = line breaks before the token.

    Blank runs ride along with the token after them (``lead``), so they add no rows: ``text[st:en] =
    tok`` and everything between tokens is blank.  st/en are 0-based code-point offsets.

    A text over LARGE_TEXT is first cut into runs of RUN_TOKENS whole tokens, so no task ever holds the
    token array of a large file, only that of one run beside the text."""
    t = _matches(df, keys, text, TOKEN_RX)
    # spaces first: they are trimmed without a search among the blanks
    t = t.withColumn("tok", F.ltrim(F.ltrim("full"), F.lit(BLANKS))).filter(F.col("tok") != "")
    lead = F.length("full") - F.length("tok")
    lead_str = F.substring(F.col("full"), 1, lead)
    lead_nb = F.regexp_count(lead_str, F.lit(r"[\n\r\x0b\x0c]"))
    t = t.select(*keys, "pos", F.length("full").alias("size"), "tok", _kind(F.col("tok")).alias("kind"), lead.alias("lead"),
                 lead_nb.alias("lead_nb"))
    before = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    row_nb = F.col("lead_nb") + _breaks(F.col("tok"), F.col("kind"))
    t = t.select(
        *keys, "pos", "tok", "kind",
        (F.coalesce(F.sum("size").over(before), F.lit(0)) + F.col("lead")).alias("st"),
        (F.coalesce(F.sum(row_nb).over(before), F.lit(0)) + F.col("lead_nb")).alias("nb"),
    )
    return t.withColumn("en", F.col("st") + F.length("tok"))


def comment_tokens(df: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, pos, tok, kind, st) of comments and preprocessor lines alone, for ``comments``: what stands between two of
    those is one row, without its text, and leaves after the running sum."""
    full = F.col("full")
    kind = F.when(full.startswith("/*") | full.startswith("//"), "comment").when(full.startswith("#"), "pp")
    t = _matches(df, keys, text, COMMENT_RX).select(*keys, "pos", F.length("full").alias("size"), kind.alias("kind"), F.when(kind.isNotNull(), full).alias("tok"))
    before = Window.partitionBy(*keys).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("st", F.coalesce(F.sum("size").over(before), F.lit(0)))
    return t.filter(F.col("kind").isNotNull()).select(*keys, "pos", "tok", "kind", "st")


def comments(tokens: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, st, en) of all comments, those on preprocessor lines included."""
    tok = F.col("tok")
    own = F.col("kind") == "comment"
    noted = (F.col("kind") == "pp") & (tok.contains("/*") | tok.contains("//"))
    parts = F.when(own, F.array(tok)).otherwise(F.regexp_extract_all(tok, F.lit(DIRECTIVE_RX), 0))
    p = tokens.filter(own | noted).select(*keys, "pos", "st", F.posexplode(parts).alias("i", "part"))
    before = Window.partitionBy(*keys, "pos").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    p = p.withColumn("st", F.col("st") + F.coalesce(F.sum(F.length("part")).over(before), F.lit(0)))
    p = p.filter(F.col("part").startswith("/*") | F.col("part").startswith("//"))
    return p.select(*keys, "st", (F.col("st") + F.length("part")).alias("en"))


def structure(tokens: DataFrame, keys: list[str], skeleton: bool = False, clamp: bool = False) -> DataFrame:
    """Structural tokens with brace/paren depth, neighbours and header information.

    ``skeleton=True`` keeps only braces, parens, ``;``, case labels, preprocessor lines and item starts
    after the first pass (enough for ``blocks``; not for statement or expression spans).  ``clamp=True``
    (whole files) keeps brace depth from going negative; function texts are balanced and skip it.

    An item outside all braces ends with ``;``, with a ``}`` that closes no type body or initialiser (a declarator may
    follow those), or at a preprocessor line, unless that stands between a ``)`` and its ``{``.

    Columns added: prev_tok, prev_kind, prev2_tok, depth (enclosing braces), pdepth, hdr / hdr_kind /
    hdr2 (on ``)``: the token before its matching ``(``, and the last one before that which is no
    qualifier), head (outside all braces: the last paren group that may be a function's), sig (the last token
    before, and its place, preprocessor lines left out), nstart (first token start of the current statement),
    close_en / close_nb (on ``{``: end and line breaks of the matching ``}``), fstart (first
    token start of the current top-level item), phdr / phdr_kind / phdr2 (on ``{`` after ``)``: the
    ``hdr`` of that ``)``).
    """
    # of a literal the first character is enough, and rows carry their neighbours'
    s = tokens.filter(F.col("kind").isin(*STRUCTURAL_KINDS)).withColumn(
        "tok", F.when(F.col("kind").isin("str", "chr"), F.left("tok", F.lit(1))).otherwise(F.col("tok")))
    tok = F.col("tok")
    seq = Window.partitionBy(*keys).orderBy("pos")
    run = seq.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # `extern "C" {` is one token (kind pp): it adds no depth, and its '}' is clamped away below
    bdelta = F.when(tok == "{", 1).when(tok == "}", -1).otherwise(0)
    pdelta = F.when(tok == "(", 1).when(tok == ")", -1).otherwise(0)
    s = s.select(
        "*",
        F.lag("tok", 1).over(seq).alias("prev_tok"),
        F.lag("kind", 1).over(seq).alias("prev_kind"),
        F.lag("tok", 2).over(seq).alias("prev2_tok"),
        F.last(F.when(~tok.isin(*QUALIFIERS), tok), ignorenulls=True).over(seq.rowsBetween(Window.unboundedPreceding, -2)).alias("_real2"),
        F.lead("tok", 1).over(seq).alias("next_tok"),
        F.last(F.when((F.col("kind") != "pp") | tok.endswith("{"), F.struct("tok", "pos")), ignorenulls=True).over(
            seq.rowsBetween(Window.unboundedPreceding, -1)).alias("sig"),
        F.sum(bdelta).over(run).alias("_bd"),
        F.sum(pdelta).over(run).alias("_pd"),
    )
    # brace depth never goes below zero (file level, ``clamp``): clamped running sum = S - min(0, running
    # min of S), which closes `extern "C" {` blocks and absorbs stray '}';
    # paren depth restarts at every brace: parentheses never span braces in C, so a stray quote or
    # paren (as in hand-edited or macro-heavy code) cannot derail the rest of the file.
    # (one window operator for both)
    extra = [F.min("_bd").over(run).alias("_bdmin")] if clamp else []
    fresh = F.col("prev_tok").isNull() | F.col("prev_tok").isin(";", "{", "}") | (F.col("prev_kind") == "pp")
    s = s.select(
        "*", *extra,
        F.coalesce(F.last(F.when(tok.isin("{", "}"), F.col("_pd")), ignorenulls=True).over(run), F.lit(0)).alias("_pd0"),
        F.last(F.when(fresh, F.col("st")), ignorenulls=True).over(run).alias("nstart"),
    )
    if clamp:
        s = s.withColumn("_bd", F.col("_bd") - F.least(F.lit(0), F.col("_bdmin"))).drop("_bdmin")
    s = s.withColumn("depth", F.when(tok == "{", F.col("_bd") - 1).otherwise(F.col("_bd"))) \
         .withColumn("pdepth", F.when(tok == "(", F.col("_pd") - 1).otherwise(F.col("_pd")) - F.col("_pd0")) \
         .drop("_bd", "_pd", "_pd0")
    # top-level item starts: first token after a depth-0 ';' / '}' or a preprocessor line
    of_type = (F.col("prev_tok").isin(*TAG_KEYWORDS, "=")
               | ((F.col("prev_kind") == "id") & F.coalesce(F.col("prev2_tok").isin(*TAG_KEYWORDS), F.lit(False))))
    s = s.withColumn("_typed", F.last(F.when((tok == "{") & (F.col("depth") == 0), of_type), ignorenulls=True).over(run))
    is_bnd = ((F.col("depth") == 0) & ((tok == ";") | ((tok == "}") & ~F.coalesce("_typed", F.lit(False))))) | (F.col("kind") == "pp")
    body = (tok == "{") & (F.col("prev_kind") == "pp") & (F.col("sig.tok") == ")")
    s = s.withColumn("_is_start", F.coalesce(F.lag(is_bnd, 1).over(seq), F.lit(True)) & (F.col("kind") != "pp")
                     & ~F.coalesce(body, F.lit(False))).drop("_typed")
    if skeleton:
        # block detection needs only these rows (each already carries its neighbours from the full
        # pass above): the remaining windows sort a fraction of the tokens
        s = s.filter(tok.isin(*SKELETON_TOKENS) | (F.col("kind") == "pp") | F.col("_is_start"))
    s = s.withColumn("fstart", F.last(F.when(F.col("_is_start"), F.col("st")), ignorenulls=True).over(run)) \
         .drop("_is_start")
    # matching parens: the previous paren at the same paren depth
    is_paren = tok.isin("(", ")")
    par = Window.partitionBy(*keys, is_paren, F.col("pdepth")).orderBy("pos")
    opened = (tok == ")") & (F.lag("tok", 1).over(par) == "(")
    s = s.select(
        "*",
        F.when(opened, F.lag("prev_tok", 1).over(par)).alias("hdr"),
        F.when(opened, F.lag("prev_kind", 1).over(par)).alias("hdr_kind"),
        F.when(opened, F.lag("_real2", 1).over(par)).alias("hdr2"),
        F.when(opened, F.lag("next_tok", 1).over(par)).alias("_open_next"),
    )
    # a ')' closing a cast: the '(' follows no operand (not a call, not sizeof) and its contents start
    # with a type keyword or end with '*'
    call_like = (((F.col("hdr_kind").isin("id", "num", "str", "chr")) & ~F.col("hdr").isin(*CAST_BEFORE_OK))
                 | F.col("hdr").isin(")", "]"))
    s = s.withColumn("cast_close", F.coalesce(
        (tok == ")") & F.col("hdr_kind").isNotNull() & ~call_like
        & (F.col("_open_next").isin(*TYPE_KEYWORDS) | (F.col("prev_tok") == "*")), F.lit(False))).drop("_open_next")
    # matching braces: the next brace at the same depth.  A ')' directly before a '{' joins that
    # brace's window group, so the '{' also reads the header of its ')' there (no extra sort).
    # So does a ')' outside all braces that may close a parameter list: what follows it up to a '{' may
    # be attributes or macros, or the parameter declarations of an old-style definition (``head``).
    is_brace = tok.isin("{", "}")
    paren_before_brace = (tok == ")") & (F.col("next_tok") == "{")
    named = F.coalesce((tok == ")") & (F.col("depth") == 0) & (F.col("pdepth") == 0) & (F.col("hdr_kind") == "id")
                       & ~F.col("hdr").isin(*C_KEYWORDS) & ~F.col("hdr").isin(*ATTRIBUTES), F.lit(False))
    grp = F.when(is_brace | paren_before_brace | named, F.col("depth"))
    br = Window.partitionBy(*keys, grp.isNull(), grp).orderBy("pos")
    nxt_brace = F.lead("tok", 1).over(br)
    closed = (tok == "{") & (nxt_brace == "}")
    after_paren = (tok == "{") & (F.col("prev_tok") == ")")
    s = s.select(
        "*",
        F.when(closed, F.lead("st", 1).over(br) + 1).alias("close_en"),
        F.when(closed, F.lead("nb", 1).over(br)).alias("close_nb"),
        F.last(F.when(named, F.struct("pos", "hdr", "hdr2", "fstart", F.col("next_tok").alias("nxt"))), ignorenulls=True).over(
            br.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias("head"),
        F.when(after_paren, F.lag("hdr", 1).over(br)).alias("phdr"),
        F.when(after_paren, F.lag("hdr_kind", 1).over(br)).alias("phdr_kind"),
        F.when(after_paren, F.lag("hdr2", 1).over(br)).alias("phdr2"),
    )
    return s.drop("next_tok", "_real2")


def head_kind() -> Column:
    """How a ``{`` outside all braces follows its function's paren group, if not directly: "late" (attributes,
    macros or preprocessor lines between) or "old" (parameter declarations between); null if it does not."""
    prev, head = F.col("prev_tok"), F.col("head")
    lines = (F.col("prev_kind") == "pp") & (F.col("sig.tok") == ")") & (F.col("sig.pos") == head["pos"])
    macro = ((F.col("prev_kind") == "id") & ~prev.isin(*C_KEYWORDS)
             & ~F.coalesce(F.col("prev2_tok").isin(*TAG_KEYWORDS), F.lit(False)))
    late = ((prev == ")") & F.col("phdr").isin(*ATTRIBUTES)) | macro
    return F.when((F.col("depth") == 0) & head.isNotNull(),
                  F.when((late | lines) & (head["fstart"] == F.col("fstart")), "late")
                  .when((prev == ";") & head["nxt"].rlike("^[A-Za-z_]"), "old"))


def typed_head() -> Column:
    """Inside braces: whether the name before a ``{``'s paren group follows a type, as in a nested definition
    (the use of a macro begins its statement)."""
    before = F.col("phdr2")
    return F.coalesce(before.rlike("^[A-Za-z_]") & ~before.isin(*NO_TYPES) | (before == "*"), F.lit(False))


def block_kind() -> Column:
    """Kind of a ``{`` from the token before it (see README, 'blocks')."""
    prev = F.col("prev_tok")
    phdr = F.col("phdr")
    depth = F.col("depth")
    named = (F.col("phdr_kind") == "id") & ~phdr.isin(*C_KEYWORDS) & ~((depth == 0) & phdr.isin(*ATTRIBUTES))
    after_paren = (
        F.when(phdr.isin(*HEADER_KEYWORDS), phdr)
        .when(named, F.when((depth == 0) | typed_head(), "function").otherwise("macro"))
        .when((depth == 0) & (phdr == ")"), "function")
        .otherwise("other")
    )
    return (
        F.when(head_kind().isNotNull(), "function")
        .when(prev == ")", after_paren)
        .when(prev == "else", "else")
        .when(prev == "do", "do")
        .when((depth > 0) & prev.isin(";", "{", "}", ":", "("), "bare")
        .otherwise("other")
    )


def blocks(structured: DataFrame, keys: list[str]) -> DataFrame:
    """c_blocks: (keys, st, en, depth, kind, parent_kind, n_lines, name, fstart, prev2_tok).

    ``kind`` is one of function, if, else, for, while, switch, do, macro, bare, case.
    ``case`` = a bare block directly in a switch body after a case/default label."""
    s = structured
    tok = F.col("tok")
    s = s.withColumn("bkind", F.when((tok == "{") & F.col("close_en").isNotNull(), block_kind()))
    by_head = (tok == "{") & head_kind().isNotNull()
    s = s.withColumn("phdr_kind", F.when(by_head, "id").otherwise(F.col("phdr_kind")))
    s = s.withColumn("phdr2", F.when(by_head, F.col("head.hdr2")).otherwise(F.col("phdr2")))
    s = s.withColumn("fstart", F.when(by_head, F.col("head.fstart")).when(F.col("depth") > 0, F.col("nstart")).otherwise(F.col("fstart")))
    s = s.withColumn("phdr", F.when(by_head, F.col("head.hdr")).otherwise(F.col("phdr"))).drop("head", "sig", "nstart")
    s = s.filter(((tok == "{") & (F.col("bkind") != "other")) | tok.isin("case", "default"))
    # parent lookup: each '{' is an entry for its own level (depth+1) and a probe for its container
    # level (depth); case labels are entries of the level they sit in.  One window, no join, no shuffle.
    roles = F.when(tok == "{", F.array(
        F.struct((F.col("depth") + 1).alias("x"), F.lit(0).alias("role")),
        F.struct(F.col("depth").alias("x"), F.lit(1).alias("role")),
    )).otherwise(F.array(F.struct(F.col("depth").alias("x"), F.lit(2).alias("role"))))
    u = s.select("*", F.explode(roles).alias("e")).select("*", F.col("e.x").alias("x"), F.col("e.role").alias("role")).drop("e")
    w = Window.partitionBy(*keys, "x").orderBy("pos", "role").rowsBetween(Window.unboundedPreceding, -1)
    u = u.select(
        "*",
        F.last(F.when(F.col("role") == 0, F.col("bkind")), ignorenulls=True).over(w).alias("parent_kind"),
        F.last(F.when(F.col("role") == 0, F.col("pos")), ignorenulls=True).over(w).alias("parent_pos"),
        F.last(F.when(F.col("role") == 2, F.col("pos")), ignorenulls=True).over(w).alias("case_pos"),
    )
    b = u.filter(F.col("role") == 1)
    is_case = (F.col("bkind") == "bare") & (F.col("parent_kind") == "switch") & (F.col("case_pos") > F.col("parent_pos"))
    name = F.when((F.col("phdr_kind") == "id") & ~F.col("phdr").isin(*C_KEYWORDS)
                  & (F.coalesce(F.col("phdr2"), F.lit("")) != "*"), F.col("phdr"))
    return b.select(
        *keys,
        F.col("st"),
        F.col("close_en").alias("en"),
        F.col("depth"),
        F.when(is_case, "case").otherwise(F.col("bkind")).alias("kind"),
        F.col("parent_kind"),
        (F.col("close_nb") - F.col("nb") + 1).alias("n_lines"),
        F.when(F.col("bkind") == "function", name).alias("name"),
        F.col("fstart"),
        F.col("prev2_tok"),
    )
