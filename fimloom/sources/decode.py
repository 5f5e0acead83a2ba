"""Bytes -> text with an encoding fallback chain, all as Column expressions.

Order tried: UTF-8 (strict), UTF-16 (only with its byte order mark), then by the statistics of its bytes either
Windows-1252 first or GB2312, GBK, GB18030, Windows-1252 (most accented letters form a clean GBK pair with the letter after them).
A charset "decodes" when the result holds no U+FFFD replacement character.  The chain needs the two
settings of ``session.decoding`` while its plan is analysed (GB charsets, U+FFFD for bad bytes);
``decode_files`` sees to that.  Text is then normalised like a Python text-mode read: a leading BOM is
dropped and ``\\r\\n`` / ``\\r`` become ``\\n``.  Nothing decodes -> empty text (the file yields no rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import decoding

# The fallback chain after strict UTF-8 and marked UTF-16.
CHAIN = ("GB2312", "GBK", "GB18030", "windows-1252")
REPLACEMENT = "\ufffd"


# Bytes over 0x7F (as ISO-8859-1 characters).  Chinese characters are pairs of them, mostly side by side;
# GB18030 also has four bytes with digits between.  Western letters and signs stand alone between ASCII, or two small
# letters inside a word; a small letter is not followed by a capital.
HIGH_RX = r"[\x80-\xff]"
FOUR_BYTES_RX = r"[\x81-\xfe][0-9][\x81-\xfe][0-9]"
WESTERN_RX = (r"(?<![\x80-\xff])(?:[\xdf-\xf6\xf8-\xff](?![A-Z\x80-\xff])|[\xc0-\xd6\xd8-\xde\xa0-\xbf\x80\x85\x8a\x8c\x8e"
              r"\x91-\x97\x99\x9a\x9c\x9e\x9f](?![\x80-\xff]))")
WESTERN_PAIR_RX = r"(?<=[A-Za-z])[\xdf-\xf6\xf8-\xff]{2}(?=[a-z])"


def looks_western(content: Column) -> Column:
    """Whether most bytes over 0x7F stand as they do in Western text, not in pairs."""
    chars = F.decode(content, "ISO-8859-1")
    rest = F.regexp_replace(chars, FOUR_BYTES_RX, "")
    western = F.regexp_count(rest, F.lit(WESTERN_RX)) + 2 * F.regexp_count(rest, F.lit(WESTERN_PAIR_RX))
    return 2 * western > F.regexp_count(chars, F.lit(HIGH_RX))


def _decodes(content: Column, charset: str) -> Column:
    return ~F.decode(content, charset).contains(REPLACEMENT)


def encoding_of(content: Column) -> Column:
    """The first charset of the chain that decodes the bytes cleanly (null if none)."""
    marked = F.hex(F.substring(content, 1, 2)).isin("FFFE", "FEFF")
    out = F.when(F.is_valid_utf8(content), F.lit("utf-8")).when(marked & _decodes(content, "UTF-16"), F.lit("utf-16"))
    out = out.when(looks_western(content) & _decodes(content, CHAIN[-1]), F.lit(CHAIN[-1]))
    for cs in CHAIN:
        out = out.when(_decodes(content, cs), F.lit(cs.lower()))
    return out


def newline_normalize(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def decode_text(content: Column) -> Column:
    """Decoded, BOM-stripped, newline-normalised text; '' when nothing decodes."""
    marked = F.hex(F.substring(content, 1, 2)).isin("FFFE", "FEFF")
    raw = F.when(F.is_valid_utf8(content), F.decode(content, "UTF-8")).when(
        marked & _decodes(content, "UTF-16"), F.decode(content, "UTF-16")).when(
        looks_western(content) & _decodes(content, CHAIN[-1]), F.decode(content, CHAIN[-1]))
    for cs in CHAIN:
        raw = raw.when(_decodes(content, cs), F.decode(content, cs))
    return newline_normalize(F.regexp_replace(F.coalesce(raw, F.lit("")), "^\ufeff", ""))


def decode_files(files: DataFrame, content: str = "content") -> DataFrame:
    """(file_path, content) -> (file_path, encoding, text); S10 drops files with empty text."""
    c = F.col(content)
    with decoding(files.sparkSession):
        out = files.select("file_path", encoding_of(c).alias("encoding"), decode_text(c).alias("text"))
    return out.filter(F.length("text") > 0)
