"""Tokeniser as Spark column expressions.

Rules (the reference's analyzer):

* CJK characters (ranges below) form runs; a run of n characters yields
  ``c0, c0c1, c1, c1c2, ..., c(n-1)``: every character, and after it the bigram
  with the next character of the same run.
* Any other maximal run of non-CJK, non-white-space characters is one token,
  kept verbatim (no lower-casing, no punctuation strip, no stemming).
* White space (Unicode White_Space) separates tokens and is dropped.
* A token's position is its running number over the whole text (unigrams and
  bigrams alike), starting at 0.

Tokens are a JVM-side expression: ``regexp_extract_all`` finds the matches
and, only for texts that contain CJK at all, a single ``zip_with`` pairs each
CJK character with the CJK character following it. The token table with byte
offsets sums the lengths of the text's tiles the same way.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's analyzer) ---------------------
# CJK code point ranges treated as CJK:
#   4E00-9FFF   CJK Unified Ideographs
#   3400-4DBF   CJK Unified Ideographs Extension A
#   20000-2A6DF CJK Unified Ideographs Extension B
#   F900-FAFF   CJK Compatibility Ideographs
#   3040-309F   Hiragana
#   30A0-30FF   Katakana
#   AC00-D7AF   Hangul Syllables
#   1100-11FF   Hangul Jamo
CJK_CLASS = (
    r"\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}\x{20000}-\x{2A6DF}\x{F900}-\x{FAFF}"
    r"\x{3040}-\x{309F}\x{30A0}-\x{30FF}\x{AC00}-\x{D7AF}\x{1100}-\x{11FF}"
)
# Unicode White_Space property (Java's \s is ASCII-only, so it is spelled out).
WS_CLASS = (
    r"\x{09}-\x{0D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
# ---------------------------------------------------------------------------


def ranges(char_class: str) -> list[tuple[int, int]]:
    """The code point ranges of a class above."""
    found = re.findall(r"\\x\{(\w+)\}(?:-\\x\{(\w+)\})?", char_class)
    return [(int(lo, 16), int(hi or lo, 16)) for lo, hi in found]


#: the characters of WS_CLASS
WS_CHARS = "".join(chr(c) for lo, hi in ranges(WS_CLASS) for c in range(lo, hi + 1))
#: maximal CJK runs or maximal non-CJK, non-space runs (same string runs in
#: Java regex and RE2, so the DuckDB oracle uses it verbatim)
RUN_PATTERN = f"([{CJK_CLASS}]+|[^{CJK_CLASS}{WS_CLASS}]+)"
#: one CJK character (group 1) with the following CJK character, if any, in
#: group 2 -- or a whole non-CJK word in group 1
TOKEN_PATTERN = f"([{CJK_CLASS}](?=([{CJK_CLASS}])?)|[^{CJK_CLASS}{WS_CLASS}]+)"
HAS_CJK = f"[{CJK_CLASS}]"
#: only texts with such a character can hold CJK, or white space of three bytes
HIGH = r"[^\x{0}-\x{10FF}]"
#: marks in a text whose white space is all spaces (see ``marked``)
PAIR, EDGE = "\r", "\n"
#: tiles in one piece of such a text, with what ends them
PIECE = 16
PIECE_PATTERN = f"(?:[^ {PAIR}{EDGE}]*+[ {PAIR}{EDGE}]){{1,{PIECE}}}+|[^ {PAIR}{EDGE}]++"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def is_cjk(ch: Column | str) -> Column:
    """True when the (single character) string is in the CJK ranges."""
    return _c(ch).rlike(f"^[{CJK_CLASS}]$")


def runs(text: Column | str) -> Column:
    """Maximal CJK runs and maximal non-CJK, non-space runs, in order."""
    return F.regexp_extract_all(_c(text), F.lit(RUN_PATTERN), 1)


def tokens(text: Column | str) -> Column:
    """ARRAY<STRING> of tokens in position order.

    Texts without a CJK character (the common case) are cut at their white
    space; only CJK texts pay for the patterns and one lambda.
    A NULL text gives an empty array.
    """
    t = F.coalesce(_c(text), F.lit(""))
    heads = F.regexp_extract_all(t, F.lit(TOKEN_PATTERN), 1)
    nexts = F.regexp_extract_all(t, F.lit(TOKEN_PATTERN), 2)
    cjk = F.flatten(
        F.zip_with(
            heads,
            nexts,
            lambda h, n: F.when(n == "", F.array(h)).otherwise(F.array(h, F.concat(h, n))),
        )
    )
    # a pattern of more than one character makes ``split`` walk the text by regex
    words = F.array_remove(F.split(F.translate(t, WS_CHARS, " " * len(WS_CHARS)), " "), "")
    return F.when(t.rlike(HAS_CJK), cjk).otherwise(words)


def lowercase_tokens(text: Column | str) -> Column:
    """A plug-in analyzer (C10): the default rules on the lower-cased text."""
    return tokens(F.lower(_c(text)))


def cjk_letter_map(text: Column | str) -> Column:
    """Fixed letter map used to get CJK text at scale from the Latin test
    corpora: lower-case, then a..l -> 北京天気今日한국上海学校 (one char each)."""
    return F.translate(F.lower(_c(text)), "abcdefghijkl", "北京天気今日한국上海学校")


def prefix_sums(numbers: Column) -> Column:
    """Running sums of an array, by doubling: after round k each place holds
    the sum of the 2^(k + 1) numbers up to it. n log n steps, whole arrays
    at a time, so no place is summed from the start again."""
    n = F.size(numbers)

    def double(held: Column, k: Column) -> Column:
        step = F.least(F.pow(F.lit(2), k).cast("int"), n)
        before = F.concat(F.array_repeat(F.lit(0), step), F.slice(held, F.lit(1), n - step))
        return F.zip_with(held, before, lambda x, y: x + y)

    rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(n, F.lit(1)))).cast("int"))
    return F.aggregate(rounds, numbers, double)


def marked(df: DataFrame, kept: list[str], text: Column) -> DataFrame:
    """``kept`` and ``_text``: the text with its white space as spaces, as
    many as it has bytes, and two marks without bytes of their own: PAIR
    between two CJK characters, EDGE between a CJK character and a word."""
    t = df.select(*kept, F.regexp_replace(text, r"[\x09-\x0D]", " ").alias("_text"))
    for size in (2, 3):
        wide = "".join(c for c in WS_CHARS if len(c.encode()) == size)
        found = F.col("_text").rlike(f"[{wide}]") if size == 2 else F.col("_text").rlike(HIGH) & F.col("_text").rlike(f"[{wide}]")
        t = t.select(*kept, F.when(found, F.regexp_replace("_text", f"[{wide}]", " " * size)).otherwise(F.col("_text")).alias("_text"))
    paired = F.regexp_replace("_text", f"([{CJK_CLASS}])(?=[{CJK_CLASS}])", f"$1{PAIR}")
    edged = F.regexp_replace(paired, f"([{CJK_CLASS}])(?=[^{CJK_CLASS} {PAIR}])|([^{CJK_CLASS} {PAIR}])(?=[{CJK_CLASS}])", f"$1$2{EDGE}")
    return t.select(*kept, F.when(F.col("_text").rlike(HIGH) & F.col("_text").rlike(HAS_CJK), edged).otherwise(F.col("_text")).alias("_text"))


def token_table_with_offsets(df: DataFrame, key_cols: list[str], text_col: str = "text") -> DataFrame:
    """C5 + C6: ``key_cols..., pos, term, pos_len, off_from, off_to``, one row
    per token of every row of ``df``; a text without tokens has none.

    Offsets are UTF-8 byte offsets into the text. The ``marked`` text is cut
    into pieces of PIECE tiles (a CJK character, a word); only the pieces'
    bytes and tokens are summed up along the text. Inside its piece a tile's
    place follows from what stands before it there, row by row. A row's tokens
    follow from its own text alone, so there is no shuffle, and no Python."""
    unpaired = lambda c: F.replace(c, F.lit(PAIR), F.lit(""))
    pairs = lambda c: F.octet_length(c) - F.octet_length(unpaired(c))
    n_bytes = lambda c: F.octet_length(F.replace(unpaired(c), F.lit(EDGE), F.lit("")))
    spaced = lambda c: F.replace(F.replace(c, F.lit(PAIR), F.lit(" ")), F.lit(EDGE), F.lit(" "))
    full = lambda c: F.size(F.array_remove(F.split(spaced(c), " "), ""))
    t = marked(df, key_cols, F.coalesce(F.col(text_col), F.lit("")))
    t = t.select(*key_cols, F.regexp_extract_all("_text", F.lit(PIECE_PATTERN), 0).alias("_piece"))
    sizes = F.transform("_piece", lambda c: n_bytes(c).cast("int"))
    counts = F.transform("_piece", lambda c: (full(c) + pairs(c)).cast("int"))
    # the first character after a piece may be in a pair with its last one
    after = F.transform("_piece", lambda c, i: F.when(c.endswith(PAIR), F.substring(F.get("_piece", i + 1), 1, 1)).otherwise(F.lit("")))
    t = t.select(*key_cols, "_piece", after.alias("_after"), sizes.alias("_size"), counts.alias("_count"))
    t = t.select(*key_cols, "_piece", "_after", "_size", "_count", prefix_sums(F.col("_size")).alias("_end"), prefix_sums(F.col("_count")).alias("_upto"))
    t = t.select(*key_cols, F.explode_outer(F.arrays_zip("_piece", "_after", "_size", "_count", "_end", "_upto")).alias("_p")).where(F.col("_p").isNotNull())
    plain = spaced(F.col("_p._piece"))
    t = t.select(
        *key_cols,
        F.concat("_p._piece", "_p._after").alias("_whole"),
        plain.alias("_plain"),
        (F.col("_p._piece") != plain).alias("_marks"),
        (F.col("_p._end") - F.col("_p._size")).alias("_off"),
        (F.col("_p._upto") - F.col("_p._count")).alias("_pos"),
    )
    gaps = F.col("_plain").startswith(" ") | F.col("_plain").contains("  ")
    tiles = F.posexplode_outer(F.split("_plain", " ")).alias("_j", "_term")
    t = t.select(*key_cols, "_whole", "_plain", "_marks", "_off", "_pos", gaps.alias("_gaps"), tiles).where("_term <> ''")
    # what stands before the tile in its piece, with the end of the last tile
    before = F.when(F.col("_j") == 0, F.lit("")).otherwise(F.concat(F.expr("substring_index(_plain, ' ', _j)"), F.lit(" ")))
    t = t.select(*key_cols, "_whole", "_marks", "_off", "_pos", "_gaps", "_j", "_term", before.alias("_before"))
    at = F.char_length("_before")
    said = F.when(F.col("_marks"), F.substring("_whole", F.lit(1), at)).otherwise(F.col("_before"))
    follows = F.when(F.col("_marks"), F.substring("_whole", at + F.char_length("_term") + 1, F.lit(2)))
    t = t.select(*key_cols, "_marks", "_off", "_pos", "_gaps", "_j", "_term", said.alias("_before"), follows.alias("_next"))
    own = F.when(F.col("_gaps"), full(F.col("_before"))).otherwise(F.col("_j"))
    t = t.select(
        *key_cols,
        "_term",
        F.when(F.col("_next").startswith(PAIR), F.substring("_next", 2, 1)).alias("_next"),
        (F.col("_pos") + own + F.when(F.col("_marks"), pairs(F.col("_before"))).otherwise(0)).alias("_pos"),
        (F.col("_off") + F.when(F.col("_marks"), n_bytes(F.col("_before"))).otherwise(F.octet_length("_before"))).alias("off_from"),
    )
    lens = F.when(F.col("_next").isNull(), F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(2)))
    t = t.select(*key_cols, "_term", "_next", "_pos", "off_from", F.explode_outer(lens).alias("pos_len"))
    term = F.when(F.col("pos_len") == 1, F.col("_term")).otherwise(F.concat("_term", "_next"))
    t = t.select(*key_cols, (F.col("_pos") + F.col("pos_len") - 1).cast("int").alias("pos"), term.alias("term"), "pos_len", F.col("off_from").cast("int").alias("off_from"))
    return t.select(*key_cols, "pos", "term", "pos_len", "off_from", (F.col("off_from") + F.octet_length("term")).cast("int").alias("off_to"))
