"""Text scalars: cleaning, punctuation stripping and tokenising.

Spark's ``trim`` only removes U+0020 and Java's ``\\s`` misses several of the
characters Python's ``str.strip``/``str.split`` treat as whitespace, so the
exact set is spelled out once here and used by every text operator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points Python's str.isspace() accepts
# (str.strip() / str.split() with no argument), in code-point order.
WHITESPACE_CODEPOINTS = (
    0x0009, 0x000A, 0x000B, 0x000C, 0x000D,
    0x001C, 0x001D, 0x001E, 0x001F, 0x0020,
    0x0085, 0x00A0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
WHITESPACE_CHARS = "".join(chr(c) for c in WHITESPACE_CODEPOINTS)

# Fixed value: the label given to negative utterances.
INVALID_LABEL = "INVALID"


def ws_class() -> str:
    """The whitespace set as regex class members (``\\x{..}`` works in Java and RE2)."""
    return "".join(f"\\x{{{c:04X}}}" for c in WHITESPACE_CODEPOINTS)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Python ``strip()`` then blank -> NULL (NULL stays NULL)."""
    return F.nullif(F.btrim(_col(c), F.lit(WHITESPACE_CHARS)), F.lit(""))


def strip_punct(c) -> Column:
    """Drop everything that is not a letter, mark, number or whitespace."""
    return F.regexp_replace(_col(c), f"[^\\p{{L}}\\p{{M}}\\p{{N}}{ws_class()}]", "")


def tokenize_ws(c) -> Column:
    """Python ``str.split()``: whitespace runs, no empty tokens.

    Every whitespace character is first mapped to U+0020 (a character map, no
    regex), so the split runs on a single character; the empty pieces between
    consecutive separators are then dropped.
    """
    spaced = F.translate(_col(c), WHITESPACE_CHARS, " " * len(WHITESPACE_CHARS))
    return F.filter(F.split(spaced, " "), lambda t: t != F.lit(""))


# A mixed-script word piece is one Han character, or a run of
# letters, marks and numbers of any script that are not Han.
HAN_PATTERN = "(\\p{IsHan})"
WORD_PATTERN = "[\\p{L}\\p{M}\\p{N}]+"


def tokenize_mixed(c) -> Column:
    """Pieces of mixed-script text: spaces are put round Han characters, then
    every run of letters, marks and numbers is a piece (no script is lost)."""
    return F.regexp_extract_all(F.regexp_replace(_col(c), HAN_PATTERN, " $1 "), F.lit(WORD_PATTERN), 0)


# The character n-gram lengths and word boundary marks of the
# subword model (FastText's defaults).
SUBWORD_MIN_N = 3
SUBWORD_MAX_N = 6
WORD_BEGIN = "<"
WORD_END = ">"


def bounded_word(c) -> Column:
    """``<word>``: the word with its boundary marks."""
    return F.concat(F.lit(WORD_BEGIN), _col(c), F.lit(WORD_END))


def char_ngrams(c, min_n: int = SUBWORD_MIN_N, max_n: int = SUBWORD_MAX_N) -> Column:
    """All character n-grams of lengths ``min_n..max_n`` of a string column, by
    length then position, repeats kept (``aaaa`` has ``aaa`` twice).

    Pass a column (e.g. one holding :func:`bounded_word`), not an expression:
    the lambdas then read it instead of recomputing it per element.
    """
    w = _col(c)
    n_chars = F.length(w)

    def grams_of_length(n: int) -> Column:
        # a one-argument lambda: transform() passes the element (the start)
        starts = F.sequence(F.lit(1), n_chars - n + 1)
        return (F.when(n_chars >= n, F.transform(starts, lambda i: F.substring(w, i, F.lit(n))))
                 .otherwise(F.array().cast("array<string>")))

    return F.concat(*[grams_of_length(n) for n in range(min_n, max_n + 1)])
