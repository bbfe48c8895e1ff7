"""Column helpers for text: splitting, trimming and unigram normalisation.

Every helper is a plain column expression, so tokenising stays in the JVM.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token separators, the white-space class of the sentence and
# link rules (the separators and U+000B), and the characters a unigram may hold
# (ASCII letters and digits; the named class is tested much faster than ranges).
BLANK = r" \t\n\r\f"
WHITE = r"\s"
UNIGRAM = r"\p{Alnum}"


def trim_control(text: Column) -> Column:
    """Strip every leading and trailing character up to U+0020."""
    return F.btrim(text, F.lit("".join(map(chr, range(0x21)))))


def normalize(token: Column, compat: bool = False) -> Column:
    """Reduce one token to its unigram.

    The strict form deletes everything but ASCII letters and digits. With
    ``compat`` only a special character directly before a ``]`` goes, together
    with that bracket.
    """
    drop = f"[^{UNIGRAM}]\\]" if compat else f"[^{UNIGRAM}]"
    return F.lower(F.regexp_replace(token, drop, ""))


def raw_tokens(text: Column) -> Column:
    """Blank-separated pieces; the first and the last may be empty."""
    return F.split(text, f"[{BLANK}]+")


def unigrams(text: Column, compat: bool = False) -> Column:
    """All unigrams of a text as an array; may hold empty strings.

    Normalising the text once, with the separators spared, gives the same
    unigrams as normalising each token and calls the regex once per row.
    """
    return raw_tokens(reduced(text, compat))


def reduced(text: Column, compat: bool = False) -> Column:
    """A text normalised as a whole, with its separators."""
    drop = f"[^{UNIGRAM}{BLANK}]\\]" if compat else f"[^{UNIGRAM}{BLANK}]+"
    return F.lower(F.regexp_replace(text, drop, ""))


def split_char(text: Column, separator: str) -> Column:
    """Split on one character, leaving out empty pieces at the end.

    A text made of separators only has no pieces; an empty text has one.
    """
    return _pieces(text, F.rtrim(text, F.lit(separator)), re.escape(separator))


def sentences(text: Column) -> Column:
    """Pieces between a period followed by white space, without empty ones at the end."""
    pieces = F.split(text, r"\." + WHITE)
    kept = F.array_max(F.transform(pieces, lambda piece, i: F.when(piece != "", i + 1).otherwise(0)))
    return F.when(text == "", F.array(F.lit(""))).otherwise(F.slice(pieces, F.lit(1), kept))


def _pieces(text: Column, body: Column, separator: str) -> Column:
    only_separators = (body == "") & (text != "")
    return F.when(only_separators, F.array().cast("array<string>")).otherwise(F.split(body, separator))


def text_lines(text: Column) -> Column:
    """Lines of a multi-line string, without an empty line after the last break."""
    n = F.char_length(text)
    body = (
        F.when(text.endswith("\r\n"), F.substring(text, F.lit(1), n - 2))
        .when(text.endswith("\n") | text.endswith("\r"), F.substring(text, F.lit(1), n - 1))
        .otherwise(text)
    )
    # A split on one character needs no regex, and most texts have no carriage return.
    return F.when(text.contains("\r"), F.split(body, r"\r\n|\r|\n")).otherwise(F.split(body, "\n"))
