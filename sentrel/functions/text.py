"""Text column expressions: cleaning, whitespace, simple token counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (character classes of the reference's cleaners).
# "pre" cleaning keeps ASCII letters and digits, Hangul syllables and
# < > / . , ! ? ' " ; : ( ) % - @ * # ^ ~ ; every other character becomes a space.
PRE_KEEP_CLASS = "a-zA-Z0-9가-힣<>/.,!?'\";:()%\\-@*#^~"
# Han characters removed by the "chinese" mode.
HAN_CLASS = "一-龥"
# Pre-translation cleaning keeps space, ASCII letters/digits/punctuation,
# Hangul syllables and jamo; runs of anything else are deleted.
FOREIGN_KEEP_CLASS = " a-zA-Z0-9가-힣ㄱ-ㅎㅏ-ㅣ!\"#$%&'()*+,\\-./:;<=>?@\\[\\]^_`{|}~\\\\"
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_text(col, mode: str | None = "pre") -> Column:
    """P09 cleaning: ``pre`` replaces every character outside the kept class by
    a space (length preserving), ``chinese`` drops Han characters, ``None``
    is the identity."""
    c = _c(col)
    if mode is None or mode == "None":
        return c
    if mode == "pre":
        return F.regexp_replace(c, f"[^{PRE_KEEP_CLASS}]", " ")
    if mode == "chinese":
        return F.regexp_replace(c, f"[{HAN_CLASS}]", "")
    raise ValueError(f"unknown cleaning mode {mode!r}")


def strip_foreign(col) -> Column:
    """P10 delete runs of characters outside the kept class."""
    return F.regexp_replace(_c(col), f"[^{FOREIGN_KEEP_CLASS}]+", "")


def squeeze_ws(col) -> Column:
    """A07 collapse whitespace runs to one space and trim."""
    return F.trim(F.regexp_replace(_c(col), r"\s+", " "))


def ws_tokens(col) -> Column:
    """Whitespace tokens (no empty tokens)."""
    return F.array_remove(F.split(_c(col), r"\s+"), "")


def marker_tokens(col) -> Column:
    """Tokens with the marker characters @ * # ^ split off as their own tokens."""
    spaced = F.regexp_replace(_c(col), "([@*#^])", " $1 ")
    return ws_tokens(spaced)


def count_spaces(col) -> Column:
    c = _c(col)
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))
