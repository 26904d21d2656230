"""Key extraction and line tests.

``strip`` removes the whitespace that Python's ``str.strip`` removes, which is
more than Spark's one-argument ``trim`` (U+0020 only).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 characters Python counts as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed value: characters of a line shown in a sample.
PREVIEW_CHARS = 150


def col(c: Column | str) -> Column:
    """A column given by name or as it is."""
    return F.col(c) if isinstance(c, str) else c


def _starts_printable(c: Column) -> Column:
    """True when the first byte is a visible ASCII character."""
    return (c >= F.lit("!")) & (c < F.lit("\x7f"))


def strip(c: Column | str) -> Column:
    """``str.strip``. Values with a visible ASCII character at both ends, nearly
    all of them, are recognised by comparing bytes and skip the slower trim."""
    v = col(c)
    clean = _starts_printable(v) & _starts_printable(F.substr(v, F.lit(-1)))
    return F.when(clean, v).otherwise(F.btrim(v, F.lit(WHITESPACE)))


def whole_line_key(value: Column | str = "value") -> Column:
    """Key of a key-list line: the whole line, stripped; a blank line gives ''."""
    return strip(value)


def first_field_key(value: Column | str = "value", sep: str = ",") -> Column:
    """Key of a data line: the text before the first separator, stripped.

    Quotes mean nothing; a line without a separator is its own key.
    """
    return strip(F.substring_index(col(value), sep, 1))


def is_blank(value: Column | str = "value") -> Column:
    """True for nothing but whitespace; the first byte decides most lines, and
    trimming from the left stops at the first other character."""
    v = col(value)
    return ~_starts_printable(v) & (F.ltrim(v, F.lit(WHITESPACE)) == "")


def is_decodable(value: Column | str = "value") -> Column:
    """True when the bytes of the line are valid UTF-8."""
    return F.is_valid_utf8(col(value))


def preview(value: Column | str = "value", chars: int = PREVIEW_CHARS) -> Column:
    return F.left(col(value), F.lit(chars))


def key_variants(key: Column | str) -> list[Column]:
    """The spellings tried for a key that is not found, in the order tried.

    Each one starts from the key itself, not from the spelling before it.
    """
    k = col(key)

    def without(*chars: str) -> Column:
        out = k
        for ch in chars:
            out = F.replace(out, F.lit(ch), F.lit(""))
        return out

    return [k, without(" "), without("-"), without("(", ")"), without("+")]
