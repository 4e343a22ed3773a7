"""String helpers as Column expressions: trimming, tag removal, patterns, numbers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: white space as Python's str.strip() and str.split() see it ---
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WS = r"\s\x1c\x1d\x1e\x1f\x{85}\p{Z}"  # the same set inside a regex class
WORD = r"\p{L}\p{N}_"

# --- Fixed values: the order of the HTML text steps and their patterns ---
# Each has a second way: what is never closed is taken to the end of the text, as group 1, and put back.
# So the end is looked for once, not once per opening.
SCRIPT_BLOCK = r"(?is)<script[^>]*+>.*?</script>|(<script.*+\z)"
STYLE_BLOCK = r"(?is)<style[^>]*+>.*?</style>|(<style.*+\z)"
BLOCK_TAG = r"(?i)<(?:p|div|br|h[1-6]|li|tr)[^>]*+>|(<(?:p|div|br|h[1-6]|li|tr)[^>]*+\z)"
ANY_TAG = r"<[^>]++>|(<[^>]*+\z)"
TITLE = r"(?is)<title(?:[^>]*+>(.*?)</title>|.*+\z)"
LINK = r"(?i)<a[" + WS + "]"
ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&quot;", '"')]
EMPTY_HTML = "(empty HTML)"

# --- Fixed values: number syntax accepted by Python's float() ---
_DIGITS = r"[0-9]++(?:_[0-9]++)*+"
FLOAT_TEXT = (
    rf"(?i)\A[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    r"|nan|inf(?:inity)?)\z"
)


def strip(c: Column) -> Column:
    """Trim white space of any kind, not only blanks."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    return strip(c) == ""


def collapse_blanks(c: Column) -> Column:
    """White-space runs to single blanks, line ends kept, ends trimmed, control characters dropped.

    One pattern does both "tab-like run to blank" and "several blanks to one": any run of these
    characters other than a lone blank.
    """
    c = F.regexp_replace(c, r"[\t\r\x0b\x0c][ \t\r\x0b\x0c]*| [ \t\r\x0b\x0c]+", " ")
    return F.regexp_replace(strip(c), r"[\x00-\x08\x0e-\x1f\x7f]+", "")


def drop_tags(c: Column) -> Column:
    """Delete tags (nothing put in their place)."""
    return strip(F.regexp_replace(c, ANY_TAG, "$1"))


def tags_to_blanks(c: Column) -> Column:
    """Tags to blanks, white space collapsed: the form used for HTML mail parts."""
    return strip(F.regexp_replace(F.regexp_replace(c, ANY_TAG, "$1 "), f"[{WS}]+", " "))


def html_to_text(c: Column) -> Column:
    """Readable text of a page; blank when nothing is left."""
    c = F.regexp_replace(c, SCRIPT_BLOCK, "$1")
    c = F.regexp_replace(c, STYLE_BLOCK, "$1")
    c = F.regexp_replace(c, BLOCK_TAG, "$1\n")  # white space behind what is never closed goes with the last step
    c = F.regexp_replace(c, ANY_TAG, "$1 ")
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    c = F.regexp_replace(c, r"[ \t]+", " ")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def html_title(c: Column) -> Column:
    return strip(F.regexp_extract(c, TITLE, 1))


def link_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(LINK))


def or_placeholder(text: Column, placeholder: str) -> Column:
    return F.when(is_blank(text), F.lit(placeholder)).otherwise(text)


def word_count(c: Column) -> Column:
    """Number of words between white space.

    A short positive class: long and negated classes are several times slower, and stay slow on
    many cores.
    """
    return F.when(is_blank(c), 0).otherwise(F.size(F.split(strip(c), f"[{WS}]+")))


def java_regex(pattern: str) -> str:
    """A Python pattern in Java syntax, with Python's Unicode classes and line ends."""

    def swap(m: re.Match) -> str:
        token = m.group(0)
        if token == r"\Z":
            return r"\z"
        if token == "(?P<":
            return "(?<"
        if token.startswith("(?P="):
            return rf"\k<{m.group(1)}>"
        return token

    return "(?Ud)" + re.sub(r"\\.|\(\?P<|\(\?P=(\w+)\)", swap, pattern, flags=re.DOTALL)


def parse_float(c: Column) -> Column:
    """Text to DOUBLE by Python's rules; null when it is no number."""
    text = strip(c)
    return F.when(text.rlike(FLOAT_TEXT), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
