"""Text rules as Column expressions (JVM side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that count as whitespace, line ends, and the patterns built on them. Ranges are spelled out
# because Java's Unicode class mode is several times slower and does not cover 1C to 1F.
_BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
WHITESPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
RULE_LINE = rf"(?dm)^-{{30,}}{WHITESPACE}*$"
TOPIC_LINE = rf"^{WHITESPACE}*###{WHITESPACE}+(.+?){WHITESPACE}*$"
NOT_A_WORD = r"[^\p{L}\p{N}]+"


def strip(text: Column) -> Column:
    """Remove whitespace at both ends."""
    return F.trim(text, F.lit(_BLANKS))


def collapse(text: Column) -> Column:
    """Every whitespace run becomes one space; none at the ends."""
    return F.trim(F.regexp_replace(text, f"{WHITESPACE}+", " "))


def content_hash(text: Column) -> Column:
    """SHA-256 (hex) of the whitespace-normalised text."""
    return F.sha2(collapse(text), 256)


def lines(text: Column) -> Column:
    return F.split(text, LINE_END)


def words(text: Column) -> Column:
    """Whitespace-separated words."""
    return F.filter(F.split(text, f"{WHITESPACE}+"), lambda w: w != "")


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits, in order, with repeats."""
    return F.filter(F.split(F.lower(text), NOT_A_WORD), lambda t: t != "")


def window_starts(length: Column, size: int, overlap: int) -> Column:
    """0-based starts of windows of ``size`` that advance by ``size - overlap`` and cover ``length``."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    step = size - overlap
    last = F.greatest(F.ceil((length - overlap) / F.lit(step)) - 1, F.lit(0)).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: i * step)


def gold_query_id(query_id: Column) -> Column:
    """``parse_a_b_01`` and ``a_b`` both give ``a_b``."""
    return F.substring_index(F.regexp_replace(query_id, "^parse_", ""), "_", 2)


def graded_relevance(raw: Column) -> Column:
    """A label as INT: text numbers are truncated, everything unreadable is 0."""
    number = raw.cast("string").try_cast("double")
    return F.coalesce(number.try_cast("int"), F.lit(0))
