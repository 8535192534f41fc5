"""Text primitives as Catalyst expressions. Lengths count code points; ``\\s`` is Unicode; only ``\\n`` ends a line."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}_]"
#: White space as a plain class, which Java matches faster than (?U)\\s; it also has the separators U+001C to U+001F.
WHITE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: The same characters.
WHITE_CHARS = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(c, F.lit(WHITE_CHARS))


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def words(c: Column) -> Column:
    """Runs of what isn't white space."""
    return F.filter(F.split(c, f"{WHITE}+", -1), lambda w: w != "")


def n_words(c: Column) -> Column:
    return F.size(words(c)).cast("long")


def count_words(c: Column) -> Column:
    """Runs of letters, digits and underscores."""
    return F.regexp_count(c, F.lit(WORD + "+")).cast("long")


def occurrences(c: Column, what: str) -> Column:
    """Non-overlapping occurrences of a literal string; a quoted pattern is searched for with a skip table."""
    return F.regexp_count(c, F.lit(rf"\Q{what}\E")).cast("long")


def contains_any(c: Column, needles: list[str]) -> Column:
    out = F.lit(False)
    for n in needles:
        out = out | F.contains(c, F.lit(n))
    return out


def drop(c: Column, pattern: str) -> Column:
    return F.regexp_replace(c, pattern, "")


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once for each row, though ``then`` uses it within other lambdas."""
    return F.element_at(F.transform(F.array(value), then), 1)
