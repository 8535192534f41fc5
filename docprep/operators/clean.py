"""Cleaning of extracted text. Each step is a string -> string expression; their order is part of the result.

Steps that work by line groups split a text into blocks with a possessive
pattern and filter the blocks, so a document stays in its row: no shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import BIBLIOGRAPHY
from ..functions.text import drop, let, lines, strip

_BIB = r"(?isdU)\n#+\s*\*{0,2}\s*(?:Referencias|Bibliografía|Fuentes|Notas y referencias)\s*\*{0,2}.*"
_BIB_STRICT = r"(?isdU)\n#+\s*\*{0,2}\s*(?:Referencias bibliográficas|Referencias|Bibliografía|Fuentes consultadas|Fuentes|Notas y referencias)\s*\*{0,2}[ \t]*(?:\n.*)?\z"
_INDEX = r"(?imdU)#{1,3}\s*\*{0,2}\s*(?:[ÍI]NDICE|Sumario|Contenido|Tabla de contenidos?|Table of contents?)\s*\*{0,2}\s*$"
_TABLE_BLOCKS = r"(?md)(?:^\|[^\n]*+(?:\n|\z))++|(?:^[^|\n][^\n]*+(?:\n|\z)|^\n)++"


def bibliography(c: Column, whole_word: bool = False) -> Column:
    """CLN1: cut at the first bibliography heading; ``whole_word`` spares headings that only begin like one."""
    return drop(c, _BIB_STRICT if whole_word else _BIB)


def index_block(c: Column) -> Column:
    """CLN2: the first index heading and what follows, up to the next heading."""

    def cut(t: Column) -> Column:
        at = F.regexp_instr(t, F.lit(_INDEX))
        rest = F.substring(t, at + F.length(F.regexp_extract(t, _INDEX, 0)), F.length(t))

        def tail(r: Column) -> Column:
            stop = F.regexp_instr(r, F.lit(r"(?md)^#{1,3}\s"))
            return F.when(stop > 0, F.substring(r, stop, F.length(r))).otherwise("")

        return F.when(at > 0, F.concat(F.substring(t, F.lit(1), at - 1), F.lit("\n"), let(rest, tail))).otherwise(t)

    return let(c, cut)


def dot_leaders(c: Column) -> Column:
    """CLN3"""
    return drop(c, r"(?mdU)^.+?(?:\.{2,}|(?:\. ){3,}\.?)\s*\d+\s*$")


def index_tables(c: Column) -> Column:
    """CLN4: blocks of table lines of which more than 30 in 100 data rows have dot leaders."""

    def is_index(b: Column) -> Column:
        rows = F.filter(lines(F.regexp_replace(b, r"\n\z", "")), lambda x: ~x.rlike(r"\A\|[-: |]+\|\z"))
        dots = F.size(F.filter(rows, lambda x: x.rlike(r"\.{3,}|(?:\. ){3,}")))
        return b.startswith("|") & (dots / F.greatest(F.size(rows), F.lit(1)) > 0.3)

    def rest(blocks: Column) -> Column:
        kept = F.array_join(F.filter(blocks, lambda b: ~is_index(b)), "")
        return F.when(is_index(F.element_at(blocks, -1)), F.regexp_replace(kept, r"\n\z", "")).otherwise(kept)

    return let(c, lambda t: F.when(F.contains(t, F.lit("|")), let(F.regexp_extract_all(t, F.lit(_TABLE_BLOCKS), F.lit(0)), rest)).otherwise(t))


def images(c: Column) -> Column:
    """CLN5"""
    return drop(c, r"(?d)!\[.*?\]\(.*?\)")


def omitted(c: Column) -> Column:
    """CLN6"""
    return drop(c, r"(?idU)\*\*==>.*?intentionally omitted.*?<==\*\*")


def captions(c: Column) -> Column:
    """CLN7"""
    return drop(c, r"(?imdU)^Figura\s+\d+[\.:].*$")


def quoted_notes(c: Column) -> Column:
    """CLN8"""
    return drop(c, r"(?mdU)^>\s*\d+\s+.+$")


def plain_notes(c: Column) -> Column:
    """CLN9"""
    return drop(c, r"(?imdU)^\d{1,2}(?:También|Además|Para|Véase|Ver |Cf\.|Ibid|Op\. ?cit|Referido|Nota)\b.+$")


def long_citations(c: Column) -> Column:
    """CLN10: parentheses of 80 and more characters with two and more semicolons."""
    return drop(c, r"\((?=[^)]{80,}\))(?=[^);]*;[^);]*;)[^)]{80,}\)")


def dehyphenate(c: Column) -> Column:
    """CLN11, PRE2"""
    return F.regexp_replace(c, r"(?<![\p{L}\p{N}_])([\p{L}\p{N}_]++)-\n([\p{L}\p{N}_]+)", "$1$2")


def number_lines(c: Column) -> Column:
    """CLN12, PRE5"""
    return drop(c, r"(?mdU)^\s*\d+\s*$")


def collapse(c: Column) -> Column:
    """CLN13, PRE8"""
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


CLEAN_STEPS = (bibliography, index_block, dot_leaders, index_tables, images, omitted, captions, quoted_notes, plain_notes, long_citations, dehyphenate, number_lines, collapse)


def clean_markdown(c: Column) -> Column:
    """PIP2: all steps in order."""
    return reduce(lambda x, step: step(x), CLEAN_STEPS, c)


#: Typographic ligatures.
LIGATURES = {"ﬁ": "fi", "ﬂ": "fl", "ﬀ": "ff", "ﬃ": "ffi", "ﬄ": "ffl"}


def ligatures(c: Column) -> Column:
    """PRE1"""
    return reduce(lambda x, kv: F.replace(x, F.lit(kv[0]), F.lit(kv[1])), LIGATURES.items(), c)


def page_of(c: Column) -> Column:
    """PRE3"""
    return drop(c, r"(?imdU)^.*P[áa]gina\s+\d+\s+de\s+\d+.*$")


def page_slash(c: Column) -> Column:
    """PRE4"""
    return drop(c, r"(?mdU)^\s*\d+\s*/\s*\d+\s*$")


def _stripped_lines(c: Column) -> Column:
    return F.filter(F.transform(lines(c), strip), lambda s: (F.length(s) > 5) & (F.length(s) < 100))


def repeated(stripped: Column) -> Column:
    """Of stripped lines those that stand more than three times: in sorted order the fourth equals the first."""

    def found(s: Column) -> Column:
        n = F.greatest(F.size(s) - 3, F.lit(0))
        return F.array_distinct(F.array_compact(F.zip_with(F.slice(s, F.lit(1), n), F.slice(s, F.lit(4), n), lambda a, b: F.when(a == b, a))))

    return let(F.array_sort(stripped), found)


def repeated_lines(c: Column) -> Column:
    """PRE6"""
    return let(c, lambda t: let(repeated(_stripped_lines(t)), lambda again: F.when(F.size(again) > 0, F.array_join(F.filter(lines(t), lambda x: ~F.array_contains(again, strip(x))), "\n")).otherwise(t)))


def n_repeated_lines(c: Column) -> Column:
    return let(_stripped_lines(c), lambda own: let(repeated(own), lambda again: F.size(F.filter(own, lambda x: F.array_contains(again, x))).cast("long")))


def blanks(c: Column) -> Column:
    """PRE7"""
    return F.regexp_replace(c, r"[ \t]+", " ")


BEFORE_REPEATED = (ligatures, dehyphenate, page_of, page_slash, number_lines)


def preclean(c: Column) -> Column:
    """PIP3: a struct of the text and PRE9's figures."""

    def counted(before: Column, text: Column) -> Column:
        return F.struct(
            text.alias("text"), (F.length(c) - F.length(text)).cast("long").alias("chars_removed"), F.length(c).cast("long").alias("chars_before"),
            F.length(text).cast("long").alias("chars_after"), n_repeated_lines(before).alias("repeated_lines_removed"),
        )

    return let(reduce(lambda x, step: step(x), BEFORE_REPEATED, c), lambda before: let(collapse(blanks(repeated_lines(before))), lambda text: counted(before, text)))


def _is_bibliography(section: Column) -> Column:
    low = F.ltrim(F.lower(section))
    return reduce(lambda a, h: a | F.startswith(low, F.lit(h)), BIBLIOGRAPHY, F.lit(False))


def strip_needless(c: Column) -> Column:
    """STR1-3: without bibliography sections (they end at the next heading of level 1 or 2) and lines that begin with an image."""
    t = F.regexp_replace(F.regexp_replace(c, "\r\n|[\r\x0b\x0c\x1c-\x1e\x85  ]", "\n"), r"\n\z", "")
    sections = F.split(t, r"(?md)(?=^[^\S\n]*#{1,2}[^\S\n]+\S)", -1)
    return let(sections, _without_needless)


def _without_needless(sections: Column) -> Column:
    biblio = F.filter(sections, _is_bibliography)
    rest = F.array_join(F.filter(sections, lambda s: ~_is_bibliography(s)), "")
    rest = F.when(_is_bibliography(F.element_at(sections, -1)), F.regexp_replace(rest, r"\n\z", "")).otherwise(rest)
    return let(rest, lambda r: let(F.array_join(biblio, ""), lambda b: _counted_needless(r, biblio, b)))


def _counted_needless(rest: Column, biblio: Column, joined: Column) -> Column:
    image = r"(?U)\A\s*!\[.*?\]\(.*?\)"
    n_images = F.size(F.filter(lines(rest), lambda x: x.rlike(image)))
    n_biblio = F.when(F.size(biblio) > 0, F.regexp_count(joined, F.lit("\n")) + F.when(joined.endswith("\n"), 0).otherwise(1)).otherwise(0)
    kept = F.array_join(F.filter(lines(rest), lambda x: ~x.rlike(image)), "\n")
    return F.struct(kept.alias("text"), n_images.cast("long").alias("images_removed"), n_biblio.cast("long").alias("biblio_lines_removed"), ((n_images + n_biblio) * 5).cast("long").alias("tokens_saved"))


FENCE = "```"


def unwrap_fence(c: Column) -> Column:
    """FIX1"""
    return let(strip(c), lambda t: F.when(t.startswith(FENCE), F.regexp_replace(F.regexp_replace(t, r"\A```[\p{L}\p{N}_]*\n", ""), r"\n```\z", "")).otherwise(t))


def drop_preamble(c: Column) -> Column:
    """FIX2"""
    return drop(c, r"(?idU)\A(?:Aquí tienes.*?\n+|A continuación.*?\n+)")


def split_gaps(c: Column) -> Column:
    """GAP1: what stands before the section of gaps, and its text."""
    return let(c, _split_gaps)


def _split_gaps(c: Column) -> Column:
    heading = r"(?i)## Lagunas detectadas"
    at = F.regexp_instr(c, F.lit(heading))
    before = strip(F.substring(c, F.lit(1), at - 1))
    before = F.when(before.endswith("---"), strip(F.regexp_replace(before, r"---\z", ""))).otherwise(before)
    return F.struct(F.when(at > 0, before).otherwise(c).alias("text"), F.when(at > 0, strip(F.substring(c, at + len("## Lagunas detectadas"), F.length(c)))).otherwise("").alias("gaps"))


def text_only(c: Column) -> Column:
    """TXT1: without table lines."""
    return drop(c, r"(?md)^\|.*\|$")


#: Characters of the Windows code page for the bytes 80 to 9F, as they stand in texts that were decoded by it, and those bytes' own.
WINDOWS_BYTES = "".join(bytes([b]).decode("cp1252") for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
OWN_BYTES = "".join(chr(b) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))


def _bytes(low: int, high: int) -> str:
    """Class of the characters that bytes of a range may have become."""
    windows = "".join(w for w, o in zip(WINDOWS_BYTES, OWN_BYTES, strict=True) if low <= ord(o) <= high)
    return f"[{chr(low)}-{chr(high)}{windows}]"


#: A character of two to four bytes in UTF-8, each byte read as a character by itself.
MISREAD = "|".join(
    (
        "[\u00c2-\u00df]" + _bytes(0x80, 0xBF), "\u00e0" + _bytes(0xA0, 0xBF) + _bytes(0x80, 0xBF), "[\u00e1-\u00ec\u00ee\u00ef]" + _bytes(0x80, 0xBF) * 2, "\u00ed" + _bytes(0x80, 0x9F) + _bytes(0x80, 0xBF),
        "\u00f0" + _bytes(0x90, 0xBF) + _bytes(0x80, 0xBF) * 2, "[\u00f1-\u00f3]" + _bytes(0x80, 0xBF) * 3, "\u00f4" + _bytes(0x80, 0x8F) + _bytes(0x80, 0xBF) * 2,
    )
)


def misread_utf8(c: Column) -> Column:
    """Repairs UTF-8 that was read as Latin-1 or by the Windows code page, run by run; what isn't such a run stays."""

    def repaired(run: Column) -> Column:
        return F.decode(F.encode(F.translate(run, WINDOWS_BYTES, OWN_BYTES), "ISO-8859-1"), "UTF-8")

    parts = F.regexp_extract_all(c, F.lit(rf"(?s)(?:{MISREAD})++|[^\u00c2-\u00f4]++|."), F.lit(0))
    return F.when(~c.rlike(MISREAD), c).otherwise(F.array_join(F.transform(parts, lambda p: F.when(p.rlike(rf"\A(?:{MISREAD})"), repaired(p)).otherwise(p)), ""))
