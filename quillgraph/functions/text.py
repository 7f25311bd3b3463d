"""Text functions: Column -> Column, all inside the JVM. Null in, null out, unless said otherwise."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.strip() and \s see it; the class reads the same in Java and RE2.
WS = r"[\x09-\x0D\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: What ends a line for str.splitlines().
LINE_END = r"[\x0A-\x0D\x1C-\x1E\x85\x{2028}\x{2029}]"

# Patterns that results depend on.
HEADING = r"^(chapter|capitol|section|sectiunea|sectiune|cap\.|chap\.|\d+\.|[ivxlcdm]+\.|appendix)\b"
SNAKE_OTHER = "[^0-9A-Za-zăâîșțĂÂÎȘȚ]+"
ENGLISH_MARKERS = ("english", "in english", "engleza")
ROMANIAN_MARKERS = ("romanian", "romana", "în română", "in romana")


def _ascii_table() -> tuple[str, str, dict[str, str]]:
    """From Latin letters with marks and common punctuation to ASCII: one-to-one part, and what takes several letters."""
    single, several = {}, {}
    for cp in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFKD", chr(cp)) if not unicodedata.combining(c))
        if base.isascii() and base:
            (single if len(base) == 1 else several)[chr(cp)] = base
    # fixed values: letters and marks that do not decompose
    several |= {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "þ": "th", "Þ": "Th", "ẞ": "SS", "…": "...", "—": "--", "€": "EUR", "«": "<<", "»": ">>", "°": "deg"}
    single |= {"ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "ł": "l", "Ł": "L", "ı": "i", "–": "-", "‘": "'", "’": "'", "“": '"', "”": '"', "„": '"', "¡": "!", "¿": "?", "\xa0": " "}
    return "".join(single), "".join(single.values()), {k: v for k, v in several.items() if k not in single}


FROM, TO, SEVERAL = _ascii_table()


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def transliterate(c: Column) -> Column:
    """To ASCII for Latin letters with marks and common punctuation; other characters stay."""
    c = F.translate(c, FROM, TO)
    for a, b in SEVERAL.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def collapse_space(c: Column) -> Column:
    """Three and more newlines to two, then runs of blanks and tabs to one blank (single tabs stay)."""
    return F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r"[ \t]{2,}", " ")


def normalized(c: Column, to_ascii: bool = True, space: bool = True) -> Column:
    c = transliterate(c) if to_ascii else c
    return collapse_space(c) if space else c


def content_hash(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


def snake(c: Column) -> Column:
    """An identifier that keeps Romanian letters: other runs become one underscore, none at the ends, lower case."""
    return F.lower(F.trim(F.regexp_replace(strip(c), SNAKE_OTHER, "_"), F.lit("_")))


def key(c: Column) -> Column:
    """A key of a-z, 0-9 and _: lower case first, so letters with marks are lost."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(strip(c)), "[^a-z0-9_]+", "_"), "_+", "_"), F.lit("_"))


def language(c: Column) -> Column:
    """en or ro from an instruction; English markers are looked for first, en is the default."""
    low = F.lower(c)

    def has(markers: tuple[str, ...]) -> Column:
        found = F.lit(False)
        for m in markers:
            found = found | low.contains(m)
        return found

    return F.when(has(ENGLISH_MARKERS), "en").when(has(ROMANIAN_MARKERS), "ro").otherwise("en")


def sentences(c: Column) -> Column:
    """Array: the text cut after . ! ? where white space follows."""
    return F.split(c, f"(?<=[.!?]){WS}+")


def io_tokens(c: Column) -> Column:
    """Set (array) of the runs of a-z and 0-9 in lower case."""
    return F.array_distinct(F.filter(F.split(F.lower(c), "[^a-z0-9]+"), lambda t: t != ""))


def key_tokens(c: Column) -> Column:
    """Set (array) of what stands between underscores; the empty key has one empty token."""
    return F.array_distinct(F.split(c, "_"))


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets (arrays); 0 if either is empty."""
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)).cast("double"))


def first_line(c: Column) -> Column:
    return F.regexp_extract(strip(c), f"^([^{LINE_END[1:]}*)", 1)


def title(c: Column) -> Column:
    return F.substring(strip(first_line(c)), 1, 120)


def is_heading(line: Column) -> Column:
    return line.rlike("(?iU)" + HEADING)


def is_blank(c: Column) -> Column:
    return ~c.rlike(f"[^{WS[1:]}")


def joined(c: Column, empty: str = "—") -> Column:
    """Array of strings joined by a comma and a blank; a dash for null and for nothing to show."""
    return F.coalesce(F.nullif(F.array_join(c, ", "), F.lit("")), F.lit(empty))


def quoted(c: Column) -> Column:
    """Double quotes with a backslash before each."""
    return F.replace(c, F.lit('"'), F.lit('\\"'))
