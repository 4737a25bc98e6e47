"""Text expressions. Whitespace means every Unicode blank, not only spaces."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from wattlake.constants import PLACEHOLDERS

# Every character that counts as blank: controls, line ends and the Unicode spaces.
BLANK_CHARS = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
BLANKS = r"[\t-\r\x1c-\x1f\x85\p{Z}]+"  # the same set as a pattern
WORD_OR_GAP = r"(\p{L}+|[^\p{L}]+)"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once.

    Filters on a computed column are pushed below its projection with the whole
    expression copied in. An expression that names its input several times then
    grows with every such layer; bound to a variable it is named once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Without blanks at the edges. A trim by characters, much cheaper than a pattern."""
    return F.btrim(text, F.lit(BLANK_CHARS))


def has_text(value: Column) -> Column:
    """Not null and not only blanks; null stays null so that a filter drops it."""
    return strip(value.cast("string")) != ""


def lacks_text(value: Column) -> Column:
    """True for null and for blank text; never null."""
    return ~F.coalesce(has_text(value), F.lit(False))


def clean_text(text: Column) -> Column:
    """Lower case, no blanks at the edges, one space between words."""
    return F.regexp_replace(strip(F.lower(text)), BLANKS, " ")


def empty_to_null(text: Column) -> Column:
    return F.nullif(strip(text), F.lit(""))


def is_placeholder(text: Column, tokens: Iterable[str] = PLACEHOLDERS) -> Column:
    return strip(F.lower(text)).isin(*tokens)


def placeholder_to_null(text: Column) -> Column:
    """Trimmed text, or null where the trimmed text only says that nothing is known."""
    trimmed = strip(text)
    return F.when(~F.lower(trimmed).isin(*PLACEHOLDERS), trimmed)


def title_case(text: Column) -> Column:
    """Capitalise each run of letters (``guinea-bissau`` gives ``Guinea-Bissau``).

    A letter that has two capitals keeps the second one small (``ß`` gives ``Ss``).
    """
    pieces = F.regexp_extract_all(F.lower(text), F.lit(WORD_OR_GAP), F.lit(1))
    return F.array_join(
        F.transform(pieces, lambda p: F.concat(F.initcap(F.upper(F.substring(p, 1, 1))), F.substring(p, 2, 2**31 - 1))),
        "",
    )


def lookup(mapping: Mapping[str, str], key: Column) -> Column:
    """Value of a fixed small vocabulary, null when the key is not in it."""
    entries = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.element_at(entries, key)


def canonical(text: Column, aliases: Mapping[str, str]) -> Column:
    """Alias of the cleaned text, else the title-cased text; placeholders give null."""

    def named(trimmed: Column) -> Column:
        return let(
            F.regexp_replace(F.lower(trimmed), BLANKS, " "),
            lambda cleaned: F.when(
                ~cleaned.isin(*PLACEHOLDERS), F.coalesce(lookup(aliases, cleaned), title_case(trimmed))
            ),
        )

    return let(strip(text), named)
