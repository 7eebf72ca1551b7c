"""Text expressions with one fixed meaning of white space and word characters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The code points that count as white space, as a Java character class.
SPACE = r"[\t-\r\x1c-\x20\x85   -     　]"


#: The same code points one by one.
_SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    """Without white space at both ends; null stays null."""
    return F.btrim(c, F.lit(_SPACES))


def squeeze(c: Column) -> Column:
    """Runs of white space become one blank, ends are stripped."""
    return strip(F.regexp_replace(c, f"{SPACE}+", " "))


def none_if_empty(c: Column) -> Column:
    """Null for an empty string."""
    return F.when(c != "", c)


def clean_text(c: Column) -> Column:
    """Squeezed text; null for null, empty and blank."""
    return none_if_empty(squeeze(c))


def id_key(c: Column) -> Column:
    """An identifier as it is compared: lower case, no surrounding white space, null when blank."""
    return none_if_empty(F.lower(strip(c)))


def plain_tex(c: Column) -> Column:
    """Squeezed text with TeX quotes as plain ones; "" for null and empty."""
    c = F.coalesce(squeeze(c), F.lit(""))
    for sign, plain in (("``", '"'), ("''", '"'), ("`", "'")):
        c = F.replace(c, F.lit(sign), F.lit(plain))
    return c


def without_tags(c: Column) -> Column:
    """clean_text() with every tag read as a blank."""
    return clean_text(F.regexp_replace(c, "<[^>]+>", " "))


def slug(c: Column) -> Column:
    """Lower case, only word characters and single blanks; "" for null."""
    return F.coalesce(squeeze(F.regexp_replace(F.lower(c), rf"(?:(?![\p{{L}}\p{{N}}_]|{SPACE}).)+", "")), F.lit(""))


def rounded(c: Column, digits: int = 2) -> Column:
    """Half up on values of 0 and more, alike in every engine: floor(x * 10^digits + 0.5) / 10^digits."""
    scale = float(10**digits)
    return F.floor(c.cast("double") * scale + 0.5) / scale
