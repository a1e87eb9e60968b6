"""Text cleaning for keys and postcodes."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from .dates import _col


def clean_code(c) -> Column:
    """Trimmed, upper-cased code; an empty one becomes null."""
    return F.nullif(F.upper(F.trim(_col(c))), F.lit(""))


def postcode_compact(c) -> Column:
    return F.upper(F.regexp_replace(F.trim(_col(c)), " ", ""))


def postcode_standard(c) -> Column:
    """'ne127ab' -> 'NE12 7AB'; shorter than five characters: only compacted."""
    pc = postcode_compact(c)
    spaced = F.concat(F.left(pc, F.length(pc) - 3), F.lit(" "), F.right(pc, F.lit(3)))
    return F.when(F.length(pc) >= 5, spaced).otherwise(pc)


def postcode_area(c) -> Column:
    """The letters before the first digit, the whole text where there is none."""
    return F.regexp_extract(postcode_compact(c), r"^([^0-9]*)", 1)


def postcode_sector(standard) -> Column:
    """A standardised postcode without its last two characters."""
    pc = _col(standard)
    return F.when(F.length(pc) >= 5, F.left(pc, F.length(pc) - 2)).otherwise(pc)


def postcode_was_dirty(c) -> Column:
    """Case-sensitive: some letter was lower case, or there was no space."""
    raw = _col(c)
    return F.coalesce((raw != F.upper(raw)) | ~F.contains(raw, F.lit(" ")), F.lit(False))


def is_lower_case(c) -> Column:
    raw = _col(c)
    return F.coalesce(raw != F.upper(raw), F.lit(False))


def join_flags(*flags: Column) -> Column:
    """Flags that are not null, joined with '; '; none at all gives null."""
    return F.nullif(F.concat_ws("; ", *flags), F.lit(""))
