"""Text clean-up expressions (all JVM side)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a full two-sided strip removes (Unicode white space plus the four
# ASCII separators).
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(chr(c) for c in range(0x2000, 0x200B))
    + "\u2028\u2029\u202f\u205f\u3000"
)


def _visible(character: Column) -> Column:
    """Whether it is one of the printable ASCII characters, of which none is blank."""
    return (character >= F.lit("!")) & (character <= F.lit("~"))


def strip(column: Column) -> Column:
    """Remove white space of every kind from both ends (plain ``trim`` keeps tabs).

    Trimming looks up each end in the list of blanks, which is slow; most texts show at their ends, once plain blanks are off, that
    there is nothing else to do.
    """
    plain = F.trim(column)
    first, last = F.substring(plain, 1, 1), F.substring(plain, -1, 1)
    return F.when(_visible(first) & _visible(last), plain).otherwise(F.btrim(column, F.lit(BLANKS)))


def clean_label(column: Column, trailing: str = ".") -> Column:
    """Strip, then drop every trailing ``trailing`` character, then strip again."""
    first, last = F.substring(column, 1, 1), F.substring(column, -1, 1)
    whole = F.rtrim(F.btrim(column, F.lit(BLANKS)), F.lit(trailing))
    done = _visible(first) & _visible(last) & ~F.lit(trailing).contains(last)
    return F.when(done, column.cast("string")).otherwise(F.btrim(whole, F.lit(BLANKS)))


def sentinel_to_null(column: Column, words: Sequence[str]) -> Column:
    """NULL for the words that mark a missing value, the value itself otherwise."""
    return F.when(column.isin(*words), F.lit(None)).otherwise(column)
