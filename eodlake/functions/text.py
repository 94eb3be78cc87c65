"""Lenient text handling: bad text becomes null, never an error (ANSI mode stays on).

Only built-in expressions, so everything stays inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space; Spark's plain trim() only knows the space character
_SPACES = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)

_NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def col(name: str) -> Column:
    """Column by verbatim header name (dots, blanks and back-quotes allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(_SPACES))


def identifier(c: Column) -> Column:
    """Strip and upper-case."""
    return F.upper(strip(c))


def to_long(c: Column) -> Column:
    """Whole numbers only: '1.0' and '-' give null. The cast itself ignores outer white space."""
    return c.try_cast("bigint")


def to_double(c: Column) -> Column:
    """Plain decimal numbers only.

    Spark's cast also takes Java spellings ('1d', '0x1p3', 'NaN', 'Infinity'): the pattern keeps
    them out. It is one small call per field; longer expressions make a projection of a dozen fields
    too large for the JVM to compile.
    """
    return F.when(c.rlike(_NUMBER), c.try_cast("double"))


def round_to(c: Column, digits: int) -> Column:
    """Round the scaled binary value half away from zero, so 1.005 gives 1.0.

    Spark's own round works on the decimal spelling of a double and would give 1.01.
    """
    factor = 10.0**digits
    return F.round(c * factor, 0) / factor


def to_date(c: Column, *patterns: str) -> Column:
    """First pattern that fits, else null. The text is taken as it is: strip it first if need be."""
    return F.coalesce(*[F.try_to_date(c, p) for p in patterns])


def blank_to(c: Column, default: str) -> Column:
    """Strip and upper-case; null or blank becomes `default`."""
    return F.coalesce(F.nullif(identifier(c), F.lit("")), F.lit(default))
