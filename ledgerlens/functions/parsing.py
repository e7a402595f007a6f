"""Text-field predicates and typed casts, all built-in Spark columns.

The exports are plain text and the jobs accept a field when Python's
``int()`` / ``float()`` would. Spark's casts are close but not equal (Spark
takes ``1d``, ``0x1p3``; Python takes ``1_000``), so each check is a pattern
plus ``try_cast``: the pattern decides what is a number, ``try_cast`` makes
sure it fits. ANSI mode stays on; nothing here can fail a task on a bad row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import PRICE, WEI

# Accepted spellings of integer and floating point text
# (the integer pattern documents the rule the integer cast applies).
INT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_PATTERN = (
    r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?\s*$"
    r"|(?i)^\s*[+-]?(nan|inf|infinity)\s*$"
)
DIGITS_PATTERN = r"^[0-9]+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_int(c: Column | str) -> Column:
    """Text Python's ``int()`` accepts and that fits a 64-bit integer.

    Spark's integer cast takes the same spellings (surrounding whitespace,
    sign, ASCII digits; no ``_``, no decimal point) -- it only also trims
    ASCII control characters -- so no pattern is needed here.
    """
    return F.coalesce(_col(c).try_cast("bigint").isNotNull(), F.lit(False))


def is_big_int(c: Column | str) -> Column:
    """Integer text of up to 38 digits (an amount as ``int()`` takes it)."""
    c = _col(c)
    return F.coalesce(c.rlike(INT_PATTERN) & c.try_cast(WEI).isNotNull(), F.lit(False))


def is_float(c: Column | str) -> Column:
    """Text Python's ``float()`` accepts (including nan / inf).

    Plain decimal text is recognised by the decimal cast (cheap, and it covers
    the integer amounts that make up nearly every row); only other text is
    matched against the pattern, because Spark's double cast also takes
    spellings Python rejects (``1d``, ``0x1p3``).
    """
    c = _col(c)
    plain = c.try_cast(WEI).isNotNull()
    spelled = c.rlike(FLOAT_PATTERN) & c.try_cast("double").isNotNull()
    return F.coalesce(plain | spelled, F.lit(False))


def is_digits(c: Column | str) -> Column:
    """``str.isdigit()`` for ASCII text: non-empty, digits only, no sign."""
    return F.coalesce(_col(c).rlike(DIGITS_PATTERN), F.lit(False))


def to_long(c: Column | str) -> Column:
    return _col(c).try_cast("bigint")


def to_wei(c: Column | str) -> Column:
    """Exact wei amount as ``decimal(38,0)``.

    Decimal text is parsed exactly (no rounding through a double; wei are whole,
    so a fraction is rounded half up). Other float spellings go through a double;
    ``nan``/``inf`` and values past 38 digits give null, so they are dropped
    where an amount is required.
    """
    c = _col(c)
    return F.coalesce(c.try_cast(WEI),
                      F.when(c.rlike(FLOAT_PATTERN), c.try_cast("double").try_cast(WEI)))


def is_wei(c: Column | str) -> Column:
    """Float text that also has an exact decimal value (drops nan / inf)."""
    return F.coalesce(to_wei(c).isNotNull(), F.lit(False))


def to_price(c: Column | str) -> Column:
    """Gas or gas price with its fraction, to nine digits (further ones are
    rounded half up). Spellings as in :func:`to_wei`; numbers of more than 19
    whole digits give null."""
    c = _col(c)
    return F.coalesce(c.try_cast(PRICE),
                      F.when(c.rlike(FLOAT_PATTERN), c.try_cast("double").try_cast(PRICE)))


def is_price(c: Column | str) -> Column:
    """Float text that :func:`to_price` holds (drops nan / inf)."""
    return F.coalesce(to_price(c).isNotNull(), F.lit(False))


def to_flag(c: Column | str) -> Column:
    """Export flags ``1/0/true/false`` as booleans; anything else is null."""
    c = F.lower(F.trim(_col(c).cast("string")))
    return (F.when(c.isin("1", "true"), F.lit(True))
            .when(c.isin("0", "false"), F.lit(False)))


def blank_to_null(c: Column | str) -> Column:
    """Blank addresses become null so they never match in a join."""
    c = _col(c)
    return F.when(F.trim(c) != "", c)
