"""Column expressions for cleaning and typing capture fields (JVM-side, ANSI-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tokens of the boolean field.
TRUE_TOKENS = ["true", "1", "yes", "y", "on"]
FALSE_TOKENS = ["false", "0", "no", "n", "off"]
# Fixed value: number of flags kept from the boolean field (padded / cut).
N_FLAGS = 3


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: str | Column) -> Column:
    """Trim surrounding whitespace (spaces, tabs, newlines)."""
    return F.btrim(_col(c), F.lit(" \t\n\x0b\f\r"))


def bool_token(tok: Column) -> Column:
    """One token to 1.0 / 0.0 / null (C2 ``map_boolean_single``)."""
    known = [(t, 1.0) for t in TRUE_TOKENS] + [(t, 0.0) for t in FALSE_TOKENS]
    return F.element_at(F.create_map(*[F.lit(x) for pair in known for x in pair]), strip(F.lower(tok)))


def boolean_parts(c: str | Column) -> Column:
    """The comma-separated parts of a boolean field."""
    return F.split(F.lower(strip(_col(c))), ",")


def boolean_flags(c: str | Column) -> list[Column]:
    """Comma-separated flags to ``N_FLAGS`` doubles (missing / invalid -> null)."""
    return part_flags(boolean_parts(c))


def part_flags(parts: str | Column) -> list[Column]:
    """C1 of ``boolean_parts``."""
    return [bool_token(F.get(_col(parts), F.lit(i))) for i in range(N_FLAGS)]


def hex_text(c: str | Column) -> Column:
    """Lower-cased hex digits without ``0x``; null unless the rest is all hex digits."""
    s = F.replace(F.lower(strip(_col(c).cast("string"))), F.lit("0x"), F.lit(""))
    return F.when(s.rlike("^[0-9a-f]+$"), s)


def hex_int(c: str | Column) -> Column:
    """C4: hex text of any width to DECIMAL(38,0); leading zeros do not count.

    Null when not hex, or beyond 31 significant digits, which that type cannot hold.
    """
    return hex_value(significant(hex_text(c)))


def significant(digits: str | Column) -> Column:
    """Hex digits without leading zeros (none are left of zero)."""
    return F.ltrim(_col(digits), F.lit("0"))


def hex_value(digits: str | Column) -> Column:
    """C4 of ``significant`` digits: up to 15 of them fit a long."""
    s = _col(digits)
    low = F.conv(F.concat(F.lit("0"), F.right(s, F.lit(15))), 16, 10).cast("bigint")
    return (F.when(F.length(s) <= 15, low.cast("decimal(38,0)"))
            .when(F.length(s) <= 31, _wide(s, low.cast("decimal(19,0)"))))


def _wide(s: Column, low: Column) -> Column:
    """Digits above the lowest 15, times 16^15, plus the lowest 15."""
    above = F.left(s, F.greatest(F.length(s) - 15, F.lit(0)))
    high = F.coalesce(F.conv(F.concat(F.lit("0"), above), 16, 10), F.lit("0")).cast("decimal(20,0)")
    return (high * F.lit(16 ** 15).cast("decimal(19,0)") + low).cast("decimal(38,0)")


def popcount_hex(c: str | Column) -> Column:
    """Number of one bits in a hex value of any length (counted per digit)."""
    return popcount(hex_text(c))


def popcount(digits: str | Column) -> Column:
    """C5 of hex digits: those with at least one bit, two, three and four bits."""
    left = [F.length(F.translate(_col(digits), none, "")) for none in ("0", "01248", "012483569ac", "012483569ac7bde")]
    return (left[0] + left[1] + left[2] + left[3]).cast("double")


def to_number(c: str | Column) -> Column:
    """Numeric coercion; bad text -> null (never an ANSI error)."""
    return _col(c).cast("string").try_cast("double")


def epoch_seconds(c: str | Column) -> Column:
    """Timestamp or timestamp text to epoch seconds; unparseable -> null."""
    x = _col(c)
    ts = F.coalesce(x.cast("string").try_cast("timestamp"), F.try_to_timestamp(x.cast("string")))
    return F.unix_micros(ts) / F.lit(1_000_000.0)


def finite(c: str | Column) -> Column:
    """NaN and +-inf -> null."""
    x = _col(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None)).otherwise(x)
