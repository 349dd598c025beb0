"""Delivered numbers: arbitrary-precision decimal text to an exact DECIMAL(18,4).

The contract reads numbers the way Python's ``decimal`` does: underscores and Unicode
digits are allowed, exponents are allowed, the range is checked on the exact value, a
unit conversion rounds its product to 28 significant digits, and the result is rounded
half-even to four places.  Nearly all numbers take the short path (a plain cast); the
rest are rebuilt digit by digit with a sticky digit standing for whatever lies beyond
the 38 digits a Spark decimal can hold.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from batchgate.functions.text import ascii_digits, full_match

_NUMBER = r"\A([+-]?)(?=[0-9]|\.[0-9])([0-9]*)(?:\.([0-9]*))?(?:[eE]([+-]?[0-9]+))?\z"
_RESULT = "decimal(18,4)"


def _bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once; keeps the rare path out of hot code."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _fixed_point(digits: Column, point: Column) -> Column:
    """Text of ``0.<digits> * 10**point``."""
    whole = F.when(point > 0, F.substring(digits, F.lit(1), point)).otherwise(F.lit("0"))
    rest = F.when(point > 0, F.substring(digits, point + 1, F.length(digits))).otherwise(
        F.concat(F.repeat(F.lit("0"), -point), digits)
    )
    return F.concat(whole, F.lit("."), rest)


def _parts(text: Column) -> Column:
    """Sign, whole and fraction digits, exponent of a matching number."""
    part = lambda i: F.regexp_extract(text, _NUMBER, i)
    exponent = F.when(part(4) == "", F.lit("0")).otherwise(part(4))
    return F.struct(
        (part(1) == "-").alias("negative"), part(2).alias("whole"),
        F.concat(part(2), part(3)).alias("mantissa"),
        exponent.try_cast("long").cast("decimal(20,0)").alias("exponent"),
    )


def _scientific(p: Column) -> Column:
    """The value as ``0.<digits> * 10**magnitude`` with digits not starting with zero."""
    digits = F.ltrim(p["mantissa"], F.lit("0"))
    zeros = F.length(p["mantissa"]) - F.length(digits)
    magnitude = F.length(p["whole"]) + p["exponent"] - zeros
    sticky = F.substring(digits, F.lit(34), F.length(digits)).rlike("[1-9]")
    head = F.concat(
        F.rpad(F.substring(digits, 1, 33), 33, "0"), F.when(sticky, "1").otherwise("0")
    )
    return F.struct(
        p["negative"].alias("negative"), (digits == "").alias("zero"),
        magnitude.alias("magnitude"),
        # Only -5..5 needs its digits looked at.
        F.when(magnitude.between(-5, 5), magnitude.cast("int")).otherwise(F.lit(0)).alias("point"),
        head.alias("head"),
    )


def _unscaled(s: Column, low: int, high: int) -> Column:
    """Value in range, rounded to four places."""

    def rounded(text: Column) -> Column:
        small, large = text.try_cast("decimal(38,38)"), text.try_cast("decimal(38,33)")
        return F.when(
            s["point"] > 0,
            F.when((large >= low) & (large <= high), F.bround(large, 4).cast(_RESULT)),
        ).otherwise(F.when((small >= low) & (small <= high), F.bround(small, 4).cast(_RESULT)))

    return _bind(_fixed_point(s["head"], s["point"]), rounded)


def _scaled(s: Column, factor: Column) -> Column:
    """Product rounded to 28 significant digits and then to four places."""

    def cut(product: Column) -> Column:
        length = F.length(product.cast("string"))
        return (
            F.when(length == 36, F.bround(product, -8))
            .when(length == 35, F.bround(product, -7))
            .otherwise(F.bround(product, -6))
            .cast("string")
        )

    def rounded(digits: Column) -> Column:
        shift = F.length(digits) + s["point"] - 34
        text = _fixed_point(digits, shift)
        return F.when(shift > 0, F.bround(text.try_cast("decimal(38,31)"), 4).cast(_RESULT)).otherwise(
            F.bround(text.try_cast("decimal(38,38)"), 4).cast(_RESULT)
        )

    product = s["head"].cast("decimal(34,0)") * factor.cast("decimal(2,0)")
    return _bind(_bind(product, cut), rounded)


def _long_form(text: Column, low: int, high: int, factor: Column) -> Column:
    zero = F.when(F.lit(low <= 0), F.lit(0).cast(_RESULT))

    def decide(s: Column) -> Column:
        in_range = _unscaled(s, low, high)
        return (
            F.when(s["magnitude"].isNull(), None)
            .when(s["zero"], zero)
            .when(s["negative"] | (s["magnitude"] > 5), None)
            .when(s["magnitude"] < -5, zero)
            .when((factor == 1) | in_range.isNull(), in_range)
            .otherwise(_scaled(s, factor))
        )

    return F.when(text.rlike(_NUMBER), _bind(_bind(_parts(text), _scientific), decide))


def contract_decimal(text: Column, low: int, high: int, factor: Column) -> Column:
    """DECIMAL(18,4) of ``text * factor``, or null when it is no number within low..high.

    ``0 <= low <= high < 100000`` and whole factors below 100 keep every step exact.
    """
    if not 0 <= low <= high < 100000:
        raise ValueError("the range must lie within 0..99999")
    short = text.try_cast("decimal(23,18)")
    converted = F.bround(short * factor.cast("decimal(2,0)"), 4).cast(_RESULT)
    clean = ascii_digits(F.replace(text, F.lit("_"), F.lit("")))
    return F.when(
        full_match(text, r"[0-9]{1,5}(?:\.[0-9]{0,18})?"),
        F.when((short >= low) & (short <= high), converted),
    ).otherwise(_bind(clean, lambda number: _long_form(number, low, high, factor)))
