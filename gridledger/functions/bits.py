"""Doubles as integers in the same order."""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Of a double: bits of the fraction, bias and largest value of the exponent.
FRACTION, BIAS, FULL = 52, 1023, 2047


def with_ordered_bits(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add a bigint that orders as the double `value` does: equal for equal values (0.0 and -0.0 too), NaN above all, NULL
    for NULL.

    It is the double's exponent and fraction, with the value's sign. Built-in functions do not show the bits, so they are
    computed: the exponent from a logarithm, put right by comparison, the fraction by scaling with powers of two, which is
    exact. The steps are columns of their own, so that none is computed twice.
    """
    # By two half powers of two, so that no factor overflows.
    scaled = "_size / pow(2D, floor(_exponent / 2)) / pow(2D, _exponent - floor(_exponent / 2))"
    finite = f"if(abs({value}) < double('Infinity'), abs({value}), 1D)"
    near = df.selectExpr("*", f"abs({value}) AS _size", f"floor(log2({finite})) AS _near")
    exact = near.selectExpr(
        "*", "_near - if(_size < pow(2D, _near), 1, 0) + if(_size >= pow(2D, _near + 1), 1, 0) AS _exponent"
    )
    size = f"""CASE
        WHEN isnan({value}) THEN {(FULL << FRACTION) + 1}
        WHEN _size = 0 THEN 0L
        WHEN _size = double('Infinity') THEN {FULL << FRACTION}
        WHEN _size < pow(2D, {1 - BIAS}) THEN bigint(_size * pow(2D, 537) * pow(2D, 537))
        ELSE shiftleft(bigint(_exponent + {BIAS}), {FRACTION}) + bigint(({scaled} - 1) * pow(2D, {FRACTION}))
    END"""
    signed = exact.selectExpr("*", f"{size} AS _bits")
    return signed.selectExpr(*df.columns, f"if({value} < 0, -_bits, _bits) AS {name}")
