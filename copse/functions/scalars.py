"""Column expressions shared by the operators; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Field texts read as missing, and the number put in their place.
MISSING_TOKENS = ("", "NaN", "NA", "null")
MISSING_VALUE = -1e-17


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def gradient(margin: Column, label: Column) -> Column:
    return sigmoid(margin) - label


def hessian(margin: Column) -> Column:
    p = sigmoid(margin)
    return p * (1.0 - p)


def leaf_value(g: Column, h: Column, reg_lambda: float) -> Column:
    """Newton step of a leaf; NULL where the denominator is zero."""
    return F.try_divide(-g, h + F.lit(float(reg_lambda)))


def split_gain(gl: str, hl: str, gr: str, hr: str, reg_lambda: float, gamma: float) -> Column:
    """Second-order loss reduction of a split; NULL where a denominator is zero.

    The sums are given as SQL text: one parsed expression is far quicker to
    build from Python than the tree of operators it stands for.
    """
    lam = f"{float(reg_lambda)!r}D"

    def score(g: str, h: str) -> str:
        return f"try_divide(({g}) * ({g}), ({h}) + {lam})"

    both = score(f"({gl}) + ({gr})", f"({hl}) + ({hr})")
    return F.expr(f"0.5D * ({score(gl, hl)} + {score(gr, hr)} - {both}) - {float(gamma)!r}D")


def midpoint(a: str, b: str) -> Column:
    """Middle of two neighbouring values, given as SQL text.

    Where rounding or overflow puts the middle outside ``[a, b)`` the lower
    value is used, so that ``v <= split`` parts the two values in every case.
    """
    mid = f"(({a}) + ({b})) / 2D"
    return F.expr(f"CASE WHEN {mid} >= ({a}) AND {mid} < ({b}) THEN {mid} ELSE ({a}) END")


def class_of(probability: Column) -> Column:
    """1 from one half upwards, else 0."""
    return (probability >= 0.5).cast("int")


def class_by_rounding(probability: Column) -> Column:
    """Same class by rounding half away from zero."""
    return F.round(probability).cast("int")


def log_odds(ones: Column, others: Column) -> Column:
    """Log of the class ratio; NULL when a class is empty."""
    return F.log(F.nullif(F.try_divide(ones.cast("double"), others.cast("double")), F.lit(0.0)))


def percent_text(share: Column) -> Column:
    return F.format_string("%.2f%%", share * 100.0)


def largest_power_exponent(n: Column) -> Column:
    """Largest k with ``2**k <= n``, by the length of the binary text (exact for longs)."""
    return F.length(F.bin(n.cast("long"))) - 1


def missing_to_value(text: Column) -> Column:
    """Numeric field as text to double, missing tokens to the fixed stand-in value."""
    return F.when(
        text.isNull() | text.isin(*MISSING_TOKENS), F.lit(MISSING_VALUE)
    ).otherwise(text.cast("double"))


def label_of(value: Column) -> Column:
    """Label as an integer, truncated toward zero."""
    return value.cast("double").cast("int")


def one_zero(x: Column) -> Column:
    """Fold -0.0 into 0.0 so that bucket search and grouping agree on it."""
    return F.when(x == 0.0, F.lit(0.0)).otherwise(x)
