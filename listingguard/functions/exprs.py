"""Column expressions shared by the operators; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: str | Column) -> Column:
    """One missing marker: NaN becomes null."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def flag(condition: Column) -> Column:
    """1 where the condition holds; 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def cap(c: str | Column, upper: Column | float) -> Column:
    """Upper clip that keeps null (``least`` alone would return the bound)."""
    c = col(c)
    upper = upper if isinstance(upper, Column) else F.lit(upper)
    return F.when(c.isNotNull(), F.least(c, upper))


def zero_to_null(c: str | Column) -> Column:
    c = col(c)
    return F.when(c != 0, c)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null when b is 0 or either side is null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def report_round(c: str | Column, digits: int) -> Column:
    """Half-up rounding for reported values.

    The decimal step makes exact ties (half cents of a median) come out the same in any SQL engine. It is slow, so numbers that lie
    clearly off a tie are rounded as doubles: the same whole number over the same power of ten.
    """
    exact = F.round(col(c).cast("decimal(38,8)"), digits).cast("double")
    if not 0 <= digits <= 6:
        return exact
    unit = float(10**digits)
    x = col(c).cast("double")
    scaled = F.abs(x) * unit
    # The step to eight digits moves a number by up to 10 ** (digits - 8) / 2 units, the product by far less below 1e9.
    off_tie = F.abs(scaled - F.floor(scaled) - 0.5) > 10.0 ** (digits - 8) + 1e-5
    near = F.floor(scaled + 0.5) / unit
    return F.when((scaled < 1e9) & off_tie, F.when((x < 0) & (near > 0), -near).otherwise(near)).otherwise(exact)


def title_case(c: str | Column) -> Column:
    """Capital after every non-letter, lower case elsewhere."""
    parts = F.split(F.lower(col(c)), r"(?<=[^\p{L}])")
    return F.array_join(
        F.transform(parts, lambda p: F.concat(F.upper(p.substr(1, 1)), F.substring(p, 2, 2147483647))), ""
    )


def unbiased_skew(c: str | Column) -> Column:
    """Bias-corrected sample skewness; null below three values."""
    c = col(c)
    n = F.count(c).cast("double")
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def parse_date(c: str | Column) -> Column:
    """Lenient date parse: what cannot be read is null."""
    return col(c).try_cast("date")


def words(c: str | Column) -> Column:
    """Unicode word tokens of a text, lower-cased."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(r"([\p{L}\p{N}_]+)"), 1)


def risk_tier(score: str | Column, high: float, medium: float) -> Column:
    score = col(score)
    return F.when(score >= high, "HIGH").when(score >= medium, "MEDIUM").otherwise("LOW")


def seeded_hash(id_col: str | Column, seed: int) -> Column:
    """Repeatable pseudo-random order key of a row."""
    return F.md5(F.concat_ws("|", col(id_col), F.lit(str(seed))))
