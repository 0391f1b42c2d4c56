"""Column expressions: month arithmetic, guarded division, annuities, hashing.

Spark runs with ANSI arithmetic, where a division by zero raises even when a
later filter would have removed the row.  Every division here is therefore
guarded inside the expression itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPAN = 1 << 28
NO_BOUND = "g"  # beyond every digest


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_index(d: Column | str) -> Column:
    """Calendar months since year 0: differences count month boundaries."""
    return F.year(col(d)) * 12 + F.month(col(d))


def months_apart(start: Column | str, end: Column | str) -> Column:
    return month_index(end) - month_index(start)


def yes_no(cond: Column) -> Column:
    return F.when(cond, F.lit("Y")).otherwise(F.lit("N"))


def flag(cond: Column) -> Column:
    """1 when the condition holds, 0 when it is false or unknown."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def safe_div(a: Column, b: Column, if_zero=None) -> Column:
    """a / b as double; a zero divisor gives ``if_zero`` (NULL by default)."""
    q = F.try_divide(a.cast("double"), b.cast("double"))
    return q if if_zero is None else F.coalesce(q, F.lit(if_zero))


def monthly_rate(annual_pct: Column, floor_pct: float) -> Column:
    """Percent a year to a monthly rate; non-positive rates take the floor."""
    return F.when(annual_pct > 0, annual_pct / F.lit(1200.0)).otherwise(F.lit(floor_pct) / F.lit(1200.0))


def level_payment(rate: Column, balance: Column, months: Column) -> Column:
    """Level monthly payment that retires ``balance`` in ``months``."""
    return safe_div(rate * balance, F.lit(1.0) - F.pow(F.lit(1.0) + rate, -months))


def balance_after(balance: Column, payment: Column, rate: Column, months: Column) -> Column:
    """Scheduled balance after ``months`` level payments."""
    growth = F.pow(F.lit(1.0) + rate, months)
    return balance * growth - safe_div(payment * (growth - F.lit(1.0)), rate)


def key_digest(*keys: Column | str, seed: int | str = 0) -> Column:
    """md5 of the joined keys and a seed, as hexadecimal text: reproducible in any engine."""
    return F.md5(F.concat_ws("|", *[col(k).cast("string") for k in keys], F.lit(str(seed))))


def hash28(*keys: Column | str, seed: int | str = 0) -> Column:
    """The first 28 bits of the key digest, as a number."""
    return F.conv(F.substring(key_digest(*keys, seed=seed), 1, 7), 16, 10).cast("bigint")


def digest_bound(rate: Column) -> Column:
    """Text b such that ``key_digest < b`` exactly when ``hash28 < rate * 2**28``.

    Comparing text saves turning the digest of every row into a number.
    """
    bound = F.ceil(rate * F.lit(HASH_SPAN)).cast("bigint")
    return F.when(bound >= HASH_SPAN, F.lit(NO_BOUND)).otherwise(F.lpad(F.lower(F.hex(bound)), 7, "0"))


def sum_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def log_odds(p: Column, eps: float = 1e-12) -> Column:
    """ln(p / (1 - p)); p is held inside [eps, 1 - eps] so the result is finite."""
    q = F.least(F.greatest(p, F.lit(eps)), F.lit(1.0 - eps))
    return F.log(q / (F.lit(1.0) - q))


def as_predicate(where: Column | str | None) -> Column | None:
    """A user predicate; a leading AND in a text predicate is optional."""
    if where is None or isinstance(where, Column):
        return where
    text = where.strip()
    if text[:4].upper() in ("AND ", "AND("):
        text = text[3:].strip()
    return F.expr(text) if text else None
