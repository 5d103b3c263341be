"""Column expressions: all JVM-side, no UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIFORM_RANGE = 4294967296  # 2 ** 32


def month_start(text: Column) -> Column:
    """``MMYYYY`` text (leading zero optional) to the first day of that month.

    Null and blank text is null; any other text that does not parse is an error,
    as a file in another format would otherwise lose all its rows later.
    """
    parsed = F.try_to_timestamp(F.lpad(F.trim(text), 6, "0"), F.lit("MMyyyy")).cast("date")
    wrong = F.raise_error(F.concat(F.lit("not a month as MMYYYY: "), text)).cast("date")
    return F.when(F.trim(text) != "", F.coalesce(parsed, wrong))


def quarter_start(text: Column) -> Column:
    """``YYYYQn`` at the start of a file name to the first day of that quarter."""
    year = F.regexp_extract(text, r"^(\d{4})Q([1-4])", 1).try_cast("int")
    quarter = F.regexp_extract(text, r"^(\d{4})Q([1-4])", 2).try_cast("int")
    return F.make_date(year, quarter * 3 - 2, F.lit(1))


def age_share(loan_age: Column, term: Column) -> Column:
    return F.try_divide(loan_age, term)


def index_ratio(now: Column, origin: Column) -> Column:
    return F.try_divide(now, origin)


def marked_ltv(balance: Column, orig_balance: Column, orig_ltv: Column, ratio: Column) -> Column:
    """Loan-to-value with the home value moved by the price index, in percent."""
    return F.try_divide(balance, F.try_divide(orig_balance, orig_ltv) * ratio)


def refinance_incentive(orig_rate: Column, benchmark: Column) -> Column:
    return F.try_divide(F.lit(100) * orig_rate, benchmark)


def level_payment(balance: Column, annual_pct: Column, months: Column) -> Column:
    """Monthly payment of a level-payment loan; ``balance / months`` at zero rate."""
    i = annual_pct / 100 / 12
    growth = F.pow(1 + i, months)
    return F.when(i == 0, F.try_divide(balance, months)).otherwise(F.try_divide(balance * i * growth, growth - 1))


def amortized_balance(
    balance: Column, annual_pct: Column, months: Column, paid: Column, round_payment: bool = False
) -> Column:
    """Balance after ``paid`` level payments, in closed form."""
    i = annual_pct / 100 / 12
    payment = level_payment(balance, annual_pct, months)
    if round_payment:
        payment = F.round(payment, 2)
    growth = F.pow(1 + i, paid)
    left = balance * growth - F.try_divide(payment * (growth - 1), i)
    return F.when(i == 0, balance - payment * paid).otherwise(left)


def metro_code(series: Column) -> Column:
    return F.substring(series, 8, 5)


def state_code(series: Column) -> Column:
    return F.substring(series, 6, 2)


def series_id(prefix: str, code: Column) -> Column:
    """Series identifier of an area: unemployment-rate measure, suffix ``03``."""
    return F.concat(F.lit(prefix), code, F.lit("03"))


def state_of_title(title: Column) -> Column:
    """``"City, ST"`` to ``ST``; null when there is no second part."""
    return F.trim(F.try_element_at(F.split(title, ","), F.lit(2)))


def uniform_int(key: list[Column], seed: int) -> Column:
    """Integer in [0, 2**32) fixed by key and seed.

    The same row gets the same draw whatever the partitioning, the run or a
    retried task, and any SQL engine with md5 reproduces it.
    """
    text = F.concat_ws("|", *[k.cast("string") for k in key], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def sampled(key: list[Column], fraction: Column | float, seed: int) -> Column:
    fraction = F.lit(fraction) if isinstance(fraction, (int, float)) else fraction
    return uniform_int(key, seed) < fraction * UNIFORM_RANGE
