"""Column expressions shared by the operators. All built-in, JVM-side, codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Money is carried as an exact decimal while summing, so results do not depend
# on the order rows arrive in, and returned as double like the source data. Ten
# decimals hold a price's own scale; nothing is rounded to cents.
PRICE = "decimal(24,10)"
AMOUNT = "decimal(28,10)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _exact_sum(exact: Column, plain: Column) -> Column:
    """Sum of ``exact`` as double; of ``plain`` if some value or the sum has no such decimal."""
    fits = F.count_if(exact.isNull() & plain.isNotNull()) == 0
    return F.coalesce(F.when(fits, F.try_sum(exact).cast("double")), F.sum(plain))


def revenue_sum(qty: str | Column, price: str | Column) -> Column:
    """Sum of quantity x unit price, exact where every price has a decimal form (not 2e20, not infinity)."""
    return _exact_sum(col(qty) * col(price).try_cast(PRICE), col(qty) * col(price).cast("double"))


def money_sum(c: str | Column) -> Column:
    """Sum of a money column (double or decimal) computed in decimal, returned as double."""
    return _exact_sum(col(c).try_cast(AMOUNT), col(c).cast("double"))


def money_sum_or_zero(c: str | Column) -> Column:
    return F.coalesce(money_sum(c), F.lit(0.0))


def long_sum(c: str | Column) -> Column:
    return F.sum(col(c)).cast("bigint")


def parse_timestamp(c: str | Column, fmt: str | None = None) -> Column:
    """ISO text to a zone-free timestamp; bad text gives null instead of failing the job.

    The feeds carry wall-clock text without a zone, so the value is kept as
    ``timestamp_ntz`` and reads the same under any session time zone.
    """
    if fmt is None:
        return col(c).try_cast("timestamp_ntz")
    return F.try_to_timestamp(col(c), F.lit(fmt)).cast("timestamp_ntz")


def parse_date(c: str | Column) -> Column:
    """ISO text (or a date/timestamp) to date; bad text gives null."""
    return col(c).try_cast("date")


def iso_timestamp(c: str | Column) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss")


def iso_date(c: str | Column) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd")


def contains_regex_ci(c: str | Column, pattern: str) -> Column:
    """Case-insensitive regex search anywhere in the text; null text is no match."""
    return F.coalesce(col(c).rlike("(?i)" + pattern), F.lit(False))


def padded_id(prefix: str, n: str | Column, width: int = 4) -> Column:
    """prefix + zero-padded number, never truncated (P0007, P12345).

    Only numbers below zero, and null, need the formatter, which costs more than all else in a row of ids.
    """
    n, text = col(n), col(n).cast("string")
    return (F.when(n >= 10 ** (width - 1), F.concat(F.lit(prefix), text))
            .when(n >= 0, F.concat(F.lit(prefix), F.lpad(text, width, "0")))
            .otherwise(F.format_string(f"{prefix}%0{width}d", n)))


def any_null(cols: list[str], nan_is_null: bool = True) -> Column:
    """True when any of the columns is null (or NaN for floating columns)."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
        if nan_is_null:
            cond = cond | F.isnan(F.col(c))
    return cond
