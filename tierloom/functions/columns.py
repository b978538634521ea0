"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(cases: Sequence[tuple[Column, object]], otherwise: object) -> Column:
    """An ordered CASE: the value (a literal or a column) of the first condition that holds."""
    chain = None
    for condition, value in cases:
        chain = F.when(condition, F.lit(value)) if chain is None else chain.when(condition, F.lit(value))
    return F.lit(otherwise) if chain is None else chain.otherwise(F.lit(otherwise))


def known_or_zero(column: Column | str) -> Column:
    """NULL and NaN become 0. In Spark NaN sorts above every number, so it must go before any comparison."""
    col = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.nanvl(col.cast("double"), F.lit(None).cast("double")), F.lit(0.0))


def money_text(column: Column | str) -> Column:
    """``$12.30``: rounded as a decimal, so that the text does not depend on the binary value."""
    col = F.col(column) if isinstance(column, str) else column
    return F.concat(F.lit("$"), col.cast("decimal(18,2)").cast("string"))


def squared_l2(left: Column | str, right: Column | str) -> Column:
    """Squared Euclidean distance of two number arrays, summed in double precision."""
    pairs = F.zip_with(left, right, lambda a, b: a.cast("double") - b.cast("double"))
    return F.aggregate(pairs, F.lit(0.0), lambda total, d: total + d * d)


def preview(column: Column | str, chars: int) -> Column:
    """The first ``chars`` characters, for display next to the whole text."""
    return F.substring(column, 1, chars)


def part_label(index: Column | str, total: Column | str) -> Column:
    """``"3/7"`` for the zero-based index 2 of 7."""
    idx = F.col(index) if isinstance(index, str) else index
    tot = F.col(total) if isinstance(total, str) else total
    return F.concat_ws("/", (idx + 1).cast("string"), tot.cast("string"))


def percent_change(before: Column, after: Column, if_zero: Column) -> Column:
    """Change in percent; ``if_zero`` answers for a base of 0 (dividing by it raises in ANSI mode)."""
    return F.when(before == 0, if_zero).otherwise(F.try_divide(after - before, before) * 100)


def clock_position(column: str, dtype: str) -> Column:
    """A double that never falls as the value of an orderable column rises.

    Timestamps without a zone are read field by field, so that daylight saving cannot reorder them; both kinds count
    microseconds.
    """
    col = F.col(column)
    if dtype in ("timestamp", "timestamp_ntz"):
        if dtype == "timestamp":
            return F.unix_micros(col).cast("double")
        seconds = F.hour(col) * 3600 + F.minute(col) * 60 + F.date_part(F.lit("SECOND"), col).cast("double")
        return F.datediff(F.to_date(col), F.lit("1970-01-01")) * 86400.0 + seconds
    if dtype == "date":
        return F.datediff(col, F.lit("1970-01-01")).cast("double")
    if dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith("decimal"):
        return col.cast("double")
    raise TypeError(f"cannot slice by column {column} of type {dtype}")
