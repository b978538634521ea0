"""Data-quality checks: declared per column, reported as one table, and enforced before a write."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierloom.operators.joins import orphans
from tierloom.session import shared_folder


@dataclass(frozen=True)
class Unique:
    """No key appears twice. NULL keys are not looked at."""

    columns: tuple[str, ...]

    @property
    def column(self) -> str:
        return ", ".join(self.columns)


@dataclass(frozen=True)
class NotNull:
    column: str

    def violated(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues:
    """Only the listed values. NULL is accepted."""

    column: str
    values: tuple

    def violated(self) -> Column:
        return F.coalesce(~F.col(self.column).isin(*self.values), F.lit(False))


@dataclass(frozen=True)
class Holds:
    """A SQL condition that no row may fail. As with a table constraint, an unknown result passes."""

    column: str
    condition: str

    def violated(self) -> Column:
        return F.coalesce(~F.expr(self.condition), F.lit(False))


@dataclass(frozen=True)
class Relationship:
    """Every key that is not NULL exists in the parent ``to`` (a name in ``refs``)."""

    column: str
    to: str
    field: str


NAMES = {
    Unique: "unique",
    NotNull: "not_null",
    AcceptedValues: "accepted_values",
    Holds: "check",
    Relationship: "relationships",
}
ROW_CHECKS = (NotNull, AcceptedValues, Holds)


def duplicate_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that appear more than once, with ``record_count``. Counts combine before the shuffle."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.where(present).groupBy(*columns).agg(F.count("*").alias("record_count")).where("record_count > 1")


def unexpected_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list, with ``record_count``."""
    return (
        df.where(AcceptedValues(column, tuple(values)).violated())
        .groupBy(column)
        .agg(F.count("*").alias("record_count"))
    )


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with the number of NULLs, all from one scan."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column", "failures")


def failing_rows(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """A custom check: a query over ``{name}`` frames that must return no rows."""
    return spark.sql(sql, **frames)


def run_checks(df: DataFrame, checks: Sequence, refs: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row per check: ``check_name``, ``column``, ``failures``, ``passed``.

    All row checks share one aggregate over one scan. A unique check counts failing keys, a relationship check counts
    orphan rows; their child keys are counted before the join, so a hot key travels as one row per task.
    """
    parts = []
    row_checks = [check for check in checks if isinstance(check, ROW_CHECKS)]
    if row_checks:
        counted = df.agg(*[F.count_if(check.violated()).alias(f"f{i}") for i, check in enumerate(row_checks)])
        rows = F.array(
            *[
                F.struct(
                    F.lit(NAMES[type(check)]).alias("check_name"),
                    F.lit(check.column).alias("column"),
                    F.col(f"f{i}").alias("failures"),
                )
                for i, check in enumerate(row_checks)
            ]
        )
        parts.append(counted.select(F.inline(rows)))
    for check in checks:
        if isinstance(check, Unique):
            failures = duplicate_keys(df, check.columns).agg(F.count("*").alias("failures"))
        elif isinstance(check, Relationship):
            keys = df.groupBy(check.column).agg(F.count("*").alias("rows"))
            missing = orphans(keys, refs[check.to], check.column, check.field)
            failures = missing.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failures"))
        else:
            continue
        parts.append(
            failures.select(
                F.lit(NAMES[type(check)]).alias("check_name"), F.lit(check.column).alias("column"), "failures"
            )
        )
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("failures") == 0)


def quarantine(df: DataFrame, checks: Sequence) -> tuple[DataFrame, DataFrame]:
    """Split rows into those that pass all row checks and those that fail any, the latter with ``violations``.

    Checks over whole tables say nothing about a single row and are refused.
    """
    if other := [NAMES[type(c)] for c in checks if not isinstance(c, ROW_CHECKS)]:
        raise TypeError(f"not checks of single rows: {', '.join(other)}")
    failed = F.array_compact(
        F.array(*[F.when(c.violated(), F.lit(f"{NAMES[type(c)]}({c.column})")) for c in checks])
    )
    judged = df.withColumn("violations", failed)
    return judged.where(F.size("violations") == 0).drop("violations"), judged.where(F.size("violations") > 0)


class CheckFailed(ValueError):
    """A write was refused; the message lists the failing checks."""


def guarded_write(
    df: DataFrame, checks: Sequence, path: str, refs: Mapping[str, DataFrame] | None = None, mode: str = "overwrite"
) -> str:
    """Write Parquet only if every check passes.

    The rows are computed once into the shared folder; the checks read them there, and so does the write. Where readers go
    by name, :func:`guarded_publish` writes them only once.
    """
    rows = _checked(df, checks, shared_folder(df.sparkSession, "guarded"), refs)
    rows.write.mode(mode).parquet(path)
    return path


def guarded_publish(
    df: DataFrame, checks: Sequence, name: str, root: str, refs: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Write a new folder under ``root`` and, if every check passes on it, let the view ``name`` stand for it.

    The rows are written once. Until the view is replaced, which is one step in the catalog, and for good if a check or
    the write fails, the name stands for the earlier folder.
    """
    folder = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    _checked(df, checks, folder, refs)
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")
    return df.sparkSession.table(name)


def checked(df: DataFrame, checks: Sequence, refs: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows, computed once into the shared folder, if every check passes on them; otherwise :class:`CheckFailed`."""
    return _checked(df, checks, shared_folder(df.sparkSession, "checked"), refs)


def _checked(df: DataFrame, checks: Sequence, folder: str, refs: Mapping[str, DataFrame] | None) -> DataFrame:
    df.write.parquet(folder)
    rows = df.sparkSession.read.schema(df.schema).parquet(folder)
    failed = run_checks(rows, checks, refs).where(~F.col("passed")).collect()  # one row per check
    if failed:
        raise CheckFailed("; ".join(f"{r.check_name}({r.column}): {r.failures}" for r in failed))
    return rows
