"""Staging: pick, rename and lower-case the columns of raw records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage(df: DataFrame, columns: Mapping[str, str], lower: Sequence[str] = ()) -> DataFrame:
    """Project ``{raw name: staged name}``; staged names in ``lower`` hold categories and are lower-cased.

    Raw names are matched without regard to case, as Spark does by default.
    """
    return df.select(
        *[(F.lower(raw) if name in lower else F.col(raw)).alias(name) for raw, name in columns.items()]
    )


def stage_customers(raw: DataFrame) -> DataFrame:
    names = {"customer_id": "customer_id", "name": "customer_name", "signup_date": "signup_date", "region": "region"}
    return stage(raw, names, lower=["region"])


def stage_orders(raw: DataFrame) -> DataFrame:
    names = {
        "order_id": "order_id",
        "customer_id": "customer_id",
        "order_date": "order_date",
        "order_amount": "order_amount",
        "status": "order_status",
        "last_updated": "last_updated",
    }
    return stage(raw, names, lower=["order_status"])
