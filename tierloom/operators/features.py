"""Feature views: declaration, point-in-time retrieval, materialisation and lookup."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.operators.keyed import extreme, extremes, upsert_newest
from tierloom.operators.skew import SLICE, join_summaries, with_slices
from tierloom.operators.windows import latest_per_key
from tierloom.session import shared_folder
from tierloom.sources.bucketed import BucketedTable
from tierloom.sources.writers import write_parquet


@dataclass(frozen=True)
class FeatureView:
    """What a feature table holds: its key, typed fields, time columns and how long a value stays valid."""

    name: str
    key: str
    fields: Mapping[str, T.DataType]
    ttl: timedelta | None = None
    timestamp_field: str = "event_timestamp"
    created_field: str = "created"
    online: bool = True
    tags: Mapping[str, str] = field(default_factory=dict)
    services: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        """Project to the declared columns and types; a missing column is an error."""
        needed = [self.key, *self.fields, self.timestamp_field, self.created_field]
        missing = [name for name in needed if name not in df.columns]
        if missing:
            raise ValueError(f"feature view {self.name}: source lacks {', '.join(missing)}")
        typed = [F.col(name).cast(dtype).alias(name) for name, dtype in self.fields.items()]
        return df.select(self.key, *typed, self.timestamp_field, self.created_field)

    def resolve(self, features: Sequence[str] | str) -> list[str]:
        """Field names from ``"view:field"`` names or from the name of a declared feature set."""
        if isinstance(features, str):
            if features not in self.services:
                raise KeyError(f"feature view {self.name} has no feature set {features}")
            features = self.services[features]
        names = []
        for feature in features:
            view, _, name = feature.rpartition(":")
            if (view and view != self.name) or name not in self.fields:
                raise KeyError(f"unknown feature {feature}")
            names.append(name)
        return names


# The declared view over the customer targets.
CUSTOMER_STATS = FeatureView(
    name="customer_stats",
    key="customer_id",
    fields={
        "region": T.StringType(),
        "total_orders": T.LongType(),
        "total_spend": T.FloatType(),
        "pending_orders": T.LongType(),
        "cancelled_orders": T.LongType(),
        "alert_priority": T.LongType(),
    },
    ttl=timedelta(days=90),
    tags={"team": "commercial_analytics"},
)


def historical_features(
    entities: DataFrame,
    view_df: DataFrame,
    spec: FeatureView,
    features: Sequence[str] | str,
    ts: str = "event_timestamp",
    **slicing,
) -> DataFrame:
    """As-of join: each entity row gets the newest feature values at or before its time, not older than the TTL.

    Among equal feature times the newest ``created`` wins. An entity row without such a value keeps NULLs, and other
    entity columns pass through. Both sides are laid on one time line per key and the last feature value is carried
    forward, so the work is linear; the slices of a hot key pass their last value on to the next ones.
    """
    return historical_views(entities, [(view_df, spec)], {spec.name: spec.resolve(features)}, ts, **slicing)


def split_features(features: Sequence[str], specs: Sequence[FeatureView]) -> dict[str, list[str]]:
    """Field names for each view from ``"view:field"`` names."""
    known, wanted = {spec.name: spec for spec in specs}, {}
    for feature in features:
        view, _, _ = feature.rpartition(":")
        if view not in known:
            raise KeyError(f"unknown feature {feature}")
        wanted.setdefault(view, []).extend(known[view].resolve([feature]))
    return wanted


def historical_views(
    entities: DataFrame,
    views: Sequence[tuple[DataFrame, FeatureView]],
    features: Sequence[str] | Mapping[str, Sequence[str]],
    ts: str = "event_timestamp",
    **slicing,
) -> DataFrame:
    """:func:`historical_features` from several views with one key: all of them are laid on one time line.

    ``features`` are ``"view:field"`` names, or field names by view. A field that two views share comes back as
    ``view__field``.
    """
    wanted = features if isinstance(features, Mapping) else split_features(features, [spec for _, spec in views])
    views = [(df, spec) for df, spec in views if spec.name in wanted]
    if len({spec.key for _, spec in views}) != 1:
        raise ValueError("views asked together need one key")
    key, known = views[0][1].key, None
    for number, (view_df, spec) in enumerate(views):
        at, created = spec.timestamp_field, spec.created_field
        typed = spec.apply(_reachable(entities, view_df, spec, ts))
        one = typed.select(
            key, F.col(at).alias("__ts"), F.lit(0).alias("__side"), F.col(created).alias("__created"),
            F.struct(F.col(at).alias("at"), *wanted[spec.name]).alias(f"__value_{number}"),
        )
        known = one if known is None else known.unionByName(one, allowMissingColumns=True)
    values = [f"__value_{number}" for number in range(len(views))]
    asked = entities.select(
        key, F.col(ts).alias("__ts"), F.lit(1).alias("__side"), F.struct(*entities.columns).alias("__entity")
    )
    # The line joins and casts several inputs. Written once, it is not planned again for its count, its sample, its summaries
    # and the result.
    line = known.unionByName(asked, allowMissingColumns=True)
    written = write_parquet(line, shared_folder(entities.sparkSession, "timeline"))
    line, slices = with_slices(entities.sparkSession.read.schema(line.schema).parquet(written), [key], "__ts", **slicing)
    so_far = (
        Window.partitionBy(key, SLICE)
        .orderBy("__ts", "__side", "__created")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = line.withColumns({value: F.last(value, ignorenulls=True).over(so_far) for value in values})
    if slices:
        earlier = Window.partitionBy(key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        carried = (
            line.where(F.col(SLICE) > 0)
            .groupBy(key, SLICE)
            .agg(*[F.expr(f"max_by({value}, struct(__ts, __created)) FILTER (WHERE {value} IS NOT NULL)").alias(f"__end{value}")
                   for value in values])
            .select(key, SLICE, *[F.last(f"__end{value}", ignorenulls=True).over(earlier).alias(f"__carry{value}")
                                  for value in values])
        )
        seen = join_summaries(seen, carried, [key, SLICE], slices)
        seen = seen.withColumns({value: F.coalesce(value, f"__carry{value}") for value in values})
    columns = []
    for value, (_, spec) in zip(values, views):
        fresh = F.lit(True) if not spec.ttl else F.col(f"{value}.at") >= F.col("__ts") - F.lit(spec.ttl)
        columns += [F.when(fresh, F.col(f"{value}.{name}")).alias(shown)
                    for name, shown in zip(wanted[spec.name], _shown(spec.name, wanted))]
    return seen.where("__side = 1").select("__entity.*", *columns)


def _shown(view: str, wanted: Mapping[str, Sequence[str]]) -> list[str]:
    """Names of a view's fields in the result."""
    return [
        f"{view}__{name}" if sum(name in names for names in wanted.values()) > 1 else name for name in wanted[view]
    ]


def _reachable(entities: DataFrame, view_df: DataFrame, spec: FeatureView, ts: str) -> DataFrame:
    """Feature rows that some entity row could get: with a key, in the time range, and of the keys asked if few.

    The time bounds are read first, so that they reach the scan as literals.
    """
    at = F.col(spec.timestamp_field)
    dtype = view_df.schema[spec.timestamp_field].dataType
    view_df = view_df.where(F.col(spec.key).isNotNull())
    asked = extremes(entities, {"first": (ts, F.min), "last": (ts, F.max)})
    if asked["first"] is None:
        return view_df
    reachable = view_df.where(at <= asked["last"].cast(dtype))
    if spec.ttl:
        reachable = reachable.where(at >= asked["first"].cast(dtype) - F.lit(spec.ttl))
    # A semi join with few keys: the planner sends them to all tasks if their size at run time allows it.
    return reachable.join(entities.select(spec.key).distinct(), spec.key, "left_semi")


def batch_scoring(
    entities: DataFrame, view_df: DataFrame, spec: FeatureView, features: Sequence[str] | str, stamp: datetime
) -> DataFrame:
    """The as-of join when every entity is asked at the same moment: latest row per key, then one join."""
    moment = F.lit(stamp).cast(view_df.schema[spec.timestamp_field].dataType)
    current = materialize(view_df, spec, None if not spec.ttl else moment - F.lit(spec.ttl), moment)
    return entities.join(current.select(spec.key, *spec.resolve(features)), spec.key, "left")


def _moment(value, dtype: T.DataType) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast(dtype)


def materialize(view_df: DataFrame, spec: FeatureView, start, end) -> DataFrame:
    """The latest row per key with a time in [start, end]; ``start`` None means from the beginning."""
    dtype = view_df.schema[spec.timestamp_field].dataType
    at = F.col(spec.timestamp_field)
    ranged = view_df.where(at <= _moment(end, dtype))
    if start is not None:
        ranged = ranged.where(at >= _moment(start, dtype))
    return latest_per_key(spec.apply(ranged), spec.key, [spec.timestamp_field, spec.created_field])


def increment(latest: DataFrame | None, view_df: DataFrame, spec: FeatureView, end, start=None) -> DataFrame:
    """The latest row per key since the previous run, up to ``end``.

    ``start`` is the end of the previous run and defaults to the newest time in the latest table; the first run looks
    back one TTL.
    """
    dtype = view_df.schema[spec.timestamp_field].dataType
    if start is None and latest is None:
        start = _moment(end, dtype) - F.lit(spec.ttl) if spec.ttl else None
    elif start is None:
        start = extreme(latest, spec.timestamp_field)
    return materialize(view_df, spec, start, end)


def materialize_incremental(
    latest: DataFrame | None, view_df: DataFrame, spec: FeatureView, end, start=None
) -> DataFrame:
    """Bring the latest table up to ``end``. Newer (time, created) wins, so an overlap with earlier runs does no harm."""
    rows = increment(latest, view_df, spec, end, start)
    newest = [spec.timestamp_field, spec.created_field]
    return rows if latest is None else upsert_newest(latest, rows, spec.key, newest)


def online_features(
    latest: DataFrame, entities: DataFrame, spec: FeatureView, features: Sequence[str] | str
) -> DataFrame:
    """Latest values by key; an unknown key gets NULLs. Other entity columns pass through."""
    return entities.join(latest.select(spec.key, *spec.resolve(features)), spec.key, "left")


def online_lookup(entities: DataFrame, table: BucketedTable, spec: FeatureView, features: Sequence[str] | str) -> DataFrame:
    """:func:`online_features` for the keys of a request: of a stored latest table only the buckets of these keys are read."""
    (key,) = table.key
    if key != spec.key:
        raise ValueError(f"the table's key is {key}, the view's {spec.key}")
    latest = table.lookup(entities.select(key))
    if latest is None:
        latest = entities.sparkSession.createDataFrame([], T.StructType([entities.schema[key], *(
            T.StructField(name, spec.fields[name]) for name in spec.resolve(features))]))
    return online_features(latest, entities, spec, features)


def online_views(
    entities: DataFrame, latest: Sequence[tuple[DataFrame, FeatureView]], features: Sequence[str]
) -> DataFrame:
    """:func:`online_features` from several views, by ``"view:field"`` names; shared fields as ``view__field``."""
    wanted = split_features(features, [spec for _, spec in latest])
    for table, spec in latest:
        if spec.name in wanted:
            columns = [F.col(name).alias(shown) for name, shown in zip(wanted[spec.name], _shown(spec.name, wanted))]
            entities = entities.join(table.select(spec.key, *columns), spec.key, "left")
    return entities


def on_demand(df: DataFrame, derived: Mapping[str, str]) -> DataFrame:
    """Features computed on request from stored features and request columns, as SQL expressions."""
    return df.withColumns({name: F.expr(sql) for name, sql in derived.items()})
