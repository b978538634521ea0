"""Keyed loads: incremental delete-and-insert, upsert, versioned history and collections of records.

The functions take the current state and a batch and return the next state as a plan. Storing that state, touching
only the buckets that hold changed keys, is the job of :mod:`tierloom.sources.bucketed`.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.operators.joins import join_null_safe
from tierloom.operators.skew import with_slices
from tierloom.operators.windows import _columns, latest_per_key, neighbours

Names = str | Sequence[str]


def extreme(df: DataFrame, column: str, of=F.max) -> Column | None:
    """The largest (or smallest) value of a column as a typed literal, so that it can be pushed into a scan.

    One value is read to the driver, a timestamp as microseconds: as text, it would go through a local time zone, in
    which an hour may come twice.
    """
    return extremes(df, {"value": (column, of)})["value"]


def extremes(df: DataFrame, wanted: Mapping[str, tuple[str, Callable]]) -> dict[str, Column | None]:
    """Several :func:`extreme` values from one scan."""
    types = {name: df.schema[column].dataType for name, (column, _) in wanted.items()}
    moments = {name for name, dtype in types.items() if isinstance(dtype, T.TimestampType)}
    found = df.agg(
        *[(F.unix_micros(of(c)) if name in moments else of(c).cast("string")).alias(name) for name, (c, of) in wanted.items()]
    ).first()
    return {
        name: None if found[name] is None
        else F.timestamp_micros(F.lit(found[name])) if name in moments else F.lit(found[name]).cast(types[name])
        for name in wanted
    }


def new_rows(source: DataFrame, target: DataFrame, cursor: str, lookback: timedelta | None = None) -> DataFrame:
    """Source rows strictly newer than the target; a target without rows has no mark and lets nothing in."""
    mark = extreme(target, cursor)
    if mark is None:
        return source.limit(0)
    if lookback is not None:
        mark = mark - F.lit(lookback)
    return source.where(F.col(cursor) > mark)


def delete_insert(
    target: DataFrame | None,
    source: DataFrame,
    key: Names,
    cursor: str,
    lookback: timedelta | None = None,
    dedup: bool = False,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Incremental load: drop the target rows whose keys are in the new rows, then add the new rows.

    Without a target all source rows load. Rows that arrive late with an old cursor value are missed unless
    ``lookback`` reaches back for them; repeated keys in one batch all load unless ``dedup`` keeps the newest.
    """
    keys = _columns(key)
    batch = source if target is None else new_rows(source, target, cursor, lookback)
    if dedup:
        batch = latest_per_key(batch, keys, cursor, tie_break)
    return batch if target is None else replace_keys(target, batch, keys)


def replace_keys(target: DataFrame, batch: DataFrame, key: Names) -> DataFrame:
    """Target rows of keys that are not in the batch, plus the batch; rows with a NULL key as in :func:`merge_upsert`."""
    keys = _columns(key)
    (held, held_keyless), (rows, keyless) = _split(target, keys), _split(batch, keys)
    replaced = _without(held, rows, keys).unionByName(rows, allowMissingColumns=True)
    return replaced.unionByName(_keyless(held_keyless, keyless), allowMissingColumns=True)


def _without(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(batch.select(*keys).distinct(), keys, "left_anti")


def _split(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a whole key, and rows with a NULL in it."""
    partial = reduce(Column.__or__, [F.col(key).isNull() for key in keys])
    return df.where(~partial), df.where(partial)


def _keyless(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows without a key match nothing: all stay, and a batch that comes again adds only those that are not there yet."""
    shared = [name for name in target.columns if name in batch.columns]
    if len(shared) < len(target.columns) or len(shared) < len(batch.columns):
        return target.unionByName(batch, allowMissingColumns=True)  # rows of another shape are never there yet
    return target.unionByName(batch.select(*shared).exceptAll(target))


def merge_upsert(target: DataFrame, batch: DataFrame, key: Names, order_by: Names) -> DataFrame:
    """Matched keys take all columns of the newest batch row, other batch keys are inserted.

    Rows with a NULL key match nothing: those of the target stay, and of the batch those that are not there yet.
    """
    keys = _columns(key)
    (held, held_keyless), (rows, keyless) = _split(target, keys), _split(batch, keys)
    merged = _without(held, rows, keys).unionByName(latest_per_key(rows, keys, order_by))
    return merged.unionByName(_keyless(held_keyless, keyless))


def upsert_newest(target: DataFrame, batch: DataFrame, key: Names, order_by: Names) -> DataFrame:
    """Like :func:`merge_upsert`, but a batch row only replaces an older one. The order of batches does not matter."""
    keys = _columns(key)
    (held, held_keyless), (rows, keyless) = _split(target, keys), _split(batch, keys)
    return latest_per_key(held.unionByName(rows), keys, order_by).unionByName(_keyless(held_keyless, keyless))


def scd2_history(
    log: DataFrame, key: Names, ts: str, columns: Names, tie_break: Sequence[str] = (), **slicing
) -> DataFrame:
    """Versions per key from a change log: ``effective_date``, ``end_date`` and ``is_current``.

    Repeats without a change open no version. A version ends where the next one starts.
    """
    keys, tracked = _columns(key), _columns(columns)
    state = F.struct(*tracked)
    ordered = log.select(*dict.fromkeys([*keys, ts, *tie_break, *tracked]))
    sliced, slices = with_slices(ordered, keys, ts, **slicing)
    seen = neighbours(sliced, slices, keys, ts, state, tie_break)
    changed = seen.where(F.col("__before").isNull() | ~F.col("__before").eqNullSafe(state)).drop("__before", "__after")
    dated = neighbours(changed, slices, keys, ts, F.struct(F.col(ts).alias("ts")), tie_break)
    return dated.select(
        *keys,
        *tracked,
        F.col(ts).alias("effective_date"),
        F.col("__after.ts").alias("end_date"),
        F.col("__after").isNull().alias("is_current"),
    )


def scd2_apply(
    dim: DataFrame, batch: DataFrame, key: Names, ts: str, columns: Names, log: DataFrame | None = None, **slicing
) -> DataFrame:
    """Bring a versioned table up to date with a batch of changes.

    Only the versions that a batch can affect are rebuilt: for each key those that are open, or closed at or after
    its first batch row. A row that falls inside a closed version splits it. The table no longer holds the repeats
    that opened no version; if such a repeat followed the late row, only the change log knows it. Given ``log`` (the
    earlier changes), the keys with batch rows older than their last logged change are rebuilt from it. Rows with a NULL
    key are the history of one key, so that a batch that comes again opens no version.
    """
    keys, tracked = _columns(key), _columns(columns)
    changes = batch.select(*keys, ts, *tracked)
    firsts = changes.groupBy(*keys).agg(F.min(ts).alias("__first"))
    rebuilt_late = None
    if log is not None:
        # Only changes from the batch's first time on can follow one of its rows; the literal reaches the scan of the log.
        since = extreme(batch, ts, F.min)
        recent = log if since is None else log.where(F.col(ts) >= since)
        logged = join_null_safe(recent, firsts, keys, "inner").groupBy(*keys).agg(F.min("__first").alias("__first"), F.max(ts).alias("__last"))
        late = logged.where(F.col("__first") < F.col("__last")).select(*keys)
        rebuilt_late = scd2_history(
            join_null_safe(log.select(*keys, ts, *tracked).unionByName(changes), late, keys, "left_semi"),
            keys, ts, tracked, profile=log.select(*keys, ts), **slicing,
        )
        dim = join_null_safe(dim, late, keys, "left_anti")
        changes = join_null_safe(changes, late, keys, "left_anti")
    matched = join_null_safe(dim, firsts, keys)
    reached = F.col("__first").isNotNull() & (F.col("is_current") | (F.col("end_date") >= F.col("__first")))
    untouched = matched.where(~reached).drop("__first")
    points = matched.where(reached).select(*keys, F.col("effective_date").alias(ts), *tracked)
    # At equal times the batch row comes after the version it corrects.
    line = points.withColumn("__order", F.lit(0)).unionByName(changes.withColumn("__order", F.lit(1)))
    loads = dim.select(*keys, F.col("effective_date").alias(ts)).unionByName(batch.select(*keys, ts))
    rebuilt = scd2_history(line, keys, ts, tracked, ["__order"], profile=loads, **slicing)
    out = untouched.unionByName(rebuilt)
    return out if rebuilt_late is None else out.unionByName(rebuilt_late)


def scd2_as_of(dim: DataFrame, at) -> DataFrame:
    """The versions valid at a time: from ``effective_date``, up to but not including ``end_date``."""
    moment = F.lit(at).cast(dim.schema["effective_date"].dataType)
    return dim.where((F.col("effective_date") <= moment) & (F.col("end_date").isNull() | (moment < F.col("end_date"))))


def collection_add(
    collection: DataFrame | None, batch: DataFrame, id_col: str = "id", order_by: Sequence[str] = ()
) -> DataFrame:
    """Add records under stable ids. An id that is already there is left alone.

    Of a repeated id the record with the largest ``order_by`` is kept, ties by its hash, so a rerun keeps the same one.
    Records without an id all stay, as in :func:`merge_upsert`.
    """
    rows, keyless = _split(batch, [id_col])
    once = latest_per_key(rows.withColumn("__tie", F.xxhash64(*rows.columns)), id_col, [*order_by, "__tie"]).drop("__tie")
    if collection is None:
        return once.unionByName(keyless)
    held, held_keyless = _split(collection, [id_col])
    added = held.unionByName(once.join(held.select(id_col), id_col, "left_anti"))
    return added.unionByName(_keyless(held_keyless, keyless))


def collection_get(collection: DataFrame, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """The records with the given ids."""
    return collection.join(ids.select(id_col), id_col, "left_semi")
