"""Vector codes: each part of a vector becomes the number of its nearest codebook entry, found by equal-average search.

Components are scaled to integers, so distances are exact and ties mean what they say. Vectors are cut into equal consecutive
parts with a codebook each, which starts as that part of the vectors with the smallest keys and is moved for a few rounds
to the mean of what it got.

**Equal-average search.** For any part ``x`` and entry ``c`` of ``d`` components, ``(sum(x) - sum(c))**2 / d`` is at most their squared
distance. Entries are sorted by component sum; each part starts where its own sum falls and goes outward on both sides,
until the squared gap of sums over ``d`` strictly exceeds the best distance found. An equal gap goes on, as an entry with a
lower index may tie there.

A round reads the table once. A task adds up its own parts per entry, so the shuffle carries one number per task, entry and
component, and the driver gets ``entries`` vectors of sums, whatever the number of rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.llm.common import staged
from tierloom.operators.joins import broadcast_if_small

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Scaled components stay below this over the width of their vector, so that squared sums and distances fit 64-bit integers.
LARGEST = 2**30
_FAR = np.iinfo(np.int64).max


def finite(column):
    """Whether a vector is there and all of its components are there and finite."""
    return column.isNotNull() & F.forall(
        column, lambda x: F.coalesce(~F.isnan(x.cast("double")) & (F.abs(x) != F.lit(float("inf"))), F.lit(False))
    )


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part's nearest entry and its squared distance, by equal-average search; ties go to the lower index.

    All parts go outward side by side: a step compares each part that is still searching with its next entry below and above.
    """
    n, width = parts.shape
    order = np.argsort(book.sum(1), kind="stable")
    sums, sorted_book = book.sum(1)[order], book[order]
    own = parts.sum(1)
    above = np.searchsorted(sums, own)
    best, index = np.full(n, _FAR), np.full(n, len(book))
    sides = [[np.arange(n), above - 1, -1], [np.arange(n), above, 1]]
    while len(sides[0][0]) or len(sides[1][0]):
        for side in sides:
            rows, at, step = side
            inside = (at >= 0) & (at < len(book))
            rows, at = rows[inside], at[inside]
            gap = own[rows] - sums[at]
            going = (best[rows] == _FAR) | (gap * gap <= width * best[rows])
            rows, at = rows[going], at[going]
            delta = parts[rows] - sorted_book[at]
            distance, entry = np.einsum("ij,ij->i", delta, delta), order[at]
            better = (distance < best[rows]) | ((distance == best[rows]) & (entry < index[rows]))
            best[rows[better]], index[rows[better]] = distance[better], entry[better]
            side[:2] = rows, at + step
    return index, best


def _cut(column: pa.Array, parts: int) -> np.ndarray:
    """Scaled vectors of one batch as ``rows, parts, components``."""
    widths = np.diff(column.offsets.to_numpy())
    width = int(widths[0]) if len(widths) else parts
    if (widths != width).any() or width % parts:
        raise ValueError(f"vectors need one width, a multiple of {parts}; got {sorted(set(widths.tolist()))[:5]}")
    whole = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), parts, -1)
    return whole


def _book(sums: dict, books: np.ndarray) -> np.ndarray:
    """Entries moved to the floor of their mean; Python integers, as sums over all rows may be long."""
    moved = books.copy()
    for (part, entry, position), (total, n) in sums.items():
        moved[part, entry, position] = total // n
    return moved


def _sums(vectors: DataFrame, books: np.ndarray) -> dict:
    """Sum and count of what each entry got: ``(part, entry, position) -> (sum, count)``."""
    schema = pa.schema([("slot", pa.int64()), ("total", pa.int64()), ("n", pa.int64())])

    def add(batches):
        totals, counts = np.zeros(books.shape, np.int64), np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            cut = _cut(batch.column(0), len(books))
            for part, book in enumerate(books):
                index, _ = nearest(cut[:, part], book)
                np.add.at(totals[part], index, cut[:, part])
                counts[part] += np.bincount(index, minlength=len(book))
        each = np.repeat(counts.ravel(), books.shape[2])
        used = np.flatnonzero(each)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(totals.ravel()[used]), pa.array(each[used])], schema=schema)

    found = vectors.select("_vector").mapInArrow(add, "slot long, total long, n long")
    found = found.groupBy("slot").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect()
    return {np.unravel_index(r["slot"], books.shape): (int(r["total"]), r["n"]) for r in found}


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in order of part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def learn_books(vectors: DataFrame, key: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks ``parts, entries, components`` of ``key, _vector`` (scaled vectors).

    They start from the rows with the smallest keys; null keys come last, and equal keys in the order of their vectors. With fewer
    rows than ``entries`` there are as many entries as rows, and none without rows.
    """
    first = vectors.orderBy(F.col(key).asc_nulls_last(), "_vector").limit(entries).collect()
    if not first:
        return np.zeros((parts, 0, 0), np.int64)
    if len(first[0]["_vector"]) % parts or len({len(r["_vector"]) for r in first}) > 1:
        raise ValueError(f"vectors need one width, a multiple of {parts}")
    books = np.array([r["_vector"] for r in first], np.int64).reshape(len(first), parts, -1).swapaxes(0, 1)
    for _ in range(rounds):
        books = _book(_sums(vectors, books), books)
    return books


def scaled(vectors: DataFrame, vector: str, scale: int = SCALE) -> DataFrame:
    """``vectors`` without rows whose vector is null or holds null or non-finite components, and ``_vector``, the floors of its
    scaled components. A component that reaches :data:`LARGEST` over the width fails, as distances would no longer be exact."""
    limit = F.lit(float(LARGEST)) / F.size(vector)
    whole = F.transform(F.col(vector), lambda x: F.when(
        F.abs(x.cast("double") * scale) < limit, F.floor(x.cast("double") * scale)
    ).otherwise(F.raise_error(F.lit("a component is too large for exact distances")).cast("bigint")))
    return vectors.where(finite(F.col(vector))).withColumn("_vector", whole)


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``vectors`` with ``_vector`` replaced by ``code`` (two hex digits a part) and ``error`` (squared distance)."""
    kept = [c for c in vectors.columns if c != "_vector"]
    schema = T.StructType([*vectors.select(kept).schema.fields, T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches):
        for batch in batches:
            cut, digits = _cut(batch.column(len(kept)), len(books)), []
            error = np.zeros(len(cut), np.int64)
            for part, book in enumerate(books):
                index, distance = nearest(cut[:, part], book)
                digits.append(index.astype(np.uint8))
                error += distance
            codes = [bytes(row).hex() for row in np.stack(digits, 1)] if digits else []
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(codes, pa.string()), pa.array(error)],
                                             names=[*kept, "code", "error"])

    return vectors.select(*kept, "_vector").mapInArrow(run, schema)


def vector_codes(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS,
                 entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """``key, code, error, label_error, codebooks_sha256`` of every row that :func:`scaled` keeps.

    ``label_error`` adds up ``error`` over the rows with an equal label, nulls together. Repeated rows and keys count each time
    and keep their rows; null keys are kept. Widths that differ, or are no multiple of ``parts``, fail. ``entries`` is at most
    256. Without a row to keep, and for an empty table, there are no rows. Other columns are ignored, whatever their names.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256")
    picked = vectors.select(F.col(key).alias("_key"), F.col(vector).alias("_raw"), F.col(label).alias("_label"))
    whole = staged(scaled(picked, "_raw", scale).select("_key", "_label", "_vector"), "scaled")
    books = learn_books(whole, "_key", parts, entries, rounds)
    coded = staged(encode(whole, books), "codes")
    sums = coded.groupBy(F.col("_label").alias("_of")).agg(F.sum("error").alias("label_error"))
    # labels may be as many as rows; a few of them are broadcast, which also leaves a common label's rows where they are
    joined = coded.join(broadcast_if_small(staged(sums, "label-errors")), F.col("_label").eqNullSafe(F.col("_of")))
    return joined.select(F.col("_key").alias(key), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
