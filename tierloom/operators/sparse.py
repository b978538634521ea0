"""Hashed text vectors as (bucket, value) lists, and exact search over posting lists that skips by bounds.

The vectors are those of ``vectors.embed``'s built-in encoder: tokens counted up or down in buckets, scaled to unit length. A text of
sixty words fills sixty of two thousand buckets, so only these are kept.

**Postings.** A task turns its rows into blocks of bounded size; from texts it does so in the same pass that counts their tokens,
a bounded number of them at a time. A block has one row per bucket with the positions and values of
its vectors there and the least and largest value, and one header row with ids and squared lengths. Building shuffles nothing.
Stored, it is sorted by bucket within a block, so a search reads the lists of the questions' buckets and the headers.

**Search.** The distance of unit vectors falls with their dot product, and a list cannot add more to it than its bound times the
question's value. Lists are added from the one with most influence on. As soon as the lists left over cannot lift a vector above the
``top_k``-th of those seen, or within the distance asked for, it is out; once few vectors are left, further lists are only
looked up at their places. A block whose lists together cannot reach the distance is not scored at all. What leaves a task is
``top_k`` per block and question.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.operators.batches import cuts
from tierloom.operators.vectors import HASH_DIM, QUERY_BLOCK, TOP_K, _Places, tokens
from tierloom.session import carry_to_workers, shared_folder

carry_to_workers(__name__)

SPARSE = T.ArrayType(T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("value", T.FloatType())]))

#: A block of postings ends at this many vectors or values.
BLOCK_ROWS, BLOCK_VALUES = 65_536, 2_000_000
#: Up to so many buckets a search names them to the scan, which then skips pages; beyond it joins them.
NAMED_BUCKETS = 2_000
#: Blocks of hits that are named to the scan of ids.
NAMED_BLOCKS = 5_000
#: Remembered tokens of a worker.
MOST_PLACES = 200_000
#: Rows and tokens that a worker counts at a time.
PIECE_ROWS, PIECE_TOKENS = 5_000, 200_000

#: Distances count to nine digits; sums in another order differ by less than this.
SLACK = 2e-9
HEADER = -1


def embed_sparse(df: DataFrame, text_col: str, dim: int = HASH_DIM, vector_col: str = "sparse",
                 keep: Sequence[str] | None = None) -> DataFrame:
    """Add the unit-length vector of each text as an array of ``bucket, value`` by bucket, without zeros.

    A text without tokens, or whose counts cancel out, and a null text have an empty array. Shuffles nothing. ``keep`` names the
    columns to return with it, all by default; others, such as the text, then are not sent to Python and back.
    """
    kept = ["*"] if keep is None else keep
    fields = df.select(*kept).schema.fields
    if vector_col in [field.name for field in fields]:
        raise ValueError(f"there is a column {vector_col} already")
    schema = T.StructType([*fields, T.StructField(vector_col, SPARSE)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _with_vectors(batches, dim):
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return df.select(*kept, tokens(text_col).alias("__tokens")).mapInArrow(count, schema)


def _with_vectors(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[list[pa.Array]]:
    """The columns of each piece of the batches, with vectors in place of the last one, lists of tokens."""
    places = _Places(dim)
    for batch in batches:
        last = batch.num_columns - 1
        lengths = batch.column(last).value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        for begin, end in cuts(lengths, PIECE_ROWS, PIECE_TOKENS):
            if len(places) > MOST_PLACES:
                places.clear()
            part = batch.slice(begin, end - begin)
            yield [*part.columns[:-1], _counted(part.column(last), places, dim)]


def _counted(words: pa.Array, places: _Places, dim: int) -> pa.Array:
    """The vectors of a batch of token lists; each distinct token is placed once."""
    lengths = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    coded = words.flatten().dictionary_encode()
    at, sign = np.array([places[word] for word in coded.dictionary.to_pylist()], np.int64).reshape(-1, 2).T
    index = coded.indices.to_numpy(zero_copy_only=False)
    cell, inverse = np.unique(np.repeat(np.arange(len(words)), lengths) * dim + at[index], return_inverse=True)
    sums = np.bincount(inverse, weights=sign[index], minlength=len(cell))
    cell, sums = cell[sums != 0], sums[sums != 0]
    row = cell // dim
    norm = np.sqrt(np.bincount(row, weights=sums * sums, minlength=len(words)))
    values = (sums / norm[row]).astype(np.float32)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(words)))]).astype(np.int32)
    pairs = pa.StructArray.from_arrays([pa.array((cell % dim).astype(np.int32)), pa.array(values)], names=["bucket", "value"])
    return pa.ListArray.from_arrays(pa.array(offsets), pairs)


def postings(vectors: DataFrame, id_col: str, by: Sequence[str] = (), vector_col: str = "sparse", block_rows: int = BLOCK_ROWS,
             block_values: int = BLOCK_VALUES) -> DataFrame:
    """Blocks of posting lists. Store them before searching, so that only the asked lists are read.

    Empty vectors are left out; they are as far from every question as can be. A block holds one combination of the ``by`` columns,
    which a search can filter on; they should have few values. Ids should be unique; each row counts by itself.
    """
    schema = _postings_schema(vectors, id_col, by)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _blocks(batches, schema, len(by), block_rows, block_values)

    picked = vectors.where(F.size(vector_col) > 0).select(F.col(id_col).alias("__id"), *by, F.col(vector_col).alias("__vector"))
    return picked.mapInArrow(build, schema)


def text_postings(texts: DataFrame, id_col: str, text_col: str, by: Sequence[str] = (), dim: int = HASH_DIM,
                  block_rows: int = BLOCK_ROWS, block_values: int = BLOCK_VALUES) -> DataFrame:
    """The :func:`postings` of the vectors of :func:`embed_sparse`, in one pass over the texts by one worker for each task."""
    schema = _postings_schema(texts, id_col, by)
    names = ["id", *(f"by{i}" for i in range(len(by))), "vector"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embedded = (pa.RecordBatch.from_arrays(columns, names=names) for columns in _with_vectors(batches, dim))
        filled = (batch.filter(pc.greater(batch.column(len(by) + 1).value_lengths(), 0)) for batch in embedded)
        yield from _blocks(filled, schema, len(by), block_rows, block_values)

    picked = texts.select(F.col(id_col).alias("__id"), *by, tokens(text_col).alias("__tokens"))
    return picked.mapInArrow(build, schema)


def _postings_schema(rows: DataFrame, id_col: str, by: Sequence[str]) -> T.StructType:
    fields = rows.schema
    return T.StructType([
        T.StructField("block", T.LongType()), *(fields[name] for name in by), T.StructField("bucket", T.IntegerType()),
        T.StructField("rows", T.ArrayType(T.IntegerType())), T.StructField("values", T.ArrayType(T.FloatType())),
        T.StructField("low", T.FloatType()), T.StructField("high", T.FloatType()),
        T.StructField("ids", T.ArrayType(fields[id_col].dataType)), T.StructField("norms", T.ArrayType(T.DoubleType())),
    ])


def _blocks(batches: Iterator[pa.RecordBatch], schema: T.StructType, by: int, block_rows: int,
            block_values: int) -> Iterator[pa.RecordBatch]:
    """The blocks of a task's rows: id, ``by`` columns and vector."""
    number = TaskContext.get().partitionId() << 32
    held: dict[tuple, list] = {}
    for batch in batches:
        keys = list(zip(*(batch.column(1 + i).to_pylist() for i in range(by)))) if by else [()] * len(batch)
        own: dict[tuple, list[int]] = {}
        for i, value in enumerate(keys):
            own.setdefault(value, []).append(i)
        for value, rows in own.items():
            part = batch.take(pa.array(rows, pa.int64())) if len(own) > 1 else batch
            group = held.setdefault(value, [0, 0, []])
            sizes = part.column(part.num_columns - 1).value_lengths().to_numpy(zero_copy_only=False)
            for begin, end in cuts(sizes, block_rows, block_values):
                values = int(sizes[begin:end].sum())
                if group[2] and (group[0] + end - begin > block_rows or group[1] + values > block_values):
                    yield _block(number, value, group[2], schema)
                    number += 1
                    group[:] = 0, 0, []
                group[0] += end - begin
                group[1] += values
                group[2].append(part.slice(begin, end - begin))
    for value, (_, _, parts) in held.items():
        if parts:
            yield _block(number, value, parts, schema)
            number += 1


def _block(number: int, value: tuple, parts: list[pa.RecordBatch], schema: T.StructType) -> pa.RecordBatch:
    """One block's rows, by bucket, the header first; its vectors stand in the order of their ids, so that places break ties."""
    whole = pa.Table.from_batches(parts).combine_chunks()
    parts.clear()
    ids = whole.column(0).combine_chunks() if isinstance(whole.column(0), pa.ChunkedArray) else whole.column(0)
    vectors = whole.column(whole.num_columns - 1).combine_chunks()
    order = pc.sort_indices(ids).to_numpy()
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order))
    pairs = vectors.flatten()
    bucket, amount = pairs.field("bucket").to_numpy(), pairs.field("value").to_numpy()
    row = np.repeat(place, vectors.value_lengths().to_numpy(zero_copy_only=False))
    norms = np.bincount(row, weights=amount.astype(np.float64) ** 2, minlength=len(order))
    by_bucket = np.lexsort((row, bucket))
    bucket, row, amount = bucket[by_bucket], row[by_bucket], amount[by_bucket]
    starts = np.flatnonzero(np.diff(bucket, prepend=HEADER))
    offsets = np.concatenate([[0], starts, [len(bucket)]]).astype(np.int32)
    n, only = len(starts) + 1, [0, len(order)]

    def header(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([*only, *[len(order)] * (n - 1)], pa.int32()), values)

    columns = [
        pa.array([number] * n, pa.int64()), *(pa.array([v] * n, whole.schema.field(1 + i).type) for i, v in enumerate(value)),
        pa.array(np.concatenate([[HEADER], bucket[starts]]).astype(np.int32)),
        pa.ListArray.from_arrays(pa.array(offsets), pa.array(row)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(amount)),
        pa.array(np.concatenate([[0], np.minimum.reduceat(amount, starts)]).astype(np.float32)),
        pa.array(np.concatenate([[0], np.maximum.reduceat(amount, starts)]).astype(np.float32)),
        header(ids.take(pa.array(order))), header(pa.array(norms)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=schema.names)


def best_of_block(norms: np.ndarray, lists: dict[int, tuple], question: dict[int, float], length: float, top_k: int,
                  floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and distances of the ``top_k`` nearest vectors of a block, and how many postings were read.

    ``lists`` has places, values, least and largest value by bucket; ``length`` is the question's squared length. A vector's
    score is its dot product less half its squared length. Vectors with a score below ``floor`` are not wanted.
    """
    parts = []
    for bucket, weight in question.items():
        if bucket in lists:
            places, values, low, high = lists[bucket]
            ends = sorted((weight * float(low), weight * float(high)))
            parts.append((max(0.0, ends[1]), min(0.0, ends[0]), places, values, weight))
    parts.sort(key=lambda part: part[1] - part[0])
    more = np.concatenate([np.cumsum([part[0] for part in parts][::-1])[::-1], [0.0]])
    less = np.concatenate([np.cumsum([part[1] for part in parts][::-1])[::-1], [0.0]])
    score, read, left = -norms / 2, 0, None
    if more[0] + score.max() < floor - SLACK:
        return np.empty(0, np.int64), np.empty(0), 0
    for i, (_, _, places, values, weight) in enumerate(parts):
        if left is None:
            reach = _reach(score, top_k, less[i], floor)
            if np.count_nonzero(score + more[i] >= reach) * 8 < len(score):
                left = np.flatnonzero(score + more[i] >= reach)
                kept = score[left]
        if left is None:
            score[places] += weight * values.astype(np.float64)
            read += len(places)
        else:
            at = np.minimum(np.searchsorted(places, left), len(places) - 1)
            there = places[at] == left
            kept[there] += weight * values[at[there]].astype(np.float64)
            read += int(there.sum())
            fit = kept + more[i + 1] >= _reach(kept, top_k, less[i + 1], floor)
            left, kept = left[fit], kept[fit]
    if left is None:
        left, kept = np.arange(len(score)), score
    near = kept >= _reach(kept, top_k, 0.0, floor)
    left, distance = left[near], np.round(length - 2 * kept[near], 9)
    order = np.lexsort((left, distance))[:top_k]
    return left[order], distance[order], read


def _reach(score: np.ndarray, top_k: int, less: float, floor: float) -> float:
    """What a vector must be able to score: the ``top_k``-th of these at worst, or the floor."""
    if len(score) <= top_k:
        return floor - SLACK
    return max(floor, float(np.partition(score, len(score) - top_k)[len(score) - top_k]) + less) - SLACK


def retrieve_sparse(
    queries: DataFrame,
    stored: DataFrame,
    top_k: int = TOP_K,
    where: Column | None = None,
    max_distance: float | None = None,
    id_col: str = "vec_id",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    rows: DataFrame | None = None,
    payload: Sequence[str] = (),
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """The ``top_k`` nearest vectors per question by squared L2 distance, ties by id, with ``rank`` from 1; exact.

    ``stored`` are :func:`postings`, ``queries`` have an array of ``bucket, value``. ``where`` filters the ``by`` columns before the
    search, ``max_distance`` drops hits after it, on the distance rounded to 4 digits. ``payload`` columns are fetched
    from ``rows`` by ``id_col`` for the hits alone. Questions go in blocks of at most about ``block``, one pass each.
    """
    spark = stored.sparkSession
    searched = stored if where is None else stored.where(where)
    asked = queries.select(query_id, F.col(query_vector).alias("__q"))
    first = asked.limit(block + 1).collect()
    search = (searched, asked.schema[query_id], top_k, max_distance, id_col)
    if len(first) <= block:
        hits, blocks = _search(first, *search), 1
    else:
        # Written once, as their vectors would be made again for each block; one block is held by the driver at a time.
        asked.write.parquet(written := shared_folder(spark, "questions"))
        asked, path = spark.read.parquet(written), shared_folder(spark, "hits")
        blocks = -(-asked.count() // block)
        for number in range(blocks):
            part = asked.where(F.pmod(F.xxhash64(query_id), F.lit(blocks)) == number).collect()
            _search(part, *search).write.parquet(f"{path}/block={number}")
        hits = spark.read.parquet(path).drop("block")
    if payload:
        few = hits if blocks * top_k > 100 else F.broadcast(hits)  # four numbers per hit of about one block of questions
        hits = rows.select(id_col, *payload).join(few, id_col)
    return hits.select(query_id, "rank", id_col, "distance", *payload)


def _search(block: list, searched: DataFrame, query_field: T.StructField, top_k: int, max_distance: float | None,
            id_col: str) -> DataFrame:
    """Hits of one block of questions: per block of vectors first, then overall, then with their ids."""
    spark, query_id = searched.sparkSession, query_field.name
    id_type = searched.schema["ids"].dataType.elementType
    result = T.StructType([query_field, T.StructField("rank", T.IntegerType()), T.StructField(id_col, id_type),
                           T.StructField("distance", T.DoubleType())])
    if not block:
        return spark.createDataFrame([], result)
    wanted = [(row[query_id], {pair["bucket"]: float(pair["value"]) for pair in row["__q"]}) for row in block]
    buckets = sorted({bucket for _, own in wanted for bucket in own} | {HEADER})
    lists = searched.select("block", "bucket", "rows", "values", "low", "high", "norms")
    if len(buckets) <= NAMED_BUCKETS:
        lists = lists.where(F.col("bucket").isin(buckets))
    else:
        named = spark.createDataFrame([(b,) for b in buckets], "bucket int")
        lists = lists.join(F.broadcast(named), "bucket", "left_semi")  # at most as many as a vector has buckets
    # a row group may end within a block, so a block's lists meet by its number
    lists = lists.repartition("block").sortWithinPartitions("block", "bucket")
    shared = spark.sparkContext.broadcast(wanted)
    schema = T.StructType([query_field, T.StructField("__block", T.LongType()), T.StructField("__place", T.IntegerType()),
                           T.StructField("__distance", T.DoubleType())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions = shared.value
        lengths = [sum(value * value for value in own.values()) for _, own in questions]
        floors = [-np.inf if max_distance is None else (length - max_distance - 5.1e-5) / 2 for length in lengths]
        name_type, now, norms, held = None, None, None, {}

        def found() -> Iterator[pa.RecordBatch]:
            for (name, own), length, floor in zip(questions, lengths, floors):
                places, distances, _ = best_of_block(norms, held, own, length, top_k, floor)
                if len(places):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(places), name_type), pa.array([now] * len(places), pa.int64()),
                         pa.array(places.astype(np.int32)), pa.array(distances)], names=schema.names)

        name_type = _arrow_type(query_field)
        for batch in batches:
            number, bucket = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i in range(len(batch)):
                if number[i] != now:
                    if now is not None:
                        yield from found()
                    now, held = int(number[i]), {}
                if bucket[i] == HEADER:
                    norms = batch.column(6)[i].values.to_numpy(zero_copy_only=False)
                else:
                    held[int(bucket[i])] = (batch.column(2)[i].values.to_numpy(zero_copy_only=False), batch.column(3)[i].values.to_numpy(
                        zero_copy_only=False), batch.column(4)[i].as_py(), batch.column(5)[i].as_py())
        if now is not None:
            yield from found()

    near = lists.mapInArrow(search, schema)
    by_distance = Window.partitionBy(query_id).orderBy("__distance")
    # all that tie with the last one stay until their ids are known
    near = near.withColumn("__rank", F.rank().over(by_distance)).where(F.col("__rank") <= top_k).drop("__rank")
    near.write.parquet(path := shared_folder(spark, "near"))
    near = spark.read.schema(near.schema).parquet(path)
    headers = searched.where(F.col("bucket") == HEADER)
    numbers = [row[0] for row in near.select("__block").distinct().limit(NAMED_BLOCKS + 1).collect()]
    if len(numbers) <= NAMED_BLOCKS:
        headers = headers.where(F.col("block").isin(numbers))
    named = near.join(headers.select(F.col("block").alias("__block"), "ids"), "__block")
    named = named.select(query_id, "__distance", F.element_at("ids", F.col("__place") + 1).alias(id_col))
    last = Window.partitionBy(query_id).orderBy("__distance", id_col)
    hits = named.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= top_k)
    hits = hits.select(query_id, "rank", id_col, F.round("__distance", 4).alias("distance"))
    return hits if max_distance is None else hits.where(F.col("distance") <= max_distance)


def _arrow_type(field: T.StructField) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)
