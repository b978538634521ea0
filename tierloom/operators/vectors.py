"""Text to vectors, and exact nearest-neighbour search over a table of vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.session import carry_to_workers, shared_folder

carry_to_workers(__name__)

# Hits per question, and the distance above which a hit is dropped.
TOP_K = 3
MAX_DISTANCE = 1.3

#: Questions are searched in blocks of at most about this many, one pass over the vectors per block.
QUERY_BLOCK = 1024

#: Random planes of the approximate search: their number (buckets are two to the power of it) and their seed.
LSH_BITS = 8
LSH_SEED = 11
#: Vectors of a bucket for one task.
BUCKET_ROWS = 200_000

#: Buckets of the built-in encoder.
HASH_DIM = 2048

Encoder = Callable[[list[str]], np.ndarray]


def tokens(text_col: str) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text_col), r"[^\p{L}\p{N}]+"), "")


class _Places(dict):
    """Bucket and direction of a token: the first 8 hex digits of its MD5, and whether the 9th is below 8."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, word: str):
        digest = hashlib.md5(word.encode()).hexdigest()
        self[word] = int(digest[:8], 16) % self.dim, 1 if digest[8] < "8" else -1
        return self[word]


def meaningful(df: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Rows whose vector is not zero: a text without known tokens is as far from every question as can be."""
    return df.where(F.exists(vector_col, lambda x: x != 0))


def embed(
    df: DataFrame,
    text_col: str,
    encoder: str | Callable[[], Encoder] = "hash",
    dim: int = HASH_DIM,
    vector_col: str = "embedding",
) -> DataFrame:
    """Add a unit-length vector per row.

    ``"hash"`` counts tokens in ``dim`` buckets, some up and some down, by the MD5 of the token, with no shuffle; a text whose
    counts are all zero has the zero vector, see :func:`meaningful`. A model comes in as a function that loads it and
    returns an encoder from texts to rows of numbers; it is loaded once per Python worker.
    """
    if encoder == "hash":

        @F.pandas_udf("array<float>")
        def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            places = _Places(dim)
            for batch in batches:
                if len(places) > 1_000_000:
                    places.clear()
                vectors = []
                for words in batch:
                    counts = np.zeros(dim)
                    if words is not None and len(words):
                        at, sign = np.array([places[word] for word in words]).T
                        np.add.at(counts, at, sign)
                    norm = np.sqrt((counts * counts).sum())
                    vectors.append((counts / norm if norm else counts).astype("float32"))
                yield pd.Series(vectors)

        return df.withColumn(vector_col, count(tokens(text_col)))

    load = encoder

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load()
        for texts in batches:
            rows = np.asarray(model(texts.fillna("").tolist()), dtype="float32")
            yield pd.Series(list(rows))

    return df.withColumn(vector_col, encode(text_col))


def retrieve(
    queries: DataFrame,
    vectors: DataFrame,
    top_k: int = TOP_K,
    where: Column | None = None,
    max_distance: float | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    payload: Sequence[str] = (),
    block: int = QUERY_BLOCK,
) -> DataFrame:
    """The ``top_k`` nearest vectors per question by squared L2 distance, ties by id, with ``rank`` from 1.

    ``where`` restricts the vectors before the search, ``max_distance`` drops hits after it, on the distance rounded
    to 4 digits, so fewer than ``top_k`` may be left.

    Vectors and questions that are missing, hold missing or non-finite numbers, or have another width than the first
    question are an error; leave them out before, knowingly.

    The search is exact. Each task scans its own part of the vectors against a block of questions and passes on only
    its ``top_k`` per question, so neither pairs nor vectors are shuffled and it does not matter how vectors cluster.
    ``payload`` columns are fetched for the hits alone.
    """
    searched = vectors if where is None else vectors.where(where)
    whole = dict(queries.dtypes)[query_id] in ("tinyint", "smallint", "int")
    asked = queries.select(
        (F.col(query_id).cast("bigint") if whole else F.col(query_id)).alias(query_id),
        F.col(query_vector).cast("array<double>").alias("__q"),
    )
    first = asked.limit(block + 1).collect()
    blocks = 1
    if len(first) > block:  # written once, as their vectors would be made again for each block
        asked.write.parquet(written := shared_folder(queries.sparkSession, "questions"))
        asked = queries.sparkSession.read.schema(asked.schema).parquet(written)
        blocks = -(-asked.count() // block)
    search = (asked.schema[query_id], searched, top_k, id_col, vector_col)
    if blocks == 1:
        nearest = _nearest(first, *search)
    else:
        # One block is held by the driver at a time; its hits are final, as a question is in one block only.
        path = shared_folder(queries.sparkSession, "hits")
        for number in range(blocks):
            part = asked.where(F.pmod(F.xxhash64(query_id), F.lit(blocks)) == number).collect()
            _nearest(part, *search).write.parquet(f"{path}/block={number}")
        nearest = queries.sparkSession.read.parquet(path).drop("block")
    ranked = nearest.withColumn("distance", F.round("__distance", 4)).drop("__distance")
    if max_distance is not None:
        ranked = ranked.where(F.col("distance") <= max_distance)
    if payload:
        ranked = searched.select(id_col, *payload).join(_bounded(ranked, blocks * top_k), id_col)
    return ranked.select(query_id, "rank", id_col, "distance", *payload)


def _planes(bits: int, width: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(bits, width))


def _codes(rows: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """One bit per plane: the side on which the vector lies."""
    return ((rows @ planes.T) > 0) @ (1 << np.arange(len(planes)))


def _with_code(df: DataFrame, name: str, vector_col: str, bits: int, seed: int, width: int | None = None) -> DataFrame:
    @F.pandas_udf(T.IntegerType())
    def code(column: pd.Series) -> pd.Series:
        rows = np.array(column.tolist(), dtype="float64")
        if width is not None and rows.shape != (len(column), width):
            raise ValueError(f"vectors have another width than {width}")
        if not np.isfinite(rows).all():
            raise ValueError("vectors hold non-finite numbers")
        return pd.Series(_codes(rows, _planes(bits, rows.shape[1], seed)))

    return df.withColumn(name, code(F.col(vector_col).cast("array<double>")))


def with_buckets(
    vectors: DataFrame, width: int, bits: int = LSH_BITS, seed: int = LSH_SEED, vector_col: str = "embedding"
) -> DataFrame:
    """Add ``bucket``, equal for vectors on the same side of some random planes: near vectors tend to share it.

    Write the result partitioned by ``bucket`` and a search over few buckets reads only their folders.
    """
    return _with_code(vectors, "bucket", vector_col, bits, seed, width)


def near_buckets(queries: DataFrame, radius: int = 1, bits: int = LSH_BITS, seed: int = LSH_SEED,
                 query_vector: str = "query_vector", probes: int | None = None) -> DataFrame:
    """The buckets of each question: those that differ from its own in at most ``radius`` bits.

    With ``probes`` these are that many buckets instead, the ones whose planes lie nearest: a bucket costs the sum of the
    question's distances to the planes that stand between them.
    """
    if probes is not None:
        near = _probed(bits, seed, probes)(F.col(query_vector).cast("array<double>"))
        return queries.select("*", F.explode(near).alias("bucket"))
    flips = [sum(1 << bit for bit in flipped) for n in range(radius + 1) for flipped in combinations(range(bits), n)]
    coded = _with_code(queries, "__code", query_vector, bits, seed)
    near = F.transform(F.array(*[F.lit(flip) for flip in flips]), lambda flip: F.col("__code").bitwiseXOR(flip))
    return coded.select("*", F.explode(near).alias("bucket")).drop("__code")


def _probed(bits: int, seed: int, probes: int):
    """A function of vectors: their ``probes`` nearest buckets by the distances to the planes that are crossed."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def probed(column: pd.Series) -> pd.Series:
        rows = np.array(column.tolist(), dtype="float64")
        if not np.isfinite(rows).all():
            raise ValueError("vectors hold non-finite numbers")
        planes = _planes(bits, rows.shape[1], seed)
        away = np.abs(rows @ (planes / np.linalg.norm(planes, axis=1, keepdims=True)).T)
        crossed = (np.arange(1 << bits)[:, None] >> np.arange(bits)) & 1
        return pd.Series([
            (np.argsort(crossed @ own, kind="stable")[:probes] ^ code).tolist() for own, code in zip(away, _codes(rows, planes))
        ])

    return probed


def retrieve_lsh(
    queries: DataFrame,
    bucketed: DataFrame,
    radius: int = 1,
    bits: int = LSH_BITS,
    seed: int = LSH_SEED,
    top_k: int = TOP_K,
    max_distance: float | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    rows_per_task: int = BUCKET_ROWS,
    probes: int | None = None,
) -> DataFrame:
    """Approximate search: the ``top_k`` nearest vectors in the near buckets of each question, by exact distance.

    The near buckets are those within ``radius`` bits, or with ``probes`` that many by distance to the planes.

    Questions and vectors meet by bucket. A bucket with more than ``rows_per_task`` vectors is cut, and its questions go to
    every cut, so a crowded bucket is many tasks. A task holds the questions of one bucket, streams the vectors past them and
    passes on ``top_k`` per question; pairs are never rows. Of vectors stored by bucket only folders of near buckets are read.
    With ``radius = bits`` every vector is compared.
    """
    whole = dict(queries.dtypes)[query_id] in ("tinyint", "smallint", "int")
    asked = near_buckets(queries, radius, bits, seed, query_vector, probes).select(
        "bucket", (F.col(query_id).cast("bigint") if whole else F.col(query_id)).alias("__id"),
        F.col(query_vector).cast("array<double>").alias("__vector"),
    )
    codes = [row[0] for row in asked.select("bucket").distinct().collect()]  # at most 2**bits
    searched = bucketed.where(F.col("bucket").isin(codes)).select("bucket", id_col, vector_col)
    cuts = searched.groupBy("bucket").agg(F.ceil(F.count("*") / rows_per_task).cast("int").alias("__cuts"))
    cuts = F.broadcast(cuts)  # at most 2**bits rows
    stored = searched.join(cuts, "bucket").select(
        "bucket", F.pmod(F.xxhash64(id_col), F.col("__cuts")).cast("int").alias("__cut"), F.lit(1).alias("__side"),
        F.col(id_col).alias("__stored"), F.col(vector_col).cast("array<double>").alias("__vector"),
    )
    everywhere = F.explode(F.sequence(F.lit(0), F.col("__cuts") - 1)).alias("__cut")
    questions = asked.join(cuts, "bucket").select("bucket", everywhere, F.lit(0).alias("__side"), "__id", "__vector")
    meeting = questions.unionByName(stored, allowMissingColumns=True)
    meeting = meeting.repartition("bucket", "__cut").sortWithinPartitions("bucket", "__cut", "__side")
    schema = T.StructType([
        T.StructField(query_id, asked.schema["__id"].dataType), bucketed.schema[id_col], T.StructField("__distance", T.DoubleType()),
    ])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, names, wanted, best = None, [], [], []

        def found() -> Iterator[pa.RecordBatch]:
            for name, (distances, kept) in zip(names, best):
                if len(distances):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(distances), id_type), pa.array(kept.tolist(), stored_type), pa.array(distances)],
                        names=schema.names,
                    )

        for batch in batches:
            id_type, stored_type = batch.schema.field("__id").type, batch.schema.field("__stored").type
            places = np.stack([batch.column(name).to_numpy() for name in ("bucket", "__cut", "__side")], axis=1)
            starts = np.flatnonzero(np.any(np.diff(places, axis=0, prepend=places[:1] - 1) != 0, axis=1))
            for begin, end in zip(starts, [*starts[1:], len(places)]):
                part = batch.slice(begin, end - begin)
                here = tuple(places[begin][:2])
                if here != place:
                    yield from found()
                    place, names, wanted, best = here, [], [], []
                vectors = part.column("__vector")
                if places[begin][2] == 0:
                    names += part.column("__id").to_pylist()
                    wanted += vectors.to_pylist()
                    best = [(np.empty(0), np.empty(0, dtype=object)) for _ in names]
                elif names:
                    target = np.array(wanted)
                    ids = part.column("__stored").to_numpy(zero_copy_only=False)
                    _keep_nearest(best, _matrix(vectors, target.shape[1]), ids, target, top_k)
        yield from found()

    by_distance = Window.partitionBy(query_id).orderBy("__distance", id_col)
    hits = meeting.mapInArrow(search, schema).withColumn("rank", F.row_number().over(by_distance))
    hits = hits.where(F.col("rank") <= top_k).withColumn("distance", F.round("__distance", 4))
    if max_distance is not None:
        hits = hits.where(F.col("distance") <= max_distance)
    return hits.select(query_id, "rank", id_col, "distance")


def _bounded(hits: DataFrame, per_question: int) -> DataFrame:
    """A block of about :data:`QUERY_BLOCK` questions with few hits each is safe to broadcast: four numbers per hit."""
    return F.broadcast(hits) if per_question <= 100 else hits


def _nearest(
    block: list, query_field: T.StructField, vectors: DataFrame, top_k: int, id_col: str, vector_col: str
) -> DataFrame:
    """The ``top_k`` best vectors per question of one bounded block, with ``rank``: per task first, then overall."""
    query_id = query_field.name
    by_distance = Window.partitionBy(query_id).orderBy("__distance", id_col)
    return (
        _scan(block, query_field, vectors, top_k, id_col, vector_col)
        .withColumn("rank", F.row_number().over(by_distance))
        .where(F.col("rank") <= top_k)
    )


def _scan(
    block: list, query_field: T.StructField, vectors: DataFrame, top_k: int, id_col: str, vector_col: str
) -> DataFrame:
    """Per task and question the ``top_k`` best vectors."""
    query_id = query_field.name
    schema = T.StructType(
        [query_field, vectors.schema[id_col], T.StructField("__distance", T.DoubleType())]
    )
    rows = list(block)
    if not rows:
        return vectors.sparkSession.createDataFrame([], schema)
    width = len(rows[0]["__q"] or [])
    if any(len(row["__q"] or []) != width or not np.isfinite(np.array(row["__q"], float)).all() for row in rows) or not width:
        raise ValueError(f"questions need {width} finite numbers each")
    shared = vectors.sparkSession.sparkContext.broadcast(
        ([row[query_id] for row in rows], np.array([row["__q"] for row in rows], dtype="float64"))
    )

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, wanted = shared.value
        best = [(np.empty(0), np.empty(0, dtype=object)) for _ in names]
        ids_type = None
        for batch in batches:
            ids_type = batch.schema.field(0).type
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            _keep_nearest(best, _matrix(batch.column(1), width), ids, wanted, top_k)
        if ids_type is None:
            return
        for name, (distances, kept) in zip(names, best):
            if not len(distances):
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([name] * len(distances)),
                    pa.array(kept.tolist(), type=ids_type),
                    pa.array(distances, type=pa.float64()),
                ],
                names=[query_id, id_col, "__distance"],
            )

    return vectors.select(id_col, vector_col).mapInArrow(nearest, schema)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of numbers; anything that can't be compared is an error."""
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    if (lengths != width).any():
        raise ValueError(f"{int((lengths != width).sum())} vectors of a batch have another width than {width}")
    rows = column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, width)
    if not np.isfinite(rows).all():
        raise ValueError(f"{int((~np.isfinite(rows)).any(axis=1).sum())} vectors of a batch hold non-finite numbers")
    return rows


def _keep_nearest(best: list, rows: np.ndarray, ids: np.ndarray, wanted: np.ndarray, top_k: int) -> None:
    """Merge a batch into the running best per question.

    One matrix product gives all distances up to rounding; the few rows within reach of the best ``top_k`` are then
    measured exactly, so the choice and the ties do not depend on how rows fall into batches. Distances count to nine
    digits, so that equal ones tie whatever the order of their terms.
    """
    if not len(rows):
        return
    norms = (rows * rows).sum(axis=1)
    rough = norms[:, None] - 2.0 * (rows @ wanted.T) + (wanted * wanted).sum(axis=1)[None, :]
    slack = 2e-9 * (1.0 + np.abs(rough).max(axis=0))
    cutoff = np.partition(rough, top_k - 1, axis=0)[top_k - 1] if len(rows) > top_k else np.full(len(wanted), np.inf)
    for j, (distances, kept) in enumerate(best):
        reach = min(cutoff[j], distances[-1] if len(distances) == top_k else np.inf) + slack[j]
        near = np.flatnonzero(rough[:, j] <= reach)
        if not len(near):
            continue
        exact = np.round(((rows[near] - wanted[j]) ** 2).sum(axis=1), 9)
        all_d = np.concatenate([distances, exact])
        all_ids = np.concatenate([kept, ids[near].astype(object)])
        order = np.lexsort((all_ids, all_d))[:top_k]
        best[j] = (all_d[order], all_ids[order])
