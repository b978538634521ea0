"""An exact index for nearest-neighbour search: clusters with radii, pruned by the triangle inequality.

Every vector is stored with its nearest center and its distance to it, in the order of both, so that the scan of a few clusters skips the
rest of the files. A member of a cluster is at least ``distance(question, center) - radius`` away from a question, and at
least ``least - distance(question, center)`` if no member is nearer to the center than ``least``.

A question first visits the clusters with the lowest bounds until these hold ``top_k`` vectors; the last of its hits then says which
other clusters can still hold a nearer one, and only these are read in the second pass. Within a cluster, members whose own
distance to the center rules them out are not compared. The result is that of comparing everything; how much is skipped
depends on how clustered the vectors are. Only the centers come from a sample.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.operators.vectors import QUERY_BLOCK, TOP_K, _bounded, _keep_nearest, _matrix
from tierloom.session import carry_to_workers, shared_folder

carry_to_workers(__name__)

#: Bound of the sample that the centers are fitted on, and of the centers, which go to all tasks.
FIT_BYTES = 32 << 20
FIT_ROUNDS = 4
#: Sampled vectors per center.
PER_CENTER = 8
CLUSTER, AWAY = "cluster", "away"


@dataclass
class ClusterIndex:
    """Stored vectors with ``cluster`` and ``away``, and of each cluster its center, least and largest distance, and size."""

    rows: DataFrame
    centers: np.ndarray
    least: np.ndarray
    radius: np.ndarray
    size: np.ndarray


def _distances(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    squares = (rows * rows).sum(1)[:, None] - 2.0 * (rows @ centers.T) + (centers * centers).sum(1)[None, :]
    return np.sqrt(np.maximum(squares, 0))


def _fit(sample: np.ndarray, count: int) -> np.ndarray:
    """Centers of the sample; those that get no vector stay where they are."""
    centers = np.unique(sample, axis=0)
    centers = centers[np.random.default_rng(7).permutation(len(centers))[:count]]
    for _ in range(FIT_ROUNDS):
        nearest = np.concatenate([_distances(sample[at : at + 4096], centers).argmin(1) for at in range(0, len(sample), 4096)])
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, sample)
        held = np.bincount(nearest, minlength=len(centers))
        centers = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centers)
    return centers


def build_clusters(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int | None = None,
                   partitions: int | None = None) -> ClusterIndex:
    """Write ``vectors`` with all their columns into the shared folder, by cluster.

    There are ``count`` clusters, the square root of the number of vectors if not given, as far as :data:`FIT_BYTES` allow. Vectors that are
    missing, non-finite or of another width are an error. The rows are dealt by range of (cluster, distance), so that a
    cluster with most of the rows is written and read by many tasks.
    """
    spark, total = vectors.sparkSession, vectors.count()
    if not total:
        return ClusterIndex(vectors.withColumn(CLUSTER, F.lit(0)).withColumn(AWAY, F.lit(0.0)), np.zeros((0, 0)), *[np.zeros(0)] * 3)
    width = len(vectors.select(vector_col).first()[0] or [])
    most = max(1, FIT_BYTES // (8 * max(width, 1)))
    count = min(count or math.isqrt(total), most)
    wanted = min(PER_CENTER * count, most)
    some = vectors.select(F.col(vector_col).cast("array<double>").alias("v"))
    picked = some.sample(min(1.0, 1.5 * wanted / total + 100 / total), 11).limit(wanted).collect()
    if not width or any(len(row["v"] or []) != width for row in picked):
        raise ValueError(f"sampled vectors have another width than {width}")
    sample = np.array([row["v"] for row in picked], float)
    if not np.isfinite(sample).all():
        raise ValueError("sampled vectors hold non-finite numbers")
    centers = _fit(sample, count)
    shared = spark.sparkContext.broadcast(centers)
    schema = T.StructType([*vectors.schema.fields, T.StructField(CLUSTER, T.IntegerType()), T.StructField(AWAY, T.DoubleType())])
    place = vectors.columns.index(vector_col)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                rows = _matrix(part.column(place), shared.value.shape[1])
                nearest = _distances(rows, shared.value).argmin(1)
                away = np.sqrt(((rows - shared.value[nearest]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(nearest.astype(np.int32)), pa.array(away)], names=schema.names)

    placed = vectors.mapInArrow(assign, schema)
    number = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartitionByRange(number, CLUSTER, AWAY, id_col).sortWithinPartitions(CLUSTER, AWAY)
    placed.write.parquet(path := shared_folder(spark, "clusters"))
    stored = spark.read.schema(schema).parquet(path)
    found = stored.groupBy(CLUSTER).agg(F.min(AWAY).alias("least"), F.max(AWAY).alias("radius"), F.count("*").alias("n")).collect()
    least, radius, size = (np.zeros(len(centers)) for _ in range(3))
    for row in found:
        least[row[CLUSTER]], radius[row[CLUSTER]], size[row[CLUSTER]] = row["least"], row["radius"], row["n"]
    return ClusterIndex(stored, centers, least, radius, size)


def bounds(index: ClusterIndex, questions: np.ndarray) -> np.ndarray:
    """At least so far is any member of a cluster from a question; infinite for empty clusters."""
    away = _distances(questions, index.centers)
    low = np.maximum(np.maximum(away - index.radius, index.least - away), 0)
    return np.where(index.size > 0, low - 1e-6 * (1 + away), np.inf)


def first_visits(index: ClusterIndex, low: np.ndarray, top_k: int) -> np.ndarray:
    """Which clusters each question visits first: by lower bound, until they hold ``top_k`` vectors."""
    order = np.argsort(low, axis=1, kind="stable")
    held = np.cumsum(index.size[order], axis=1)
    wanted = np.concatenate([np.zeros((len(low), 1)), held[:, :-1]], axis=1) < top_k
    out = np.zeros(low.shape, bool)
    np.put_along_axis(out, order, wanted, axis=1)
    return out & np.isfinite(low)


def retrieve_clusters(
    queries: DataFrame,
    index: ClusterIndex,
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
    """As ``vectors.retrieve``, with the same rows, over an index."""
    spark = index.rows.sparkSession
    whole = dict(queries.dtypes)[query_id] in ("tinyint", "smallint", "int")
    name = (F.col(query_id).cast("bigint") if whole else F.col(query_id)).alias(query_id)
    asked = queries.select(name, F.col(query_vector).cast("array<double>").alias("__q"))
    asked.write.parquet(path := shared_folder(spark, "questions"))  # so that they are made once
    asked = spark.read.schema(asked.schema).parquet(path)
    blocks = max(1, -(-asked.count() // block))
    search = (index, asked.schema[query_id], top_k, where, max_distance, id_col, vector_col)
    if blocks == 1:
        hits = _search(asked.collect(), *search)
    else:
        path = shared_folder(spark, "hits")
        for number in range(blocks):
            part = asked.where(F.pmod(F.xxhash64(query_id), F.lit(blocks)) == number).collect()
            _search(part, *search).write.parquet(f"{path}/block={number}")
        hits = spark.read.parquet(path).drop("block")
    if payload:
        hits = index.rows.select(id_col, *payload).join(_bounded(hits, blocks * top_k), id_col)
    return hits.select(query_id, "rank", id_col, "distance", *payload)


def _search(block: list, index: ClusterIndex, query_field: T.StructField, top_k: int, where: Column | None,
            max_distance: float | None, id_col: str, vector_col: str) -> DataFrame:
    """Two passes for a block of questions; the hits of the first one, ``top_k`` per question, are held by the driver."""
    spark, query_id = index.rows.sparkSession, query_field.name
    schema = T.StructType([query_field, index.rows.schema[id_col], T.StructField("__distance", T.DoubleType())])
    by_distance = Window.partitionBy(query_id).orderBy("__distance", id_col)

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(by_distance)).where(F.col("rank") <= top_k)

    found = []
    if block and len(index.centers):
        names = [row[query_id] for row in block]
        questions = np.array([row["__q"] for row in block], float)
        if questions.ndim != 2 or questions.shape[1] != index.centers.shape[1] or not np.isfinite(questions).all():
            raise ValueError(f"questions need {index.centers.shape[1]} finite numbers each")
        low = bounds(index, questions)
        limit = np.full(len(block), np.inf if max_distance is None else math.sqrt(max_distance + 5.1e-5))
        first = first_visits(index, low, top_k) & (low <= limit[:, None])
        scan = (index, names, questions, top_k, id_col, vector_col, where, schema)
        found = ranked(_scan(first, limit, *scan)).drop("rank").collect()
        place, worst = {name: i for i, name in enumerate(names)}, {}
        for row in found:
            worst.setdefault(place[row[query_id]], []).append(row["__distance"])
        for i, own in worst.items():
            if len(own) == top_k:
                limit[i] = min(limit[i], math.sqrt(max(own)) * (1 + 1e-6) + 1e-6)
        rest = ~first & (low <= limit[:, None])
    hits = spark.createDataFrame(found, schema)
    if found or block and len(index.centers):
        hits = hits.union(_scan(rest, limit, *scan)) if rest.any() else hits
    hits = ranked(hits).select(query_id, "rank", id_col, F.round("__distance", 4).alias("distance"))
    return hits if max_distance is None else hits.where(F.col("distance") <= max_distance)


def _scan(visits: np.ndarray, limit: np.ndarray, index: ClusterIndex, names: list, questions: np.ndarray, top_k: int, id_col: str,
          vector_col: str, where: Column | None, schema: T.StructType) -> DataFrame:
    """Per task and question the best members of the clusters to visit."""
    spark, clusters = index.rows.sparkSession, np.flatnonzero(visits.any(0))
    rows = index.rows if where is None else index.rows.where(where)
    rows = rows.where(F.col(CLUSTER).isin(clusters.tolist()) if len(clusters) < len(index.centers) else F.lit(True))
    visitors = {int(c): np.flatnonzero(visits[:, c]) for c in clusters}
    away = {int(c): _distances(questions[q], index.centers[c : c + 1])[:, 0] for c, q in visitors.items()}
    shared = spark.sparkContext.broadcast((names, questions, visitors, away, limit))
    width = questions.shape[1]

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, questions, visitors, away, limit = shared.value
        best: list = [(np.empty(0), np.empty(0, dtype=object)) for _ in names]
        id_type = None
        for batch in batches:
            id_type = batch.schema.field(0).type
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            cluster, own = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            starts = np.flatnonzero(np.diff(cluster, prepend=-1))
            for begin, end in zip(starts, [*starts[1:], len(cluster)]):
                asking, far = visitors.get(int(cluster[begin]), ()), away.get(int(cluster[begin]), ())
                if not len(asking):
                    continue
                part = slice(begin, end)
                reach = [min(limit[j], np.sqrt(best[j][0][-1]) + 1e-6 if len(best[j][0]) == top_k else np.inf) for j in asking]
                near = np.abs(own[part][:, None] - far[None, :]) <= np.array(reach)[None, :] + 1e-6 * (1 + far[None, :])
                members = np.flatnonzero(near.any(1))
                if not len(members):
                    continue
                matrix = _matrix(batch.column(1).slice(begin, end - begin).take(pa.array(members)), width)
                held = [best[j] for j in asking]
                _keep_nearest(held, matrix, ids[part][members], questions[asking], top_k)
                for j, kept in zip(asking, held):
                    best[j] = kept
        for name, (distances, kept) in zip(names, best):
            if len(distances):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(distances)), pa.array(kept.tolist(), type=id_type), pa.array(distances, pa.float64())],
                    names=schema.names)

    return rows.select(id_col, vector_col, CLUSTER, AWAY).mapInArrow(nearest, schema)
