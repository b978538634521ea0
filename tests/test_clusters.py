"""The cluster index against the plain search."""

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierloom.operators import clusters, vectors


def grouped(n=3000, groups=40, width=12, spread=0.05):
    rng = np.random.default_rng(9)
    centers = rng.normal(size=(groups, width))
    return [(i, (centers[i % groups] + spread * rng.normal(size=width)).tolist(), i % 7) for i in range(n)], centers


@pytest.fixture(scope="module")
def points(spark):
    """Clustered vectors, of which a third are one and the same."""
    made, centers = grouped()
    made = [(i, centers[0].tolist() if i % 3 == 0 else v, part) for i, v, part in made]
    return spark.createDataFrame(made, "vec_id bigint, embedding array<double>, part int").repartition(6)


@pytest.fixture(scope="module")
def asked(spark):
    _, centers = grouped()
    pick = random.Random(3)
    made = [(i, [x + pick.gauss(0, 0.05) for x in c]) for i, c in enumerate(centers.tolist())] + [(99, [9.0] * 12), (100, [0.0] * 12)]
    return spark.createDataFrame(made, "query_id bigint, query_vector array<double>")


@pytest.mark.parametrize("count", [None, 1, 500])
def test_hits_are_those_of_the_plain_search(spark, points, asked, count):
    index = clusters.build_clusters(points, count=count, partitions=4)
    assert rows(index.rows.drop("cluster", "away")) == rows(points) and index.size.sum() == points.count()
    for top_k, limit, block in ((5, None, 1024), (1300, None, 1024), (3, 0.02, 1024), (3, None, 7)):
        got = clusters.retrieve_clusters(asked, index, top_k, max_distance=limit, block=block)
        assert rows(got) == rows(vectors.retrieve(asked, points, top_k, max_distance=limit))


def test_filter_payload_and_few_rows(spark, points, asked):
    index = clusters.build_clusters(points)
    where = F.col("part") == 2
    assert rows(clusters.retrieve_clusters(asked, index, 4, where=where, payload=["part"])) == rows(
        vectors.retrieve(asked, points, 4, where=where, payload=["part"]))
    narrow = asked.withColumn("query_id", F.col("query_id").cast("int"))
    assert rows(clusters.retrieve_clusters(narrow, index, 2)) == rows(vectors.retrieve(narrow, points, 2))
    few = points.where("vec_id < 3")
    assert rows(clusters.retrieve_clusters(asked, clusters.build_clusters(few), 5)) == rows(vectors.retrieve(asked, few, 5))
    none = clusters.build_clusters(points.where("vec_id < 0"))
    assert clusters.retrieve_clusters(asked, none).collect() == []
    assert clusters.retrieve_clusters(asked.limit(0), index).collect() == []


def test_clustered_vectors_are_mostly_skipped(spark, asked):
    made, _ = grouped()
    stored = spark.createDataFrame(made, "vec_id bigint, embedding array<double>, part int")
    index = clusters.build_clusters(stored, count=60)
    questions = np.array([r.query_vector for r in asked.where("query_id < 90").collect()])
    low = clusters.bounds(index, questions)
    first = clusters.first_visits(index, low, 3)
    worst = {}
    for r in vectors.retrieve(asked, stored, 3).where("rank = 3").collect():
        worst[r.query_id] = r.distance
    limit = np.sqrt(np.array([worst[i] for i in range(len(questions))]) + 1e-4)
    visited = first | (low <= limit[:, None])
    assert (visited * index.size).sum() <= 0.3 * len(questions) * index.size.sum()
    # and no bound is above a member's distance
    placed = {r.vec_id: r.cluster for r in index.rows.collect()}
    for vec_id, vector, _ in made[:400]:
        away = np.linalg.norm(questions - np.array(vector), axis=1)
        assert (low[:, placed[vec_id]] <= away + 1e-9).all()


def test_only_files_of_visited_clusters_are_asked(spark, points, asked):
    index = clusters.build_clusters(points, count=50)
    got = clusters.retrieve_clusters(asked.where("query_id = 99"), index, 3)
    assert got.count() == 3
    plan = index.rows.where(F.col("cluster").isin([1, 2]))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(cluster, [1,2])" in plan


def test_a_crowded_cluster_is_many_tasks(spark):
    """Equal vectors share a cluster and a distance; they are dealt by id."""
    stored = spark.range(4000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.lit(0.5)).alias("embedding"))
    index = clusters.build_clusters(stored, count=4, partitions=8)
    sizes = [r["count"] for r in index.rows.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 1200


@pytest.mark.parametrize("bad", [[1.0, float("nan")], [1.0], [], None, [None, 1.0]])
def test_vectors_that_cannot_be_compared_are_an_error(spark, bad):
    stored = spark.createDataFrame([(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, bad)], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="width|finite"):
        clusters.build_clusters(stored)
