"""Sparse vectors against dense ones, and posting-list search against brute force."""

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierloom.operators import sparse, vectors

WORDS = [f"w{i}" for i in range(60)]


@pytest.fixture(scope="module")
def texts(spark):
    pick = random.Random(6)
    weights = [1 / (i + 1) for i in range(60)]
    made = [(i, " ".join(pick.choices(WORDS, weights, k=pick.randint(0, 25))), i % 3 or None) for i in range(700)]
    made += [(700 + i, made[i][1], 1) for i in range(150)] + [(900, None, 1), (901, "", 2), (902, "...", 2)]  # equal texts tie
    return spark.createDataFrame(made, "vec_id bigint, text string, part int").repartition(5)


@pytest.fixture(scope="module")
def questions(spark):
    asked = [(q, t) for q, t in enumerate(["w0 w1 w2", "w40 w3", "w59", "w7 w7 w7 w50 w51 w52", "nothing of it"])]
    return spark.createDataFrame(asked, "query_id int, t string")


def brute(pool, asked, top_k, max_distance=None):
    dense = [(r.vec_id, np.array(r.embedding, float)) for r in pool]
    out = []
    for q in asked:
        target = np.array(q.embedding, float)
        best = sorted((round(float(((v - target) ** 2).sum()), 9), k) for k, v in dense)[:top_k]
        out += [(q.query_id, n + 1, k, round(d, 4)) for n, (d, k) in enumerate(best)
                if max_distance is None or round(d, 4) <= max_distance]
    return sorted(out)


def test_vectors_are_those_of_the_dense_encoder(spark, texts):
    got = sparse.embed_sparse(texts.withColumn("bucket", F.lit(1)), "text", dim=31)  # few buckets, so that tokens collide
    dense = {r.vec_id: r.embedding for r in vectors.embed(texts, "text", dim=31).collect()}
    assert got.columns == ["vec_id", "text", "part", "bucket", "sparse"] and got.count() == len(dense)
    for row in got.collect():
        buckets = [pair.bucket for pair in row.sparse]
        assert buckets == sorted(set(buckets)) and {p.bucket: p.value for p in row.sparse} == {
            i: v for i, v in enumerate(dense[row.vec_id]) if v}
    assert sparse.embed_sparse(texts.where("vec_id < 0"), "text").count() == 0
    with pytest.raises(ValueError):
        sparse.embed_sparse(got, "text")


@pytest.mark.parametrize("limit", [None, 1.3, 0.4])
@pytest.mark.parametrize("dim", [29, 2048])
def test_search_is_exact(spark, texts, questions, tmp_path, dim, limit):
    """Many ties, colliding buckets, blocks of a few vectors, several blocks of questions."""
    embedded = sparse.embed_sparse(texts, "text", dim)
    asked = sparse.embed_sparse(questions, "t", dim, "query_vector").where(F.size("query_vector") > 0)
    pool = vectors.meaningful(vectors.embed(texts, "text", dim=dim)).collect()
    want = brute(pool, vectors.meaningful(vectors.embed(questions, "t", dim=dim)).collect(), 5, limit)
    assert want
    for number, (size, block) in enumerate(((sparse.BLOCK_ROWS, 1024), (40, 1024), (7, 2))):
        built = sparse.postings(embedded, "vec_id", block_rows=size, block_values=10 * size)
        built.write.parquet(path := str(tmp_path / f"p{number}"))
        stored = spark.read.parquet(path)
        assert stored.where("bucket = -1").agg(F.sum(F.size("ids"))).first()[0] == len(pool)
        assert stored.where("bucket = -1").agg(F.max(F.size("ids"))).first()[0] <= size
        got = sparse.retrieve_sparse(asked, stored, 5, max_distance=limit, block=block)
        assert rows(got) == want


def test_filter_comes_before_and_payload_after(spark, texts, questions, tmp_path):
    embedded = sparse.embed_sparse(texts, "text")
    sparse.postings(embedded, "vec_id", ["part"]).write.parquet(path := str(tmp_path / "p"))
    stored = spark.read.parquet(path)
    asked = sparse.embed_sparse(questions, "t", vector_col="query_vector")
    target = vectors.embed(questions, "t").collect()
    for where in (F.col("part") == 2, F.col("part").isNull()):
        pool = vectors.meaningful(vectors.embed(texts.where(where), "text")).collect()
        got = sparse.retrieve_sparse(asked, stored, 3, where=where, rows=texts.withColumn("distances", F.lit(1)), payload=["text", "part"])
        assert rows(got.drop("text", "part")) == brute(pool, target, 3)
        held = {r.vec_id: r.text for r in pool}
        assert all(r.text == held[r.vec_id] for r in got.collect())
    assert sparse.retrieve_sparse(asked, stored, 3, where=F.col("part") == 9).collect() == []
    assert sparse.retrieve_sparse(asked.limit(0), stored).collect() == []


def test_text_ids_tie_in_their_own_order(spark, tmp_path):
    made = spark.createDataFrame([(f"d#{i}", "same words") for i in range(30)], "name string, text string").repartition(4)
    sparse.postings(sparse.embed_sparse(made, "text"), "name", block_rows=4).write.parquet(path := str(tmp_path / "p"))
    asked = sparse.embed_sparse(spark.createDataFrame([("q", "words")], "query_id string, t string"), "t", vector_col="query_vector")
    got = sparse.retrieve_sparse(asked, spark.read.parquet(path), 4, id_col="name")
    assert [r.name for r in got.orderBy("rank").collect()] == sorted(f"d#{i}" for i in range(30))[:4]


def lists_of(dense):
    lists = {}
    for bucket in range(dense.shape[1]):
        places = np.flatnonzero(dense[:, bucket]).astype(np.int32)
        if len(places):
            values = dense[places, bucket].astype(np.float32)
            lists[bucket] = (places, values, float(values.min()), float(values.max()))
    return lists


def test_bounds_skip_most_postings():
    """A rare word decides; the long lists of common words are looked up at a few places only."""
    pick = np.random.default_rng(2)
    dense = np.zeros((20_000, 60), np.float32)
    dense[:, :4] = pick.integers(0, 2, (20_000, 4))
    for bucket in range(4, 60):
        dense[pick.integers(0, 20_000, 60), bucket] = 3
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-9)
    norms, lists = (dense.astype(float) ** 2).sum(1), lists_of(dense)
    question = {0: 0.2, 1: 0.2, 2: -0.1, 10: 0.6, 11: 0.7}
    target = np.zeros(60)
    target[list(question)] = list(question.values())
    distances = np.round(((dense - target) ** 2).sum(1), 9)
    best = sorted(zip(distances, range(20_000)))[:5]
    places, got, read = sparse.best_of_block(norms, lists, question, float(target @ target), 5)
    assert [(round(d, 6), p) for d, p in zip(got, places)] == [(round(d, 6), p) for d, p in best]
    assert read < 0.1 * sum(len(lists[b][0]) for b in question)
    floor = (float(target @ target) - 0.1) / 2  # nothing is that near
    assert sparse.best_of_block(norms, lists, question, float(target @ target), 5, floor)[2] <= read
    far = {bucket: 0.01 for bucket in (20, 21)}
    assert sparse.best_of_block(norms, lists, far, 0.0002, 5, 0.2)[2] == 0  # a block out of reach is not read


def test_work_is_done_in_bounded_pieces(spark, texts, monkeypatch):
    """However many rows a session puts into a batch, few tokens are counted at a time."""
    import pyarrow as pa

    words = pa.array([["a"] * n for n in (3, 0, 5, 900, 1)] * 40 + [None], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(words))), words], names=["id", "tokens"])
    monkeypatch.setattr(sparse, "PIECE_TOKENS", 10)
    counted = []
    monkeypatch.setattr(sparse, "_counted", lambda part, places, dim: counted.append(len(part.flatten())) or part)
    ids = [i for columns in sparse._with_vectors(iter([batch]), 29) for i in columns[0].to_pylist()]
    assert ids == list(range(len(words))) and sum(counted) == 909 * 40 and set(counted) <= {*range(11), 900}


@pytest.mark.parametrize("by", [[], ["part"]])
def test_postings_of_texts_are_those_of_their_vectors(spark, texts, by):
    """One pass over the texts gives the blocks that their vectors give; the text does not go through Python."""
    sizes = {"block_rows": 40, "block_values": 300}
    one = sparse.text_postings(texts.coalesce(1), "vec_id", "text", by, dim=31, **sizes)
    two = sparse.postings(sparse.embed_sparse(texts.coalesce(1), "text", 31, keep=["vec_id", "part"]), "vec_id", by, **sizes)
    assert one.schema == two.schema and one.columns == two.columns
    assert sorted(i for r in one.where(f"bucket = {sparse.HEADER}").collect() for i in r.ids) == sorted(
        r.vec_id for r in sparse.embed_sparse(texts, "text", 31).where("size(sparse) > 0").collect())
    drop = ["block"]  # their numbers and where they end may differ with the cuts
    assert rows(one.drop(*drop).where("bucket >= 0").selectExpr("bucket", "explode(values) v")) == rows(
        two.drop(*drop).where("bucket >= 0").selectExpr("bucket", "explode(values) v"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
