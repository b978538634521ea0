import hashlib
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierloom.operators import text, vectors


def split(body, size=400, overlap=60, separators=text.SEPARATORS):
    return text.split_text(body, size, overlap, separators)


def test_boundaries_by_hand():
    assert split("", 10, 2) == []
    assert split("  \n ", 10, 2) == []
    assert split("short", 10, 2) == ["short"]
    assert split("aaa bbb ccc ddd", 8, 4) == ["aaa bbb", "bbb ccc", "ccc ddd"]
    assert split("aaa bbb ccc ddd", 8, 0) == ["aaa bbb", "ccc ddd"]
    assert split("one\n\ntwo\n\nthree", 9, 0) == ["one\n\ntwo", "three"]
    assert split("abcdefghij", 4, 1) == ["abcd", "defg", "ghij"]
    assert split("A first. B second. C third", 12, 0) == ["A first", ". B second", ". C third"]
    # a long paragraph is split further, its short neighbours stay whole
    assert split("tiny\n\nxx yy zz ww\n\nend", 8, 0) == ["tiny", "xx yy", "zz ww", "end"]


def random_texts(count):
    rng = random.Random(5)
    for _ in range(count):
        words = ["".join(rng.choice("abc") for _ in range(rng.choice([1, 3, 9, 50]))) for _ in range(rng.randint(0, 60))]
        yield "".join(word + rng.choice([" ", "\n", ". ", "\n\n"]) for word in words)


def test_nothing_is_lost_or_too_long():
    for body in random_texts(200):
        chunks = split(body, 30, 0)
        assert all(0 < len(c) <= 30 and c == c.strip() for c in chunks)
        assert "".join("".join(chunks).split()) == "".join(body.split())


def slow_split(body, size, overlap, separators):
    """The packing rule step by step: pieces as a plain list, every length counted anew."""
    here = next(s for s in separators if s == "" or s in body)
    weaker = separators[separators.index(here) + 1:]
    if here == "":
        pieces = list(body)
    else:
        cuts = [0] + [i for i in range(len(body)) if body.startswith(here, i)]
        kept = [0]
        for cut in cuts[1:]:  # separators do not overlap
            if kept == [0] or cut >= kept[-1] + len(here):
                kept.append(cut)
        pieces = [body[i:j] for i, j in zip(kept, kept[1:] + [len(body)]) if body[i:j]]
    out, run = [], []

    def flush():
        window = []
        for piece in run:
            if window and len("".join(window)) + len(piece) > size:
                out.append("".join(window).strip())
                while len("".join(window)) > overlap or (window and len("".join(window)) + len(piece) > size):
                    window = window[1:]
            window = window + [piece]
        out.append("".join(window).strip())
        run.clear()

    for piece in pieces:
        if len(piece) < size:
            run.append(piece)
        else:
            flush()
            out.extend(slow_split(piece, size, overlap, weaker) if weaker else [piece])
    flush()
    return [c for c in out if c]


@pytest.mark.parametrize("overlap", [0, 4, 12])
def test_splits_like_the_slow_rule(overlap):
    for body in random_texts(150):
        assert split(body, 30, overlap) == slow_split(body, 30, overlap, list(text.SEPARATORS))


def test_chunk_tables(spark):
    docs = spark.createDataFrame(
        [("a", "word " * 200), ("b", ""), ("c", None), ("d", "short"), ("e", "x" * 1000)], "source string, text string")
    got = text.chunk_recursive(docs, "source", "text")
    by_doc = {}
    for r in got.orderBy("source", "chunk_index").collect():
        by_doc.setdefault(r.source, []).append(r)
    assert set(by_doc) == {"a", "d", "e"}
    for source, chunks in by_doc.items():
        body = {"a": "word " * 200, "d": "short", "e": "x" * 1000}[source]
        assert [c.chunk_text for c in chunks] == split(body)
        assert [c.chunk_label for c in chunks] == [f"{i + 1}/{len(chunks)}" for i in range(len(chunks))]
        assert [c.chunk_id for c in chunks] == [f"{source}#{i}" for i in range(len(chunks))]
    fixed = text.chunk_fixed(docs, "source", "text", 400, 60)
    assert rows(fixed.where("source = 'e'"), "chunk_index", F.length("chunk_text")) == [(0, 400), (1, 400), (2, 320)]
    assert fixed.select("source").distinct().count() == 3
    with pytest.raises(ValueError):
        text.chunk_fixed(docs, "source", "text", 60, 60)


def test_documents_of_the_test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = [(r.doc_id, i, c) for r in docs.collect() for i, c in enumerate(split(r.text))]
    assert rows(text.chunk_recursive(docs, "doc_id", "text"), "doc_id", "chunk_index", "chunk_text") == sorted(want, key=repr)


def test_hash_vectors(spark):
    docs = spark.createDataFrame([(1, "Red red, Ärger!"), (2, ""), (3, None)], "id int, text string")
    got = {r.id: np.array(r.embedding) for r in vectors.embed(docs, "text", dim=32).collect()}
    want = np.zeros(32)
    for token in ("red", "red", "ärger"):
        digest = hashlib.md5(token.encode()).hexdigest()
        want[int(digest[:8], 16) % 32] += 1 if int(digest[8], 16) < 8 else -1
    assert got[1] == pytest.approx(want / np.linalg.norm(want), abs=1e-6)
    assert not got[2].any() and not got[3].any() and len(got[2]) == 32


def test_model_encoder(spark):
    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    docs = spark.createDataFrame([("abc",), (None,)], "text string")
    assert rows(vectors.embed(docs, "text", encoder=load), "embedding") == [([0.0, 1.0],), ([3.0, 1.0],)]


@pytest.fixture(scope="module")
def points(spark):
    """600 points of which a third are the same point."""
    rng = np.random.default_rng(3)
    data = [(i, f"id{i:04}", (rng.normal(size=4) if i % 3 else np.ones(4)).astype("float32").tolist(), i % 5)
            for i in range(600)]
    return spark.createDataFrame(data, "vec_id bigint, name string, embedding array<float>, part int").repartition(5)


def nearest(points, queries, k, id_col="vec_id", keep=lambda r: True):
    out = []
    for query_id, q in queries:
        scored = sorted(
            (float(((np.array(r.embedding, dtype="float64") - np.array(q)) ** 2).sum()), r[id_col])
            for r in points.collect() if keep(r))
        out += [(query_id, i + 1, name, round(d, 4)) for i, (d, name) in enumerate(scored[:k])]
    return sorted(out, key=repr)


QUERIES = [("q1", [1.0, 1.0, 1.0, 1.0]), ("q2", [0.0, 0.5, -1.0, 2.0]), ("q3", [5.0, 0.0, 0.0, 0.0])]


@pytest.mark.parametrize("id_col", ["vec_id", "name"])
def test_search_is_exact(spark, points, id_col):
    asked = spark.createDataFrame(QUERIES, "query_id string, query_vector array<double>")
    want = nearest(points, QUERIES, 7, id_col)
    assert rows(vectors.retrieve(asked, points, 7, id_col=id_col)) == want
    assert rows(vectors.retrieve(asked, points, 7, id_col=id_col, block=1)) == want
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        assert rows(vectors.retrieve(asked, points, 7, id_col=id_col)) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_filter_comes_before_and_threshold_after(spark, points):
    asked = spark.createDataFrame(QUERIES, "query_id string, query_vector array<double>")
    want = nearest(points, QUERIES, 3, keep=lambda r: r.part == 2)
    got = vectors.retrieve(asked, points, 3, where=F.col("part") == 2, payload=["part"])
    assert rows(got.drop("part")) == want and rows(got.select("part").distinct()) == [(2,)]
    limited = rows(vectors.retrieve(asked, points, 3, max_distance=0.5))
    assert limited == [r for r in nearest(points, QUERIES, 3) if r[3] <= 0.5] and len(limited) < 9
    assert vectors.retrieve(asked, points.where("vec_id < 0")).count() == 0
    assert vectors.retrieve(asked.limit(0), points).count() == 0
    few = vectors.retrieve(asked, points.where("vec_id < 2"), 3)
    assert few.count() == 6


def test_approximate_search(spark):
    rng = np.random.default_rng(9)
    centers = rng.normal(size=(20, 16))
    data = [(i, (centers[i % 20] + 0.1 * rng.normal(size=16)).tolist()) for i in range(2000)]
    stored = vectors.with_buckets(spark.createDataFrame(data, "vec_id bigint, embedding array<double>"), 16)
    asked = spark.createDataFrame([(i, centers[i].tolist()) for i in range(20)], "query_id bigint, query_vector array<double>")
    exact = set(rows(vectors.retrieve(asked, stored, 5)))
    assert set(rows(vectors.retrieve_lsh(asked, stored, radius=8, top_k=5))) == exact
    found = set(rows(vectors.retrieve_lsh(asked, stored, radius=1, top_k=5)))
    assert len(found) == 100 and len(found & exact) >= 90
    one = asked.where("query_id = 4")
    own = set(rows(vectors.retrieve_lsh(one, stored, radius=0, top_k=5)))
    assert len(own) == 5 and {r[2] % 20 for r in own} == {4}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_approximate_search_finds_nine_of_ten(spark, sf):
    import __spark_entry__ as entry
    from tierloom.plans import analysis_queries as aq
    from tierloom.plans import testtables as tt

    sf_dir = f"/root/testdata/{sf}"
    exact, near = (
        {(r.query_id, r.vec_id) for r in entry.queries()[name](spark, sf_dir).collect()}
        for name in ("retrieve_topk", "retrieve_lsh")
    )
    assert len(exact) == 30 and len(exact & near) >= 0.9 * len(exact)
    probed = vectors.near_buckets(tt.centroids(spark, sf_dir), bits=aq.LSH_BITS, probes=aq.LSH_PROBES)
    seen = probed.groupBy("query_id").agg(F.count("*").alias("n"), F.countDistinct("bucket").alias("different")).collect()
    assert {(r.n, r.different) for r in seen} == {(aq.LSH_PROBES, aq.LSH_PROBES)} and aq.LSH_PROBES <= 0.7 * 2**aq.LSH_BITS + 1
    placed = vectors.with_buckets(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 64, bits=aq.LSH_BITS)
    compared = placed.join(probed.select("query_id", "bucket"), "bucket").count()
    print(sf, len(exact & near), len(exact), compared / placed.count() / len(seen))
    assert compared < 0.75 * placed.count() * len(seen)


def test_probes_go_by_distance_to_the_planes(spark):
    rng = np.random.default_rng(4)
    questions = [(i, rng.normal(size=8).tolist()) for i in range(5)]
    frame = spark.createDataFrame(questions, "query_id bigint, query_vector array<double>")
    got = {}
    for r in vectors.near_buckets(frame, bits=5, probes=9).collect():
        got.setdefault(r.query_id, set()).add(r.bucket)
    planes = np.random.default_rng(vectors.LSH_SEED).normal(size=(5, 8))
    for name, q in questions:
        sides = [float(np.dot(q, p) / np.linalg.norm(p)) for p in planes]
        cost = {b: sum(abs(s) for i, s in enumerate(sides) if (s > 0) != bool(b >> i & 1)) for b in range(32)}
        assert got[name] == set(sorted(cost, key=cost.get)[:9])


def test_crowded_buckets_are_cut(spark):
    data = [(i, [1.0, i / 1000]) for i in range(500)]
    stored = vectors.with_buckets(spark.createDataFrame(data, "vec_id bigint, embedding array<double>"), 2, bits=3)
    asked = spark.createDataFrame([("a", [1.0, 0.2]), ("b", [1.0, 0.4505])], "query_id string, query_vector array<double>")
    want = rows(vectors.retrieve(asked, stored, 5))
    assert rows(vectors.retrieve_lsh(asked, stored, radius=3, bits=3, top_k=5, rows_per_task=7)) == want


@pytest.mark.parametrize("bad", [[1.0, float("nan")], [1.0], [], None, [1.0, float("inf")], [None, 1.0]])
def test_vectors_that_cannot_be_compared_are_an_error(spark, bad):
    from pyspark.errors import PythonException

    good = [(1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [1.0, 1.0])]
    stored = spark.createDataFrame([*good, (4, bad)], "vec_id bigint, embedding array<double>")
    asked = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, query_vector array<double>")
    with pytest.raises(PythonException, match="vectors of a batch"):
        vectors.retrieve(asked, stored).collect()
    wrong = spark.createDataFrame([("q", [1.0, 0.0]), ("r", bad)], "query_id string, query_vector array<double>")
    with pytest.raises(ValueError, match="questions need"):
        vectors.retrieve(wrong, stored.where("vec_id < 4")).collect()


def test_off_domain_questions_and_empty_texts_find_nothing(spark):
    texts = spark.createDataFrame([(1, "the cat sat"), (2, ""), (3, None), (4, "!!")], "vec_id bigint, text string")
    stored = vectors.meaningful(vectors.embed(texts, "text"))
    assert [r.vec_id for r in stored.collect()] == [1]
    asked = vectors.embed(spark.createDataFrame([("q", "zzzz"), ("r", "cat")], "query_id string, t string"), "t",
                          vector_col="query_vector")
    hits = vectors.retrieve(asked, stored, max_distance=vectors.MAX_DISTANCE)
    assert rows(hits, "query_id", "vec_id") == [("r", 1)]


def test_prompts(spark):
    queries = spark.createDataFrame([("q1", "Why?"), ("q2", "Off topic?")], "query_id string, query_text string")
    hits = spark.createDataFrame(
        [("q1", 2, "b.txt", "second"), ("q1", 1, "a.txt", "first"), ("q1", 3, "a.txt", "third")],
        "query_id string, rank int, source string, text string")
    got = {r.query_id: r for r in text.grounded_prompts(queries, hits).collect()}
    assert got["q1"].prompt == (
        'Answer the question using ONLY the context below. If the context does not contain enough information to answer, '
        'say "I don\'t have enough information to answer this."\n\nContext:\n[a.txt]: first\n\n[b.txt]: second\n\n'
        "[a.txt]: third\n\nQuestion: Why?\n\nAnswer:")
    assert got["q1"].sources == ["a.txt", "b.txt", "a.txt"] and got["q1"].answer is None
    assert got["q2"].prompt is None and got["q2"].sources == [] and got["q2"].answer == text.NO_ANSWER


def brute_force(pool, id_col, question_vectors, max_distance=None):
    """All distances, per question the three nearest as (question, rank, id)."""
    out = []
    for query_id, asked in question_vectors.items():
        scored = sorted(
            (float(((np.array(r.embedding, dtype="float64") - np.array(asked, dtype="float64")) ** 2).sum()), r[id_col])
            for r in pool)
        out += [(query_id, i + 1, name) for i, (d, name) in enumerate(scored[:3])
                if max_distance is None or round(d, 4) <= max_distance]
    return sorted(out)


def question_vectors(spark, questions):
    frame = spark.createDataFrame(list(questions.items()), "query_id string, query_text string")
    return {r.query_id: r.embedding for r in vectors.meaningful(vectors.embed(frame, "query_text")).collect()}


def test_note_search(spark):
    """Every question finds the notes whose words it shares most, by brute force over all notes of the region."""
    from tierloom.plans.analysis_queries import NOTE_QUESTIONS, note_search, notes

    sf_dir = "/root/testdata/sf0.001"
    got = note_search(spark, sf_dir)
    pool = vectors.embed(notes(spark, sf_dir), "alert_note").where("region = 'asia'").collect()
    wanted = question_vectors(spark, NOTE_QUESTIONS)
    assert rows(got, "query_id", "rank", "note_id") == brute_force(pool, "note_id", wanted)


def test_chunk_search(spark):
    from tierloom.plans.analysis_queries import CHUNK_QUESTIONS, chunk_search

    sf_dir = "/root/testdata/sf0.001"
    got = chunk_search(spark, sf_dir)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    chunks = text.chunk_recursive(documents, "doc_id", "text")
    pool = vectors.embed(chunks, "chunk_text").collect()
    wanted = question_vectors(spark, CHUNK_QUESTIONS)
    want = brute_force(pool, "chunk_id", wanted, vectors.MAX_DISTANCE)
    assert rows(got, "query_id", "rank", "chunk_id") == want and want
    texts = {r.chunk_id: (r.chunk_label, r.chunk_text) for r in pool}
    assert all((r.chunk_label, r.chunk_text) == texts[r.chunk_id] for r in got.collect())


def test_chunk_search_fixed_reads_all_documents(spark):
    """The nearest fixed windows by brute force over every document, whatever its source."""
    from tierloom.plans.analysis_queries import CHUNK_QUESTIONS, chunk_search_fixed

    sf_dir = "/root/testdata/sf0.001"
    got = chunk_search_fixed(spark, sf_dir)
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    chunks = text.chunk_fixed(documents, "doc_id", "text", keep=["source"])
    pool = vectors.meaningful(vectors.embed(chunks, "chunk_text")).collect()  # without blank windows
    wanted = question_vectors(spark, CHUNK_QUESTIONS)
    want = brute_force(pool, "chunk_id", wanted, vectors.MAX_DISTANCE)
    assert rows(got, "query_id", "rank", "chunk_id") == want
    sources = {r.chunk_id: r.source for r in pool}
    assert any(sources[name] != "src3" for _, _, name in want)


def test_texts_are_split_once_and_in_bounded_pieces(spark):
    """One Python step in the plan (a column function stood there twice), and a few texts at a time in it."""
    docs = spark.createDataFrame([(i, f"Words {i}. " * (i % 90) or None, "s") for i in range(1300)], "d long, t string, s string").coalesce(1)
    got = text.chunk_recursive(docs, "d", "t", keep=["s"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") + plan.count("ArrowEvalPython") == 1
    want = [(f"{i}#{n}", i, "s", n, part) for i, t, _ in docs.collect() if t
            for n, part in enumerate(text.split_text(t, text.CHUNK_SIZE, text.CHUNK_OVERLAP, text.SEPARATORS))]
    assert rows(got, "chunk_id", "d", "s", "chunk_index", "chunk_text") == sorted(want, key=repr)
