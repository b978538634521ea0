"""Quality votes against plain counts, exact cosines and held-out labels."""

import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from tierloom.llm import quality, queries  # noqa: E402
from tierloom.llm.toxicity import fold_of  # noqa: E402


def test_words_and_trigrams_of_each_text_are_its_own():
    pick = random.Random(1)
    texts = [b"", b" ", b"a", b"\x02 x", "ÄÖ über 12 x!! x!! x!!".encode()]
    texts += [" ".join(pick.choice(["Aa", "bb", "c#c", "1 1", "\n"]) for _ in range(pick.randint(0, 80))).encode() for _ in range(40)]
    together = quality.term_counts(texts)
    assert (together == np.vstack([quality.term_counts([text]) for text in texts])).all()
    assert (together[:, : quality.TRIGRAMS].sum(1) == [len(text) + 1 for text in texts]).all()
    for text, own in zip(texts, together):
        words = text.split()
        distances, last = Counter(), {}
        for i, word in enumerate(words):
            distances[(i - last[word]).bit_length() if word in last else 0] += 1
            last[word] = i
        assert Counter({k: int(v) for k, v in enumerate(own[quality.TRIGRAMS :][: quality.DISTANCES]) if v}) == distances
        assert own[quality.TRIGRAMS + quality.DISTANCES :].sum() == len(words)


def test_shapes_tell_words_apart():
    shape = lambda word: tuple(quality.term_counts([word])[0, -quality.SHAPES :])
    assert shape(b"Hello") == shape(b"Wor") and shape(b"HELLO!!") == shape(b"OF!") and shape(b"ab") != shape(b"AB")
    assert len({shape(w) for w in (b"a", b"A", b"1", b"a!", b"a#", b"Aa", b"aA")}) == 7


def test_votes_are_those_of_the_nearest():
    pick = np.random.default_rng(3)
    counts = pick.poisson(0.3, (60, quality.TERMS))
    vectors = pick.standard_normal((40, 8)).astype(np.float32)
    voters = quality.Voters(np.ones(quality.TERMS, np.float32), pick.standard_normal((quality.TERMS, 8)).astype(np.float32),
                            quality.unit(vectors), pick.integers(0, 2, 40).astype(float), pick.uniform(1, 5, 40))
    got = voters.scores(counts, 7)
    for own, want in zip(voters.project(counts), got):
        cosines = sorted(((float(own @ v), i) for i, v in enumerate(voters.vectors)), reverse=True)[:7]
        votes = [(max(c, 0) ** quality.SHARPNESS * voters.stands_for[i], voters.labels[i]) for c, i in cosines]
        assert want == pytest.approx(sum(v for v, y in votes if y) / sum(v for v, _ in votes), abs=1e-5)


def test_odd_rows_and_few_labels(spark):
    texts = [None, "", " \n", "fine words here", "JUNK!! JUNK!!", "a " * 200_000, "fine words here"]
    rows = [*enumerate(texts), (3, "more fine words"), (None, "x")]
    extra = ("_key", "_text", "y", "term", "n", "score", "terms")
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *(F.lit(1).alias(n) for n in extra))
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")
    voters = quality.train(docs, labels([(3, 1), (3, 1), (4, 0), (5, 7), (6, None), (99, 1), (None, 1)]))
    assert sorted(voters.labels) == [0, 1, 1]
    got = quality.score(docs, voters)
    assert got.columns == ["doc_id", "score", "predicted"] and got.count() == len(rows)
    by = {r["doc_id"]: r for r in got.collect()}
    assert by[6]["predicted"] == 1 and by[4]["predicted"] == 0 and all(0 <= r["score"] <= 1 for r in by.values())
    for some, want in (([(3, 1)], 1.0), ([(4, 0)], 0.0), ([], 0.5)):
        got = quality.score(docs, quality.train(docs, labels(some)))
        assert {r["score"] for r in got.collect()} == {want}
    none = docs.where("doc_id > 1000")
    assert quality.score(none, quality.train(none, labels([(1, 1)]))).collect() == []


def test_the_sample_is_bounded_and_votes_stand_for_all(spark):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(100)], "doc_id long, text string")
    labels = docs.select("doc_id", F.when(F.col("doc_id") < 20, 0).otherwise(1).alias("quality"))
    voters = quality.train(docs, labels, most_docs=10)
    assert len(voters.labels) == 20 and sorted(set(voters.stands_for)) == [2.0, 8.0]


def test_held_out_accuracy(spark):
    got = queries.QUERIES["op11_quality_votes"](spark, "/root/testdata/sf0.1")
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in labels.where(fold_of(F.col("doc_id"), 4) == 2).collect()}
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    wrong = [r for r in rows if r["predicted"] != r["quality"]]
    good, bad = ([r["score"] for r in rows if r["quality"] == y] for y in (1, 0))
    auc = np.mean([(g > b) + (g == b) / 2 for g in good for b in bad])
    assert len(wrong) <= 0.005 * len(rows) and auc > 0.99
    assert got.count() == 10_000 and {r["predicted"] for r in got.where("score < 0.7").collect()} == {0}
