"""The string kernel and its machine against plain versions, and which spans are learned."""

import math
import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierloom.llm import toxicity

SPANS = ["idiot", "i.d.i.o.t", "idxiot", "a", "", "moron", "aaaa", "ideal", "you idiot", "ßüé"]


def plain_features(span):
    """Every choice of four places of the marked span whose neighbours have at most two characters between them."""
    marked, found = f"\x02{span}\x03", {}
    for places in combinations(range(len(marked)), toxicity.ORDER):
        between = [b - a - 1 for a, b in zip(places, places[1:])]
        if max(between) <= toxicity.GAP:
            key = "".join(marked[i] for i in places)
            found[key] = found.get(key, 0.0) + toxicity.DECAY ** sum(between)
    return found


def plain_kernel(left, right):
    a, b = plain_features(left), plain_features(right)
    return sum(weight * b.get(key, 0.0) for key, weight in a.items())


def test_kernel_is_the_sum_over_common_subsequences():
    features = [toxicity.subsequences(span) for span in SPANS]
    got = toxicity.kernel(features, features)
    want = [[plain_kernel(a, b) for b in SPANS] for a in SPANS]
    assert got == pytest.approx(np.array(want))


def test_nystroem_features_give_the_kernel_back_among_landmarks():
    chosen = [toxicity.subsequences(span) for span in SPANS if span]
    gram = toxicity.kernel(chosen, chosen)
    values, vectors = np.linalg.eigh(gram / gram.diagonal().mean())
    solid = values > 1e-6 * values.max()
    whiten = vectors[:, solid] / np.sqrt(values[solid]) / gram.diagonal().mean()
    mapped = gram @ whiten
    assert mapped @ mapped.T == pytest.approx(gram / gram.diagonal().mean(), abs=1e-6)


def test_scores_are_the_weighted_sums_of_the_machine():
    clean = ["loose", "moon", "ideal", "clover", "house", "garden", "idiom", "weather"] * 3
    machine = toxicity.fit(["idiot", "moron", "clown"], clean, cost=100)
    plain = [sum(machine.weights.get(k, 0.0) * v for k, v in plain_features(span).items()) + machine.bias for span in SPANS]
    scorer = machine.scorer()
    assert scorer.spans(SPANS) == pytest.approx(plain, abs=1e-3)
    by_word = {word: max(scorer.spans([toxicity.span_of(word)])) for word in ("an", "idiot!", "house")}
    assert scorer.texts(["An idiot! House", "", "house"]) == pytest.approx([max(by_word.values()), machine.bias, by_word["house"]], abs=1e-4)


def test_surprise_is_a_chernoff_bound(spark):
    cases = [(0, 0), (3, 0), (60, 0), (60, 2), (5, 50), (0, 9), (50, 50)]
    frame = spark.createDataFrame(cases, "t long, c long").select("t", "c", toxicity.surprise(F.col("t"), F.col("c"), 0.3).alias("s"))
    for r in frame.collect():
        n = r.t + r.c
        if r.t <= 0.3 * n:
            assert r.s == 0
            continue
        tail = sum(math.comb(n, k) * 0.3**k * 0.7 ** (n - k) for k in range(r.t, n + 1))
        assert tail <= math.exp(-r.s) * (1 + 1e-9)


def test_a_rare_insult_is_learned_from_any_sample(spark):
    """One word in 60 toxic documents, among 400 labelled toxic ones and among 4,000."""
    pick = random.Random(5)
    words = ["".join(pick.choice("abdehilnorstu") for _ in range(pick.randint(3, 8))) for _ in range(1500)]
    for size in (400, 4_000):
        rows = []
        for i in range(2 * size):
            text = pick.choices(words, k=12)
            if i < size:
                text[pick.randrange(12)] = "grumzwock" if i < 60 else pick.choice(["idiot", "moron", "scumbag"])
            rows.append((i, " ".join(text), int(i < size)))
        docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(8)
        machine = toxicity.train(docs, docs.select("doc_id", "toxic"))
        found = toxicity.score(docs, machine)
        assert found.where("doc_id < 60 and predicted = 1").count() >= 58
        assert found.where(f"doc_id >= {size} and predicted = 1").count() <= 0.02 * size


def test_long_words_are_cut_as_in_scoring():
    long = "x" * 50 + "idiot" + "y" * 30
    assert toxicity.windows_of("idiot") == ["idiot"] and toxicity.windows_of("") == [""]
    cut = toxicity.windows_of(long)
    assert all(len(span) <= toxicity.LONGEST for span in cut) and any("idiot" in span for span in cut) and cut[-1].endswith("y")
