"""Vector codes against a plain version."""

import math
import random
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from brute import sha  # noqa: E402
from tierloom.llm import vector_codes  # noqa: E402

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Rows of the operator for (vec_id, embedding, label), one distance at a time."""
    kept = [(k, [math.floor(float(np.float32(x)) * scale) for x in v], l) for k, v, l in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    cut = [[v[len(v) * p // parts : len(v) * (p + 1) // parts] for p in range(parts)] for _, v, _ in kept]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][1]))
    books = [[cut[i][p] for i in order[:entries]] for p in range(parts)]

    def pick(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), i) for i, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            got = defaultdict(list)
            for own in cut:
                got[pick(own[p], books[p])[1]].append(own[p])
            books[p] = [[sum(c) // len(got[i]) for c in zip(*got[i])] if got[i] else entry for i, entry in enumerate(books[p])]
    found = [[pick(own[p], books[p]) for p in range(parts)] for own in cut]
    by = defaultdict(int)
    for (_, _, label), own in zip(kept, found):
        by[label] += sum(d for d, _ in own)
    text = sha(",".join(str(c) for book in books for entry in book for c in entry))
    return [(k, "".join(f"{i:02x}" for _, i in own), sum(d for d, _ in own), by[label], text)
            for (k, _, label), own in zip(kept, found)]


def odd_vectors():
    pick = random.Random(5)
    rows = [(i, [pick.choice([0.0, 0.25, -0.25, pick.uniform(-2, 2)]) for _ in range(16)], pick.choice([None, 1, 2])) for i in range(90)]
    rows += [(i, rows[i][1], 3) for i in range(0, 60, 3)]  # keys and vectors that repeat
    rows += [(None, rows[0][1], None), (None, [0.0] * 16, 1), (900, None, 1), (901, [None] + [1.0] * 15, 1), (-5, [0.0] * 16, 2),
             (902, [math.nan] + [1.0] * 15, 2), (903, [math.inf] + [1.0] * 15, 2), (904, [-math.inf] + [1.0] * 15, 2)]
    return rows + [(905 + i, [1.0] * 16, 4) for i in range(100)]


def test_codes_match_the_plain_version(spark):
    rows = odd_vectors()
    names = ("code", "error", "_key", "_vector", "slot", "total", "n", "_of")
    frame = spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit(1).alias(n) for n in names))
    for part in (rows, rows[:7]):  # also with fewer rows than entries
        got = vector_codes.vector_codes(frame if part is rows else spark.createDataFrame(part, SCHEMA))
        assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(plain(part), key=repr)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_codes_of_no_rows(spark):
    for rows in ([], [(1, None, 1), (2, [math.nan] * 8, None)]):
        assert vector_codes.vector_codes(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_codes_refuse_what_they_cannot_compare(spark):
    for rows in ([(1, [1.0] * 8, 1), (2, [1.0] * 16, 1)], [(1, [1.0] * 9, 1)], [(1, [1e30] * 8, 1)]):
        with pytest.raises(Exception, match="multiple of 8|too large"):
            vector_codes.vector_codes(spark.createDataFrame(rows, SCHEMA)).collect()


def test_equal_average_search_compares_few_and_ties_go_down():
    pick = np.random.default_rng(1)
    for width in (1, 3, 8):
        book, parts = pick.integers(-9, 9, (16, width)), pick.integers(-12, 12, (500, width))
        book[9], book[3] = book[2], book[2]
        distances = ((parts[:, None] - book[None]) ** 2).sum(2)
        index, best = vector_codes.nearest(parts, book)
        assert (index == distances.argmin(1)).all() and (best == distances.min(1)).all()
