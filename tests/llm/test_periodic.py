"""Periodic runs against a plain version."""

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from brute import sha  # noqa: E402
from tierloom.llm import periodic, queries  # noqa: E402


def plain_runs(words):
    """All runs (start, length, period): every start and period, extended word by word."""
    n, found = len(words), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.add((i, j - i + q, q))
            i = j
    smallest = {}
    for start, length, q in sorted(found, key=lambda run: run[2]):
        smallest.setdefault((start, length), q)
    return sorted(((a, b, q) for (a, b), q in smallest.items()), key=lambda run: (run[0], run[2]))


def plain_row(words):
    runs = plain_runs(words)
    best = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=(None,) * 3)
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return (len(runs), *best, best[1] * 1000 // best[2] if runs else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def planted(doc_id, words):
    h, n = zlib.crc32(("" if doc_id is None else str(doc_id)).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def texts_with_runs():
    pick = random.Random(8)
    texts = []
    for _ in range(150):
        words = []
        while len(words) < pick.randint(5, 120):
            unit = [pick.choice("abcdefgh") for _ in range(pick.randint(1, 7))]
            words += (unit * pick.randint(1, 7))[: pick.randint(1, 40)]
        texts.append(" ".join(words))
    texts += ["a a a a a", "a a a a a a", "a a a a a a a", "a b a b a b a", "a b a b a b a b", "x a b a b a b a b y", "a a a a b a a a a b a a a a b a a a a b"]
    return texts


def test_runs_of_small_texts():
    texts = texts_with_runs()
    for got, text in zip(periodic.find_runs([t.encode() for t in texts]), texts):
        words = text.encode().split()
        assert got[:6] + (sha(got[6]),) == plain_row(words), text


def test_one_cut_at_a_time_equals_bulk_rounds():
    pick = random.Random(4)
    for n in (50, 400, 3000):
        words = np.array([pick.randrange(n // 12) for _ in range(n)], np.int32)
        zeros = np.zeros(n, np.int64)
        assert sorted(periodic.split_by_frequency(words, zeros, rounds=0)) == sorted(periodic.split_by_frequency(words, zeros, rounds=500))
    chain = np.repeat(np.arange(4000), 4)  # 0 0 0 0 1 1 1 1 ..., shifted by one, so that each cut makes the next word rare
    chain = np.concatenate([chain[1:], [9999] * 3]).astype(np.int32)
    order = np.argsort([i * 4 % 15999 + i // 4000 for i in range(len(chain))], kind="stable")
    for words in (chain, chain[order]):
        zeros = np.zeros(len(words), np.int64)
        assert sorted(periodic.split_by_frequency(words, zeros)) == sorted(periodic.split_by_frequency(words, zeros, rounds=10**6))


def test_long_texts_are_scanned_in_little_time():
    pick = random.Random(2)
    words = [pick.randrange(400) for _ in range(200_000)]
    words[50_000:150_000] = (words[50_000:51_000] * 100)[:100_000]
    words += [7] * 100_000
    got = periodic.runs_in(np.array(words, np.int32))
    wide = [run for run in got if run[1] > 100]
    assert [(run[2], run[1] >= size) for run, size in zip(sorted(wide), (100_000, 100_000))] == [(1000, True), (1, True)]


def test_operator(spark):
    texts = [None, "", " \n ", "a " * 30_000, *texts_with_runs()[-40:]]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, "a b " * 9), (1, "a b " * 9), (None, "z " * 6)]
    extra = ("_key", "_text", "n_runs", "start", "runs", "collapsed")
    frame = spark.createDataFrame(rows, "doc_id long, text string").select("*", *(F.lit(1).alias(n) for n in extra))
    outputs = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = periodic.periodic_runs(frame.repartition(3), outputs=outputs)
    assert got.columns == ["doc_id", *outputs]
    want = [(k, *plain_row((t or "").encode().split() if len(t or "") < 9999 else [b"a"] * 30)) for k, t in rows]
    got = [tuple(r) for r in got.collect()]
    long = [r for r in got if r[3] == 30_000]
    assert long == [(3, 1, 0, 30_000, 1, 30_000_000, sha("0,30000,1\n"), sha("a"))]
    assert sorted((r for r in got if r not in long), key=repr) == sorted((r for r in want if r[0] != 3), key=repr)
    collapsed = periodic.periodic_runs(frame, outputs=("collapsed", "runs")).where("doc_id = 1 and runs <> ''").first()
    assert (bytes(collapsed["collapsed"]), collapsed["runs"]) == (b"a b", "0,18,2\n")
    assert periodic.periodic_runs(frame.where("doc_id > 10000")).collect() == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(frame, repeats=1)


def test_query_plants_and_finds(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    got = queries.QUERIES["op12_periodic_runs"](spark, "/root/testdata/sf0.001")
    want = [(k, *plain_row(planted(k, (t or "").encode().split()))) for k, t in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
