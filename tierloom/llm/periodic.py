"""Periodic runs of words: stretches that repeat themselves with a period, found by recursive frequency splitting.

A run of period ``q`` is a maximal stretch of consecutive words in which words ``q`` apart are identical, ``q`` being its smallest
period, of at least :data:`REPEATS` periods and :data:`SHORTEST` words.

**Frequency splitting.** Every word of a run occurs in it once per period, so at least ``REPEATS`` times. A word that occurs less
often than that within a segment is in no run that lies inside it, and cuts the segment there. Counts fall in the pieces, so
they are counted again until nothing changes; most texts are gone after a few rounds. All segments of a batch are counted
in one sort a round. A segment that still changes after :data:`BULK_ROUNDS` is finished on its own: of the two sides of a cut
only the shorter one is counted and taken off the other, so that even a text that loses one word at a time costs ``n log n``.

**Lag scan.** In what is left, a run of period ``q`` covers at least ``REPEATS`` consecutive multiples of ``q``, and these words
are equal. So lag ``q`` looks at the multiples of ``q`` only, which for all lags together is ``n log n`` words, and a place where
they agree is extended to both sides. Places inside a run whose period divides ``q`` would find that run again and are skipped.

Each text is processed whole and by itself; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.llm.common import numbering, whole_text, words_of

REPEATS, SHORTEST = 4, 6
BULK_ROUNDS = 24
#: Texts are split into words together until they hold this many bytes; a longer one goes alone.
BATCH_BYTES = 2 << 20


def _pieces(kept: np.ndarray, segment: np.ndarray, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Consecutive positions of one segment as new segments: those of ``kept`` in pieces long enough, and each one's piece."""
    if not len(kept):
        return kept, segment
    first = np.concatenate([[True], (np.diff(kept) != 1) | (np.diff(segment) != 0)])
    piece = np.cumsum(first) - 1
    long = np.bincount(piece)[piece] >= shortest
    return kept[long], piece[long]


def split_by_frequency(words: np.ndarray, texts: np.ndarray, least: int = REPEATS, shortest: int = SHORTEST,
                       rounds: int = BULK_ROUNDS) -> list[tuple[int, int]]:
    """Segments ``[begin, end)`` of ``words`` (numbers; ``texts`` tells which text each is from) that may hold runs.

    In each of them every word occurs at least ``least`` times and it has ``shortest`` words.
    """
    at, segment = _pieces(np.arange(len(words)), texts, shortest)
    done: list[tuple[int, int]] = []
    for _ in range(rounds):
        if not len(at):
            return done
        pair = segment.astype(np.int64) * (int(words.max()) + 1) + words[at]
        _, inverse, counts = np.unique(pair, return_inverse=True, return_counts=True)
        rare = counts[inverse] < least
        changed = np.zeros(int(segment[-1]) + 1, bool)
        changed[segment[rare]] = True
        stable = ~changed[segment]
        done += _bounds(at[stable], segment[stable])
        going = ~stable & ~rare
        at, segment = _pieces(at[going], segment[going], shortest)
    for begin, end in _bounds(at, segment):
        done += _split_on(words, begin, end, least, shortest)
    return done


def _bounds(at: np.ndarray, segment: np.ndarray) -> list[tuple[int, int]]:
    if not len(at):
        return []
    first = np.flatnonzero(np.concatenate([[True], np.diff(segment) != 0]))
    last = np.concatenate([first[1:], [len(at)]]) - 1
    return list(zip(at[first].tolist(), (at[last] + 1).tolist()))


def _split_on(words: np.ndarray, begin: int, end: int, least: int, shortest: int) -> list[tuple[int, int]]:
    """The same for one segment: cut at one rare word after the other; only the shorter side of a cut is counted."""
    own, out = words[begin:end].tolist(), []
    places = defaultdict(list)
    for i, word in enumerate(own):
        places[word].append(i)
    open_segments = [(0, len(own), Counter(own), list(places))]  # bounds, counts, and words that may be rare there
    while open_segments:
        low, high, counts, suspects = open_segments.pop()
        if high - low < shortest:
            continue
        while suspects and not 0 < counts[suspects[-1]] < least:
            suspects.pop()
        if not suspects:
            out.append((begin + low, begin + high))
            continue
        word = suspects[-1]
        at = places[word][bisect_left(places[word], low)]
        short, long = sorted(((low, at), (at + 1, high)), key=lambda side: side[1] - side[0])
        taken = Counter(own[short[0] : short[1]])
        counts[word] -= 1
        counts.subtract(taken)
        suspects += taken
        open_segments += [(*long, counts, suspects), (*short, taken, list(taken))]
    return out


def _same(words: np.ndarray, i: int, j: int, step: int, room: int) -> int:
    """How many words agree from ``i`` and ``j`` on in direction ``step``; looks at a stretch that doubles."""
    size, found = 16, 0
    while found < room:
        size = min(size, room - found)
        if step > 0:
            differ = words[i + found : i + found + size] != words[j + found : j + found + size]
        else:
            differ = (words[i - found - size + 1 : i - found + 1] != words[j - found - size + 1 : j - found + 1])[::-1]
        first = int(differ.argmax())
        if differ[first]:
            return found + first
        found += size
        size *= 2
    return found


def runs_in(words: np.ndarray, repeats: int = REPEATS, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """All runs ``(start, length, period)`` of a sequence, by lag scan."""
    n, found, by_period, seen = len(words), [], {}, set()
    for q in range(1, n // repeats + 1):
        at_multiples = words[::q]
        pairs = at_multiples[1:] == at_multiples[:-1]
        agree = pairs[: len(pairs) - repeats + 2].copy()
        for i in range(1, repeats - 1):
            agree &= pairs[i : i + len(agree)]
        places = np.flatnonzero(agree) * q
        if not len(places):
            continue
        inside = np.zeros(len(places), bool)
        for period, own in by_period.items():
            if q % period == 0:
                for start, length in own:
                    inside |= (places >= start) & (places + (repeats - 1) * q < start + length)
        covered = -1
        for place in places[~inside].tolist():
            if place < covered:
                continue
            right = _same(words, place, place + q, 1, n - place - q)
            left = _same(words, place - 1, place - 1 + q, -1, place)
            start, length = place - left, left + right + q
            covered = place + right  # lag q agrees up to here, so places before it find the same stretch
            if length >= max(shortest, repeats * q) and (start, length) not in seen:  # seen with a smaller period
                seen.add((start, length))
                found.append((start, length, q))
                by_period.setdefault(q, []).append((start, length))
    return found


def _described(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """Output columns of one text from its runs."""
    runs.sort(key=lambda run: (run[0], run[2]))
    start, length, period = min(runs, key=lambda run: (-run[1], run[0], run[2]), default=(None, None, None))
    if runs:
        gone = np.zeros(len(words) + 1, np.int64)
        for begin, size, q in runs:
            gone[begin + q] += 1
            gone[begin + size] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
    else:
        kept = words
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (len(runs), start, length, period, 1000 * length // period if runs else None,
            hashlib.sha256(listed.encode()).hexdigest(), b" ".join(kept), listed)


def find_runs(texts: list[bytes], repeats: int = REPEATS, shortest: int = SHORTEST) -> list[tuple]:
    """``n_runs, start, length, period, exponent_milli, runs_sha256, collapsed, runs`` of each text."""
    split = [words_of(text) for text in texts]
    ids = numbering()
    numbers = np.fromiter((ids[word] for own in split for word in own), np.int32)
    lengths = [len(own) for own in split]
    begins = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    found: dict[int, list] = defaultdict(list)
    for begin, end in split_by_frequency(numbers, np.repeat(np.arange(len(split)), lengths), repeats, shortest):
        if runs := runs_in(numbers[begin:end], repeats, shortest):
            text = int(np.searchsorted(begins, begin, "right")) - 1
            found[text] += [(int(begin - begins[text]) + start, length, period) for start, length, period in runs]
    return [_described(own, found.get(i, [])) for i, own in enumerate(split)]


COLUMNS = {"n_runs": T.LongType(), "start": T.LongType(), "length": T.LongType(), "period": T.LongType(), "exponent_milli": T.LongType(),
           "runs_sha256": T.StringType(), "collapsed_sha256": T.StringType(), "runs": T.StringType(), "collapsed": T.BinaryType()}


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", repeats: int = REPEATS, shortest: int = SHORTEST,
                  outputs: tuple[str, ...] = tuple(COLUMNS)) -> DataFrame:
    """``key`` and ``outputs`` for every row.

    ``n_runs``; ``start, length, period, exponent_milli`` of the longest run (ties: smaller start, then period), null without one; ``runs``,
    a line ``start,length,period`` for each run by start, then period, and its hash; ``collapsed``, the words joined by one space
    without those that a run holds after its first period, and its hash.

    A null, empty or blank text has no words and no runs. Texts of any length are processed whole, in memory of about ten times
    their size. Repeated rows and null keys are kept, each row by itself; an empty table gives no rows. Other columns are
    ignored, whatever their names.
    """
    if repeats < 2 or shortest < repeats:
        raise ValueError("runs need at least two repeats, and as many words")
    picked = docs.select(F.col(key).alias("_key"), whole_text(F.col(text)).alias("_text"))
    schema = T.StructType([picked.schema["_key"], *(T.StructField(name, COLUMNS[name]) for name in outputs)])
    types = {name: {"LongType": pa.int64(), "StringType": pa.string(), "BinaryType": pa.binary()}[type(COLUMNS[name]).__name__]
             for name in outputs}

    def run(batches):
        for batch in batches:
            sizes = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))])
            begin = 0
            while begin < len(batch):
                end = max(begin + 1, int(np.searchsorted(sizes, sizes[begin] + BATCH_BYTES, "right")) - 1)
                rows = find_runs(batch.column(1)[begin:end].to_pylist(), repeats, shortest)
                columns = {"n_runs": 0, "start": 1, "length": 2, "period": 3, "exponent_milli": 4, "runs_sha256": 5, "collapsed": 6, "runs": 7}
                made = [
                    pa.array([hashlib.sha256(row[6]).hexdigest() if name == "collapsed_sha256" else row[columns[name]] for row in rows], types[name])
                    for name in outputs
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0)[begin:end], *made], names=["_key", *outputs])
                begin = end

    return picked.mapInArrow(run, schema).withColumnRenamed("_key", key)
