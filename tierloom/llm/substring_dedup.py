"""Repeated passages: every word that a window of words covers which starts anywhere else, too.

Which windows are repeated is found with compressed full-text indexes, one per shard. Windows are dealt to shards by content:
a window's anchor is the smallest hash among its short word runs, so equal windows have equal anchors, wherever they stand, and
neighbouring windows mostly share one. A run of windows with one anchor is a segment. Segments whose anchor stands nowhere else are
left out early, equal segments are kept once, and the others go to the shard of their anchor with their words. There the
words get integer names, an index is built over the segments, and backward search gives the stretches that occur twice.

An anchor with very many different segments, such as the edge of a passage that is in every other document, gets no index. Its
segments are cut into single windows, whose digests Spark counts, so that no task holds all texts with that passage.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import SPACES, fresh_name, shuffle_partitions, staged, whole_text, with_unique_key, words_of
from tierloom.llm.fm_index import FMIndex, repeated_stretches
from tierloom.operators.batches import cuts

WINDOW, ANCHOR = 35, 12
#: Segments of an anchor before it is dealt window by window, words of one index.
CROWDED, SHARD_WORDS = 1_000, 200_000
#: A worker's remembered words, and its remembered segments, are dropped beyond this count; the results stay the same.
MOST_WORDS = 100_000
#: Texts and bytes of text that a worker splits into words at a time.
MOST_TEXTS, MOST_BYTES = 400, 1 << 20

_EMPTY = hashlib.sha256(b"").hexdigest()


class WordHashes(dict):
    def __missing__(self, word):
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left * np.uint64(0x9E3779B97F4A7C15) ^ right
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, by doubling."""
    out, have, power, width = None, 0, words, 1
    while True:
        if size & width:
            n = len(words) - have - width + 1
            out = power[:n] if out is None else _joined(out[:n], power[have : have + n])
            have += width
        if have == size:
            return out
        power, width = _joined(power[:-width], power[width:]), 2 * width


def smallest(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of each ``size`` values in a row, by doubling."""
    width = 1
    while 2 * width <= size:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    rest = size - width
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments(hashes: np.ndarray, bounds: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor, over documents laid end to end: ``document, start, windows, anchor, again``.

    ``bounds`` has the documents' first places and the end of the last. Runs are cut after as many windows as can hold the same
    word run; ``again`` says that the anchor stands more than once in a segment, so that windows may be repeated within it.
    """
    none = np.zeros(0, np.int64)
    if len(hashes) < window:
        return none, none, none, none.astype(np.uint64), none.astype(bool)
    grams, most = run_hashes(hashes, anchor), window - anchor + 1
    anchors = smallest(grams, most)
    document = np.searchsorted(bounds, np.arange(len(anchors)), "right") - 1
    inside = np.arange(len(anchors)) + window <= bounds[document + 1]
    anchors, document, place = anchors[inside], document[inside], np.flatnonzero(inside)
    if not len(place):
        return none, none, none, none.astype(np.uint64), none.astype(bool)
    new = np.ones(len(place), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (document[1:] != document[:-1])
    begin = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    new |= (np.arange(len(place)) - begin[run]) % most == 0
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(place)))
    steps = np.arange(2 * most - 1)
    around = grams[np.minimum(place[begin][:, None] + steps, len(grams) - 1)] == anchors[begin][:, None]
    again = (around & (steps < (count + most - 1)[:, None])).sum(1) > 1
    return document[begin], place[begin] - bounds[document[begin]], count, anchors[begin], again


def _pieces(batch: pa.RecordBatch, text: int) -> Iterator[pa.RecordBatch]:
    """A batch in pieces with a bounded number of bytes in column ``text``, or a single row."""
    sizes = pc.binary_length(batch.column(text)).to_numpy(zero_copy_only=False)
    for begin, end in cuts(sizes, MOST_TEXTS, MOST_BYTES):
        yield batch.slice(begin, end - begin)


def _hashed(texts: list[list[bytes]], known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    if len(known) > MOST_WORDS:
        known.clear()
    bounds = np.concatenate([[0], np.cumsum([len(words) for words in texts])])
    flat = np.fromiter((known[word] for words in texts for word in words), np.uint64, int(bounds[-1]))
    return flat, bounds


def word_digest(text):
    """Digest of the words joined by one space, without Python."""
    return F.unhex(F.sha2(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACES}]+", " ")), 256))


def _anchored(docs: DataFrame, key: str, text: str, window: int, anchor: int) -> DataFrame:
    """``row, key, n_words, digest, anchors`` for each row; ``digest`` stands for the words, ``anchors`` are those of its windows."""
    picked = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
                         whole_text(F.col(text)).alias("text"))
    kind = picked.schema["key"].dataType.simpleString()

    def run(batches):
        known = WordHashes()
        for batch in batches:
            for part in _pieces(batch, 2):
                texts = [words_of(text) for text in part.column(2).to_pylist()]
                flat, bounds = _hashed(texts, known)
                document, _, _, anchors, again = segments(flat, bounds, window, anchor)
                document, anchors = (np.repeat(x, 1 + again) for x in (document, anchors))
                offsets = np.searchsorted(document, np.arange(len(texts) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(np.diff(bounds)),
                        pa.array([hashlib.sha256(b" ".join(words)).digest() for words in texts], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(anchors.view(np.int64))),
                    ],
                    names=["row", "key", "n_words", "digest", "anchors"],
                )

    return picked.mapInArrow(run, f"row long, key {kind}, n_words long, digest binary, anchors array<long>")


def _cut(texts: DataFrame, window: int, anchor: int, with_words: bool) -> DataFrame:
    """Segments of each text whose anchors are in its ``found``: ``row, start, windows, anchor, segment``, or, with words, each
    segment once for a task: ``anchor, segment, words``."""

    def run(batches):
        known, seen = WordHashes(), set()
        for batch in batches:
            for part in _pieces(batch, 1):
                rows, found = part.column(0).to_pylist(), part.column(2).to_pylist()
                texts = [words_of(text) for text in part.column(1).to_pylist()]
                flat, bounds = _hashed(texts, known)
                document, start, count, anchors, _ = segments(flat, bounds, window, anchor)
                anchors = anchors.view(np.int64)
                wanted = [np.isin(anchors[a:b], own) for own, a, b in zip(found, *_ranges(document, len(texts)))]
                keep = np.flatnonzero(np.concatenate(wanted)) if wanted else []
                out = []
                for i in keep:
                    words = texts[document[i]][start[i] : start[i] + count[i] + window - 1]
                    joined = b" ".join(words)
                    segment = hashlib.md5(joined).digest()
                    if not with_words:
                        out.append((rows[document[i]], int(start[i]), int(count[i]), int(anchors[i]), segment))
                    elif segment not in seen:
                        if len(seen) > MOST_WORDS:
                            seen.clear()
                        seen.add(segment)
                        out.append((int(anchors[i]), segment, joined))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    if with_words:
        names, types = ["anchor", "segment", "words"], [pa.int64(), pa.binary(), pa.binary()]
        return texts.mapInArrow(run, "anchor long, segment binary, words binary")
    names, types = ["row", "start", "windows", "anchor", "segment"], [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
    return texts.mapInArrow(run, "row long, start int, windows int, anchor long, segment binary")


def _ranges(owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    edges = np.searchsorted(owner, np.arange(n + 1))
    return edges[:-1], edges[1:]


def _by_window(crowded: DataFrame, window: int) -> DataFrame:
    """Windows of segments cut one by one, each segment once: ``segment, begin, end, window``, the last a digest."""
    segments = crowded.groupBy("segment").agg(F.first("words").cast("string").alias("words"))
    words = segments.select("segment", F.split("words", " ").alias("words"))
    begin = F.explode(F.sequence(F.lit(0), F.size("words") - window)).alias("begin")
    own = F.unhex(F.md5(F.array_join(F.slice("words", F.col("begin") + 1, F.lit(window)), " ")))
    return words.select("segment", begin, "words").select("segment", "begin", (F.col("begin") + window).alias("end"), own.alias("window"))


def _repeated(windows: DataFrame) -> DataFrame:
    """``segment, begin, end`` of the windows that occur twice."""
    several = windows.groupBy("window").agg(F.count("*").alias("n")).where("n > 1").select("window")
    return windows.join(several, "window", "left_semi").select("segment", "begin", "end")


def _searched(shards: DataFrame, window: int) -> DataFrame:
    """``segment, begin, end`` of repeated stretches, from shards sorted by anchor and segment."""

    def search(strings: list[tuple[bytes, bytes]]):
        words = [joined.split(b" ") for _, joined in strings]
        lengths = np.array([len(own) for own in words])
        names = {word: i for i, word in enumerate(sorted({w for own in words for w in own}), 1)}
        begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        text = np.zeros(int((lengths + 1).sum()), np.int64)
        for begin, own in zip(begins, words):
            text[begin : begin + len(own)] = [names[word] for word in own]
        index = FMIndex(text, len(names) + 1)
        owner, begin, end = repeated_stretches(index, text, begins, lengths, window)
        segment = [strings[i][0] for i in owner]
        return pa.RecordBatch.from_arrays(
            [pa.array(segment, pa.binary()), pa.array(begin, pa.int32()), pa.array(end, pa.int32())],
            names=["segment", "begin", "end"],
        )

    def run(batches):
        strings, words, before, last = [], 0, None, None
        for batch in batches:
            for anchor, segment, joined in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if segment == last:
                    continue  # the same segment from another task
                if anchor != before and words > SHARD_WORDS:
                    yield search(strings)
                    strings, words = [], 0
                before, last = anchor, segment
                strings.append((segment, joined))
                words += joined.count(b" ") + 2
        if strings:  # one segment can repeat a window within itself
            yield search(strings)

    return shards.mapInArrow(run, "segment binary, begin int, end int")


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW,
                      anchor: int = ANCHOR) -> DataFrame:
    """``row, key, n_words, n_removed, kept_sha256, kept_text`` for every row of ``docs``.

    A word goes if it lies in a window of ``window`` words whose sequence also starts at another place, in the same document or
    in another; all windows are judged on the input. ``kept_text`` has the words that stay, joined by one space, and is null where
    nothing goes or nothing stays. ``row`` numbers the rows, so repeated rows and null keys are rows of their own (and repeat
    each other). Null texts have no words. Further columns are not read.
    """
    spark = docs.sparkSession
    rows = staged(_anchored(docs, key, text, window, anchor), "anchored")
    kept = F.min(F.struct("row", "key"))
    texts = rows.groupBy("digest").agg(F.count("*").alias("copies"), kept.alias("first"), F.max("n_words").alias("n_words"))
    texts = texts.select("digest", "copies", F.col("first.row").alias("row"), F.col("first.key").alias("key"), "n_words")
    texts = staged(texts.where(F.col("n_words") >= window), "texts")

    # Anchors of different texts; those that stand in one place only can't belong to a repeated window.
    places = rows.join(texts.select("row"), "row").select("row", F.explode("anchors").alias("anchor"))
    common = places.groupBy("anchor").count().where("count > 1").select("anchor")
    found = places.distinct().join(common, "anchor").groupBy("row").agg(F.collect_list("anchor").alias("found"))
    wanted = found.join(texts.select("row", "digest", "key"), "row")
    whole = docs.select(F.col(key).alias("_key"), word_digest(F.col(text)).alias("_digest"), whole_text(F.col(text)).alias("text"))
    wanted = wanted.join(whole, (F.col("digest") == F.col("_digest")) & F.col("key").eqNullSafe(F.col("_key")))
    wanted = staged(wanted.select("row", "text", "found"), "candidate-texts")

    members = staged(_cut(wanted, window, anchor, False).distinct(), "segments")
    copies = members.groupBy("segment").agg(F.count("*").alias("n"), F.max("anchor").alias("anchor"))
    crowds = copies.groupBy("anchor").count().where(F.col("count") > CROWDED).select("anchor")
    crowds = staged(crowds, "crowded-anchors")
    once = _cut(wanted, window, anchor, True)
    shards = once.join(crowds, "anchor", "left_anti").select("anchor", "segment", "words")
    shards = shards.repartition(shuffle_partitions(spark), "anchor").sortWithinPartitions("anchor", "segment")
    stretches = staged(_searched(shards, window), "stretches")
    if not crowds.isEmpty():
        windows = staged(_by_window(once.join(crowds, "anchor", "left_semi"), window), "windows")
        stretches = stretches.union(staged(_repeated(windows), "repeated-windows"))

    several = members.join(copies.where("n > 1").select("segment"), "segment", "left_semi")
    spans = several.select("row", F.col("start").alias("a"), (F.col("start") + F.col("windows") + window - 1).alias("b"))
    spans = spans.union(members.join(stretches, "segment").select("row", F.expr("start + begin"), F.expr("start + end")))
    spans = spans.groupBy("row").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    cleaned = _without(wanted.join(spans, "row")).dropDuplicates(["row"])  # rows repeated with their key

    of_text = texts.select("digest", "copies", F.col("row").alias("first")).join(
        cleaned.withColumnRenamed("row", "first"), "first", "left")
    out = rows.drop("anchors").join(of_text, "digest", "left")
    copied = F.col("copies") > 1
    empty = F.lit(_EMPTY)
    return out.select(
        "row", "key", "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, empty).otherwise(F.coalesce("kept_sha256", F.lower(F.hex("digest")))).alias("kept_sha256"),
        F.when(~copied, F.col("kept_text")).alias("kept_text"),
    )


def _without(texts: DataFrame) -> DataFrame:
    """``row, n_removed, kept_sha256, kept_text`` from ``row, text, ..., spans`` of words to leave out."""

    def run(batches):
        for part in (part for batch in batches for part in _pieces(batch, 1)):
            out, bounds = [], np.append(0, np.cumsum(pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False)))
            a, b = (x.to_numpy(zero_copy_only=False) for x in part.column(2).flatten().flatten())
            for i, (row, text) in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist())):
                words, own = words_of(text), slice(bounds[i], bounds[i + 1])
                edges = np.zeros(len(words) + 1, np.int64)
                np.add.at(edges, a[own], 1)
                np.add.at(edges, b[own], -1)
                gone = np.cumsum(edges)[:-1] > 0
                left = b" ".join(word for word, drop in zip(words, gone.tolist()) if not drop)
                out.append((row, int(gone.sum()), hashlib.sha256(left).hexdigest(), left.decode() if left else None))
            types = pa.int64(), pa.int64(), pa.string(), pa.string()
            columns = zip(*out) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    names = ["row", "n_removed", "kept_sha256", "kept_text"]
    return texts.select("row", "text", "spans").mapInArrow(run, "row long, n_removed long, kept_sha256 string, kept_text string")


def cut_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with all their columns; texts that lose words have those that stay, joined by one space, others are unchanged.

    Every row stays, even if no word does. A column ``n_chars`` is brought up to date.
    """
    rows, own = with_unique_key(docs, key)
    found = repeated_passages(rows, own, text, window).where("n_removed > 0")
    name, left = fresh_name(rows, "_cut"), fresh_name(rows, "_left")
    found = found.select(F.col("key").alias(name), F.coalesce("kept_text", F.lit("")).alias(left))
    joined = rows.join(found, F.col(own) == F.col(name), "left").withColumn(text, F.coalesce(F.col(left), F.col(text)))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.when(F.col(left).isNull(), F.col("n_chars")).otherwise(F.length(text)).cast("long"))
    return joined.select(*docs.columns)
