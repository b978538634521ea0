"""Packing documents into sequences of bounded length: best-two-fit.

A sequence is filled greedily with the longest pieces that still fit. Then its shortest piece is taken out again if two unpacked
ones fit the widened gap more tightly.

Only lengths matter for this, and a length is at most the capacity. So Spark counts the pieces of each length, and the packing
is worked out on these at most ``capacity`` counts, however many documents there are: the same filling is repeated until one
of its lengths runs short, as it would be one sequence at a time. The result is a table of runs, "pieces number r to r + n of this
length go to these sequences, at this offset", and every piece finds its place by its number among those of its length.
"""

from __future__ import annotations

import base64
import os
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierloom.llm.common import staged, whole_text

#: A worker's remembered words are dropped beyond this count; the ids stay the same.
MOST_CHUNKS = 300_000


class Encoder:
    """Ids of whole texts, as ``tokenizers`` gives them for a byte-level BPE file.

    A text falls apart at spaces between two other characters (no piece of the pattern reaches across one), so its words are
    looked up. New words without special strings are encoded with ``tiktoken`` from the same vocabulary's rank file, which
    gives the same ids faster; everything else goes through ``tokenizers``.
    """

    def __init__(self, path: str, ranks_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(entry): int(rank) for entry, rank in (x.split() for x in lines if x.strip())}
        self.plain = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, tuple[int, ...]] = {}

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _word(self, word: str) -> tuple[int, ...] | None:
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        if len(self.known) > MOST_CHUNKS:
            self.known.clear()
        ids = self.known[word] = tuple(self.plain.encode_ordinary(" " + word))
        return ids

    def encode(self, text: str) -> list[int]:
        if any(token in text for token in self.special):
            return self._whole(text)
        first, *rest = text.split(" ")
        if not first or first[-1].isspace():
            return self._whole(text)
        known, ids = self.known, self.plain.encode_ordinary(first)
        for word in rest:
            found = known.get(word) or self._word(word)
            if found is None:
                return self._whole(text)
            ids += found
        return ids


def cut_documents(
    docs: DataFrame,
    capacity: int = 2048,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
    keep_ids: bool = True,
    tokenizer_path: str = public_tokenizers.path("byte_bpe_50k.json"),
    ranks_path: str = public_tokenizers.path("byte_bpe_50k.tiktoken"),
) -> DataFrame:
    """Pieces of at most ``capacity`` ids: ``key, piece, start, length, ids_crc32`` and, with ``keep_ids``, ``ids``.

    A document is the ids of its text and ``end_id``. Only longer ones are cut; their first piece takes what does not fill a whole
    sequence. ``part`` and ``nth`` number the pieces of each length within a task. A null text is empty: the end id alone.
    """
    picked = docs.select(F.col(key).alias("_key"), whole_text(F.col(text)).alias("_text"))
    kind = picked.schema["_key"].dataType.simpleString()
    fields = ["piece int", "start long", "length long", "ids_crc32 long", "part int", "nth long"] + ["ids array<int>"] * keep_ids
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()] + [pa.list_(pa.int32())] * keep_ids

    def run(batches):
        encoder, part, seen = None, TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            encoder = encoder or Encoder(tokenizer_path, ranks_path)
            taken, rows = [], []
            for at, text in enumerate(batch.column(1)):
                ids = np.array(encoder.encode(text.as_py().decode()) + [end_id], "<u4")
                begin, end = 0, (len(ids) - 1) % capacity + 1
                piece = 0
                while begin < len(ids):
                    own = ids[begin:end]
                    row = (piece, begin, end - begin, zlib.crc32(own.tobytes()), part, int(seen[end - begin]))
                    rows.append((*row, own.astype(np.int32)) if keep_ids else row)
                    taken.append(at)
                    seen[end - begin] += 1
                    begin, end, piece = end, end + capacity, piece + 1
            columns = zip(*rows) if rows else [[] for _ in types]
            arrays = [batch.column(0).take(pa.array(taken, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, types))]
            yield pa.RecordBatch.from_arrays(arrays, names=["_key", *(f.split()[0] for f in fields)])

    return picked.mapInArrow(run, ", ".join([f"_key {kind}", *fields])).withColumnRenamed("_key", key)


def best_two_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(length, first, each, times, sequence, offset)`` for ``counts[length]`` pieces of each length.

    Pieces ``first`` to ``first + each * times`` of that length go to the sequences from ``sequence`` on, ``each`` in a row to one
    sequence, beginning at ``offset``.
    """
    left, used, runs, sequence = counts.astype(np.int64).copy(), np.zeros(capacity + 1, np.int64), [], 0
    while True:
        there = np.flatnonzero(left)
        if not len(there):
            return runs
        gap, filling, at = capacity, {}, len(there) - 1
        while at >= 0:
            length = int(there[at])
            fits = min(gap // length, int(left[length]))
            if fits:
                filling[length] = fits
                gap -= fits * length
            at = min(at - 1, int(np.searchsorted(there, gap, "right")) - 1)
        if sum(filling.values()) > 1:
            last = min(filling)
            free = left.copy()
            for length, n in filling.items():
                free[length] -= n
            pair = tightest_pair(np.flatnonzero(free), free, gap + last)
            if pair and sum(pair) > last:
                filling[last] -= 1
                for length in pair:
                    filling[length] = filling.get(length, 0) + 1
                filling = {length: n for length, n in filling.items() if n}
        times, offset = min(int(left[length]) // n for length, n in filling.items()), 0
        for length, n in sorted(filling.items(), reverse=True):
            runs.append((length, int(used[length]), n, times, sequence, offset))
            used[length] += n * times
            left[length] -= n * times
            offset += n * length
        sequence += times


def tightest_pair(lengths: np.ndarray, left: np.ndarray, gap: int) -> tuple[int, int] | None:
    """Two lengths of those left with the largest sum that fits; the longer of them as long as can be."""
    lengths = lengths[lengths < gap]
    if not len(lengths):
        return None
    partner = np.searchsorted(lengths, gap - lengths, "right") - 1
    twice = (partner >= 0) & (lengths[partner] == lengths) & (left[lengths] < 2)
    partner = np.where(twice, partner - 1, partner)
    sums = np.where(partner >= 0, lengths + lengths[partner], 0)
    best = len(sums) - 1 - int(np.argmax(sums[::-1]))
    return (int(lengths[best]), int(lengths[partner[best]])) if sums[best] else None


def place(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """``pieces`` (with ``length``, ``part`` and ``nth``) with ``sequence_id`` and ``offset``.

    A piece's number among those of its length is its number in its task plus the pieces of that length in earlier tasks, so
    a length that most pieces share needs no task that holds them all. The driver sees one count for each length.
    """
    by_task = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")
    by_task = by_task.select("part", "length", before.alias("before"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most `capacity` rows
        counts[row["length"]] = row["n"]
    runs = np.array(sorted(best_two_fit(counts, capacity)), np.int64).reshape(-1, 6)
    numbered = pieces.join(by_task, ["part", "length"]).withColumn("_nth", F.col("nth") + F.col("before"))
    numbered = numbered.select(*(c for c in pieces.columns if c not in ("part", "nth")), "_nth")
    at_length = np.searchsorted(runs[:, 0], np.arange(capacity + 2))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema if f.name != "_nth")

    def run(batches):
        for batch in batches:
            lengths, nth = (batch.column(name).to_numpy() for name in ("length", "_nth"))
            own = np.empty(len(nth), np.int64)
            for length in np.unique(lengths):
                here = lengths == length
                begin, end = at_length[length], at_length[length + 1]
                own[here] = begin + np.searchsorted(runs[begin:end, 1], nth[here], "right") - 1
            length, first, each, _, sequence, offset = runs[own].T
            within = nth - first
            batch = batch.drop_columns("_nth")
            arrays = [*batch.columns, pa.array(sequence + within // each), pa.array(offset + within % each * length)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "sequence_id", "offset"])

    return numbered.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = 2048, key: str = "doc_id", text: str = "text", keep_ids: bool = True,
                   **options) -> DataFrame:
    """One row per piece with its place: ``key, piece, start, length, ids_crc32, [ids,] sequence_id, offset``.

    Every row is a document of its own, repeated rows and rows without a key too; further columns are not read. An empty table
    packs into nothing.
    """
    cut = staged(cut_documents(docs, capacity, key=key, text=text, keep_ids=keep_ids, **options), "pieces")
    return place(cut, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The ids of every sequence, in order: ``sequence_id, ids``."""
    parts = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
