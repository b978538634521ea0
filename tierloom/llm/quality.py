"""Quality of texts by the votes of labelled neighbours in a latent-semantic space.

**Terms.** A text is a bag of hashed terms of two kinds: its byte trigrams, begin and end marked; and, per word, its shape (runs of
capitals, letters, digits and marks) and the logarithm of the distance to the same word's last place. Counts go in by their
square root, times the logarithm of how rare a term is in *all* documents, and both kinds have the same length.

**Latent-semantic vectors.** A bounded sample of labelled documents is decomposed into singular vectors; every text is projected
on the first :data:`DIMENSIONS` of them and scaled to length 1.

**Votes.** The sample's vectors and labels, at most ``2 * MOST_DOCS * DIMENSIONS`` numbers, go to all tasks. A task multiplies them with a
block of its documents at a time, which gives every cosine exactly, and takes the :data:`NEIGHBOURS` largest. A neighbour's vote
counts its cosine to the power :data:`SHARPNESS`, times the number of labelled documents that it stands for in the sample.

Documents are read twice, once for the terms' counts and once for the scores, in numpy and by whole texts; neither pass shuffles
more than one number per task and term.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.llm.common import staged, whole_text

#: Labelled documents of each label that vote, at most; latent dimensions; votes per document.
MOST_DOCS, DIMENSIONS, NEIGHBOURS, SHARPNESS = 1_500, 64, 15, 8
#: Numbers of hashed terms: trigrams (a power of two), distances, shapes.
TRIGRAMS, DISTANCES, SHAPES = 2_048, 32, 224
TERMS = TRIGRAMS + DISTANCES + SHAPES
#: A block of documents ends at this many bytes or rows.
BLOCK_BYTES, BLOCK_ROWS = 1 << 20, 400
SHAPE_LENGTH = 6

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[ord("A") : ord("Z") + 1] = ord("A")
_CLASS[ord("a") : ord("z") + 1] = ord("a")
_CLASS[ord("0") : ord("9") + 1] = ord("0")
_CLASS[0x80:] = ord("a")
_POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, np.uint64))


def _rows_and_trigrams(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Counts of hashed trigrams; ``data`` holds each text from ``begins`` to ``ends`` with one mark before and two after."""
    wide = data.astype(np.uint32)
    code = wide[:-2] * np.uint32(0x9E3779B1) ^ wide[1:-1] * np.uint32(0x85EBCA6B) ^ wide[2:] * np.uint32(0xC2B2AE35)
    code = (code * np.uint32(0x27D4EB2F)) >> np.uint32(32 - TRIGRAMS.bit_length() + 1)
    whole = np.ones(len(code), bool)
    whole[(ends[:-1, None] - [1, 2]).ravel()] = False  # these would reach into the next text
    own = np.repeat(np.arange(len(begins)), ends - begins)[: len(code)]
    place = own[whole] * TRIGRAMS + code[whole]
    return np.bincount(place, minlength=len(begins) * TRIGRAMS).reshape(len(begins), TRIGRAMS)


def _words(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Counts of distances and shapes."""
    n = len(begins)
    out = np.zeros(n * (DISTANCES + SHAPES), np.int64)
    letter = ~_SPACE[data]
    letter[np.concatenate([begins, ends - 1, ends - 2])] = False  # the marks
    first = letter & ~np.concatenate([[False], letter[:-1]])
    at = np.flatnonzero(letter)
    if not len(at):
        return out.reshape(n, -1)
    starts = np.flatnonzero(first)
    word = np.cumsum(first)[at] - 1
    text = np.searchsorted(ends, starts, "right")
    heads = np.searchsorted(at, starts)
    named = np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * _POWERS[(at - starts[word]) & 4095], heads)
    named = (named ^ (named >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + text.astype(np.uint64)
    order = np.argsort(named, kind="stable")
    again = named[order[1:]] == named[order[:-1]]
    distance = np.zeros(len(order), np.int64)
    distance[order[1:][again]] = (order[1:] - order[:-1])[again]
    size = np.minimum(np.frexp(distance.astype(float))[1], DISTANCES - 1)  # 0 for a new word, 1 for a repeated one, ...
    classes = _CLASS[data[at]]
    kept = np.flatnonzero(np.concatenate([[True], (classes[1:] != classes[:-1]) | (word[1:] != word[:-1])]))
    head = np.searchsorted(kept, heads)  # the first letter of each word is kept
    rank = np.arange(len(kept)) - head[word[kept]]
    value = np.where(rank < SHAPE_LENGTH, (classes[kept].astype(np.uint64) + np.uint64(1)) * _POWERS[np.minimum(rank, SHAPE_LENGTH)], 0)
    shape = (np.add.reduceat(value.astype(np.uint64), head) >> np.uint64(40)) % np.uint64(SHAPES)
    width = DISTANCES + SHAPES
    np.add.at(out, text * width + size, 1)
    np.add.at(out, text * width + DISTANCES + shape.astype(np.int64), 1)
    return out.reshape(n, width)


def term_counts(texts: list[bytes]) -> np.ndarray:
    """How often each of :data:`TERMS` hashed terms stands in each text. An empty text has one trigram, its marks, and no words."""
    data = np.frombuffer(b"".join(b"\x02" + text + b"\x03\x03" for text in texts), np.uint8)
    ends = np.cumsum([len(text) + 3 for text in texts])
    begins = np.concatenate([[0], ends[:-1]])
    return np.hstack([_rows_and_trigrams(data, begins, ends), _words(data, begins, ends)])


def blocks(column: pa.Array):
    """Bounds of consecutive rows that hold about :data:`BLOCK_BYTES`, at least one row each."""
    sizes = np.concatenate([[0], np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))])
    begin = 0
    while begin < len(column):
        end = int(np.searchsorted(sizes, sizes[begin] + BLOCK_BYTES, "right")) - 1
        end = min(max(end, begin + 1), begin + BLOCK_ROWS)
        yield begin, end
        begin = end


def weighted(counts: np.ndarray, rarity: np.ndarray) -> np.ndarray:
    """Square roots of counts times the terms' weights; trigrams and words scaled to length 1 each."""
    out = np.sqrt(counts, dtype=np.float32) * rarity
    for part in (out[:, :TRIGRAMS], out[:, TRIGRAMS:]):
        part /= np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-12)
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Voters:
    """Term weights, projection, and the labelled documents' vectors, labels and shares."""

    rarity: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    stands_for: np.ndarray

    def project(self, counts: np.ndarray) -> np.ndarray:
        return unit(weighted(counts, self.rarity) @ self.projection)

    def scores(self, counts: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
        """Share of label 1 among the nearest documents' votes; all vote by their numbers where no neighbour is on the text's side."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        cosines = self.project(counts) @ self.vectors.T
        most = min(neighbours, len(self.labels))
        near = np.argpartition(-cosines, most - 1, axis=1)[:, :most]
        votes = np.maximum(np.take_along_axis(cosines, near, 1), 0).astype(float) ** SHARPNESS * self.stands_for[near]
        total = votes.sum(1)
        usual = float(self.stands_for @ self.labels / self.stands_for.sum())
        return np.clip(np.where(total > 1e-12, (votes * self.labels[near]).sum(1) / np.maximum(total, 1e-12), usual), 0, 1)


def rarity_of(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Weight of each term by the number of documents, of all of them, that hold it."""

    def count(batches):
        seen, rows = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for begin, end in blocks(batch.column(0)):
                seen += (term_counts(batch.column(0)[begin:end].to_pylist()) > 0).sum(0)
                rows += end - begin
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, TERMS)), pa.array(np.concatenate([[rows], seen]))], names=["term", "n"])

    found = docs.select(whole_text(F.col(text)).alias("text")).mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {row["term"]: row["n"] for row in found.collect()}
    total = counts.get(-1, 0)
    seen = np.array([counts.get(term, 0) for term in range(TERMS)], float)
    return (np.log((1 + total) / (1 + seen)) + 0.2).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
          most_docs: int = MOST_DOCS, dimensions: int = DIMENSIONS) -> Voters:
    """Voters from ``labels`` (``key, label``) and their texts in ``docs``: at most ``most_docs`` of each label, picked by a hash.

    Labels other than 0 and 1, and keys without a document, are left out; a null text is empty. With one label only, all votes
    are for it. Without a labelled document every score is 0.5. Term weights come from all of ``docs``.
    """
    rarity = rarity_of(docs, text)
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("y")).where("y in (0, 1)").distinct()
    order = F.xxhash64("_key")
    sizes = {row["y"]: row["count"] for row in known.groupBy("y").count().collect()}
    sample = known.where("y = 1").orderBy(order).limit(most_docs).union(known.where("y = 0").orderBy(order).limit(most_docs))
    texts = docs.select(F.col(key).alias("_doc"), whole_text(F.col(text)).alias("text"))
    picked = texts.join(F.broadcast(sample), F.col("_doc") == F.col("_key"))  # at most 2 * most_docs rows of two numbers

    def features(batches):
        for batch in batches:
            for begin, end in blocks(batch.column(1)):
                rows = term_counts(batch.column(1)[begin:end].to_pylist()).astype(np.float32)
                yield pa.RecordBatch.from_arrays([batch.column(0)[begin:end], pa.array([row.tobytes() for row in rows], pa.binary())],
                                                 names=["y", "terms"])

    found = staged(picked.select("y", "text").mapInArrow(features, "y int, terms binary").distinct(), "labelled-terms")
    rows = [r for y in (0, 1) for r in found.where(F.col("y") == y).orderBy(F.xxhash64("terms")).limit(most_docs).collect()]
    if not rows:
        return Voters(rarity, np.zeros((TERMS, 0), np.float32), np.zeros((0, 0), np.float32), np.zeros(0), np.zeros(0))
    y = np.array([row["y"] for row in rows], float)
    matrix = weighted(np.stack([np.frombuffer(row["terms"], np.float32) for row in rows]), rarity)
    values, vectors = np.linalg.eigh((matrix @ matrix.T).astype(float))
    values, vectors = values[::-1][:dimensions], vectors[:, ::-1][:, :dimensions]
    solid = values > 1e-8 * values[0]
    projection = (matrix.T @ (vectors[:, solid] / np.sqrt(values[solid]))).astype(np.float32)
    stands_for = np.array([sizes[label] for label in y]) / np.where(y == 1, max(1, (y == 1).sum()), max(1, (y == 0).sum()))
    return Voters(rarity, projection, unit(matrix @ projection), y, stands_for)


def score(docs: DataFrame, voters: Voters, key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``key, score, predicted`` for every row.

    Null and empty texts are scored by their marks alone, like any other short text. Texts of any length count as a whole.
    Repeated rows and null keys are kept; an empty table gives no rows. Other columns are ignored, whatever their names.
    """
    picked = docs.select(F.col(key).alias("_key"), whole_text(F.col(text)).alias("_text"))
    schema = T.StructType([picked.schema["_key"], T.StructField("score", T.DoubleType())])
    # at most most_docs * 2 * dimensions + terms * dimensions numbers, whatever the tables hold
    parts = tuple(vars(voters).values())
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def run(batches):
        voters = Voters(*shared.value)
        for batch in batches:
            for begin, end in blocks(batch.column(1)):
                scores = voters.scores(term_counts(batch.column(1)[begin:end].to_pylist()))
                yield pa.RecordBatch.from_arrays([batch.column(0)[begin:end], pa.array(scores, pa.float64())], names=["_key", "score"])

    found = picked.mapInArrow(run, schema).withColumnRenamed("_key", key)
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
