"""Near-duplicate vectors by product quantisation.

Coarse centroids and the codewords of every subspace are fitted on a bounded sample; all vectors are indexed. A vector is stored in
the list of its nearest centroid as one code byte per subspace for its residual. As a question it goes to every list that can
hold a neighbour. The plane between two centroids cuts the way from a vector to a neighbour in another list, and one of the two is
within half of that way of the plane; it is enough that this one asks, as a link is told to both. In a list, table lookups give the distance of a question to each coded vector; where that is
within the threshold plus the vector's own coding error, the exact cosine decides. So codes lose nothing; only probes can.

Equal vectors are one class, searched once. Lists are split by stored vectors and by questions, so a list that holds a third of all
rows is many tasks. Pairs are never emitted: a task gives each vector its number of links and edges to the smallest vector
that its links reach.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.llm.common import components, linked_labels, shuffle_partitions, staged

#: Bound of the fitted sample; vectors for each list until there are MOST_LISTS; vectors of a stored chunk and of a salt of questions.
SAMPLE, PER_LIST, MOST_LISTS, CHUNK, SALT = 8192, 128, 1024, 2048, 32768
SUBSPACES, CODEWORDS = 8, 256
#: Standard deviations of a neighbour's step towards another centroid that probes allow for, if steps have no preferred direction;
#: None allows for any step.
SPREAD = 4.0


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * x @ y.T, 0)


def k_means(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres of ``points``, begun at evenly spaced ones."""
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        own = squared_distances(points, centres).argmin(1)
        sums, sizes = np.zeros_like(centres), np.bincount(own, minlength=k)
        np.add.at(sums, own, points)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


class Quantiser:
    """Coarse centroids and the residuals' codewords in each subspace."""

    def __init__(self, sample: np.ndarray, lists: int, threshold: float, spread: float | None):
        sample = unit(sample)
        self.centroids = k_means(sample, min(lists, len(sample)))
        residuals = sample - self.centroids[squared_distances(sample, self.centroids).argmin(1)]
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(SUBSPACES, sample.shape[1]))
        self.codebooks = [k_means(residuals[:, cut], min(CODEWORDS, len(sample))) for cut in self.cuts]
        self.reach = math.sqrt(2 - 2 * threshold)
        step = 1.0 if spread is None else min(1.0, spread / math.sqrt(sample.shape[1]))
        self.slack = self.reach * step / 2
        self.between = np.sqrt(squared_distances(self.centroids, self.centroids))

    def probes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Own list of each vector, and which lists it is a question to (its own is one)."""
        squared = squared_distances(vectors, self.centroids)
        own = squared.argmin(1)
        plane = (squared - squared[np.arange(len(own)), own][:, None]) / 2
        return own, plane <= self.slack * self.between[own] + 1e-9

    def encode(self, vectors: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes, the part of the squared distance that no question changes, and the coding error."""
        residuals = vectors - self.centroids[own]
        codes = np.stack([squared_distances(residuals[:, c], book).argmin(1) for c, book in zip(self.cuts, self.codebooks)], 1)
        coded = self.centroids[own] + np.concatenate([book[codes[:, i]] for i, book in enumerate(self.codebooks)], 1)
        return codes.astype(np.uint8), (coded * coded).sum(1), np.sqrt(((vectors - coded) ** 2).sum(1))

    def distances(self, questions: np.ndarray, centroid: np.ndarray, codes: np.ndarray, fixed: np.ndarray) -> np.ndarray:
        """Squared distances of questions to the coded vectors of one list, by one table for each subspace."""
        products = np.repeat((questions @ centroid)[:, None], len(codes), 1)
        for i, (cut, book) in enumerate(zip(self.cuts, self.codebooks)):
            products += (questions[:, cut] @ book.T)[:, codes[:, i]]
        return (questions * questions).sum(1)[:, None] + fixed - 2 * products


def _indexed(classes: DataFrame, quantiser: Quantiser, width: int) -> DataFrame:
    """Packed rows of at most 1024 vectors: ``list, kind`` (0 stored, 1 questions), ``nth, size`` and their arrays."""
    kind = np.float32 if classes.schema["vector"].dataType.elementType == T.FloatType() else np.float64

    def run(batches):
        nth = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                raw = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, width)
                nodes, weights = part.column(0).to_numpy(), part.column(1).to_numpy()
                vectors = unit(raw)
                own, asked = quantiser.probes(vectors)
                codes, fixed, error = quantiser.encode(vectors, own)
                out = []
                for number in range(len(quantiser.centroids)):
                    for role, rows in ((0, np.flatnonzero(own == number)), (1, np.flatnonzero(asked[:, number]))):
                        for begin in range(0, len(rows), 1024):
                            i = rows[begin : begin + 1024]
                            more = (codes[i].tobytes(), np.stack([fixed[i], error[i]]).tobytes(), np.packbits(asked[i], axis=1).tobytes())
                            packed = (nodes[i].tobytes(), weights[i].tobytes(), own[i].astype(np.int32).tobytes(), raw[i].tobytes())
                            out.append((number, role, nth, len(i), *packed, *(more if role == 0 else (None,) * 3)))
                            nth += 1
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    names = ["list", "kind", "nth", "size", "nodes", "weights", "own", "raw", "codes", "numbers", "asked"]
    types = [pa.int32(), pa.int32(), pa.int64(), pa.int64()] + [pa.binary()] * 7
    ddl = "list int, kind int, nth long, size long, " + ", ".join(f"{n} binary" for n in names[4:])
    return classes.select("node", "weight", "vector").mapInArrow(run, ddl)


def _searched(pieces: DataFrame, quantiser: Quantiser, width: int, kind, threshold: float) -> DataFrame:
    """``node, links, root`` from pieces sorted by list, chunk, salt and kind."""
    lists = len(quantiser.centroids)

    def run(batches):
        place, stored = None, []
        for batch in batches:
            for row in batch.to_pylist():
                here = row["list"], row["chunk"], row["salt"]
                if here != place:
                    place, stored, block = here, [], None
                if row["kind"] == 0:
                    stored.append(row)
                    continue
                if not stored:
                    continue
                block = block or gather(stored)
                for out in compare(row, block, place[0]):
                    yield out

    def gather(rows):
        def whole(name, as_type):
            return np.concatenate([np.frombuffer(row[name], as_type) for row in rows])

        codes = np.concatenate([np.frombuffer(row["codes"], np.uint8).reshape(row["size"], -1) for row in rows])
        fixed, error = np.concatenate([np.frombuffer(row["numbers"]).reshape(2, -1) for row in rows], 1)
        asked = [np.unpackbits(np.frombuffer(r["asked"], np.uint8).reshape(r["size"], -1), axis=1, count=lists) for r in rows]
        vectors = unit(whole("raw", kind).reshape(-1, width))
        nodes = whole("nodes", np.int64)
        return {"codes": codes, "fixed": fixed, "limit": (quantiser.reach + error + 1e-6) ** 2, "vectors": vectors, "nodes": nodes,
                "weights": whole("weights", np.int64), "asked": np.concatenate(asked).astype(bool), "labels": nodes.copy()}

    def compare(row, block, number):
        nodes, weights = np.frombuffer(row["nodes"], np.int64), np.frombuffer(row["weights"], np.int64)
        own, vectors = np.frombuffer(row["own"], np.int32), unit(np.frombuffer(row["raw"], kind).reshape(-1, width))
        for at in range(0, len(nodes), 256):
            cut = slice(at, at + 256)
            near = quantiser.distances(vectors[cut], quantiser.centroids[number], block["codes"], block["fixed"]) <= block["limit"]
            near &= nodes[cut][:, None] != block["nodes"]
            rows, columns = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            if not len(rows):
                continue
            i = rows + at
            links = near[np.ix_(rows, columns)] & (vectors[i] @ block["vectors"][columns].T >= threshold)
            # A stored vector that is no question to this one's list would not hear of the link elsewhere.
            deaf = ~block["asked"][columns][:, own[i]].T
            labels, after = linked_labels(links, nodes[i], block["labels"][columns])
            answers = (links & deaf).T @ weights[i]
            changed = (after < block["labels"][columns]) | (answers > 0)
            block["labels"][columns] = after
            has = links.any(1)
            out = [np.concatenate(x) for x in (
                (nodes[i][has], block["nodes"][columns][changed]),
                ((links @ block["weights"][columns])[has], answers[changed]),
                (labels[has], after[changed]),
            )]
            if len(out[0]):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["node", "links", "root"])

    return pieces.mapInArrow(run, "node long, links long, root long")


def near_vectors(rows: DataFrame, threshold: float = 0.95, key: str = "vec_id", vector: str = "embedding",
                 spread: float | None = SPREAD) -> DataFrame:
    """``key, n_links, component_id, kept`` for every row: how many other rows have a cosine of ``threshold`` or more, the smallest
    key that links reach, and whether that is its own.

    Vectors that are null, zero or empty or hold null or non-finite components link with nothing, and so do rows without a key;
    vectors link only with those of their own width. Repeated rows link with each other, and so do different vectors that share a
    key; all rows of a component's smallest key are kept. An empty table gives no rows. ``spread=None`` probes every list that
    can hold a neighbour. Further columns are not read.
    """
    picked = rows.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    element = rows.schema[vector].dataType.elementType
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")).cast(element)))
    good = F.coalesce((F.size("vector") > 0) & finite & F.exists("vector", lambda x: x != 0) & F.col("key").isNotNull(), F.lit(False))
    picked = picked.withColumn("good", good)
    # A class has a number of its own, as different vectors may share a key.
    classes = picked.where("good").groupBy("vector").agg(F.min("key").cast("long").alias("least"), F.count("*").alias("weight"))
    classes = classes.withColumns({"width": F.size("vector"), "node": F.monotonically_increasing_id()})
    classes = staged(classes, "vector-classes")
    found = None
    for width, count in sorted(tuple(r) for r in classes.groupBy("width").count().collect()):  # as many rows as widths
        of_width = classes.where(F.col("width") == width)
        one = _links_of_width(of_width, width, count, element, threshold, spread)
        found = one if found is None else found.union(one)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "node long, links long, root long")
    found = staged(found, "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    roots = roots.groupBy("node").agg(F.min("root").alias("root"))
    of_class = classes.join(links, "node", "left").join(roots, "node", "left")
    of_class = staged(of_class.select(F.col("vector").alias("_vector"), "least", "weight", "links", F.coalesce("root", "node").alias("root")),
                      "vector-results")
    smallest = staged(of_class.groupBy("root").agg(F.min("least").alias("component")), "components")
    of_class = of_class.join(smallest, "root")
    out = picked.withColumn("_join", F.when(F.col("good"), F.col("vector")))
    out = out.join(of_class, F.col("_join") == F.col("_vector"), "left")
    component = F.coalesce("component", F.col("key").cast("long"))
    return out.select(
        F.col("key").alias(key),
        F.coalesce(F.col("weight") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("key"), F.lit(True)).alias("kept"),
    )


def _links_of_width(classes: DataFrame, width: int, count: int, element, threshold: float, spread: float | None) -> DataFrame:
    spark = classes.sparkSession
    sample = classes.orderBy(F.xxhash64("vector"), "node").limit(SAMPLE).select("vector").collect()  # at most SAMPLE vectors
    lists = max(1, min(MOST_LISTS, count // PER_LIST))
    quantiser = Quantiser(np.array([row["vector"] for row in sample]), lists, threshold, spread)
    packed = staged(_indexed(classes.repartition(shuffle_partitions(spark)), quantiser, width), "vector-lists")
    sizes = packed.groupBy("list").agg(*(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("size"))), F.lit(0)).alias(n)
                                         for k, n in enumerate(("stored", "questions"))))
    sizes = sizes.select("list", F.ceil(F.col("stored") / CHUNK).cast("int").alias("chunks"),
                         F.ceil(F.col("questions") / SALT).cast("int").alias("salts"))
    sized = packed.join(F.broadcast(sizes), "list").where("chunks > 0")  # at most MOST_LISTS rows

    def all_of(n):
        return F.sequence(F.lit(0), F.col(n) - 1)

    def one_of(n):
        return F.array(F.pmod(F.xxhash64("nth"), F.col(n)).cast("int"))

    stored = F.col("kind") == 0
    pieces = sized.withColumn("chunk", F.explode(F.when(stored, one_of("chunks")).otherwise(all_of("chunks"))))
    pieces = pieces.withColumn("salt", F.explode(F.when(stored, all_of("salts")).otherwise(one_of("salts"))))
    pieces = pieces.drop("chunks", "salts").repartition(shuffle_partitions(spark), "list", "chunk", "salt")
    pieces = pieces.sortWithinPartitions("list", "chunk", "salt", "kind")
    kind = np.float32 if element == T.FloatType() else np.float64
    return _searched(pieces, quantiser, width, kind, threshold)
