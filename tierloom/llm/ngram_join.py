"""Near-duplicate texts: the Jaccard join of their word n-grams by a MinHash LSH forest.

A tree's label of a text is a sequence of short minimum hashes, packed into one integer from the top down, so that texts which share
the first d hashes share the first d bytes. Sorted labels are the tree's prefix trie: texts under one prefix lie side by side and form
a bucket. Two texts of similarity s share a prefix of length d in a tree with probability s^d.

The descent starts at the longest prefixes. Each round compares the texts of the buckets that it has and the rounds before had not,
and exact verification gives their links. Then prefixes are shortened by one hash in all trees and the next round follows, until
the least similar link met so far is one that these prefixes meet with the target probability. At the latest it ends with the prefixes
that meet a pair at the threshold with that probability; some trees keep longer ones there. Labels that share even those with no
other text are left out of the tries from the start.

Texts with the same n-grams are one class, compared once. In a bucket the n-grams of its texts decide exactly. A pair is compared in
the first bucket that it shares: in its first round, and there in its first tree; texts that met under a longer prefix are not
intersected again. Crowded buckets are cut into blocks, and each pair of blocks is a task of its own. Pairs are never emitted: a task
gives each text its number of links and edges to the smallest text its links reach.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import (
    components,
    linked_labels,
    rows_with,
    shuffle_partitions,
    staged,
    whole_text,
    with_unique_key,
    words_of,
)

WORDS, THRESHOLD, TREES, DEPTH, RECALL = 5, 0.8, 20, 7, 0.998
#: Texts and n-grams of a block; texts and n-grams of it that are worked on at a time.
BLOCK_TEXTS, BLOCK_GRAMS, STRIP, GRAMS_AT_ONCE = 2048, 500_000, 64, 1024
#: A worker's remembered words are dropped beyond this count; the hashes stay the same.
MOST_WORDS = 200_000


def chance(similarity: float, depths: list[int]) -> float:
    """Probability that two texts share the prefix of some tree."""
    return 1 - float(np.prod([1 - similarity**d for d in depths]))


def forest_depths(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> list[int]:
    """Shortest prefixes of the descent: the longest that meet the recall at ``threshold``, within one of each other."""
    depths, turn = [depth] * trees, 0
    while chance(threshold, depths) < recall:
        if depths[turn] == 1:
            raise ValueError("too few trees for this recall")
        depths[turn] -= 1
        turn = (turn + 1) % trees
    return depths


def descent(last: list[int], depth: int) -> list[list[int]]:
    """Prefix lengths of each round: all of them ``depth``, then one less each time, but no shorter than the ``last`` ones."""
    return [[max(d, own) for own in last] for d in range(depth, min(last) - 1, -1)]


def prefix_masks(depths: list[int], depth: int) -> list[int]:
    """What keeps a label's tree, in its top byte, and the first hashes of it."""
    return [(1 << 63) - (1 << 8 * (depth - d)) for d in depths]


class WordHashes(dict):
    """Hash of a word in lower case without anything but letters and digits; 0 if nothing is left."""

    def __missing__(self, word):
        plain = word.decode().lower()
        if not plain.isalnum():
            plain = "".join(filter(str.isalnum, plain))
        value = self[word] = xxhash.xxh64_intdigest(plain) | 1 if plain else 0
        return value


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = (left ^ (left >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + right
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def gram_sets(texts: list[bytes], known: WordHashes, size: int) -> list[np.ndarray]:
    """Sorted hashes (48 bits) of each text's word n-grams; a text with fewer words is one gram, a text without words has none."""
    if len(known) > MOST_WORDS:
        known.clear()
    out = []
    for text in texts:
        words = np.fromiter(map(known.__getitem__, words_of(text)), np.uint64)
        words = words[words != 0]
        if len(words):
            width = min(size, len(words))
            grams = np.full(len(words) - width + 1, width, np.uint64)
            for i in range(width):
                grams = _mixed(grams, words[i : len(words) - width + 1 + i])
            words = np.unique(grams >> np.uint64(16))
        out.append(words)
    return out


def labels(sets: list[np.ndarray], trees: int, depth: int) -> np.ndarray:
    """Label of each non-empty set in each tree: ``depth`` bytes of minimum hashes, the first one on top."""
    flat, begins = np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    seeds = np.random.default_rng(5).integers(1, 1 << 63, trees * depth, dtype=np.uint64) | np.uint64(1)
    out = np.zeros((len(sets), trees), np.uint64)
    for i, seed in enumerate(seeds):
        hashed = (flat ^ (seed >> np.uint64(7))) * seed
        hashed ^= hashed >> np.uint64(32)
        least = np.minimum.reduceat(hashed * np.uint64(0x9E3779B97F4A7C15), begins)
        least = (least ^ (least >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        tree = i // depth
        out[:, tree] = (out[:, tree] << np.uint64(8)) | (least >> np.uint64(56))
    return out


def _labelled(docs: DataFrame, key: str, text: str, words: int, trees: int, depth: int) -> DataFrame:
    """``row, key, of_text, grams, digest, labels``: digests of each text and of its n-grams, and its label in every tree."""
    whole = whole_text(F.col(text))
    picked = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.unhex(F.md5(whole)).alias("of_text"),
                         whole.alias("text"))
    kind = picked.schema["key"].dataType.simpleString()
    tops = np.arange(trees, dtype=np.uint64) << np.uint64(56)

    def run(batches):
        known = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 300):
                part = batch.slice(at, 300)
                sets = gram_sets(part.column(3).to_pylist(), known, words)
                there = [s for s in sets if len(s)]
                own = (labels(there, trees, depth) | tops).astype(np.int64) if there else np.zeros((0, trees), np.int64)
                sizes = np.array([len(s) for s in sets], np.int64)
                offsets = np.concatenate([[0], np.cumsum((sizes > 0) * trees)]).astype(np.int32)
                digests = [hashlib.md5(s.tobytes()).digest() for s in sets]
                arrays = [part.column(0), part.column(1), part.column(2), pa.array(sizes), pa.array(digests, pa.binary()),
                          pa.ListArray.from_arrays(pa.array(offsets), pa.array(own.ravel()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", "key", "of_text", "grams", "digest", "labels"])

    return picked.mapInArrow(run, f"row long, key {kind}, of_text binary, grams long, digest binary, labels array<long>")


def _with_sets(texts: DataFrame, words: int) -> DataFrame:
    """``node, weight, labels, set`` from ``node, weight, labels, text``: labels and n-grams as bytes."""

    def run(batches):
        known = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 100):
                part = batch.slice(at, 100)
                own = [np.array(row, np.int64).tobytes() for row in part.column(2).to_pylist()]
                packed = [np.ascontiguousarray(s.view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
                          for s in gram_sets(part.column(3).to_pylist(), known, words)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(own, pa.binary()), pa.array(packed, pa.binary())],
                                                 names=["node", "weight", "labels", "set"])

    return texts.mapInArrow(run, "node long, weight long, labels binary, set binary")


class Members:
    """Texts of one block: nodes, weights, labels, and sets."""

    def __init__(self, rows: list[dict]):
        self.nodes = np.array([row["node"] for row in rows], np.int64)
        self.weights = np.array([row["weight"] for row in rows], np.int64)
        self.labels = np.array([np.frombuffer(row["labels"], np.int64) for row in rows])
        self.sets = []
        for row in rows:
            wide = np.zeros((len(row["set"]) // 6, 8), np.uint8)
            wide[:, :6] = np.frombuffer(row["set"], np.uint8).reshape(-1, 6)
            self.sets.append(wide.view(np.uint64).ravel())
        self.sizes = np.array([len(s) for s in self.sets], np.int64)

    def places(self, tree: int, masks: list[int], before: list[int] | None) -> np.ndarray:
        """Prefixes under which a text met others before this tree: longer ones in all trees, and this round's in earlier trees."""
        now = self.labels[:, :tree] & np.array(masks[:tree], np.int64)
        return now if before is None else np.hstack([now, self.labels & np.array(before, np.int64)])


def shared_grams(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of each pair of sets."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left])
    owners = np.concatenate([np.repeat(np.arange(len(s), dtype=np.int32), [len(x) for x in s]) for s in (left, right)])
    side = np.repeat(np.array([False, True]), [sum(map(len, left)), sum(map(len, right))])
    every = np.concatenate([*left, *right])
    order = np.argsort(every, kind="stable")
    every, owners, side = every[order], owners[order], side[order]
    del order
    new = np.concatenate([[True], every[1:] != every[:-1]])
    ends = np.flatnonzero(np.concatenate([new[1:], [True]]))
    keep = np.repeat(np.diff(ends, prepend=-1) > 1, np.diff(ends, prepend=-1))  # grams of one text alone are in no intersection
    owners, side, gram = owners[keep], side[keep], np.cumsum(new[keep], dtype=np.int32) - 1
    del every, new, keep
    out = np.zeros((len(left), len(right)), np.float32)
    for begin in range(0, int(gram[-1]) + 1 if len(gram) else 0, GRAMS_AT_ONCE):
        a, b = np.searchsorted(gram, [begin, begin + GRAMS_AT_ONCE])
        x, y = np.zeros((len(left), GRAMS_AT_ONCE), np.float32), np.zeros((len(right), GRAMS_AT_ONCE), np.float32)
        on_left = ~side[a:b]
        x[owners[a:b][on_left], gram[a:b][on_left] - begin] = 1
        y[owners[a:b][~on_left], gram[a:b][~on_left] - begin] = 1
        out += x @ y.T
    return out


def newly_shared(left: Members, right: Members, tree: int, before: list[int] | None) -> np.ndarray:
    """As :func:`shared_grams`, but for the largest part that met under one longer prefix of the tree, whose pairs are left 0."""
    if before is None:
        return shared_grams(left.sets, right.sets)
    a, b = left.labels[:, tree] & before[tree], right.labels[:, tree] & before[tree]
    prefixes, sizes = np.unique(np.concatenate([a, b]), return_counts=True)
    met = prefixes[np.argmax(sizes)]
    out = np.zeros((len(a), len(b)), np.float32)
    for rows, columns in ((a != met, np.ones(len(b), bool)), (a == met, b != met)):
        if rows.any() and columns.any():
            out[np.ix_(rows, columns)] = shared_grams([left.sets[i] for i in np.flatnonzero(rows)],
                                                      [right.sets[i] for i in np.flatnonzero(columns)])
    return out


def links_between(left: Members, right: Members, bucket: int, masks: list[int], before: list[int] | None,
                  threshold: float) -> tuple[np.ndarray, float]:
    """Which pairs are at least as similar as the threshold and meet here first, and the least similarity of these."""
    tree, least = bucket >> 56, 1.0
    shared = newly_shared(left, right, tree, before)
    links = np.zeros(shared.shape, bool)
    mine, yours = left.places(tree, masks, before), right.places(tree, masks, before)
    for at in range(0, len(links), STRIP):
        strip = slice(at, at + STRIP)
        either = left.sizes[strip, None] + right.sizes - shared[strip].astype(float)
        near = (shared[strip] >= threshold * either - 1e-9) & (left.nodes[strip, None] != right.nodes)
        if near.any():
            near &= ~(mine[strip, None, :] == yours[None]).any(2)
            links[strip] = near
            least = min(least, float((shared[strip][near] / either[near]).min(initial=1.0)))
    return links, least


def _compared(rows: DataFrame, masks: list[int], before: list[int] | None, threshold: float) -> DataFrame:
    """``node, links, root, least`` from rows sorted by bucket, pair of blocks, block and node."""

    def run(batches):
        place, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                here = row["bucket"], row["left"], row["right"]
                if here != place:
                    if len(rows) > 1:
                        yield from finish(place, rows)
                    place, rows = here, []
                if not rows or rows[-1]["node"] != row["node"]:  # a text that is there twice, with its key
                    rows.append(row)
        if len(rows) > 1:
            yield from finish(place, rows)

    def finish(place, rows):
        bucket, left, right = place
        first = Members([row for row in rows if row["block"] == left])
        second = first if left == right else Members([row for row in rows if row["block"] == right])
        if not len(first.nodes) or not len(second.nodes):
            return
        links, least = links_between(first, second, bucket, masks, before, threshold)
        roots, other = linked_labels(links, first.nodes, second.nodes)
        out = [(first.nodes, links @ second.weights, roots)]
        if second is not first:
            out.append((second.nodes, links.T @ first.weights, other))
        for nodes, found, root in out:
            has = found > 0
            if has.any():
                columns = [pa.array(x[has]) for x in (nodes, found, root, np.full(len(nodes), least))]
                yield pa.RecordBatch.from_arrays(columns, names=["node", "links", "root", "least"])

    return rows.mapInArrow(run, "node long, links long, root long, least double")


def _met_in_round(leaves: DataFrame, sets: DataFrame, seen: list[DataFrame], masks: list[int], before: list[int] | None,
                  threshold: float) -> DataFrame:
    """Links of the texts under the prefixes of one round; the buckets compared go to ``seen``."""
    tree = F.shiftright("label", 56).cast("int")
    if before is not None:
        leaves = leaves.where(tree.isin([i for i, (a, b) in enumerate(zip(masks, before)) if a != b]))
    prefix = F.element_at(F.array(*[F.lit(mask) for mask in masks]), tree + 1)
    places = leaves.select("node", "grams", F.col("label").bitwiseAND(prefix).alias("bucket"))
    hashed = [F.bit_xor(F.xxhash64("node", F.lit(seed))).alias(f"h{seed}") for seed in (1, 2)]
    buckets = places.groupBy("bucket").agg(F.count("*").alias("size"), F.sum("grams").alias("grams"), *hashed).where("size > 1")
    # Buckets with the same members are kept once, in the first round and tree.
    buckets = buckets.groupBy("size", "h1", "h2").agg(F.min("bucket").alias("bucket"), F.max("grams").alias("grams"))
    for earlier in seen:
        buckets = buckets.join(earlier, ["size", "h1", "h2"], "left_anti")
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK_TEXTS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")
    seen.append(staged(buckets.select("size", "h1", "h2", "bucket", blocks.alias("blocks")), "buckets"))
    member = places.select("node", "bucket").join(seen[-1].select("bucket", "blocks"), "bucket").join(sets, "node")
    member = member.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    member = member.select("*", other).withColumn("left", F.least("block", "other")).withColumn("right", F.greatest("block", "other"))
    member = member.repartition(shuffle_partitions(leaves.sparkSession), "bucket", "left", "right")
    member = member.sortWithinPartitions("bucket", "left", "right", "node")
    return staged(_compared(member, masks, before, threshold), "links")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, threshold: float = THRESHOLD,
                    trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """``row, key, class_id, copy_id, n_links, kept`` for every row of ``docs``.

    Words are compared in lower case by their letters and digits; a text's n-grams are a set. ``n_links`` counts the other rows
    that are at least as similar as ``threshold``, ``copy_id`` is the smallest key among rows with the same n-grams, ``class_id`` the
    smallest key that links reach; ``kept`` is true for one row of each class, the first of those with that key. Texts with
    fewer than ``words`` words are one n-gram; texts without words, null ones included, link with nothing and are their
    own class, and an empty table gives no rows. Long texts are read whole. ``row`` numbers the rows, so repeated rows and null keys are rows of their own; null keys come last. Further
    columns are not read.
    """
    spark, last = docs.sparkSession, forest_depths(threshold, trees, depth, recall)
    rows = staged(_labelled(docs, key, text, words, trees, depth), "labelled-texts")
    texts = rows.where("grams > 0").groupBy("digest", "grams").agg(F.min("row").alias("node"), F.count("*").alias("weight"))
    texts = staged(texts, "texts")
    own = rows.select(F.col("row").alias("node"), "key", "of_text", "labels").join(texts.select("node", "grams", "weight"), "node")

    # The tries: labels that share their shortest prefix with another text, in their order, so that rows of one bucket lie together.
    stems = prefix_masks(last, depth)
    leaves = own.select("node", "grams", F.posexplode("labels").alias("tree", "label"))
    leaves = leaves.withColumn("stem", F.col("label").bitwiseAND(F.element_at(F.array(*[F.lit(mask) for mask in stems]), F.col("tree") + 1)))
    crowded = leaves.groupBy("stem").agg(F.count("*").alias("size")).where("size > 1").select("stem")
    leaves = leaves.join(crowded, "stem").select("node", "grams", "label")
    leaves = leaves.repartitionByRange(shuffle_partitions(spark), "label", "node").sortWithinPartitions("label", "node")
    leaves = staged(leaves, "sorted-labels")

    # by key and text, so that rows which share a key, or have none, don't meet each other
    whole = docs.select(F.col(key).alias("_key"), whole_text(F.col(text)).alias("text")).withColumn("_of_text", F.unhex(F.md5("text")))
    wanted = own.join(leaves.select("node").distinct(), "node")
    wanted = wanted.join(whole, F.col("key").eqNullSafe(F.col("_key")) & (F.col("of_text") == F.col("_of_text")))
    sets = staged(_with_sets(wanted.select("node", "weight", "labels", "text"), words), "sets")

    found, seen, before = None, [], None
    for depths in descent(last, depth):
        masks = prefix_masks(depths, depth)
        met = _met_in_round(leaves, sets, seen, masks, before, threshold)
        found, before = met if found is None else found.union(met), masks
        least = found.agg(F.min("least")).first()[0]
        if least is not None and chance(least, depths) >= recall:
            break

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b"))).groupBy("node").agg(F.min("root").alias("root"))
    of_text = texts.join(links, "node", "left").join(roots, "node", "left")
    of_text = staged(of_text.select("digest", "grams", "node", "weight", "links", F.coalesce(F.least("root", "node"), "node").alias("root")),
                     "text-results")
    of_row = rows.select("row", "key", "digest", "grams").join(of_text, ["digest", "grams"], "left")
    of_row = of_row.select("row", "key", F.coalesce("node", "row").alias("node"), F.coalesce("root", "row").alias("root"),
                           (F.coalesce("links", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1).alias("n_links"))
    of_row = staged(of_row, "row-results")
    smallest = F.min(F.struct(F.col("key").isNull(), F.col("key"), F.col("row"))).alias("least")
    classes = staged(of_row.groupBy("root").agg(smallest).select("root", F.col("least.key").alias("class_id"),
                                                                F.col("least.row").alias("keep_row")), "classes")
    copies = staged(of_row.groupBy("node").agg(smallest).select("node", F.col("least.key").alias("copy_id")), "copies")
    out = of_row.join(classes, "root").join(copies, "node")
    return out.select("row", F.col("key").alias(key), "class_id", "copy_id", "n_links", (F.col("row") == F.col("keep_row")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay, one of each class, with all their columns."""
    rows, own = with_unique_key(docs, key)
    kept = near_duplicates(rows, own, text, **options).where("kept").select(F.col(own).alias("kept"))
    return rows_with(rows, own, kept).select(*docs.columns)
