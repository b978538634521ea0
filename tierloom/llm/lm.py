"""Language-model scores of whole texts by a weighted backoff automaton.

The model: word n-grams with Dirichlet smoothing. With ``c`` for counts in the training texts,

    P(w | h) = (c(h w) + MASS * P(w | h')) / (c(h) + MASS)

where ``h'`` is ``h`` without its first word, and without history P(w) = (c(w) + 0.1) / (N + 0.1 (V + 1)), which leaves one share for
all unknown words. So a history that was seen is a state; it has an arc for each word seen after it and a failure arc to
the state of ``h'`` with weight MASS / (c(h) + MASS). The automaton reads a text from left to right, carries its state and adds up
logarithms: it follows failure arcs until a state has an arc for the word.

The counts come from all training texts and grow with them, so no task holds the whole automaton. Documents are read in blocks. A
block asks for the counts of the n-grams that occur in it and for the counts of their histories, and so gets all arcs that its
texts can reach. Its questions are its own counts at the same time: each n-gram's hash is dealt to the part that adds up its counts
from all blocks and answers each block. A frequent n-gram is there once for each block and not once for each place.
Hashes have 64 bits.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import numbering, shuffle_partitions, staged, whole_text, words_of

ORDER, MASS = 2, 200.0
#: Tokens of a block, and parts for each shuffle partition.
BLOCK, PARTS = 400_000, 4
START, END = xxhash.xxh64_intdigest(b"\t"), xxhash.xxh64_intdigest(b"\n")  # no word is one of these


def planes(values: np.ndarray) -> bytes:
    """Integers as bytes, all lowest bytes first: high bytes that are mostly zero then cost nothing once compressed."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def from_planes(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def _mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = (left ^ (left >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + right
    out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


class Grams:
    """The distinct n-grams of a block, order by order, from its texts laid end to end.

    Token 0 begins every text, token 1 ends it. ``at[k]`` has the n-gram of ``k + 1`` tokens that ends at each place, -1 where a text is
    too short for one; ``hashes[k]``, ``last[k]`` and ``head[k]`` have, for each of these n-grams, its hash, its last token and the
    n-gram before that.
    """

    def __init__(self, tokens: np.ndarray, words: np.ndarray, order: int):
        n = len(words)
        self.at, self.hashes, self.last, self.head = [tokens], [words], [np.arange(n)], [np.zeros(n, np.int64)]
        starts = tokens == 0
        for _ in range(1, order):
            before = np.full(len(tokens), -1, np.int64)
            before[1:] = np.where(starts[1:], -1, self.at[-1][:-1])
            there = before >= 0
            keys, inverse = np.unique(before[there] * n + tokens[there], return_inverse=True)
            at = np.full(len(tokens), -1, np.int64)
            at[there] = inverse
            head, last = keys // n, keys % n
            self.hashes.append(_mixed(self.hashes[-1][head], words[last]))
            self.at.append(at)
            self.head.append(head)
            self.last.append(last)


def build_automaton(grams: Grams, counts: list[np.ndarray], total: int, kinds: int, mass: float):
    """Arcs ``(state * tokens + token) -> logarithm``, the state after each token and the arcs that lead further, failure
    weights and targets, and the state of the start.

    State 0 has no history; the other states are the block's n-grams below the highest order that training has seen. Most
    arcs lead to the state of their token alone, so only the others carry a state.
    """
    n, order = len(grams.hashes[0]), len(grams.hashes)
    arcs: dict[int, float] = {}
    further: dict[int, int] = {}
    fail_weight, fail_to, states = [np.zeros(1)], [np.zeros(1, np.int64)], 1
    for k in range(order):
        if k == 0:
            probability, source, shorter = (counts[0] + 0.1) / (total + 0.1 * (kinds + 1)), np.zeros(n, np.int64), np.zeros(n, np.int64)
        else:
            # The suffix of an n-gram is the suffix of its head, prolonged by its last token.
            if k == 1:
                suffix = grams.last[1]
            else:
                keys = grams.head[k - 1] * n + grams.last[k - 1]  # sorted, as they come from np.unique
                suffix = np.searchsorted(keys, suffix[grams.head[k]] * n + grams.last[k])
            probability = (counts[k] + mass * probability[suffix]) / (counts[k - 1][grams.head[k]] + mass)
            source, shorter = state[grams.head[k]], state[suffix]
        seen = counts[k] > 0
        if k < order - 1:
            is_state = seen & (grams.last[k] != 1)  # nothing follows an end
            state = np.where(is_state, states + np.cumsum(is_state) - 1, shorter)
            states += int(is_state.sum())
            fail_weight.append(np.log10(mass / (counts[k][is_state] + mass)))
            fail_to.append(shorter[is_state])
            following = state
        else:
            following = shorter
        real = seen | (k == 0)  # without history there is an arc for every token
        keys = source * n + grams.last[k]
        arcs.update(zip(keys[real].tolist(), np.log10(probability[real]).tolist()))
        if k == 0:
            after = following
        longer = real & (following != after[grams.last[k]])
        further.update(zip(keys[longer].tolist(), following[longer].tolist()))
    start = int(after[0])
    return arcs, after.tolist(), further, np.concatenate(fail_weight).tolist(), np.concatenate(fail_to).tolist(), start


def traverse(automaton, width: int, tokens: list[int]) -> float:
    """Sum of the logarithms along one text's way; ``tokens`` without the start."""
    arcs, after, further, fail_weight, fail_to, state = automaton
    find, total = arcs.get, 0.0
    for token in tokens:
        arc = state * width + token
        weight = find(arc)
        while weight is None:
            total += fail_weight[state]
            state = fail_to[state]
            arc = state * width + token
            weight = find(arc)
        total += weight
        state = further.get(arc, after[token]) if further else after[token]
    return total


def _blocks(docs: DataFrame, key: str, text: str, held_out: Column, block: int) -> DataFrame:
    """One row for each block: its documents' keys, folds and lengths, their tokens as numbers, and the numbers' hashes."""
    picked = docs.select(F.col(key).alias("key"), held_out.alias("held"), whole_text(F.col(text)).alias("text"))
    kind = picked.schema["key"].dataType.simpleString()

    def run(batches):
        part, made = TaskContext.get().partitionId(), 0
        keys, held, sizes, ids, known = [], [], [], [], numbering()

        def finish():
            nonlocal made, known
            hashes = [START, END, *map(xxhash.xxh64_intdigest, list(known)[2:])]
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) + made]), pa.array([-1], pa.int32()), pa.array([pa.array(keys, key_type).to_pylist()], pa.list_(key_type)),
                    pa.array([held], pa.list_(pa.bool_())), pa.array([np.array(sizes, np.int64).tobytes()], pa.binary()),
                    pa.array([planes(np.concatenate(ids))], pa.binary()), pa.array([np.array(hashes, np.uint64).tobytes()], pa.binary()),
                ],
                names=["block", "part", "keys", "held", "sizes", "tokens", "hashes"],
            )
            made += 1
            for own in (keys, held, sizes, ids):
                own.clear()
            known = numbering()
            return row

        tokens = 0
        for batch in batches:
            key_type = batch.column(0).type
            for at in range(0, batch.num_rows, 200):
                piece = batch.slice(at, 200)
                for own_key, fold, text in zip(*(piece.column(i).to_pylist() for i in range(3))):
                    if not known:
                        known[b"\t"], known[b"\n"]
                    words = words_of(text.lower())  # bytes.lower knows A to Z only
                    own = np.fromiter(map(known.__getitem__, words), np.uint32, len(words))
                    ids.append(np.concatenate([np.array([0], np.uint32), own, np.array([1], np.uint32)]))
                    keys.append(own_key)
                    held.append(fold)
                    sizes.append(len(words) + 2)
                    tokens += len(words) + 2
                    if tokens >= block:
                        yield finish()
                        tokens = 0
        if keys:
            yield finish()

    return picked.mapInArrow(run, f"block long, part int, keys array<{kind}>, held array<boolean>, sizes binary, tokens binary, hashes binary")


def _grams_of(row: dict, order: int) -> tuple[Grams, np.ndarray, np.ndarray]:
    tokens = from_planes(row["tokens"], np.uint32).astype(np.int64)
    sizes = np.frombuffer(row["sizes"], np.int64)
    return Grams(tokens, np.frombuffer(row["hashes"], np.uint64), order), sizes, np.array(row["held"], bool)


def _dealt(grams: Grams, parts: int):
    """For each order: the n-grams in the order of part and hash, and where each part begins."""
    for hashes in grams.hashes:
        part = (hashes >> np.uint64(40)) % np.uint64(parts)
        order = np.lexsort((hashes, part))
        yield order, np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))


def _asked(blocks: DataFrame, order: int, parts: int) -> DataFrame:
    """``part, block, hashes, counts``: for each block and part the hashes (as differences) and training counts, per order."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                grams, sizes, held = _grams_of(row, order)
                training = np.repeat(~held, sizes)
                dealt = list(_dealt(grams, parts))
                counts = []
                for at, (turn, _) in zip(grams.at, dealt):
                    there = training & (at >= 0)
                    counts.append(np.bincount(at[there], minlength=len(turn)).astype(np.uint32)[turn])
                out = []
                for part in range(parts):
                    cuts = [slice(edges[part], edges[part + 1]) for _, edges in dealt]
                    hashes = [planes(np.diff(h[turn][cut], prepend=np.uint64(0)))
                              for h, (turn, _), cut in zip(grams.hashes, dealt, cuts)]
                    if any(hashes):
                        out.append((part, row["block"], hashes, [planes(c[cut]) for c, cut in zip(counts, cuts)]))
                    if len(out) == 64 or out and part == parts - 1:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                        out = []

    names, types = ["part", "block", "hashes", "counts"], [pa.int32(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.binary())]
    return blocks.mapInArrow(run, "part int, block long, hashes array<binary>, counts array<binary>")


def _answered(asked: DataFrame, order: int) -> DataFrame:
    """``block, part, counts, total, kinds``: each block's counts in all training texts; block -1 has a part's sums of tokens and
    of different tokens (the start is none)."""

    def run(batches):
        part, rows = None, []
        for batch in batches:
            for own in batch.to_pylist():
                if rows and own["part"] != part:
                    yield from finish(part, rows)
                    rows = []
                part = own["part"]
                rows.append(own)
        if rows:
            yield from finish(part, rows)

    def finish(part, rows):
        answers, total, kinds = [[] for _ in rows], 0, 0
        for k in range(order):
            hashes = [np.cumsum(from_planes(row["hashes"][k], np.uint64), dtype=np.uint64) for row in rows]
            counts = np.concatenate([from_planes(row["counts"][k], np.uint32) for row in rows])
            distinct, inverse = np.unique(np.concatenate(hashes), return_inverse=True)
            sums = np.bincount(inverse, weights=counts, minlength=len(distinct)).astype(np.uint64)
            if k == 0:
                tokens = sums[distinct != np.uint64(START)]
                total, kinds = int(tokens.sum()), int((tokens > 0).sum())
            at = 0
            for answer, own in zip(answers, hashes):
                answer.append(planes(sums[inverse[at : at + len(own)]]))
                at += len(own)
        out = [(row["block"], part, answer, None, None) for row, answer in zip(rows, answers)] + [(-1, part, None, total, kinds)]
        for at in range(0, len(out), 256):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out[at : at + 256]), types)], names=names)

    names = ["block", "part", "counts", "total", "kinds"]
    types = [pa.int64(), pa.int32(), pa.list_(pa.binary()), pa.int64(), pa.int64()]
    return asked.mapInArrow(run, "block long, part int, counts array<binary>, total long, kinds long")


def score_texts(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", order: int = ORDER,
                mass: float = MASS, block: int = BLOCK) -> DataFrame:
    """``key, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row, learning from those not held out.

    Tokens are words with A to Z in lower case, and one end for each text. ``base_score`` is the score without histories, ``score``
    that of the automaton of ``order``; both are base-10 logarithms. A null text is empty: its end alone. Null folds count as
    training, repeated rows and null keys are rows of their own, further columns are not read. Without training rows every token is
    unknown and both scores are 0 times their number.
    """
    spark = docs.sparkSession
    parts = PARTS * shuffle_partitions(spark)
    blocks = staged(_blocks(docs, key, text, F.coalesce(held_out, F.lit(False)), block), "lm-blocks")
    asked = _asked(blocks, order, parts).repartition(shuffle_partitions(spark), "part").sortWithinPartitions("part")
    answers = staged(_answered(asked, order), "lm-counts")
    sums = answers.where("block = -1").agg(F.sum("total"), F.sum("kinds")).first()
    total, kinds = (int(x or 0) for x in sums)
    kind = docs.schema[key].dataType.simpleString()
    both = blocks.withColumn("counts", F.lit(None).cast("array<binary>")).unionByName(
        answers.where("block >= 0").select("block", "part", "counts"), allowMissingColumns=True)
    both = both.repartition(shuffle_partitions(spark), "block").sortWithinPartitions("block", "part")

    def run(batches):
        row, answers = None, {}
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch.slice(i, 1).to_pylist()[0]
                if own["part"] == -1:
                    if row:
                        yield finish(row, answers, batch.schema.field("keys").type.value_type)
                    row, answers = own, {}
                else:
                    answers[own["part"]] = own["counts"]
        if row:
            yield finish(row, answers, batch.schema.field("keys").type.value_type)

    def finish(row, answers, key_type):
        grams, sizes, held = _grams_of(row, order)
        counts = []
        for k, (turn, _) in enumerate(_dealt(grams, parts)):
            found = np.concatenate([from_planes(answers[part][k], np.uint64) for part in sorted(answers)])
            own = np.empty(len(turn), np.int64)
            own[turn] = found.astype(np.int64)
            counts.append(own)
        automaton, width = build_automaton(grams, counts, total, kinds, mass), len(grams.hashes[0])
        tokens, begins = grams.at[0], np.concatenate([[0], np.cumsum(sizes)[:-1]])
        base = np.log10((counts[0] + 0.1) / (total + 0.1 * (kinds + 1)))
        known = (counts[0] > 0).astype(np.int64)
        base[0], known[0] = 0.0, 0  # the start is no token
        scores = [traverse(automaton, width, tokens[a + 1 : a + n].tolist()) for a, n in zip(begins, sizes)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(row["keys"], key_type), pa.array(held), pa.array(sizes - 1), pa.array(np.add.reduceat(known[tokens], begins)),
                pa.array([total] * len(sizes), pa.int64()), pa.array(np.add.reduceat(base[tokens], begins)), pa.array(scores, pa.float64()),
            ],
            names=names,
        )

    names = [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return both.mapInArrow(run, f"`{key}` {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
