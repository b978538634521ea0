"""Toxicity by a support vector machine with a gapped-subsequence string kernel.

The kernel compares two spans by the subsequences of :data:`ORDER` characters they share, begin and end marks included. Up to
:data:`GAP` other characters may stand between two of a subsequence's characters, each of which costs the factor
:data:`DECAY`; so ``i.d.i.o.t`` and ``idxiot`` still share most of ``idiot``. A Nyström map turns the kernel values against a few
landmark spans into features, and a linear machine with squared hinge loss is trained on these.

Training takes a bounded sample of labelled documents. Their sentences are cut into spans: words, and letters spelled one by
one. In a toxic document only few spans are toxic, so a span counts as a toxic example if it occurs in enough different
surroundings of toxic sentences and hardly ever in clean ones; every span of a clean sentence is a clean example, and those
that come nearest to the toxic ones are added in further rounds. A sentence scores as its highest span, a document as its
highest sentence, and a logistic curve fitted on the sample turns that into a probability.

Scoring reads whole texts in one pass without a shuffle. Because the kernel is a sum over subsequences, the landmarks' weights are
added up once into one weight for each subsequence.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.llm.common import staged

ORDER, GAP, DECAY = 4, 2, 0.8
#: Bounds of the training sample: documents of each label, toxic spans, clean spans, landmarks of each label.
MOST_DOCS, MOST_TOXIC, MOST_CLEAN, LANDMARKS = 8_000, 400, 12_000, 80
#: A span counts as a toxic example if its toxic surroundings are more than chance explains, at this level for all spans
#: together, or if they are as many as this share of the toxic documents (at least 3); in clean documents it may occur at most so often
#: against toxic ones. The first way's minimum grows with the logarithm of the number of spans only, so a rare insult is not
#: lost in a larger sample; the second one is for samples too small for the first.
LEVEL, LEAST_SHARE, MOST_RATIO = 0.01, 0.008, 0.05
LONGEST = 40
#: A worker's remembered spans are dropped beyond this count; the scores stay the same.
MOST_SPANS = 200_000

_GAPS = [g for g in product(range(1, GAP + 2), repeat=ORDER - 1)]
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_SENTENCE = re.compile(r"[.!?\n]+(?:\s+|$)")


def span_of(word: str) -> str:
    """A word without marks at its edges."""
    return word if word.isalnum() else _EDGE.sub("", word)


def spelled(words: list[str]) -> list[str]:
    """Runs of at least three single characters, joined."""
    singles, runs = [i for i, w in enumerate(words) if len(w) == 1], []
    begin = 0
    for at in range(1, len(singles) + 1):
        if at == len(singles) or singles[at] != singles[at - 1] + 1:
            if at - begin >= 3:
                runs.append("".join(words[singles[begin] : singles[at - 1] + 1]))
            begin = at
    return runs


def windows_of(word: str) -> list[str]:
    """A word of up to :data:`LONGEST` characters, or the overlapping windows of a longer one."""
    return [word[at : at + LONGEST] for at in range(0, max(1, len(word) - LONGEST // 2), LONGEST // 2)]


def subsequences(span: str) -> dict[str, float]:
    """Weights of a span's subsequences."""
    marked, found = f"\x02{span}\x03", {}
    for gaps in _GAPS:
        steps = np.concatenate([[0], np.cumsum(gaps)])
        weight = DECAY ** (sum(gaps) - len(gaps))
        for at in range(len(marked) - int(steps[-1])):
            key = "".join(marked[at + step] for step in steps)
            found[key] = found.get(key, 0.0) + weight
    return found


@dataclass
class Machine:
    """Weight of each subsequence, intercept, and the logistic curve over a document's highest span."""

    weights: dict[str, float]
    bias: float = -1.0
    slope: float = 1.0
    shift: float = 0.0

    def scorer(self) -> Scorer:
        return Scorer(self)

    def probability(self, highest: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.zeros(len(highest))
        return 1 / (1 + np.exp(-np.clip(self.slope * highest + self.shift, -60, 60)))


class Scorer:
    """Scores spans in bulk and remembers them."""

    def __init__(self, machine: Machine):
        self.bias, self.known = machine.bias, {}
        letters = sorted(set("".join(machine.weights)) | {"\x02", "\x03"})
        self.base = len(letters) + 1
        self.code = np.zeros(0x110000, np.uint8)
        self.code[[ord(c) for c in letters]] = np.arange(1, self.base)
        self.table = np.zeros(self.base**ORDER, np.float32)
        for key, weight in machine.weights.items():
            self.table[self._place([int(self.code[ord(c)]) for c in key])] = weight

    def _place(self, codes):
        place = 0
        for code in codes:
            place = place * self.base + code
        return place

    def spans(self, spans: list[str]) -> np.ndarray:
        """Scores of many spans at a time."""
        if not spans:
            return np.zeros(0)
        between = "\0" * (GAP + 1)  # wider than any gap, so nothing reaches into the next span
        joined = "".join(f"\x02{span}\x03{between}" for span in spans)
        codes = self.code[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.int32)
        begins = np.concatenate([[0], np.cumsum([len(span) + 3 + GAP for span in spans])[:-1]])
        total = np.zeros(len(codes), np.float32)
        codes = np.concatenate([codes, np.zeros(ORDER * (GAP + 1), np.int32)])
        for gaps in _GAPS:
            steps = np.concatenate([[0], np.cumsum(gaps)])
            place = self._place([codes[step : step + len(total)] for step in steps])
            total += np.float32(DECAY ** (sum(gaps) - len(gaps))) * self.table[place]
        return np.add.reduceat(total, begins) + self.bias

    def texts(self, texts: list[str]) -> np.ndarray:
        """Highest span of each text; the intercept where there is none."""
        words = [text.lower().split() for text in texts]
        for own in words:
            own += spelled(own)
        if len(self.known) > MOST_SPANS:
            self.known.clear()
        known = self.known
        new = list({word for own in words for word in own if word not in known})
        known.update(zip(new, self._words(new)))
        return np.array([max(map(known.__getitem__, own), default=self.bias) for own in words])

    def _words(self, words: list[str]) -> list[float]:
        """Long words are scored in overlapping windows."""
        cut, owner = [], []
        for i, word in enumerate(map(span_of, words)):
            for span in windows_of(word):
                cut.append(span)
                owner.append(i)
        if not words:
            return []
        scores = np.concatenate([self.spans(cut[at : at + 20_000]) for at in range(0, len(cut), 20_000)])
        return np.maximum.reduceat(scores, np.searchsorted(owner, np.arange(len(words)))).tolist()


def kernel(left: list[dict[str, float]], right: list[dict[str, float]]) -> np.ndarray:
    """Kernel values of spans given by their subsequences."""
    where: dict[str, list[tuple[int, float]]] = {}
    for j, own in enumerate(right):
        for key, weight in own.items():
            where.setdefault(key, []).append((j, weight))
    out = np.zeros((len(left), len(right)))
    for i, own in enumerate(left):
        for key, weight in own.items():
            for j, other in where.get(key, ()):
                out[i, j] += weight * other
    return out


def stretched(span: str) -> list[str]:
    """The span with a foreign character put in at each place, and at all places."""
    return [f"{span[:i]}{c}{span[i:]}" for i in range(1, len(span)) for c in ".x"] + ["-".join(span), "*".join(span)]


def fit(toxic: list[str], clean: list[str], landmarks: int = LANDMARKS, cost: float = 1000.0) -> Machine:
    """Nyström features on landmarks, the first toxic and the first clean spans, then Newton steps on the squared hinge loss."""
    if not toxic:
        return Machine({})
    chosen = [subsequences(span) for span in toxic[:landmarks] + clean[:landmarks]]
    gram = kernel(chosen, chosen)
    values, vectors = np.linalg.eigh(gram / gram.diagonal().mean())
    solid = values > 1e-6 * values.max()
    whiten = vectors[:, solid] / np.sqrt(values[solid]) / gram.diagonal().mean()
    positive = toxic + [other for span in toxic[:landmarks] for other in stretched(span)]
    clean = [*clean, ""]  # a span that shares nothing with any landmark is clean
    x = kernel([subsequences(s) for s in positive + clean], chosen) @ whiten
    x = np.hstack([x, np.ones((len(x), 1))])
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(clean))])
    weight = np.where(y > 0, 1 / len(positive), 4 / len(clean)) * cost * 100
    weight[-1] *= len(clean)
    w, active = np.zeros(x.shape[1]), np.ones(len(y), bool)
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(40):
        scaled = x[active] * weight[active, None]
        w = np.linalg.solve(ridge + scaled.T @ x[active], scaled.T @ y[active])
        now = y * (x @ w) < 1
        if (now == active).all():
            break
        active = now
    shares, weights = whiten @ w[:-1], {}
    for share, own in zip(shares, chosen):
        for key, value in own.items():
            weights[key] = weights.get(key, 0.0) + share * value
    return Machine(weights, float(w[-1]))


def boundary(highest: np.ndarray, toxic: np.ndarray) -> float:
    """The value with the fewest wrong sides, in the middle of the widest gap that has this number."""
    order = np.argsort(highest, kind="stable")
    x, y = highest[order], toxic[order]
    wrong = np.concatenate([[0], np.cumsum(y)]) + np.concatenate([np.cumsum((1 - y)[::-1])[::-1], [0]])
    edges = np.concatenate([[x[0] - 1], x, [x[-1] + 1]])
    gaps = np.diff(edges)
    wrong = np.where(gaps > 0, wrong, len(y) + 1)
    best = np.flatnonzero(wrong == wrong.min())
    at = best[np.argmax(gaps[best])]
    return float((edges[at] + edges[at + 1]) / 2)


def logistic(highest: np.ndarray, toxic: np.ndarray, threshold: float) -> tuple[float, float]:
    """Slope and shift of a logistic curve that takes ``threshold`` at the boundary; targets are kept off 0 and 1."""
    n1, n0 = toxic.sum(), (1 - toxic).sum()
    target = np.where(toxic > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    middle, offset, slope = boundary(highest, toxic), math.log(threshold / (1 - threshold)), 1.0
    x = highest - middle
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(slope * x + offset, -60, 60)))
        step = ((x * (p - target)).sum() + 1e-3 * slope) / ((x * x * p * (1 - p)).sum() + 1e-3)
        slope = min(max(slope - step, slope / 2), slope * 2)
    return slope, offset - slope * middle


def highest_spans(docs: DataFrame, machine: Machine, kept: list[str], text: str) -> DataFrame:
    """``kept`` columns of ``docs`` and ``highest``, the score of each whole text's highest span; a null text is empty."""
    picked = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = T.StructType([*picked.schema.fields[:-1], T.StructField("highest", T.DoubleType())])

    def run(batches):
        scorer = None
        for batch in batches:
            scorer = scorer or machine.scorer()
            texts = batch.column(batch.num_columns - 1)
            highest = [scorer.texts(texts[at : at + 500].to_pylist()) for at in range(0, len(texts), 500)]
            columns = batch.columns[:-1] + [pa.array(np.concatenate(highest) if highest else [], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "highest"])

    return picked.mapInArrow(run, schema)


def surprise(toxic: Column, clean: Column, usual: float) -> Column:
    """Minus the logarithm of a bound on the chance (Chernoff's) that so many of ``toxic + clean`` occurrences are toxic."""
    both, n = F.greatest(toxic + clean, F.lit(1)), toxic + clean
    seen = F.when(toxic > 0, toxic * F.log(toxic / (both * usual))).otherwise(0.0)
    unseen = F.when(clean > 0, clean * F.log(clean / (both * (1 - usual)))).otherwise(0.0)
    return F.when(toxic > n * usual, seen + unseen).otherwise(0.0)


def fold_of(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key counts as the empty text."""
    return (F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds).cast("int")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          threshold: float = 0.7, most_docs: int = MOST_DOCS) -> Machine:
    """Train on ``labels`` (``key, label``) and their texts in ``docs``: at most ``most_docs`` of each label, picked by a hash of
    the key. Scores from ``threshold`` on mean toxic. Labels other than 0 and 1 are left out. Without documents of both labels every score is 0."""
    known = labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("y")).where("y in (0, 1)").distinct()
    order = F.xxhash64("_key")
    sample = known.where("y = 1").orderBy(order).limit(most_docs).union(known.where("y = 0").orderBy(order).limit(most_docs))
    texts = docs.select(F.col(key).alias("_doc"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    picked = texts.join(F.broadcast(sample), F.col("_doc") == F.col("_key"))  # at most 2 * most_docs rows of two numbers
    picked = staged(picked.select("y", "text").distinct(), "labelled", 24)

    def cut(batches):
        for batch in batches:
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = set()
                for sentence in _SENTENCE.split(text):
                    words = [span_of(word) for word in sentence.lower().split()]
                    words += spelled(words)
                    for before, word, after in zip(["", *words], words, [*words[1:], ""]):
                        if 2 < len(word) <= LONGEST:
                            rows.add((word, f"{before} {after}" if y else ""))
                if rows:
                    spans, around = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([y] * len(rows), pa.int32()), pa.array(spans), pa.array(around)], names=["y", "span", "around"]
                    )

    sizes = {row["y"]: row["count"] for row in picked.groupBy("y").count().collect()}
    if len(sizes) < 2:
        return Machine({})
    spans = picked.mapInArrow(cut, "y int, span string, around string")
    once = spans.groupBy("span", "y", "around").agg(F.count("*").alias("n"))
    counts = once.groupBy("span").agg(F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("toxic"),
                                      F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("clean"))
    counts = staged(counts, "spans")
    share = F.col("clean") / sizes[0] <= MOST_RATIO * F.col("toxic") / sizes[1]
    least = max(3, int(LEAST_SHARE * sizes[1]))
    enough = (F.col("toxic") >= least) | (surprise(F.col("toxic"), F.col("clean"), sizes[1] / (sizes[0] + sizes[1]))
                                          >= math.log(max(1, counts.count()) / LEVEL))
    toxic = counts.where(enough & share).orderBy(F.desc("toxic"), "span").limit(MOST_TOXIC)
    toxic = [row["span"] for row in toxic.collect()]
    ordinary = counts.where("clean > 0").where(~enough | ~share).select("span")
    clean = [row["span"] for row in ordinary.orderBy(F.xxhash64("span")).limit(MOST_CLEAN // 2).collect()]
    machine = fit(toxic, clean)
    for _ in range(3):
        scored = highest_spans(ordinary, machine, ["span"], "span") if toxic else ordinary.withColumn("highest", F.lit(0.0))
        nearest = scored.where("highest > -1").orderBy(F.desc("highest"), "span").limit(MOST_CLEAN // 4).collect()
        clean = list(dict.fromkeys([row["span"] for row in nearest] + clean))
        machine = fit(toxic, clean)
    found = highest_spans(picked, machine, ["y"], "text").select("y", "highest").toPandas()  # two numbers per sampled document
    machine.slope, machine.shift = logistic(found["highest"].to_numpy(), found["y"].to_numpy(), threshold)
    return machine


def score(docs: DataFrame, machine: Machine, key: str = "doc_id", text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``key, score, predicted`` for every row; empty and null texts too. Repeated rows and null keys are kept."""
    found = highest_spans(docs.select(F.col(key).alias("_key"), F.col(text).alias("_t")), machine, ["_key"], "_t")
    exponent = F.greatest(F.lit(-60.0), F.least(F.lit(60.0), F.col("highest") * machine.slope + machine.shift))
    scored = F.lit(1.0) / (F.lit(1.0) + F.exp(-exponent)) if machine.weights else F.lit(0.0)
    found = found.select(F.col("_key").alias(key), scored.alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, machine: Machine, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, with all their columns; decided in the same pass."""
    if not machine.weights:
        return docs
    whole = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_t"))
    limit = (np.log(threshold / (1 - threshold)) - machine.shift) / machine.slope
    return highest_spans(whole, machine, ["_row"], "_t").where(F.col("highest") < float(limit)).select("_row.*")
