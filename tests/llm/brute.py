"""Plain versions of the operators, for small tables."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def closure(n, pairs):
    """Smallest member of each of n items' group."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def grams(text, size=5):
    words = ["".join(c for c in w.decode() if c.isalnum()) for w in (text or "").lower().encode().split()]
    words = [w for w in words if w]
    width = min(size, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def jaccard_links(texts, threshold=0.8):
    """Links and group of each text."""
    sets, where, shared = [grams(t) for t in texts], defaultdict(list), Counter()
    for i, own in enumerate(sets):
        for gram in own:
            shared.update((j, i) for j in where[gram])
            where[gram].append(i)
    pairs = [(a, b) for (a, b), n in shared.items() if n >= threshold * (len(sets[a]) + len(sets[b]) - n) - 1e-9]
    degree = Counter(i for pair in pairs for i in pair)
    return [degree[i] for i in range(len(texts))], closure(len(texts), pairs)


def without_repeats(texts, window=35):
    """Words, words removed and kept text of each text."""
    split, seen = [(t or "").encode().split() for t in texts], Counter()
    for words in split:
        seen.update(tuple(words[i : i + window]) for i in range(len(words) - window + 1))
    out = []
    for words in split:
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if seen[tuple(words[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((len(words), sum(gone), kept))
    return out


def exact(rows):
    """(keep_id, group_size, text hash) of each (doc_id, text)."""
    norm = [(text or "").translate({ord(c): None for c in " \t\n\x0b\f\r"}) for _, text in rows]
    groups = defaultdict(list)
    for (doc_id, text), own in zip(rows, norm):
        groups[own].append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    return [(min(groups[own], key=lambda x: x[:3])[3], len(groups[own]), sha(own)) for own in norm]


def language_model(rows, mass, order=2):
    """(n_tokens, n_known, train_tokens, base, score) of each (doc_id, text), with histories up to order - 1."""
    split = [["<s>", *(text or "").encode().lower().split(), "</s>"] for _, text in rows]
    counts = Counter()
    for (doc_id, _), words in zip(rows, split):
        if zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10:
            for n in range(1, order + 1):
                counts.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    single = {g[0]: c for g, c in counts.items() if len(g) == 1 and g[0] != "<s>"}
    total, kinds = sum(single.values()), len(single)

    def probability(gram):
        if len(gram) == 1:
            return (single.get(gram[0], 0) + 0.1) / (total + 0.1 * (kinds + 1))
        return (counts[gram] + mass * probability(gram[1:])) / (counts[gram[:-1]] + mass)

    out = []
    for words in split:
        base = sum(math.log10(probability((w,))) for w in words[1:])
        score = sum(math.log10(probability(tuple(words[max(0, i - order + 1) : i + 1]))) for i in range(1, len(words)))
        out.append((len(words) - 1, sum(w in single for w in words[1:]), total, base, score))
    return out
