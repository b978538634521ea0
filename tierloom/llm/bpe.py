"""Byte-level BPE by longest matches and backtracking.

A piece of text is encoded from left to right. At each place the longest vocabulary entry is tried first, then its shorter
prefixes. An entry may follow the one before it only if the two stay apart when their joined bytes are merged by rank;
a sequence whose neighbours all stay apart is exactly the one that the merges give. These answers are remembered. A place from
which nothing fits is closed and the entry that led to it is taken back, so every place is left at most once and the work
is linear in the piece.

The automaton works on strings, so bytes are mapped to the 256 Latin-1 characters.
"""

from __future__ import annotations

import base64
import hashlib

import ahocorasick
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierloom.llm.common import whole_text

#: Remembered entries are dropped beyond these counts, so a worker's memory has a bound; the ids stay the same.
MOST_CHUNKS, MOST_PAIRS, LONGEST_CHUNK = 500_000, 400_000, 40


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: per line an entry in base 64 and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(entry): int(rank) for entry, rank in (line.split() for line in lines if line.strip())}


class Pairs(dict):
    """Whether two entries may stand side by side, remembered by (left, right).

    While the merges build the left entry, the part at its right end grows step by step, and so does the part at the left end
    of the right entry. A part lives from its own rank until the rank of the part that takes it up. Two end parts that live
    at the same time come together if their joined bytes have a rank before either is taken up; on equal ranks the merge
    further left goes first. Only if that never happens the entries stay apart.
    """

    def __init__(self, entries: dict[int, bytes], ranks: dict[bytes, int]):
        super().__init__()
        self.entries, self.ranks = entries, ranks
        self.rights: dict[int, list] = {}
        self.lefts: dict[int, list] = {}

    def __missing__(self, pair):
        if len(self) >= MOST_PAIRS:
            self.clear()
        left, right = pair
        kept = self[pair] = self._apart(
            self.rights.get(left) or self._ends(left, 1, self.rights), self.lefts.get(right) or self._ends(right, 0, self.lefts)
        )
        return kept

    def _ends(self, rank: int, side: int, memo: dict) -> list[tuple[bytes, int, int]]:
        """End parts from the whole entry down to one byte: bytes, rank of birth, rank at which it is taken up."""
        ends, part, until = [], self.entries[rank], 1 << 60
        while len(part) > 1:
            born = self.ranks[part]
            ends.append((part, born, until))
            part, until = merged(part, self.ranks, born)[-side], born
        memo[rank] = [*ends, (part, -1, until)]
        return memo[rank]

    def _apart(self, rights: list, lefts: list) -> bool:
        i = j = 0
        while i < len(rights) and j < len(lefts):
            (a, born_a, until_a), (b, born_b, until_b) = rights[i], lefts[j]
            joined = self.ranks.get(a + b)
            if joined is not None and joined < until_a and joined <= until_b:
                return False
            if born_a >= born_b:
                i += 1
            else:
                j += 1
        return True


def merged(piece: bytes, ranks: dict[bytes, int], before: int = 1 << 60) -> list[bytes]:
    """Merges by rank, the plain way, with ranks below ``before`` only; used on single entries."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], before), i) for i in range(len(parts) - 1))
        if rank >= before:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Codec:
    """Encoder and decoder for one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"the ranks lack the single bytes {missing[:5]}")
        self.entries = {rank: entry for entry, rank in ranks.items()}
        self.lengths = {rank: len(entry) for entry, rank in ranks.items()}
        self.by_text = {entry.decode("latin-1"): rank for entry, rank in ranks.items()}
        self.widest = max(self.lengths.values())
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for entry, rank in self.by_text.items():
            self.automaton.add_word(entry, rank)
        self.automaton.make_automaton()
        self.shorter = {rank: self._longest_prefix(entry[:-1], ranks) for entry, rank in ranks.items()}
        self.pairs = Pairs(self.entries, ranks)
        self.find = regex.compile(pattern).findall
        self.chunks: dict[str, tuple[int, ...]] = {}

    @staticmethod
    def _longest_prefix(head: bytes, ranks: dict[bytes, int]) -> int | None:
        return next((ranks[head[:n]] for n in range(len(head), 0, -1) if head[:n] in ranks), None)

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        text, size = piece.decode("latin-1"), len(piece)
        prefix, widest, known = self.automaton.longest_prefix, self.widest, self.by_text
        lengths, pairs, shorter = self.lengths, self.pairs, self.shorter
        closed = bytearray(size + 1)
        ids: list[int] = []
        at, candidate = 0, None
        fresh = True
        while at < size:
            if fresh:  # the longest entry that starts here: the automaton gives the longest start of any entry
                end = at + prefix(text[at : at + widest])
                candidate = known.get(text[at:end])
                while candidate is None:
                    end -= 1
                    candidate = known.get(text[at:end])
            while candidate is not None:
                end = at + lengths[candidate]
                if not closed[end] and (not ids or pairs[ids[-1], candidate]):
                    break
                candidate = shorter[candidate]
            fresh = candidate is not None
            if fresh:
                ids.append(candidate)
                at = end
            else:
                closed[at] = 1
                candidate = ids.pop()
                at -= lengths[candidate]
        return ids

    def _pieces(self, text: str) -> list[int]:
        known = self.chunks
        ids: list[int] = []
        for piece in self.find(text):
            ids += known.get(piece) or self._piece(piece)
        return ids

    def _piece(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        whole = self.by_text.get(raw.decode("latin-1"))
        ids = tuple(self.encode_piece(raw)) if whole is None else (whole,)
        self._remember(piece, ids)
        return ids

    def _remember(self, text: str, ids: tuple[int, ...]) -> None:
        if len(text) <= LONGEST_CHUNK:
            if len(self.chunks) >= MOST_CHUNKS:
                self.chunks.clear()
            self.chunks[text] = ids

    def _chunk(self, chunk: str) -> tuple[int, ...] | None:
        """Ids of a chunk that begins with its space, or None if it can't be taken by itself."""
        if len(chunk) < 2 or chunk[1].isspace() or chunk[-1].isspace():
            return None
        ids = tuple(self._pieces(chunk))
        self._remember(chunk, ids)
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text.

        Pieces start at a space that stands between two other characters, since no piece holds white space and then something
        else, except for one leading space. So a text falls apart into chunks at such spaces, and chunks seen before are
        looked up. Other texts are taken as one.
        """
        first, *rest = text.split(" ")
        if not first or first[-1].isspace():
            return self._pieces(text)
        known, ids = self.chunks, self._pieces(first)
        for chunk in map(" ".__add__, rest):
            found = known.get(chunk) or self._chunk(chunk)
            if found is None:
                return self._pieces(text)
            ids += found
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids))


#: What :func:`transcode` can return for each text.
OUTPUTS = {
    "ids": ("array<int>", pa.list_(pa.int32()), lambda ids, raw: ids),
    "n_tokens": ("long", pa.int64(), lambda ids, raw: len(ids)),
    "ids_sha256": ("string", pa.string(), lambda ids, raw: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()),
    "decoded": ("binary", pa.binary(), lambda ids, raw: raw),
    "decoded_sha256": ("string", pa.string(), lambda ids, raw: hashlib.sha256(raw).hexdigest()),
}


def transcode(
    docs: DataFrame,
    key: str = "doc_id",
    text: str | Column = "text",
    outputs: tuple[str, ...] = ("ids", "decoded"),
    ranks_path: str = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """Encode each whole text and decode its ids again: ``key`` and the columns named in ``outputs``.

    One pass without a shuffle; every input row gives one row, repeated rows too. A null text is an empty one, with no ids. A
    null key is kept. Other columns, whatever their names, are not read.
    """
    unknown = set(outputs) - set(OUTPUTS)
    if unknown:
        raise ValueError(f"unknown outputs {sorted(unknown)}")
    picked = docs.select(F.col(key).alias("_key"), whole_text(F.col(text) if isinstance(text, str) else text).alias("_text"))

    def run(batches):
        codec = None
        for batch in batches:
            codec = codec or Codec(read_ranks(ranks_path), pattern)
            columns = [[] for _ in outputs]
            for text in batch.column(1):
                ids = codec.encode(text.as_py().decode())
                raw = codec.decode(ids)
                for column, name in zip(columns, outputs):
                    column.append(OUTPUTS[name][2](ids, raw))
            arrays = [batch.column(0), *(pa.array(c, OUTPUTS[n][1]) for c, n in zip(columns, outputs))]
            yield pa.RecordBatch.from_arrays(arrays, names=[key, *outputs])

    kind = picked.schema["_key"].dataType.simpleString()
    return picked.mapInArrow(run, ", ".join([f"`{key}` {kind}", *(f"`{n}` {OUTPUTS[n][0]}" for n in outputs)]))
