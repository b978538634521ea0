"""Alert notes, chunking and grounded prompts."""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierloom.functions.columns import first_match, money_text, part_label
from tierloom.operators.alerts import CANCELLED, HIGH_VALUE, PENDING
from tierloom.operators.batches import cuts
from tierloom.session import carry_to_workers

carry_to_workers(__name__)

# The wording of the four notes. Names in braces are columns, {$name} is money.
NOTE_TEXTS = {
    HIGH_VALUE: "{customer_name} in {region} region is a high-value account with {$total_spend} in total spend across "
    "{total_orders} orders. Recommend priority outreach to maintain engagement and explore upsell opportunities.",
    PENDING: "{customer_name} has {pending_orders} pending order(s) requiring follow-up. Total historical spend is "
    "{$total_spend}. Recommend contacting to confirm order status and resolve any blockers before the order lapses.",
    CANCELLED: "{customer_name} has {cancelled_orders} cancelled order(s), which may indicate dissatisfaction or a "
    "competitive loss. Recommend a retention call to understand the cancellation reason and rebuild the relationship.",
}
NOTE_OTHERWISE = (
    "{customer_name} shows no active alerts. Standard cadence outreach is sufficient; no immediate action required."
)

# The prompt around the context, and the answer without one.
PROMPT_HEAD = (
    "Answer the question using ONLY the context below. If the context does not contain enough information to answer, "
    'say "I don\'t have enough information to answer this."\n\nContext:\n'
)
NO_ANSWER = "I don't have enough information to answer this."

# Chunk size, overlap, and the boundaries from strongest to weakest.
CHUNK_SIZE = 400
CHUNK_OVERLAP = 60
SEPARATORS = ("\n\n", "\n", ". ", " ", "")

#: Texts and bytes that a worker splits at a time.
PIECE_ROWS, PIECE_BYTES = 500, 1 << 20


def fill_template(template: str) -> Column:
    """A text with ``{column}`` and ``{$column}`` (money) places as one concatenation."""
    parts = []
    for piece in re.split(r"(\{[^}]+\})", template):
        if piece.startswith("{$"):
            parts.append(money_text(piece[2:-1]))
        elif piece.startswith("{"):
            parts.append(F.col(piece[1:-1]).cast("string"))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)


def alert_notes(targets: DataFrame) -> DataFrame:
    """Add ``alert_note``, the text for a customer's alert, and its record id ``note_id``."""
    cases = [(F.col("alert_reason") == alert, fill_template(template)) for alert, template in NOTE_TEXTS.items()]
    return targets.withColumns(
        {
            "alert_note": first_match(cases, fill_template(NOTE_OTHERWISE)),
            "note_id": F.concat(F.lit("alert_note_"), F.col("customer_id").cast("string")),
        }
    )


def split_text(text: str, size: int, overlap: int, separators: Sequence[str]) -> list[str]:
    """Chunks of at most ``size`` characters that break at the strongest boundary possible.

    A separator stays at the head of the piece that follows it. A piece without any usable boundary is cut between
    characters if ``""`` is among the separators and kept whole otherwise.
    """
    level = next((i for i, s in enumerate(separators) if s == "" or s in text), len(separators) - 1)
    separator, weaker = separators[level], separators[level + 1 :]
    chunks: list[str] = []
    short: list[str] = []
    for piece in _pieces(text, separator):
        if len(piece) < size:
            short.append(piece)
            continue
        chunks += _pack(short, size, overlap)
        short = []
        chunks += split_text(piece, size, overlap, weaker) if weaker else [piece]
    return chunks + list(_pack(short, size, overlap))


def _pieces(text: str, separator: str) -> Iterable[str]:
    if not separator:
        return text
    first, *rest = text.split(separator)
    return filter(None, [first, *(separator + part for part in rest)])


def _pack(pieces: Iterable[str], size: int, overlap: int) -> Iterator[str]:
    """Join short pieces up to ``size``; a new chunk starts with the last pieces that fit into ``overlap``."""
    held: deque[str] = deque()
    length = 0
    for piece in pieces:
        if length + len(piece) > size:
            yield from _trimmed(held)
            while length > overlap or (length and length + len(piece) > size):
                length -= len(held.popleft())
        held.append(piece)
        length += len(piece)
    yield from _trimmed(held)


def _trimmed(held: Iterable[str]) -> Iterator[str]:
    text = "".join(held).strip()
    if text:
        yield text


def chunk_recursive(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: Sequence[str] = SEPARATORS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per chunk of each whole text: id, ``chunk_index``, ``total_chunks``, ``chunk_label``, ``chunk_text``.

    Splitting follows the data partitioning and shuffles nothing; ids are ``<document id>#<index>`` because a counter
    over all documents would need a total order. ``keep`` names further document columns to repeat on each chunk.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")

    # Not a function of the column: the optimizer would repeat it in the filter for texts with chunks, and so split twice.
    picked = docs.select(id_col, *keep, F.col(text_col).alias("__text"))
    schema = T.StructType([*picked.schema.fields[:-1], T.StructField("__chunks", T.ArrayType(T.StringType()))])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            lengths = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
            for begin, end in cuts(lengths, PIECE_ROWS, PIECE_BYTES):
                part = texts.slice(begin, end - begin).to_pylist()
                chunks = [split_text(text, size, overlap, separators) if text else [] for text in part]
                columns = [column.slice(begin, end - begin) for column in batch.columns[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(chunks, pa.list_(pa.string()))], names=schema.names)

    return _numbered(picked.mapInArrow(split, schema), id_col, "__chunks", keep)


def _numbered(chunked: DataFrame, id_col: str, chunks: str, keep: Sequence[str]) -> DataFrame:
    exploded = chunked.select(
        id_col, *keep, F.size(chunks).alias("total_chunks"), F.posexplode(chunks).alias("chunk_index", "chunk_text")
    )
    return exploded.select(
        F.concat_ws("#", F.col(id_col).cast("string"), F.col("chunk_index").cast("string")).alias("chunk_id"),
        id_col,
        *keep,
        "chunk_index",
        "total_chunks",
        part_label("chunk_index", "total_chunks").alias("chunk_label"),
        "chunk_text",
    )


def chunk_fixed(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Windows of ``size`` characters, each starting ``size - overlap`` after the previous one; no text, no chunk."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and below size")
    # One walk over the text: each step looks ahead a whole window and moves on by less. Cutting substrings by position
    # would count characters from the start of the text for every window.
    step = f"(?s)(?=(.{{1,{size}}})).{{1,{size - overlap}}}"
    windows = F.regexp_extract_all(F.col(text_col), F.lit(step), F.lit(1))
    chunked = docs.select(id_col, *keep, windows.alias("__chunks"))
    return _numbered(chunked, id_col, "__chunks", keep)


def grounded_prompts(
    queries: DataFrame, hits: DataFrame, query_id: str = "query_id", query_text: str = "query_text"
) -> DataFrame:
    """For all questions at once: the prompt with its context, the sources by rank, or the fallback answer.

    ``hits`` has the query id, ``rank``, ``source`` and ``text``; a question has at most top-k of them.
    """
    blocks = F.array_sort(F.collect_list(F.struct("rank", "source", "text")))
    per_query = hits.groupBy(query_id).agg(blocks.alias("blocks"))
    context = F.array_join(
        F.transform("blocks", lambda b: F.concat(F.lit("["), b["source"], F.lit("]: "), b["text"])), "\n\n"
    )
    prompt = F.concat(F.lit(PROMPT_HEAD), context, F.lit("\n\nQuestion: "), F.col(query_text), F.lit("\n\nAnswer:"))
    return queries.join(per_query, query_id, "left").select(
        query_id,
        query_text,
        prompt.alias("prompt"),
        F.when(F.col("blocks").isNull(), F.lit(NO_ANSWER)).alias("answer"),
        F.coalesce(F.transform("blocks", lambda b: b["source"]), F.array().cast("array<string>")).alias("sources"),
    )
