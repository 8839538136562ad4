"""Tokens of each section of a text, from one encoding of the whole text.

A text is encoded once. The tokens' byte lengths give their spans, which are
joined with the spans of the sections. Sections are given in order and do not
overlap; what lies between them (here the line feeds) belongs to none.

The rule for a token that touches several sections: it counts for the one that
holds most of its bytes, the earlier one if two hold equally many. A token that
touches no section counts for section -1. So the counts of a text add up to the
length of its encoding.

Nulls: a null text has no tokens and no section, and gives one row of section -1
with 0 tokens; so does the empty text. Repeated rows each give their rows.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.llm.tables import mapped, texts_of

# Fixed value: how the vocabularies named here cut a text before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Where the vocabulary of the registered query lies, on the driver.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

Sections = Callable[[bytes], tuple[np.ndarray, np.ndarray]]


def lines(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the lines that are not empty."""
    feeds = np.flatnonzero(np.frombuffer(text, np.uint8) == 10)
    start = np.concatenate(([0], feeds + 1))
    end = np.concatenate((feeds, [len(text)]))
    full = end > start
    return start[full], end[full]


def attribute(length: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token (-1: none), and whether it touches several.

    ``length`` are the tokens' byte lengths, ``start`` and ``end`` the sections'.
    """
    stop = np.cumsum(length)
    begin = stop - length
    low = np.searchsorted(end, begin, "right")  # first section that ends after the token begins
    high = np.searchsorted(start, stop, "left")  # first one that starts at its end or later
    touched = high - low
    owner = np.where(touched > 0, low, -1)
    for i in np.flatnonzero(touched > 1).tolist():
        each = slice(low[i], high[i])
        held = np.minimum(end[each], stop[i]) - np.maximum(start[each], begin[i])
        owner[i] = low[i] + int(held.argmax())
    return owner, touched > 1


def _encoder(ranks: bytes, pattern: str):
    import tiktoken

    merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    size = np.zeros(max(merges.values()) + 1, np.int64)
    for piece, rank in merges.items():
        size[rank] = len(piece)
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=merges, special_tokens={}), size


def count_by_section(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
    sections: Sections = lines,
) -> DataFrame:
    """Rows (doc_id, section, byte_start, byte_end, n_tokens, n_shared, doc_tokens).

    ``n_shared`` are those of the section's tokens that touch other sections too.
    The vocabulary is read on the driver and sent to the tasks; its size does not
    depend on the data.
    """
    with open(vocabulary, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    ready: list = []

    def step(batch: pa.RecordBatch) -> Iterator[dict]:
        if not ready:
            ready.append(_encoder(ranks.value, pattern))
        encoder, size = ready[0]
        out: list[list[np.ndarray]] = []
        ids: list = []
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
            length = size[encoder.encode_to_numpy(text, disallowed_special=())]
            start, end = sections(text.encode("utf-8", "surrogatepass"))
            owner, shared = attribute(length, start, end)
            tokens = np.bincount(owner + 1, minlength=len(start) + 1)
            crossing = np.bincount(owner[shared] + 1, minlength=len(start) + 1)
            number = np.arange(-1, len(start))
            # Section -1 is told only if it has tokens, or if there is nothing else to tell.
            skip = int(tokens[0] == 0 and len(start) > 0)
            none = [-1]
            columns = (number, np.append(none, start), np.append(none, end), tokens, crossing)
            out.append([c[skip:] for c in columns] + [np.full(len(number) - skip, len(length))])
            ids += [doc_id] * (len(number) - skip)
        parts = [np.concatenate(c) for c in zip(*out)]
        names = ("section", "byte_start", "byte_end", "n_tokens", "n_shared", "doc_tokens")
        yield {"doc_id": ids, **dict(zip(names, parts))}

    return mapped(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        step,
        "doc_id long, section int, byte_start long, byte_end long, n_tokens long, n_shared long, doc_tokens long",
    )


def op9_section_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Tokens of every line of every document."""
    return count_by_section(docs, vocabulary)
