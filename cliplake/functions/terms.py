"""Terms of whole texts, counted inside Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cliplake.functions import text

# Bytes of text that are counted at once; a longer text is counted by itself.
BLOCK = 1 << 22
SEPARATORS = f"[{text.PUNCTUATION}{text.WHITE_SPACE}]+"


def blocks(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows whose texts have about ``BLOCK`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    numbers = (np.cumsum(sizes, dtype=np.int64) - sizes) // BLOCK
    starts = np.flatnonzero(np.diff(numbers, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(numbers)]):
        yield batch.slice(start, end - start)


def counted(lowered: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Number of tokens and the terms of each lower-case text, most frequent first, ties by position.

    Null texts give nulls.
    """
    tokens = pc.split_pattern_regex(lowered, SEPARATORS)
    rows, found = pc.list_parent_indices(tokens), tokens.flatten()
    held = pc.not_equal(pc.binary_length(found), 0)
    rows = pc.filter(rows, held).to_numpy().astype(np.int64)
    encoded = pc.filter(found, held).dictionary_encode()
    codes, words = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary
    lengths = np.bincount(rows, minlength=len(lowered))
    keys, first, counts = np.unique(
        rows * max(len(words), 1) + codes, return_index=True, return_counts=True
    )
    order = np.lexsort((first, -counts, rows[first]))
    first, counts = first[order], counts[order]
    terms = pa.StructArray.from_arrays(
        [
            words.take(pa.array(codes[first])),
            pa.array(counts.astype(np.int64)),
            pa.array((first - (np.cumsum(lengths) - lengths)[rows[first]]).astype(np.int32)),
        ],
        ["term", "n", "position"],
    )
    ends = np.cumsum(np.bincount(rows[first], minlength=len(lowered)))
    offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
    null = lowered.is_null()
    listed = pa.ListArray.from_arrays(offsets, terms, mask=null)
    return pa.array(lengths.astype(np.int32), mask=null.to_numpy(zero_copy_only=False)), listed


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, content) as (doc_id, length, terms)."""
    for batch in batches:
        for block in blocks(batch, "content"):
            length, terms = counted(block.column("content"))
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), length, terms], ["doc_id", "length", "terms"]
            )
