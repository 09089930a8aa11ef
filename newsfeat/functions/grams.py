"""N-grams of token lists as numbers, for tasks that read Arrow batches; needs neither Spark nor this package's other modules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def cut(lists: pa.Array, documents: int, terms: int) -> pa.Array:
    """The first lists, at most `documents` of them and `terms` words, but one list at least."""
    some = lists.slice(0, documents)
    ends = pc.cumulative_sum(pc.fill_null(pc.list_value_length(some), 0)).to_numpy(zero_copy_only=False)
    return some.slice(0, max(1, int((ends <= terms).sum())))


def slices(batch: pa.RecordBatch, column: str, terms: int) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of at most so many words of a list column; a longer list is a piece of its own."""
    at = 0
    while at < len(batch):
        size = len(cut(batch.column(column).slice(at), len(batch), terms))
        yield batch.slice(at, size)
        at += size


def word_codes(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Each word of the lists as the place of its list and of its text, and the distinct texts."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(lists), dtype=np.int64), lengths)
    encoded = lists.flatten().dictionary_encode(null_encoding="encode")
    return rows, encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary


def gram_codes(rows: np.ndarray, codes: np.ndarray, words: pa.Array, n: int = 1,
               masks: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Each n-gram of coded words as the place of its list and of its text, and the distinct texts (`a.b`).

    `masks` say for each of the n positions which of the words an n-gram may have there; others are left out.
    """
    starts = np.arange(max(0, len(codes) - n + 1))
    if masks is not None:
        good = [mask[codes] for mask in masks]
        starts = starts[np.logical_and.reduce([g[k:len(g) - n + 1 + k] for k, g in enumerate(good)])] if len(starts) else starts
    if n > 1:  # lists lie one after the other, so the ends tell
        starts = starts[rows[starts + n - 1] == rows[starts]]
    grams, names, base = codes[starts], words, max(1, len(words))
    for k in range(1, n):
        pairs, grams = np.unique(grams * base + codes[starts + k], return_inverse=True)
        names = pc.binary_join_element_wise(names.take(pa.array(pairs // base)), words.take(pa.array(pairs % base)), ".")
    return rows[starts], grams, names


def gram_masks(words: pa.Array, wanted: pa.Array, n: int) -> list[np.ndarray]:
    """For each position the words that some wanted n-gram has there; no word holds a point, so n-1 points tell an n-gram."""
    parts = pc.split_pattern(wanted, ".")
    parts = parts.filter(pc.equal(pc.list_value_length(parts), n))
    return [pc.is_in(words, pc.list_element(parts, k)).to_numpy(zero_copy_only=False) for k in range(n)]


def counts_in_lists(rows: np.ndarray, codes: np.ndarray, words: pa.Array, n: int = 1, masks: list[np.ndarray] | None = None,
                    wanted: pa.Array | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Each distinct n-gram of each list: the places of its list and of its text, its number there, and the distinct texts.

    With `masks` only n-grams of these words, with `wanted` only these n-grams.
    """
    if wanted is not None:
        masks = gram_masks(words, wanted, n)
    rows, grams, names = gram_codes(rows, codes, words, n, masks)
    if wanted is not None and n > 1:
        keep = pc.is_in(names, wanted).to_numpy(zero_copy_only=False)[grams]
        rows, grams = rows[keep], grams[keep]
    base = max(1, len(names))
    keys, counts = np.unique(rows * base + grams, return_counts=True)
    return keys // base, keys % base, counts, names
