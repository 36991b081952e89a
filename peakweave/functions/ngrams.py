"""N-grams that texts share with their references, counted row by row on whole Arrow batches.

The tokens of a batch become numbers, an n-gram a number made of its prefix's and its last
token's, renumbered where 62 bits would not hold it, so equal numbers are equal n-grams. One
sort per order brings a text's equal n-grams together, the prediction's before the references'.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tokens that are worked on at once; a longer text is worked on alone.
BLOCK = 1 << 16
SHARED = "struct<each:array<array<bigint>>,most:array<bigint>>"
SPELLED = "array<struct<order:int,gram:string,n:bigint,hits:array<struct<k:int,n:bigint>>>>"


def _bits(n: int) -> int:
    return max(int(n) - 1, 0).bit_length()


def gram_runs(codes: np.ndarray, sequence: np.ndarray, text: np.ndarray, side: np.ndarray, order: int,
              spell: bool = False) -> Iterator[tuple]:
    """For the orders from 1 on, one row per distinct n-gram of a sequence: (text, side, count, group, first, gram, made).

    A token has a code and the number of its sequence, a sequence its text and its side (0: the
    prediction). Rows of a text's n-gram share a `group`, sides ascending; `first` are the rows that begin one.
    To `spell` n-grams, they are numbered from 0 by order, and `made` has the number of each one's prefix and its last token.
    """
    text_bits, side_bits = _bits(text.max(initial=0) + 1), _bits(side.max(initial=0) + 1)
    code_bits = width = _bits(codes.max(initial=0) + 1)
    gram = codes.astype(np.int64)
    place = (text.astype(np.int64)[sequence], side.astype(np.int64)[sequence])
    made = None
    for n in range(1, order + 1):
        if n > 1:
            whole = np.flatnonzero(sequence[: len(gram) - 1] == sequence[n - 1 :]) if len(gram) > 1 else np.zeros(0, dtype=np.int64)
            if not spell and width + code_bits + text_bits + side_bits > 62:
                known, gram = np.unique(gram, return_inverse=True)
                width = _bits(len(known))
            # starts keep their places: where a sequence ends, what is put together is left out
            gram = (gram[:-1] << code_bits) | codes[n - 1 :]
            width += code_bits
            if spell:
                known, gram = np.unique(gram, return_inverse=True)
                width, made = _bits(len(known)), (known >> code_bits, known & ((1 << code_bits) - 1))
        else:
            whole = slice(None)
        keys = np.sort((((place[0][: len(gram)] << width | gram) << side_bits) | place[1][: len(gram)])[whole])
        new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
        count = np.diff(np.append(new, len(keys)))
        keys = keys[new]
        owner = keys >> side_bits
        begins = np.concatenate([[True], owner[1:] != owner[:-1]]) if len(keys) else np.zeros(0, dtype=bool)
        yield (owner >> width, keys & ((1 << side_bits) - 1), count, np.cumsum(begins) - 1, np.flatnonzero(begins),
               owner & ((1 << width) - 1), made)


def _sides(lengths: np.ndarray, n_refs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token its sequence, per sequence its text and side; first the predictions, then the references text by text."""
    texts = len(n_refs)
    owner = np.repeat(np.arange(texts), n_refs)
    place = np.arange(len(owner)) - (np.cumsum(n_refs) - n_refs)[owner] + 1
    return (np.repeat(np.arange(texts + len(owner)), lengths), np.concatenate([np.arange(texts), owner]),
            np.concatenate([np.zeros(texts, dtype=np.int64), place]))


def _shared(codes: np.ndarray, lengths: np.ndarray, n_refs: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Shared n-grams by order: per (text, reference) in a row, and per text with the reference that has an n-gram most often."""
    texts, start, size = len(n_refs), np.cumsum(n_refs) - n_refs, int(n_refs.sum())
    each, most = np.zeros((size, order), dtype=np.int64), np.zeros((texts, order), dtype=np.int64)
    for n, (t, s, c, group, first, _, _) in enumerate(gram_runs(codes, *_sides(lengths, n_refs), order)):
        if not len(t):
            break
        mine = np.where(s[first] == 0, c[first], 0)
        theirs = np.where(s > 0, c, 0)
        both = np.flatnonzero((s > 0) & (mine[group] > 0))
        each[:, n] = np.bincount(start[t[both]] + s[both] - 1, np.minimum(mine[group[both]], c[both]), size)
        most[:, n] = np.bincount(t[first], np.minimum(mine, np.maximum.reduceat(theirs, first)), texts)
    return each, most


def _spelled(codes: np.ndarray, tokens: pa.Array, lengths: np.ndarray, n_refs: np.ndarray, order: int) -> tuple[np.ndarray, pa.Array]:
    """The n-grams of the references and their texts, by text: order, words, count in all references, counts shared with each."""
    found, owners, names = [], [], tokens
    for n, (t, s, c, group, first, gram, made) in enumerate(gram_runs(codes, *_sides(lengths, n_refs), order, True), 1):
        if not len(t):
            break
        if made:
            names = pc.binary_join_element_wise(names.take(pa.array(made[0])), tokens.take(pa.array(made[1])), " ")
        mine = np.where(s[first] == 0, c[first], 0)
        total = np.add.reduceat(np.where(s > 0, c, 0), first)
        kept = np.flatnonzero(total > 0)
        both = np.flatnonzero((s > 0) & (mine[group] > 0))
        offsets = np.concatenate([[0], np.cumsum(np.bincount(group[both], minlength=len(first))[kept])]).astype(np.int32)
        hits = pa.StructArray.from_arrays([pa.array((s[both] - 1).astype(np.int32)), pa.array(np.minimum(mine[group[both]], c[both]))],
                                          names=["k", "n"])
        found.append(pa.StructArray.from_arrays(
            [pa.array(np.full(len(kept), n, dtype=np.int32)), names.take(pa.array(gram[first[kept]])), pa.array(total[kept]),
             pa.ListArray.from_arrays(pa.array(offsets), hits)], names=["order", "gram", "n", "hits"]))
        owners.append(t[first[kept]])
    if not found:
        return np.zeros(len(n_refs), dtype=np.int64), None
    owner = np.concatenate(owners)
    return np.bincount(owner, minlength=len(n_refs)), pa.concat_arrays(found).take(pa.array(np.argsort(owner, kind="stable")))


def _lists(values: np.ndarray) -> pa.Array:
    """A list per row of a matrix."""
    rows, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(values.ravel()))


def _numbers(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column, 0).to_numpy(zero_copy_only=False).astype(np.int64)


def _word_codes(hyp: pa.Array, refs: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes of the tokens of all sequences, and the tokens they stand for."""
    tokens = pa.concat_arrays([hyp.flatten(), refs.flatten()]).dictionary_encode()
    return tokens.indices.to_numpy(zero_copy_only=False).astype(np.int64), tokens.dictionary


def _character_codes(hyp: pa.Array, refs: pa.Array) -> tuple[np.ndarray, None]:
    """Codes of the characters of all texts."""
    texts = pc.fill_null(pa.concat_arrays([hyp, refs]), "").to_pylist()
    points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
    seen = np.zeros(int(points.max(initial=0)) + 1, dtype=bool)
    seen[points] = True
    return (np.cumsum(seen, dtype=np.int64) - 1)[points], None


def _blocks(hyp: pa.Array, refs: pa.Array, size, coded) -> Iterator[tuple]:
    """Runs of rows with about BLOCK tokens: codes, what they stand for, lengths of the sequences, references per row."""
    n_refs, flat = _numbers(pc.list_value_length(refs)), refs.flatten()
    upto, own, other = np.cumsum(n_refs), _numbers(size(hyp)), _numbers(size(flat))
    tokens = np.cumsum(own) + np.concatenate([[0], np.cumsum(other)])[upto]
    at = 0
    while at < len(n_refs):
        end = max(at + 1, int(np.searchsorted(tokens, (tokens[at - 1] if at else 0) + BLOCK, side="right")))
        low, high = (int(upto[at - 1]) if at else 0), int(upto[end - 1])
        yield (*coded(hyp.slice(at, end - at), flat.slice(low, high - low)),
               np.concatenate([own[at:end], other[low:high]]), n_refs[at:end])
        at = end


def shared_grams(hyp: Column, refs: Column, order: int, characters: bool = False) -> Column:
    """Per row (each, most): the n-grams shared with each reference, and with the one that has an n-gram most often, by order.

    `hyp` and the elements of `refs` are token arrays, or texts whose `characters` are the tokens. Null ones have no tokens.
    """
    how = (pc.utf8_length, _character_codes) if characters else (pc.list_value_length, _word_codes)

    @F.arrow_udf(SHARED)
    def count(hyp: pa.Array, refs: pa.Array) -> pa.Array:
        none = np.zeros((0, order), dtype=np.int64)
        done = [_shared(codes, lengths, n_refs, order) for codes, _, lengths, n_refs in _blocks(hyp, refs, *how)]
        each, most = (np.concatenate([none, *parts]) for parts in (zip(*done) if done else ([], [])))
        offsets = np.concatenate([[0], np.cumsum(_numbers(pc.list_value_length(refs)))]).astype(np.int32)
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), _lists(each)), _lists(most)],
                                          names=["each", "most"])

    return count(hyp, refs)


def reference_grams(hyp: Column, refs: Column, order: int) -> Column:
    """Per row the n-grams of its references: order, gram, n in all of them, hits (k, n) shared with each that the prediction shares."""

    @F.arrow_udf(SPELLED)
    def count(hyp: pa.Array, refs: pa.Array) -> pa.Array:
        sizes, parts = [np.zeros(1, dtype=np.int64)], []
        for codes, tokens, lengths, n_refs in _blocks(hyp, refs, pc.list_value_length, _word_codes):
            size, part = _spelled(codes, tokens, lengths, n_refs, order)
            sizes.append(size)
            parts += [part] if part is not None else []
        offsets = pa.array(np.cumsum(np.concatenate(sizes)).astype(np.int32))
        kind = pa.struct([("order", pa.int32()), ("gram", pa.string()), ("n", pa.int64()),
                          ("hits", pa.list_(pa.struct([("k", pa.int32()), ("n", pa.int64())])))])
        return pa.ListArray.from_arrays(offsets, pa.concat_arrays(parts) if parts else pa.array([], kind))

    return count(hyp, refs)
