"""What texts gain by the n-grams they share with their references, weighed by counts over all references.

N-grams never become rows. A block of texts asks with the distinct windows of `order` tokens of its
references, which have all shorter n-grams as their beginnings; the owner of a window's first two
tokens adds the counts of all blocks up and answers each block in the order it asked. Words, and the
number of words of a group, have owners of their own. Blocks, questions and answers are packed bytes,
and texts are scored where their block's answers meet what was kept of it.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakweave.functions.ngrams import _bits, _numbers, _sides, _word_codes

#: Tokens of the texts of a block; a longer text is a block of its own.
BLOCK = 1 << 20
#: Owners of n-grams at least; with more shuffle partitions there is one for each.
OWNERS = 256
#: What a row is, besides a question that is answered for n-grams from so many words on: what is kept of a block, and its groups.
KEPT, GROUP = -1, -2


# --- packed arrays ---------------------------------------------------------------------------

def _packed(*arrays: np.ndarray | pa.Array) -> bytes:
    """Arrays of numbers from 0 on, or of strings: numbers as narrow as they can be, like bytes side by side, each array compressed."""
    return pickle.dumps([(*_planes(_numbers(pc.binary_length(a))), *_small("".join(a.to_pylist()).encode())) if isinstance(a, pa.Array)
                         else _planes(a) for a in arrays], protocol=5)


def _small(raw: bytes) -> tuple[int, bytes]:
    return len(raw), pa.compress(raw, codec="zstd", asbytes=True)


def _planes(a: np.ndarray) -> tuple[int, int, bytes]:
    narrow = np.ascontiguousarray(a, dtype=np.min_scalar_type(int(a.max(initial=0))))
    return narrow.itemsize, *_small(narrow.view(np.uint8).reshape(-1, narrow.itemsize).T.tobytes())


def _unpacked(data: bytes) -> list[np.ndarray | pa.Array]:
    def opened(size, raw):
        return pa.decompress(raw, size, codec="zstd", asbytes=True)

    def numbers(width, *raw):
        return np.frombuffer(opened(*raw), np.uint8).reshape(width, -1).T.copy().view(f"u{width}").ravel().astype(np.int64)

    def strings(width, size, raw, *text):
        ends = np.concatenate([[0], np.cumsum(numbers(width, size, raw))]).astype(np.int32)
        return pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(opened(*text)))

    return [strings(*p) if len(p) > 3 else numbers(*p) for p in pickle.loads(data)]


# --- n-grams of a block ----------------------------------------------------------------------

def _ahead(values: np.ndarray, sequence: np.ndarray, n: int) -> np.ndarray:
    """For each token 1 + the value n tokens on, 0 behind the end of its sequence."""
    found = np.zeros(len(values), dtype=np.int64)
    if n < len(values):
        found[: len(values) - n] = np.where(sequence[n:] == sequence[: len(values) - n], values[n:] + 1, 0)
    return found


def _numbered(columns: Sequence[np.ndarray]) -> np.ndarray:
    """One number per row, in the order of the columns; equal rows have equal numbers."""
    key, width = np.zeros(len(columns[0]), dtype=np.int64), 0
    for c in columns:
        bits = _bits(c.max(initial=0) + 1)
        if width + bits > 62:
            known, key = np.unique(key, return_inverse=True)
            width = _bits(len(known))
        key, width = key << bits | c, width + bits
    return key


def _distinct(columns: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct row, in the order of the columns, and the number of each row's distinct one."""
    _, place, number = np.unique(_numbered(columns), return_index=True, return_inverse=True)
    return place, number


def _hits(codes: np.ndarray, sequence: np.ndarray, text: np.ndarray, side: np.ndarray, order: int) -> np.ndarray:
    """Per token of a reference the orders, as bits, in which the n-gram that begins there is one its text's prediction shares.

    An n-gram that a reference has oftener than the prediction is shared in its first places only.
    """
    flags = np.zeros(len(codes), dtype=np.int64)
    # sequences in the order of their texts, the prediction's first
    ranked = np.lexsort((side, text))
    text, predicted, place = text[ranked], side[ranked] == 0, np.argsort(ranked)[sequence]
    code_bits = width = _bits(codes.max(initial=0) + 1)
    place_bits, gram = _bits(len(ranked)), codes
    for n in range(1, order + 1):
        if n > 1:
            if width + code_bits + place_bits > 62:
                known, gram = np.unique(gram, return_inverse=True)
                width = _bits(len(known))
            gram, width = gram[:-1] << code_bits | codes[n - 1 :], width + code_bits
        whole = np.flatnonzero(sequence[: len(gram)] == sequence[n - 1 :]) if len(gram) else []
        if not len(whole):
            break
        key = gram[whole] << place_bits | place[whole]
        by_key = np.argsort(key, kind="stable")
        key = key[by_key]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        start, run = np.flatnonzero(new), np.cumsum(new) - 1
        size, runs = np.diff(np.append(start, len(key))), key[start]
        at = runs & ((1 << place_bits) - 1)
        runs, mine = runs >> place_bits, predicted[at]
        # the runs of one text's n-gram
        group = np.cumsum(np.concatenate([[True], (runs[1:] != runs[:-1]) | (text[at[1:]] != text[at[:-1]])])) - 1
        most = np.bincount(group[mine], size[mine], group[-1] + 1)[group]
        shared = ~mine[run] & (np.arange(len(key)) - start[run] < most[run])
        flags[whole[by_key[shared]]] |= 1 << (n - 1)
    return flags


def _utc(kind: pa.DataType) -> pa.DataType:
    """The type in which Spark takes a column back, whatever the session's time zone."""
    if pa.types.is_timestamp(kind) and kind.tz:
        return pa.timestamp(kind.unit, "UTC")
    if pa.types.is_struct(kind):
        return pa.struct([f.with_type(_utc(f.type)) for f in kind])
    return pa.list_(kind.value_field.with_type(_utc(kind.value_type))) if pa.types.is_list(kind) else kind


def _in_utc(table: pa.Table) -> pa.Table:
    return table.cast(pa.schema([f.with_type(_utc(f.type)) for f in table.schema]))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def _label(values: tuple) -> str:
    return repr(tuple(v + 0.0 if isinstance(v, float) else v for v in values))


def _asked(texts: pa.Table, by: Sequence[str], order: int, owners: int, home: int) -> Iterator[tuple]:
    """(owner, kind, data, text) of a block: its questions, what is kept of it (by way of `home`), and its groups by the first text of each."""
    hyp, refs = (texts[c].combine_chunks() for c in ("hyp", "refs"))
    n_refs, flat = _numbers(pc.list_value_length(refs)), refs.flatten()
    codes, tokens = _word_codes(hyp, flat)
    # sorted words are the smaller when packed
    ranked = pc.sort_indices(tokens)
    tokens, codes = tokens.take(ranked), np.argsort(ranked.to_numpy())[codes]
    own, other = _numbers(pc.list_value_length(hyp)), _numbers(pc.list_value_length(flat))
    sequence, text, side = _sides(np.concatenate([own, other]), n_refs)
    flags = _hits(codes, sequence, text, side, order)[own.sum() :]

    labels: dict[str, int] = {}
    keys = zip(*(texts[c].to_pylist() for c in by)) if by else [()] * len(own)
    group_of = np.array([labels.setdefault(_label(k), len(labels)) for k in keys], dtype=np.int64)
    first_text = np.unique(group_of, return_index=True)[1]
    tokens = pa.concat_arrays([tokens.cast(pa.string()), pa.array(list(labels), pa.string())])
    hashes = np.array([zlib.crc32(s.encode()) for s in tokens.to_pylist()], dtype=np.uint64)

    # from here on the tokens of references only
    words, ref = codes[own.sum() :], sequence[own.sum() :] - len(own)
    group = group_of[text[len(own) :]][ref]
    start = len(tokens) - len(labels)
    ahead = [_ahead(words, ref, n) for n in range(order)]  # 0 stands for no token
    known = np.append(np.uint64(0), hashes)
    group_hash = _mixed(hashes[start:])
    word_hash = _mixed(group_hash[group] + hashes[words])
    pair_hash = _mixed(word_hash + (known[ahead[1]] if order > 1 else np.uint64(0)))
    owner = [(h % np.uint64(owners)).astype(np.int64) for h in (group_hash, word_hash, pair_hash)]

    place, window = _distinct([owner[2], group, *ahead])
    count = np.bincount(window, minlength=len(place))
    where, word = _distinct([owner[1][place], group[place], words[place]])
    where = place[where]
    word_count = np.bincount(word, count, len(where)).astype(np.int64)
    by_owner = np.argsort(owner[0], kind="stable")
    group_count = np.bincount(group, minlength=len(labels))[by_owner]

    questions = [(0, owner[0][by_owner], [by_owner], group_count), (1, owner[1][where], [group[where], ahead[0][where]], word_count)]
    if order > 1:
        questions.append((2, owner[2][place], [group[place], *[a[place] for a in ahead]], count))
    for kind, owned, columns, counts in questions:
        # the group is a token before the others
        columns = np.array([columns[0] + start + 1, *columns[1:]])
        cuts = np.flatnonzero(np.concatenate([[True], owned[1:] != owned[:-1]])) if len(owned) else []
        for low, high in zip(cuts, [*cuts[1:], len(owned)]):
            used, local = np.unique(columns[:, low:high], return_inverse=True)
            zero = int(used[0] == 0)  # codes from 1 on, whether or not a window is short
            local = local.reshape(len(columns), -1) + 1 - zero
            yield int(owned[low]), kind, _packed(tokens.take(pa.array(used[zero:] - 1)), counts[low:high], *local), None

    at = np.flatnonzero(flags)
    at = at[np.argsort(ref[at] * np.int64(len(place)) + window[at], kind="stable")]
    steps = np.diff(window[at], prepend=0) & 0xFFFFFFFF
    yield home, KEPT, _packed(group_of, own, n_refs, other, np.bincount(ref[at], minlength=len(other)), steps, flags[at], word,
                              group[where], np.argsort(by_owner)), None
    for k, row in enumerate(first_text):
        yield home, GROUP - k, b"", int(row)


def _cut(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.Table]:
    """Texts of about `block` tokens, in their order; a side counts one more, and a row without references is no text."""
    def size(lists):
        return _numbers(pc.list_value_length(lists))

    kept, held = [], 0
    for batch in batches:
        batch = batch.filter(pc.greater(pc.list_value_length(batch["refs"]), 0))
        refs = batch["refs"]
        upto = np.concatenate([[0], np.cumsum(1 + size(refs.flatten()))])[np.cumsum(size(refs))]
        upto, at = np.cumsum(1 + size(batch["hyp"])) + upto, 0
        while at < len(batch):
            before = int(upto[at - 1]) if at else 0
            end = max(at + (not kept), int(np.searchsorted(upto, before + block - held, side="right")))
            kept += [batch.slice(at, end - at)] if end > at else []
            held += (int(upto[end - 1]) if end else 0) - before
            if end < len(batch):
                yield pa.Table.from_batches(kept)
                kept, held = [], 0
            at = end
    if kept:
        yield pa.Table.from_batches(kept)


# --- answers and scores ----------------------------------------------------------------------

def _answered(questions: Sequence[bytes], kind: int) -> Iterator[bytes]:
    """For each question its counts in all of them, one array per number of words from `kind` on."""
    opened = [_unpacked(q) for q in questions]
    sizes = [len(q[1]) for q in opened]
    tokens = pa.concat_arrays([q[0] for q in opened]).dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    offset = np.concatenate([[0], np.cumsum([len(q[0]) for q in opened])])
    codes = [np.append(0, tokens[a:b]) for a, b in zip(offset[:-1], offset[1:])]
    count = np.concatenate([q[1] for q in opened])
    columns = [np.concatenate([own[q[n]] for own, q in zip(codes, opened)]) for n in range(2, len(opened[0]))]
    _, key = _distinct(columns[: kind + 1])
    totals = [np.bincount(key, count)[key].astype(np.int64)]
    for column in columns[kind + 1 :]:
        _, key = _distinct([key, column])
        totals.append(np.bincount(key, count)[key].astype(np.int64))
    totals = [np.where(column > 0, total, 0) for column, total in zip(columns[kind:], totals)]
    ends = np.cumsum(sizes)
    for low, high in zip(ends - sizes, ends):
        yield _packed(*[t[low:high] for t in totals])


def _scored(kept: bytes, answers: dict[int, list[bytes]], order: int) -> Iterator[tuple]:
    """Per order and group of a block the sums over texts, each with the reference that gains it most: (order, group, gain, den, h, r)."""
    group_of, hyp_len, n_refs, ref_len, found, steps, flags, word, word_group, place = _unpacked(kept)
    opened = {kind: [_unpacked(a) for a in rows] for kind, rows in answers.items()}
    counts = [np.concatenate(parts) for kind in sorted(opened) for parts in zip(*opened[kind])]
    ref = np.repeat(np.arange(len(ref_len)), found)
    window = np.cumsum(steps) & 0xFFFFFFFF
    text = np.repeat(np.arange(len(n_refs)), n_refs)
    groups = len(place)
    for n in range(1, order + 1):
        shared = (flags >> (n - 1) & 1).astype(bool)
        owner, at = ref[shared], window[shared]
        # equal n-grams follow one another, so references that share the same ones gain the same
        if not len(at):
            info = np.zeros(0)
        elif n == 1:
            at = word[at]
            by_word = np.argsort(owner * np.int64(len(counts[1]) + 1) + at, kind="stable")
            owner, at = owner[by_word], at[by_word]
            info = np.log2(counts[0][place][word_group[at]] / counts[1][at])
        else:
            info = np.log2((counts[1][word[at]] if n == 2 else counts[n - 1][at]) / counts[n][at])
        gain = np.bincount(owner, info, len(ref_len))
        ranked = np.lexsort((ref_len, gain, text))
        best = ranked[np.cumsum(n_refs) - 1]
        sums = [gain[best], np.maximum(hyp_len - (n - 1), 0), hyp_len, ref_len[best]]
        sums = [np.bincount(group_of, s, groups) for s in sums]
        for g in range(groups):
            yield n, g, float(sums[0][g]), float(sums[1][g]), int(sums[2][g]), int(sums[3][g])


def reference_gains(texts: DataFrame, by: Sequence[str], order: int, block: int = BLOCK, owners: int = OWNERS) -> DataFrame:
    """Per order (and group) gain, den, h and r: sums over the texts, each with the reference that gains it most.

    `texts` have token arrays `hyp` and `refs`, and must come in an order that is the same whenever they are read. A shared
    n-gram gains log2 of the count of its beginning (a word's is all words) over its own, counted in all references of a
    group. Of references that gain the same the longer counts; den are the prediction's n-grams, h and r its and the reference's tokens.
    """
    by = list(by)
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    owners = max(owners, tasks)
    groups = [T.StructField(c, texts.schema[c].dataType) for c in by]
    mail = T.StructType([*groups, T.StructField("__block", T.LongType()), T.StructField("__owner", T.IntegerType()),
                         T.StructField("__kind", T.IntegerType()), T.StructField("__data", T.BinaryType())])
    sums = T.StructType([*groups, *[T.StructField(c, t) for c, t in (
        ("order", T.IntegerType()), ("gain", T.DoubleType()), ("den", T.DoubleType()), ("h", T.LongType()), ("r", T.LongType()))]])

    def ask(batches):
        task = TaskContext.get().partitionId()
        for number, texts in enumerate(_cut(batches, block)):
            texts = _in_utc(texts.combine_chunks())
            found = list(_asked(texts, by, order, owners, (task + number) % owners))
            rows = pa.array([f[3] for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[texts[c].combine_chunks().take(rows) for c in by], pa.array(np.full(len(found), task << 32 | number, dtype=np.int64)),
                 *[pa.array([f[k] for f in found], kind) for k, kind in ((0, pa.int32()), (1, pa.int32()), (2, pa.binary()))]],
                names=mail.names)

    def answer(mail):
        kinds, data = mail["__kind"].to_pylist(), mail["__data"].to_pylist()
        for kind in sorted({k for k in kinds if k >= 0}):
            at = [k for k, x in enumerate(kinds) if x == kind]
            for k, reply in zip(at, _answered([data[k] for k in at], kind)):
                data[k] = reply
        return _in_utc(mail).set_column(mail.schema.get_field_index("__data"), "__data", pa.array(data, pa.binary()))

    def score(mail):
        mail = _in_utc(mail).sort_by([("__kind", "ascending"), ("__owner", "ascending")])
        kinds, data = mail["__kind"].to_pylist(), mail["__data"].to_pylist()
        answers = {kind: [d for d, k in zip(data, kinds) if k == kind] for kind in sorted({k for k in kinds if k >= 0})}
        place = {GROUP - k: row for row, k in enumerate(kinds)}
        found = list(_scored(data[kinds.index(KEPT)], answers, order))
        rows = pa.array([place[f[1]] for f in found], pa.int64())
        return pa.Table.from_arrays(
            [*[mail[c].take(rows) for c in by], *[pa.array([f[k] for f in found], kind) for k, kind in (
                (0, pa.int32()), (2, pa.float64()), (3, pa.float64()), (4, pa.int64()), (5, pa.int64()))]], names=sums.names)

    # packed rows are few for what they hold, so the number of tasks does not follow from their size
    answered = texts.select(*by, "hyp", "refs").mapInArrow(ask, mail).repartition(tasks, "__owner").groupBy("__owner").applyInArrow(answer, mail)
    scored = answered.repartition(tasks, "__block").groupBy("__block").applyInArrow(score, sums)
    return scored.groupBy(*by, "order").agg(*[F.sum(c).alias(c) for c in ("gain", "den", "h", "r")])
