"""Benchmark decontamination with suffix arrays over the training words.

Documents are read in shards of about `SHARD_WORDS` words. A shard's words become ids of the benchmark's vocabulary (0
for any other word); no match can run over a 0, so the suffix array holds the suffixes that start in a run of benchmark
words at least as long as the shortest window. Every different window of the benchmark's suffixes is then binary-searched
in the shard's array, once however many items have it; the range it opens holds all places where it stands verbatim. Words
hit are the union of these places. A longest match is a stretch of a document that stands verbatim in one item and in no
longer such stretch; it is found by following the places of its windows through the items, so their number grows with the
document's words, not with words times items. Nothing is shuffled: a shard lives inside one task.

The benchmark is cut into blocks of about BLOCK_BYTES of text. The driver indexes one block at a time and broadcasts it;
a task holds one at a time too and searches its shard in each.

Defined cases: a null or empty text has no words and no hits; a null benchmark text has no windows; a null `item_id` is
written as the empty id; equal items are found side by side; an item shorter than the window is one window of its own
length; of several places of a longest match the first of the least item is named; repeated document rows each give their
row; extra columns are ignored by `find_matches` and kept by `clean`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peakweave.llm.common import alnum_words, utf8

WINDOW = 10
SHARD_WORDS = 1_000_000
#: Bytes of benchmark text that are indexed together.
BLOCK_BYTES = 32_000_000

MATCH = "array<struct<item_id:string,item_start:bigint,start:bigint,length:bigint>>"


def paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A number for each pair of numbers, the same for equal pairs."""
    return np.unique(first.astype(np.int64) * (int(second.max(initial=0)) + 1) + second, return_inverse=True)[1]


class Benchmark:
    """The windows of one block of benchmark items.

    Different texts lie one behind the other in `flat`, a 0 after each. A window is a number; `pattern` and `length` have
    its words, `window_at` the full window that starts at each place of `flat` or -1, and `places` of a window where it
    starts.
    """

    def __init__(self, rows: list[tuple], window: int):
        self.window, self.vocabulary = window, {}
        texts: dict[bytes, set[str]] = {}
        for item_id, text in rows:
            words = alnum_words((text or "").encode())
            if words:
                ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], dtype=np.int32)
                texts.setdefault(ids.tobytes(), set()).add("" if item_id is None else str(item_id))
        # texts in the order of their least id
        ordered = sorted(texts, key=lambda t: (min(texts[t]), t))
        self.items = [sorted(texts[t]) for t in ordered]
        arrays = [np.frombuffer(t, dtype=np.int32) for t in ordered]
        size = np.array([len(a) for a in arrays], dtype=np.int64)
        self.first = np.cumsum(size + 1) - size - 1  # of each text in `flat`
        self.flat = np.zeros(int(size.sum() + len(size)) + window, dtype=np.int32)
        owner = np.full(len(self.flat), -1, dtype=np.int64)
        for k, a in enumerate(arrays):
            self.flat[self.first[k] : self.first[k] + len(a)] = a
            owner[self.first[k] : self.first[k] + len(a)] = k
        full = np.zeros(len(self.flat), dtype=bool)
        for k in np.flatnonzero(size >= window).tolist():
            full[self.first[k] : self.first[k] + size[k] - window + 1] = True
        starts = np.flatnonzero(full)
        _, first, number = np.unique(self._names(window)[starts], return_index=True, return_inverse=True)
        self.window_at = np.full(len(self.flat) + 1, -1, dtype=np.int64)
        self.window_at[starts] = number
        short = np.flatnonzero(size < window)
        # every short text is a window of its own
        begins = np.concatenate([starts[first], self.first[short]]).astype(np.int64)
        self.n_full = len(first)
        self.length = np.concatenate([np.full(len(first), window), size[short]]).astype(np.int64)
        self.shortest = int(self.length.min(initial=window))
        self.depth = int(self.length.max(initial=1))
        columns = np.arange(self.depth)
        self.pattern = np.where(columns < self.length[:, None], self.flat[np.minimum(begins[:, None] + columns, len(self.flat) - 1)], 0)
        every = np.concatenate([starts, self.first[short]]).astype(np.int64)
        window_of = np.concatenate([number, len(first) + np.arange(len(short))]).astype(np.int64)
        self.place = every[np.argsort(window_of, kind="stable")]
        self.bounds = np.concatenate([[0], np.cumsum(np.bincount(window_of, minlength=len(self.length)))])
        self.owner = owner

    def _names(self, n: int) -> np.ndarray:
        """A number for the n words from each place on, by doubling; places near the end of a text are not used."""
        names, span, built, done = self.flat.astype(np.int64), 1, None, 0
        while True:
            if n & span:
                built = names if built is None else paired(built, np.concatenate([names[done:], np.zeros(done, np.int64)]))
                done += span
            span *= 2
            if span > n:
                return built if built is not None else names
            half = span // 2
            names = paired(names, np.concatenate([names[half:], np.zeros(half, np.int64)]))

    def places(self, window: int) -> np.ndarray:
        return self.place[self.bounds[window] : self.bounds[window + 1]]

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, words, repeat(0)), dtype=np.int32, count=len(words))


def suffix_array(words: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes in the order of their first `depth` words, by prefix doubling."""
    rank, span = words.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while span < depth and len(words):
        after = np.zeros_like(rank)
        after[:-span] = rank[span:] if span < len(rank) else 0
        key = rank * (int(rank.max()) + 1 + len(rank)) + after
        order = np.argsort(key, kind="stable")
        step = np.concatenate([[1], (np.diff(key[order]) != 0).astype(np.int64)])
        rank[order] = np.cumsum(step)
        if step.all():
            break
        span *= 2
    return order


def search(words: np.ndarray, order: np.ndarray, benchmark: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """For every different window the first and the last-plus-one row of `order` whose suffix starts with it."""
    padded = np.concatenate([words, np.zeros(benchmark.depth, dtype=words.dtype)])
    columns = np.arange(benchmark.depth)
    inside = columns[None, :] < benchmark.length[:, None]

    def bound(after_equal: bool) -> np.ndarray:
        low, high = np.zeros(len(benchmark.length), dtype=np.int64), np.full(len(benchmark.length), len(order), dtype=np.int64)
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            found = padded[order[middle][:, None] + columns[None, :]]
            differs = (found != benchmark.pattern[open_]) & inside[open_]
            first = differs.argmax(axis=1)
            rows = np.arange(len(open_))
            smaller = found[rows, first] < benchmark.pattern[open_, first]
            equal = ~differs[rows, first]
            right = np.where(equal, after_equal, smaller)
            low[open_] = np.where(right, middle + 1, low[open_])
            high[open_] = np.where(right, high[open_], middle)
        return low

    return bound(False), bound(True)


def in_long_runs(words: np.ndarray, least: int) -> np.ndarray:
    """Positions in runs of at least `least` known words."""
    known = np.concatenate([[0], (words > 0).astype(np.int8), [0]])
    edges = np.flatnonzero(np.diff(known))
    starts, ends = edges[::2], edges[1::2]
    long = (ends - starts) >= least
    mark = np.zeros(len(words) + 1, dtype=np.int32)
    np.add.at(mark, starts[long], 1)
    np.add.at(mark, ends[long], -1)
    return np.flatnonzero(np.cumsum(mark[:-1]))


def occurrences(words: np.ndarray, benchmark: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (position in `words`, window) of all verbatim windows; a position has at most one of each length."""
    none = np.zeros(0, dtype=np.int64)
    if not len(benchmark.length) or not len(words):
        return none, none
    kept = in_long_runs(words, benchmark.shortest)
    if not len(kept):
        return none, none
    # a 0 after each run keeps runs apart once the words between them are left out
    gap = np.concatenate([np.diff(kept) > 1, [True]])
    target = np.arange(len(kept)) + np.concatenate([[0], np.cumsum(gap)[:-1]])
    packed = np.zeros(int(target[-1]) + 2, dtype=np.int32)
    packed[target] = words[kept]
    back = np.zeros(len(packed), dtype=np.int64)
    back[target] = kept
    order = suffix_array(packed, benchmark.depth)
    low, high = search(packed, order, benchmark)
    count = high - low
    window = np.repeat(np.arange(len(count)), count)
    row = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
    return back[order[row]], window


def longest_matches(at: int, windows: np.ndarray, benchmark: Benchmark) -> Iterator[tuple[int, int, int]]:
    """(start, length, place in the benchmark) of the longest matches in a run of full windows, which start at `at`,
    `at` + 1, … None of them lies inside another."""
    k, n = 0, len(windows)
    while k < n:
        # to the left as far as some item has it, from all places of the window at k
        here, start = benchmark.places(int(windows[k])), k
        while start and len(before := here[benchmark.window_at[here - 1] == windows[start - 1]]):
            here, start = before - 1, start - 1
        # then to the right
        there, end = here + (k - start), k + 1
        while end < n and len(after := there[benchmark.window_at[there + 1] == windows[end]]):
            there, end = after + 1, end + 1
        yield at + start, end - start - 1 + benchmark.window, int(there[0]) - (end - 1 - start)
        k = end


def search_shard(words: list[list[bytes]], blocks: list[Benchmark | Broadcast]) -> list[dict]:
    """For each document of a shard its number of words, the merged intervals hit, the items and the longest matches."""
    lengths = np.array([len(w) for w in words])
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    change = np.zeros(starts[-1] + 1, dtype=np.int64)
    rows = [{"n_words": int(n), "hits": [], "items": set(), "matches": []} for n in lengths]
    for block in blocks:
        benchmark = block.value if isinstance(block, Broadcast) else block
        flat = np.zeros(starts[-1], dtype=np.int32)
        for w, at in zip(words, starts):
            flat[at : at + len(w)] = benchmark.ids(w)
        position, window = occurrences(flat, benchmark)
        np.add.at(change, position, 1)
        np.add.at(change, position + benchmark.length[window], -1)
        owner = np.searchsorted(starts, position, side="right") - 1
        _note_items(rows, owner, window, benchmark)
        _note_matches(rows, owner, position, window, starts, benchmark)
        if isinstance(block, Broadcast) and len(blocks) > 1:
            block.__dict__.pop("_value", None)  # one block in memory at a time; it is read again from the worker's disk
    hit = np.concatenate([[0], (np.cumsum(change[:-1]) > 0).astype(np.int8), [0]])
    edges = np.flatnonzero(np.diff(hit))
    for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        doc = int(np.searchsorted(starts, begin, side="right")) - 1
        rows[doc]["hits"].append({"start": begin - int(starts[doc]), "end": end - int(starts[doc])})
    for row in rows:
        row["items"] = sorted(row["items"])
        row["matches"].sort(key=lambda m: (m["start"], m["item_id"]))
    return rows


def _note_items(rows: list[dict], owner: np.ndarray, window: np.ndarray, benchmark: Benchmark) -> None:
    """The items of each different window a document has."""
    for key in np.unique(owner * len(benchmark.length) + window).tolist():
        doc, w = divmod(key, len(benchmark.length))
        for text in np.unique(benchmark.owner[benchmark.places(w)]).tolist():
            rows[doc]["items"].update(benchmark.items[text])


def _note_matches(rows: list[dict], owner: np.ndarray, position: np.ndarray, window: np.ndarray, starts: np.ndarray,
                  benchmark: Benchmark) -> None:
    def note(doc: int, start: int, length: int, place: int) -> None:
        text = int(benchmark.owner[place])
        rows[doc]["matches"].append({
            "item_id": benchmark.items[text][0], "item_start": place - int(benchmark.first[text]),
            "start": start - int(starts[doc]), "length": length})

    full = window < benchmark.n_full
    for doc, at, w in zip(owner[~full].tolist(), position[~full].tolist(), window[~full].tolist()):
        note(doc, at, int(benchmark.length[w]), int(benchmark.places(w)[0]))
    order = np.argsort(position[full], kind="stable")
    at, found, doc = position[full][order], window[full][order], owner[full][order]
    for run in np.split(np.arange(len(at)), np.flatnonzero(np.diff(at) != 1) + 1):
        if len(run):
            for start, length, place in longest_matches(int(at[run[0]]), found[run], benchmark):
                note(int(doc[run[0]]), start, length, place)


def search_batches(batches: Iterator[pa.RecordBatch], blocks: list) -> Iterator[tuple[pa.RecordBatch, list[dict]]]:
    """Each batch with one result per row."""
    for batch in batches:
        texts, rows, shard, size = utf8(batch.column("text")), [], [], 0
        for n, text in enumerate(texts):
            shard.append(alnum_words(text))
            size += len(shard[-1]) + 1
            if size >= SHARD_WORDS or n == len(texts) - 1:
                rows += search_shard(shard, blocks)
                shard, size = [], 0
        yield batch, rows


def benchmark_blocks(benchmark: DataFrame, window: int) -> list[Broadcast]:
    """The items in blocks of about BLOCK_BYTES text each, indexed and broadcast one after the other."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-size // BLOCK_BYTES))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    context = benchmark.sparkSession.sparkContext
    return [context.broadcast(Benchmark([tuple(r) for r in items.filter(block == b).collect()], window)) for b in range(n_blocks)]


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: `n_words`, the longest `matches` (item, places, length), `hits`, the covered intervals, and the
    ids of all `items` with a window in it."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    hits = "array<struct<start:bigint,end:bigint>>"
    types = {"matches": MATCH, "hits": hits, "items": "array<string>"}
    arrow = {c: to_arrow_type(_parse_datatype_string(t)) for c, t in types.items()}
    blocks = benchmark_blocks(benchmark, window)

    def run(batches):
        for batch, rows in search_batches(batches, blocks):
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([r["n_words"] for r in rows], pa.int64()),
                *[pa.array([r[c] for r in rows], arrow[c]) for c in types]], names=["doc_id", "n_words", *types])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, n_words bigint, " + ", ".join(f"{c} {t}" for c, t in types.items()))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a verbatim window of the benchmark, all columns kept."""
    blocks = benchmark_blocks(benchmark, window)

    def run(batches):
        for batch, rows in search_batches(batches, blocks):
            yield batch.filter(pa.array([not r["hits"] for r in rows], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """The matches as the counts and the digest the query returns."""
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda total, h: total + h["end"] - h["start"])
    longest = F.coalesce(F.array_max(F.transform("matches", lambda m: m["length"])), F.lit(0).cast("bigint"))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"), longest.alias("longest_match"))
