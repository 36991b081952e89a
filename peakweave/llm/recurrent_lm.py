"""A gated recurrent language model in numpy.

Tokens are words `[^\\x20\\x09-\\x0D]+` with A-Z in lower case, and one end after each text. Their counts over all training
texts make the vocabulary. The most frequent words have their own symbol: as many as hold COVERED of all tokens, but HEAD at
least and HEAD_MOST at most, and the hidden state grows in step with them. HEAD_MOST bounds the work per token: in corpora of
many rare words it holds less than COVERED (46 % of the tokens of check_s, where COVERED takes 131 000 words, whose softmax
would cost some ten times as much). Every other word's symbol is its shape (length and alphabet). A gated recurrent unit reads the symbols; its output softmax
is factored: first the class (head words fall into classes of equal size by frequency, a shape is a class of its own), then
the word within the class, by a softmax over the class for head words, and by add-one smoothed counts of the whole corpus
for the others, where a word never seen shares one place.

Training is truncated backpropagation over windows of TRAIN_STEPS words, one pass over every training text, in ROUNDS
rounds. The texts are dealt evenly into shards of about SHARD_TOKENS tokens, whatever files they come from, and every
round takes an equal share of the shards: each trains a copy from the last round's network, and the copies are averaged,
weighted by their tokens. A smaller shard has fewer lanes, so that it still makes LEAST_UPDATES. Scoring carries the
state across windows, so a text's log-likelihood is that of the whole text; texts share the lanes of a batch and each
starts from an empty state.

After the counts every text is read once more and its symbols are stored, from which the network is trained and texts are
scored. Rows move three times: counts per word, the symbols of the training texts into shards, and each text's words outside
the LOOKUP most frequent, which meet their counts in one join by word. No table of all words is ever held by a task or the
driver. Copies are averaged in the order of their shards, so that scores don't depend on which task ends first.

Defined cases: a null or empty text is the end alone; without training texts all counts are zero and the network stays at
its start; repeated rows are counted and scored each; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peakweave.llm.common import crc_mod, lowered, space_words, written
from peakweave.session import scratch_path

#: Fewest and most words with a symbol of their own, multiples of CLASS_SIZE, and the share of the tokens they are to hold.
HEAD = 512
HEAD_MOST = 1024
COVERED = 0.9
CLASS_SIZE = 32
#: Most frequent words whose counts each task holds.
LOOKUP = 200_000
#: Hidden units for HEAD words.
HIDDEN = 8
TRAIN_STEPS = 16
TRAIN_LANES = 512
LEAST_LANES = 16
LEAST_UPDATES = 64
#: Rounds of training, each of an equal share of the shards, and the tokens a shard has at most on average.
ROUNDS = 8
SHARD_TOKENS = 2_000_000
#: Pieces of the parameters that are averaged apart, and shards that are added up by one task.
PIECES = 16
BUNDLE = 256
#: A longer text is trained in parts of so many words, each from an empty state.
TRAIN_PART = 2048
SCORE_STEPS = 32
SCORE_LANES = 1024
RATE = 0.01
#: Tokens put into lanes together.
CHUNK = 4_000_000
#: Words looked up together.
READ_WORDS = 200_000
#: Words counted by a task before it hands on what it has.
COUNTED = 400_000
LENGTHS = (3, 5, 7, 9, 12, 16)
SHAPES = 3 * (len(LENGTHS) + 1)
HELD_OUT = (7, 2)
END = b""


def shape(word: bytes) -> int:
    """Length band times alphabet: ASCII letters alone, with other ASCII, with characters beyond."""
    n = len(word)
    return 3 * sum(n > limit for limit in LENGTHS) + (0 if word.isalpha() else 1 if word.isascii() else 2)


def shapes_of(words: list[bytes]) -> np.ndarray:
    """`shape` of many words."""
    n = len(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=n)
    letters = np.fromiter(map(bytes.isalpha, words), dtype=bool, count=n)
    ascii_ = np.fromiter(map(bytes.isascii, words), dtype=bool, count=n)
    return 3 * np.searchsorted(LENGTHS, size, side="left") + np.where(letters, 0, np.where(ascii_, 1, 2))


def shape_column(word: str = "word") -> Column:
    """`shape` as a column expression."""
    size = F.octet_length(word)
    letters = F.col(word).rlike(r"\A[a-z]+\z")
    return 3 * sum((size > limit).cast("int") for limit in LENGTHS) + F.when(letters, 0).when(
        size == F.char_length(word), 1).otherwise(2)


def count_words(docs: DataFrame) -> DataFrame:
    """`word` (empty for the end) and its count `c` in the texts."""

    def rows(counter: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counter), pa.binary()).cast(pa.string()),
                                           pa.array(list(counter.values()), pa.int64())], names=["word", "n"])

    def run(batches):
        counter: Counter = Counter()
        for batch in batches:
            for text in lowered(batch.column("text")):
                counter.update(space_words(text))
                counter[END] += 1
                if len(counter) > COUNTED:
                    yield rows(counter)
                    counter = Counter()
        if counter:
            yield rows(counter)

    return docs.select("text").mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("c"))


class Vocabulary:
    """The symbols, and the counts of the most frequent words; the end is symbol 0."""

    def __init__(self, top: list[tuple[str, int]], totals: tuple[int, int], shapes: dict[int, tuple[int, int]]):
        counts = {w.encode(): c for w, c in top}
        words = [END, *[w for w in counts if w != END]]
        self.tokens, self.distinct = totals
        self.index = {w: k for k, w in enumerate(words)}
        self.counts = np.array([counts.get(w, 0) for w in words], dtype=float)
        needed = int(np.searchsorted(np.cumsum(self.counts), COVERED * self.tokens)) + 1
        self.head = min(max(HEAD, -(-min(needed, len(words)) // CLASS_SIZE) * CLASS_SIZE), HEAD_MOST)
        head = min(self.head, len(words))
        self.symbol = np.array([k if k < head else self.head + shape(w) for k, w in enumerate(words)], dtype=np.int16)
        # counts and different words of each shape, without the head
        held = np.array([shapes.get(k, (0, 0)) for k in range(SHAPES)], dtype=float).reshape(SHAPES, 2)
        for k in range(head):
            if self.counts[k]:
                held[shape(words[k])] -= self.counts[k], 1
        self.shape_tokens = held[:, 0]
        self.shape_room = np.log10(held.sum(axis=1) + 1)
        self.gain = np.log10(self.counts + 1)

    def read(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """Symbols with the end, places in the lookup (-1: not there) and the words that are not there."""
        at = np.fromiter(map(self.index.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        symbols = np.zeros(len(words) + 1, dtype=np.int16)
        symbols[:-1] = self.symbol[at]
        missing = np.flatnonzero(at < 0)
        rest = [words[i] for i in missing.tolist()]
        symbols[missing] = self.head + shapes_of(rest)
        return symbols, at, rest


class Network:
    """Parameters as one flat vector, viewed as arrays."""

    def __init__(self, vocabulary: Vocabulary | None = None, flat: np.ndarray | None = None, head: int = HEAD):
        head = self.head = vocabulary.head if vocabulary is not None else head
        h = self.hidden = HIDDEN * head // HEAD
        classes, symbols = head // CLASS_SIZE + SHAPES, head + SHAPES
        self.shapes = {"inputs": (symbols, 3 * h), "state": (h, 3 * h), "gates": (3 * h,), "to_class": (h, classes),
                       "class_bias": (classes,), "to_word": (head, h), "word_bias": (head,)}
        sizes = {k: int(np.prod(v)) for k, v in self.shapes.items()}
        if flat is None:
            rng = np.random.default_rng(3)
            flat = rng.normal(scale=0.1, size=sum(sizes.values())).astype(np.float32)
        self.flat = np.asarray(flat, dtype=np.float32)
        at = 0
        self.parts: dict[str, np.ndarray] = {}
        for name, size in sizes.items():
            self.parts[name] = self.flat[at : at + size].reshape(self.shapes[name])
            at += size
        if vocabulary is not None:
            # start from the frequencies: an untrained network is the unigram model
            counts = np.full(head, 0.1)
            n = min(head, len(vocabulary.counts))
            counts[:n] += vocabulary.counts[:n]
            self.parts["word_bias"][:] = np.log(counts)
            grouped = np.concatenate([counts.reshape(-1, CLASS_SIZE).sum(axis=1), vocabulary.shape_tokens + 1])
            self.parts["class_bias"][:] = np.log(grouped / grouped.sum())
            self.parts["gates"][:] = 0

    def forward(self, x: np.ndarray, fresh: np.ndarray, state: np.ndarray, all_parts: bool = True) -> dict:
        """Run the unit over a window; x and fresh are (steps, lanes), `fresh` marks the first word of a text."""
        p, h = self.parts, self.hidden
        steps, lanes = x.shape
        names = ("after", "before", "update", "reset", "new", "inner") if all_parts else ("after",)
        keep = {k: np.empty((steps, lanes, h), np.float32) for k in names}
        inputs, any_fresh = p["inputs"] + p["gates"], fresh.any(axis=1).tolist()
        for t in range(steps):
            if any_fresh[t]:
                state = np.where(fresh[t][:, None], np.float32(0), state)
            g = inputs[x[t]]
            u = state @ p["state"]
            gates = g[:, : 2 * h] + u[:, : 2 * h]
            np.exp(np.negative(gates, out=gates), out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            update, reset, inner = gates[:, :h], gates[:, h:], u[:, 2 * h :]
            new = reset * inner
            new += g[:, 2 * h :]
            np.tanh(new, out=new)
            after = state - new
            after *= update
            after += new
            for k, v in zip(names, (after, state, update, reset, new, inner)):
                keep[k][t] = v
            state = after
        return keep

    def read_out(self, states: np.ndarray, y: np.ndarray, gradient: bool):
        """Natural log-probabilities of symbols y (a shape symbol: of its class) and, if asked for, all gradients.

        Scores lie class by class, so that a softmax runs along long rows.
        """
        p, head = self.parts, self.head
        states = np.ascontiguousarray(states.T)
        cls = np.where(y < head, y // CLASS_SIZE, y - head + head // CLASS_SIZE).astype(np.int16)
        logp, error = self._softmax(p["to_class"].T @ states + p["class_bias"][:, None], cls, gradient)
        grads = {}
        if gradient:
            grads = {"to_class": states @ error.T, "class_bias": error.sum(axis=1), "to_word": np.zeros_like(p["to_word"]),
                     "word_bias": np.zeros_like(p["word_bias"]), "back": p["to_class"] @ error}
        # head words class by class: sorted once, so that a class is a slice
        heads = np.flatnonzero(y < head)
        order = heads[np.argsort(cls[heads], kind="stable")]
        bounds = np.searchsorted(cls[order], np.arange(head // CLASS_SIZE + 1))
        sorted_states, sorted_words = states[:, order], y[order] % CLASS_SIZE
        within = np.empty(len(order), logp.dtype)
        back = np.empty_like(sorted_states) if gradient else None
        for c in np.flatnonzero(np.diff(bounds)).tolist():
            at = slice(bounds[c], bounds[c + 1])
            block = slice(c * CLASS_SIZE, (c + 1) * CLASS_SIZE)
            own = sorted_states[:, at]
            within[at], error = self._softmax(p["to_word"][block] @ own + p["word_bias"][block][:, None], sorted_words[at], gradient)
            if gradient:
                grads["to_word"][block] = error @ own.T
                grads["word_bias"][block] = error.sum(axis=1)
                back[:, at] = p["to_word"][block].T @ error
        logp[order] += within
        if gradient:
            grads["back"][:, order] += back
        if gradient:
            grads["back"] = grads["back"].T
        return logp, grads

    @staticmethod
    def _softmax(scores: np.ndarray, chosen: np.ndarray, gradient: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """Log-probabilities of the chosen rows and the gradient of their negative sum; `scores` is used up."""
        columns = np.arange(len(chosen))
        scores -= scores.max(axis=0)
        own = scores[chosen, columns]
        np.exp(scores, out=scores)
        total = scores.sum(axis=0)
        if gradient:
            scores /= total
            scores[chosen, columns] -= 1
        return own - np.log(total), scores if gradient else None

    def gradients(self, x: np.ndarray, fresh: np.ndarray, y: np.ndarray, state: np.ndarray) -> tuple[dict, np.ndarray, float]:
        """Gradients of the mean loss over a window, the state behind it, and the summed log-probability."""
        p, h = self.parts, self.hidden
        kept = self.forward(x, fresh, state)
        steps, lanes = x.shape
        real = y >= 0
        flat = np.flatnonzero(real)
        logp, grads = self.read_out(kept["after"].reshape(-1, h)[flat], y.reshape(-1)[flat], True)
        from_output = np.zeros((steps * lanes, h), np.float32)
        from_output[flat] = grads.pop("back")
        from_output = from_output.reshape(steps, lanes, h)
        to_gates = np.empty((steps, lanes, 3 * h), np.float32)
        to_state = np.empty((steps, lanes, 3 * h), np.float32)
        before, update, reset, new, inner = (kept[k] for k in ("before", "update", "reset", "new", "inner"))
        # what a state's gradient is multiplied by on its way to the gates, for all steps at once
        into_new = (1 - update) * (1 - new * new)
        into_update = (before - new) * update * (1 - update)
        into_reset = inner * reset * (1 - reset)
        back_to_state, any_fresh = p["state"].T.copy(), fresh.any(axis=1).tolist()
        later = np.zeros((lanes, h), np.float32)
        for t in range(steps - 1, -1, -1):
            d = from_output[t]
            d += later
            gate, state_side = to_gates[t], to_state[t]
            np.multiply(d, into_update[t], out=gate[:, :h])
            d_new = d * into_new[t]
            np.multiply(d_new, into_reset[t], out=gate[:, h : 2 * h])
            gate[:, 2 * h :] = d_new
            state_side[:, : 2 * h] = gate[:, : 2 * h]
            np.multiply(d_new, reset[t], out=state_side[:, 2 * h :])
            later = state_side @ back_to_state
            later += d * update[t]
            if any_fresh[t]:
                later = np.where(fresh[t][:, None], np.float32(0), later)
        wide = to_gates.reshape(-1, 3 * h)
        grads["state"] = kept["before"].reshape(-1, h).T @ to_state.reshape(-1, 3 * h)
        grads["gates"] = wide.sum(axis=0)
        symbols = x.reshape(-1).astype(np.int16)
        order = np.argsort(symbols, kind="stable")
        first = np.flatnonzero(np.diff(symbols[order], prepend=-1))
        grads["inputs"] = np.zeros_like(p["inputs"])
        grads["inputs"][symbols[order][first]] = np.add.reduceat(wide[order], first, axis=0)
        scale = np.float32(1 / max(1, len(flat)))
        return {k: v * scale for k, v in grads.items()}, kept["after"][-1], float(logp.sum())


class Lanes:
    """Texts laid end to end in lanes, the longest lane first, read window by window."""

    def __init__(self, texts: list[np.ndarray], lanes: int):
        order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
        heap = [(0, lane) for lane in range(min(lanes, len(texts)))]
        members: list[list[int]] = [[] for _ in heap]
        for k in order:
            length, lane = heapq.heappop(heap)
            members[lane].append(k)
            heapq.heappush(heap, (length + len(texts[k]), lane))
        totals = [sum(len(texts[k]) for k in m) for m in members]
        members = [members[lane] for lane in sorted(range(len(members)), key=lambda lane: -totals[lane])]
        self.texts = [k for m in members for k in m]
        sizes = np.array([len(texts[k]) for k in self.texts])
        self.y = np.concatenate([texts[k] for k in self.texts]).astype(np.int64)
        self.starts_of_texts = np.cumsum(sizes) - sizes
        self.fresh = np.zeros(len(self.y), dtype=bool)
        self.fresh[self.starts_of_texts] = True
        # what a first word follows is symbol 0, the end
        self.x = np.where(self.fresh, 0, np.concatenate([[0], self.y[:-1]]))
        self.lengths = np.array([sum(len(texts[k]) for k in m) for m in members])
        self.starts = np.cumsum(self.lengths) - self.lengths

    def windows(self, steps: int) -> Iterator[tuple[np.ndarray, ...]]:
        """(places, x, fresh, y) of each window, as (steps, lanes); y is -1 behind a lane's end."""
        for at in range(0, int(self.lengths[0]), steps):
            active = int(np.searchsorted(-self.lengths, -at, side="left"))
            time = at + np.arange(min(steps, int(self.lengths[0]) - at))[:, None]
            inside = time < self.lengths[:active]
            places = np.where(inside, self.starts[:active] + time, 0)
            yield (places, np.where(inside, self.x[places], 0), self.fresh[places] & inside,
                   np.where(inside, self.y[places], -1))


def train(network: Network, texts: list[np.ndarray], moments: dict) -> int:
    """One pass of truncated backpropagation over the texts; returns the tokens seen."""
    parts = [t[at : at + TRAIN_PART] for t in texts for at in range(0, len(t), TRAIN_PART)]
    room = sum(map(len, parts)) // (TRAIN_STEPS * LEAST_UPDATES)
    lanes, seen = Lanes(parts, min(max(room, LEAST_LANES), TRAIN_LANES)), 0
    state = np.zeros((len(lanes.lengths), network.hidden), np.float32)
    for _, x, fresh, y in lanes.windows(TRAIN_STEPS):
        grads, state, _ = network.gradients(x, fresh, y, state[: x.shape[1]])
        step = moments["step"] = moments.get("step", 0) + 1
        flat = np.concatenate([grads[k].reshape(-1) for k in network.shapes])
        first, second = moments.setdefault("means", [np.zeros_like(flat), np.zeros_like(flat)])
        first += 0.1 * (flat - first)
        flat *= flat
        second += 0.01 * (flat - second)
        network.flat -= (RATE / (1 - 0.9**step)) * first / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        seen += int((y >= 0).sum())
    return seen


def likelihoods(network: Network, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of each text's symbols."""
    lanes = Lanes(texts, SCORE_LANES)
    logp = np.zeros(len(lanes.y))
    state = np.zeros((len(lanes.lengths), network.hidden), np.float32)
    for places, x, fresh, y in lanes.windows(SCORE_STEPS):
        kept = network.forward(x, fresh, state[: x.shape[1]], False)
        state = kept["after"][-1]
        real = np.flatnonzero(y >= 0)
        found, _ = network.read_out(kept["after"].reshape(-1, network.hidden)[real], y.reshape(-1)[real], False)
        logp[places.reshape(-1)[real]] = found
    out = np.zeros(len(texts))
    out[lanes.texts] = np.add.reduceat(logp, lanes.starts_of_texts)
    return out


def learn_vocabulary(counts: DataFrame) -> Vocabulary:
    """The most frequent words, at most LOOKUP of them, and totals by shape; both of fixed size."""
    # words by sixteenths of octaves of their count; as many of the upper ones as the lookup holds
    octave = F.floor(16 * F.log2("c"))
    bins = sorted(((r["b"], r["count"]) for r in counts.groupBy(octave.alias("b")).count().collect()), reverse=True)
    held, least = 0, None
    for b, n in bins:
        if held + n > LOOKUP:
            break
        held, least = held + n, b
    top = counts.filter(octave >= least).collect() if held else []
    top.sort(key=lambda r: (-r["c"], r["word"]))
    by_shape = counts.groupBy(shape_column().alias("shape")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    ends = counts.filter("word = ''").agg(F.sum("c")).first()[0]
    pairs = [("", ends or 0)] + [(r["word"], r["c"]) for r in top if r["word"]]
    return Vocabulary(pairs, (sum(r["n"] for r in by_shape), sum(r["v"] for r in by_shape)),
                      {r["shape"]: (r["n"], r["v"]) for r in by_shape})


def read_texts(docs: DataFrame, vocabulary: Vocabulary, training: Column) -> DataFrame:
    """All texts, read once: a row per text with its `symbols` and what its task knows of the words in the lookup, and a
    row per text and place of a word outside the lookup."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = (f"row bigint, training boolean, doc_id {dict(docs.dtypes)['doc_id']}, symbols binary, n_known bigint, gain double, "
              "room double, word string")
    target = to_arrow_schema(_parse_datatype_string(schema))

    def filled(n: int, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in target], schema=target)

    def run(batches):
        for batch in batches:
            held, size, first = [], 0, 0
            texts = lowered(batch.column("text"))
            for n, text in enumerate(texts):
                held.append(space_words(text))
                size += len(held[-1])
                if size >= READ_WORDS or n == len(texts) - 1:
                    yield from read(batch.slice(first, len(held)), held)
                    held, size, first = [], 0, n + 1

    def read(batch: pa.RecordBatch, texts: list[list[bytes]]) -> Iterator[pa.RecordBatch]:
        """The rows of some texts, given as words."""
        n, sizes = len(texts), np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        symbols, at, rest = vocabulary.read([w for words in texts for w in words])
        owner = np.repeat(np.arange(n), sizes)
        ends = np.cumsum(sizes + 1)
        placed = np.zeros(len(owner) + n, dtype=np.int16)  # every text ends with symbol 0, the end
        placed[np.arange(len(owner)) + owner] = symbols[:-1]
        known = at >= 0
        inside, of = at[known], owner[known]
        total = lambda values, rows: np.bincount(rows, weights=values, minlength=n)
        # a head word's probability is the network's; others divide by their shape's counts
        shaped, tail = symbols[:-1] >= vocabulary.head, vocabulary.symbol[inside] >= vocabulary.head
        room = total(vocabulary.shape_room[symbols[:-1][shaped] - vocabulary.head], owner[shaped]) - total(
            vocabulary.gain[inside[tail]], of[tail])
        yield filled(n, row=batch.column("row"), training=batch.column("training"), doc_id=batch.column("doc_id"),
                     symbols=pa.array([x.tobytes() for x in np.split(placed, ends[:-1])], pa.binary()),
                     n_known=pa.array((total(vocabulary.counts[inside] > 0, of) + (vocabulary.counts[0] > 0)).astype(np.int64)),
                     gain=pa.array(total(vocabulary.gain[inside], of) + vocabulary.gain[0]), room=pa.array(room))
        if rest:
            rows = batch.column("row").take(pa.array(owner[~known]))
            yield filled(len(rest), row=rows, word=pa.array(rest, pa.binary()).cast(pa.string()))

    numbered = docs.select("doc_id", "text", training.alias("training")).withColumn("row", F.monotonically_increasing_id())
    return numbered.mapInArrow(run, schema)


def shards(training: DataFrame, tokens: int) -> DataFrame:
    """The texts' symbols, dealt evenly whatever partitions they stand in: a row per shard with its `round`, `shard`,
    `symbols` and the `lengths` of their parts."""

    def cut(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[at : at + 2 * TRAIN_PART] for x in batch.column("symbols").to_pylist()
                           for at in range(0, len(x), 2 * TRAIN_PART)], pa.binary())], names=["symbols"])

    def gather(batches):
        held = [x for batch in batches for x in batch.column("symbols").to_pylist()]
        if held:
            from pyspark import TaskContext

            place = TaskContext.get().partitionId()
            lengths = np.array([len(x) // 2 for x in held], dtype="<i4")
            yield pa.RecordBatch.from_arrays(
                [pa.array([place % ROUNDS], pa.int32()), pa.array([place // ROUNDS], pa.int64()),
                 pa.array([b"".join(held)], pa.binary()), pa.array([lengths.tobytes()], pa.binary())],
                names=["round", "shard", "symbols", "lengths"])

    each = -(-tokens // (ROUNDS * SHARD_TOKENS))
    dealt = training.select("symbols").mapInArrow(cut, "symbols binary").repartition(each * ROUNDS)
    return dealt.mapInArrow(gather, "round int, shard bigint, symbols binary, lengths binary")


def learn_network(training: DataFrame, vocabulary: Vocabulary) -> Network:
    """ROUNDS times: copies trained on each shard of the round, averaged by their tokens. `training` has the texts' symbols."""
    network = Network(vocabulary)
    if not vocabulary.tokens:
        return network
    path = scratch_path(training.sparkSession, "lm-shards")
    # a folder per round
    shards(training, vocabulary.tokens).write.partitionBy("round").parquet(path)
    stored = training.sparkSession.read.schema("shard bigint, symbols binary, lengths binary, round int").parquet(path)
    for k in range(ROUNDS):
        network = trained(stored.filter(F.col("round") == k), network)
    return network


def trained(part: DataFrame, start: Network) -> Network:
    """The average of copies of `start`, each trained on a shard."""
    flat, head = start.flat.copy(), start.head

    def run(batches):
        for batch in batches:
            for shard, symbols, lengths in zip(batch.column("shard"), batch.column("symbols"), batch.column("lengths")):
                network = Network(flat=flat.copy(), head=head)
                ends = np.cumsum(np.frombuffer(lengths.as_py(), "<i4"))
                seen = train(network, np.split(np.frombuffer(symbols.as_py(), np.int16), ends[:-1]), {})
                weighted = np.array_split(network.flat.astype("<f8") * seen, PIECES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(PIECES)), pa.array(np.full(PIECES, shard.as_py() // BUNDLE)),
                     pa.array(np.full(PIECES, shard.as_py())), pa.array([x.tobytes() for x in weighted], pa.binary()),
                     pa.array(np.full(PIECES, seen))], names=["piece", "bundle", "place", "value", "weight"])

    schema = "piece bigint, bundle bigint, place bigint, value binary, weight bigint"
    pieces = part.select("shard", "symbols", "lengths").mapInArrow(run, schema)
    # bundle by bundle, then the bundles: always in the order of the shards, so that sums don't depend on what came first
    bundles = pieces.groupBy("piece", "bundle").applyInArrow(_added, schema)
    summed = bundles.withColumn("place", F.col("bundle")).groupBy("piece").applyInArrow(_added, schema)
    rows = sorted(summed.select("piece", "value", "weight").collect())  # PIECES rows
    averaged = np.concatenate([np.frombuffer(r["value"], "<f8") for r in rows]) / rows[0]["weight"]
    return Network(flat=averaged.astype(np.float32), head=head)


def _added(group: pa.Table) -> pa.Table:
    """One row with the sums of the values and weights, added in the order of `place`."""
    group = group.sort_by("place")
    total = np.sum([np.frombuffer(v, "<f8") for v in group.column("value").to_pylist()], axis=0)
    return group.slice(0, 1).set_column(3, "value", pa.array([total.tobytes()], pa.binary())).set_column(
        4, "weight", pa.array([sum(group.column("weight").to_pylist())], pa.int64()))


def score_texts(texts: DataFrame, network: Network) -> DataFrame:
    """Per text what its task knew and the network's part of its score."""
    doc_type = dict(texts.dtypes)["doc_id"]

    def finish(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        symbols = [np.frombuffer(x, np.int16) for x in table.column("symbols").to_pylist()]
        score = likelihoods(network, symbols) / np.log(10) - table.column("room").to_numpy()
        return pa.RecordBatch.from_arrays(
            [table.column(c).combine_chunks() for c in ("row", "doc_id")] + [pa.array([len(x) for x in symbols], pa.int64())]
            + [table.column(c).combine_chunks() for c in ("n_known", "gain")] + [pa.array(score)],
            names=["row", "doc_id", "n_tokens", "n_known", "gain", "score"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += pc.sum(pc.binary_length(batch.column("symbols"))).as_py() // 2
            if size >= CHUNK:
                yield finish(held)
                held, size = [], 0
        if held:
            yield finish(held)

    return texts.select("row", "doc_id", "symbols", "n_known", "gain", "room").mapInArrow(
        run, f"row bigint, doc_id {doc_type}, n_tokens bigint, n_known bigint, gain double, score double")


def score(docs: DataFrame, held_out: tuple[int, int] = HELD_OUT) -> DataFrame:
    """One row per text: `n_tokens`, `n_known`, `train_tokens`, `base_score` (add-one unigrams) and `score`, the model's."""
    held = crc_mod("doc_id", held_out[0]) == held_out[1]
    counts = written(count_words(docs.filter(~held)), "lm-counts")
    vocabulary = learn_vocabulary(counts)
    stored = written(read_texts(docs, vocabulary, ~held), "lm-texts")
    texts = stored.filter("symbols is not null")
    network = learn_network(texts.filter("training"), vocabulary)
    rest = stored.filter("word is not null").select("row", "word").join(counts.hint("shuffle_hash"), "word", "left")
    c = F.coalesce("c", F.lit(0))
    gain = F.log10(c + 1)
    scored = score_texts(texts, network)
    outside = rest.select("row", F.lit(None).cast(dict(docs.dtypes)["doc_id"]).alias("doc_id"), F.lit(None).cast("bigint").alias("n_tokens"),
                          (c > 0).cast("bigint").alias("n_known"), gain.alias("gain"), gain.alias("score"))
    summed = scored.unionByName(outside).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("gain").alias("gain"), F.sum("score").alias("score"))
    room = float(np.log10(vocabulary.tokens + vocabulary.distinct + 1))
    return summed.select(
        "doc_id", (crc_mod("doc_id", held_out[0]) == held_out[1]).alias("held_out"), "n_tokens", "n_known",
        F.lit(vocabulary.tokens).cast("bigint").alias("train_tokens"),
        (F.col("gain") - F.col("n_tokens") * F.lit(room)).alias("base_score"), "score")
