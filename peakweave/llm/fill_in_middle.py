"""Fill-in-the-middle forms of whole documents, cut between lines.

Lines are found by arithmetic on words of eight bytes (SWAR). The UTF-8 of a slice of texts is viewed as uint64; a byte
that ends a line is marked in its highest bit without a look at single bytes; `bitwise_count` gives the marks of each
word and their running sum the marks up to it. Rank and select follow from that: the number of lines of a text is a
difference of ranks, and the end of its k-th line is found by a binary search of the running sum for the word, and inside
the word by clearing its lowest marks. All texts of a slice are searched together; a slice holds SLICE bytes, or one text
that is longer.

Where a text is cut, and in which form it is put together, follows from the SHA-256 of its id alone, so that a lost task
gives the same again. Marks are `<P>`, `<S>` and `<M>`; texts that contain one stay plain, which makes every output
readable backwards by `restored`.

Defined cases: a null text is empty, an empty text is plain; a null id counts as the empty string; repeated rows are
transformed each, alike; a text without a line end is one line; other columns are ignored, and none clashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SALT = 7
RATE = 100
SPM_SHARE = 50
SLICE = 8_000_000

_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_ENDS = np.uint64(0x0A0A0A0A0A0A0A0A)
_ONE = np.uint64(1)


class LineIndex:
    """Rank and select over the line ends of a buffer."""

    def __init__(self, data: np.ndarray):
        """`data`: bytes as uint8."""
        words = np.zeros(len(data) // 8 + 1, dtype="<u8")
        words.view(np.uint8)[: len(data)] = data
        x = words ^ _ENDS
        # a byte of x is zero just where adding 0x7f to its low bits and keeping its own high bit leaves that bit clear
        self.marks = ~(((x & _LOW) + _LOW) | x | _LOW)
        self.until = np.concatenate([[0], np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Line ends before each byte position."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        below = (_ONE << (byte << np.uint64(3))) - _ONE
        return self.until[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, nth: np.ndarray) -> np.ndarray:
        """The byte position of the line end with each number, from 1."""
        word = np.searchsorted(self.until, nth, side="left") - 1
        left = nth - self.until[word] - 1
        marks = self.marks[word]
        for step in range(7):  # at most seven marks stand before the wanted one
            clear = left > step
            if not clear.any():
                break
            marks = np.where(clear, marks & (marks - _ONE), marks)
        lowest = marks & (~marks + _ONE)
        return (word << 3) + (np.bitwise_count(lowest - _ONE) >> 3)


def characters(data: np.ndarray) -> np.ndarray:
    """A running count of the code points of UTF-8 bytes: those that start in the first n bytes."""
    return np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])


def seeds(doc_id: object, salt: int = SALT) -> tuple[int, int, int, int]:
    digest = hashlib.sha256(f"{salt}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[a : a + 8], 16) for a in range(0, 32, 8))


def _slices(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of SLICE bytes, or of one longer text."""
    start = total = 0
    for n, length in enumerate(lengths.tolist()):
        if n > start and total + length > SLICE:
            yield start, n
            start, total = n, 0
        total += length
    if start < len(lengths):
        yield start, len(lengths)


def transform(docs: DataFrame, rate: int = RATE, spm_share: int = SPM_SHARE, salt: int = SALT) -> DataFrame:
    """One row per document: `doc_id`, `n` lines, `form` (plain, psm or spm), `prefix_chars`, `middle_chars`, `output`.

    `rate` of 100 documents are transformed, `spm_share` of 100 of these with the suffix first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            texts = pc.fill_null(batch.column("text"), "").cast(pa.binary())
            for a, b in _slices(pc.binary_length(texts).to_numpy()):
                yield _slice(ids.slice(a, b - a), texts.slice(a, b - a).to_pylist())

    def _slice(ids: pa.Array, texts: list[bytes]) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        starts = np.concatenate([[0], ends[:-1]])
        index = LineIndex(data)
        before, marks = index.rank(starts), index.rank(ends)
        last = np.where(ends > starts, data[np.maximum(ends, 1) - 1] if len(data) else 0, 10)
        n = marks - before + (last != 10)
        h = np.array([seeds(i, salt) for i in ids.to_pylist()], dtype=np.int64).reshape(-1, 4)
        cuts = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
        # after no line: the start; after all lines: the end; else behind the line end
        inner = (cuts > 0) & (cuts < n[:, None])
        at = np.where(cuts > 0, ends[:, None], starts[:, None])
        at[inner] = index.select((before[:, None] + cuts)[inner]) + 1
        points = characters(data)
        plain = np.array([not t or PREFIX in t or SUFFIX in t or MIDDLE in t for t in texts], dtype=bool) | (h[:, 2] % 100 >= rate)
        spm = h[:, 3] % 100 < spm_share
        local = (at - starts[:, None]).tolist()
        outputs = []
        for t, (p, m), is_plain, suffix_first in zip(texts, local, plain.tolist(), spm.tolist()):
            if is_plain:
                outputs.append(t)
            elif suffix_first:
                outputs.append(b"".join((SUFFIX, t[m:], PREFIX, t[:p], MIDDLE, t[p:m])))
            else:
                outputs.append(b"".join((PREFIX, t[:p], SUFFIX, t[m:], MIDDLE, t[p:m])))
        return pa.RecordBatch.from_arrays([
            ids, pa.array(n), pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).tolist(), pa.string()),
            pa.array(points[at[:, 0]] - points[starts], mask=plain), pa.array(points[at[:, 1]] - points[at[:, 0]], mask=plain),
            pa.array(outputs, pa.binary()).cast(pa.string())],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text from which an output was made. Each mark stands in it once, as no text with a mark is transformed."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(output, "<[PSM]>")
    return F.when(form == "psm", F.concat(parts[1], parts[3], parts[2])).when(
        form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output)


def digest(transformed: DataFrame) -> DataFrame:
    """The rows with hashes of the output and of the text rebuilt from it in place of the output."""
    return transformed.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"))
