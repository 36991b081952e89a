"""Token counts of sections by offset-mapped attribution.

A document is encoded once as a whole (its fields joined by line breaks), so that its counts add up to what a model sees.
Every token's character span is then joined to the sections, which tile the document: a merge of two sorted interval
lists. A token inside one section counts there; a token that crosses boundaries goes to the section that holds most of its
characters, the earliest of equals. The line break behind a section belongs to it.

Defined cases: null fields are empty; an empty document has one empty section per field without tokens; repeated rows give
repeated sections; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from peakweave.llm.tokens import VOCABULARY, encode_spans, pieces

#: Texts encoded between two looks at the encoder's memory.
STEP = 256


def attribute_tokens(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token and whether it crosses a boundary; section k covers bounds[k] to bounds[k + 1]."""
    first = np.clip(np.searchsorted(bounds, starts, side="right") - 1, 0, len(bounds) - 2)
    last = np.clip(np.searchsorted(bounds, ends, side="left") - 1, first, len(bounds) - 2)
    section, crossing = first.copy(), last > first
    for k in np.flatnonzero(crossing).tolist():
        inner = np.arange(first[k], last[k] + 1)
        held = np.minimum(bounds[inner + 1], ends[k]) - np.maximum(bounds[inner], starts[k])
        section[k] = inner[int(held.argmax())]
    return section, crossing


def sections(docs: DataFrame, fields: tuple[str, ...] = ("text",), vocabulary: str = VOCABULARY,
             encode_special_tokens: bool = True) -> DataFrame:
    """One row per line of each field: its place, its tokens, those that cross its borders, and the document's tokens."""

    def run(batches):
        for batch in batches:
            columns = [batch.column(f).to_pylist() for f in fields]
            for at in range(0, batch.num_rows, STEP):
                yield count(batch.column("doc_id")[at : at + STEP], [c[at : at + STEP] for c in columns])

    def count(doc_ids: pa.Array, columns: list[list]) -> pa.RecordBatch:
        lines, fields_of = [], []
        for values in zip(*columns):
            parts = [(n, line) for n, v in zip(fields, values) for line in (v or "").split("\n")]
            fields_of.append([n for n, _ in parts])
            lines.append([line for _, line in parts])
        texts = ["\n".join(x) for x in lines]
        owner, name, number, start, end, tokens, crossed, total = ([] for _ in range(8))
        encoder = pieces(vocabulary, encode_special_tokens, spans=True)
        for k, (text, (ids, a, b)) in enumerate(zip(texts, encode_spans(texts, encoder))):
            widths = np.array([len(x) + 1 for x in lines[k]])
            bounds = np.concatenate([[0], np.cumsum(widths)])
            bounds[-1] -= 1
            section, crossing = attribute_tokens(a, b, bounds)
            n = len(widths)
            owner += [k] * n
            name += fields_of[k]
            number += range(n)
            start.append(bounds[:-1])
            end.append(bounds[1:])
            tokens.append(np.bincount(section, minlength=n))
            crossed.append(np.bincount(section[crossing], minlength=n))
            total += [len(ids)] * n
        whole = lambda parts: pa.array(np.concatenate(parts).astype(np.int64))
        return pa.RecordBatch.from_arrays(
            [doc_ids.take(pa.array(owner, pa.int64())), pa.array(name, pa.string()), pa.array(number, pa.int64()), whole(start),
             whole(end), whole(tokens), whole(crossed), pa.array(total, pa.int64())],
            names=["doc_id", "field", "section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"])

    return docs.select("doc_id", *fields).mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, field string, section bigint, start bigint, end bigint, "
             "n_tokens bigint, n_crossing bigint, doc_tokens bigint")
