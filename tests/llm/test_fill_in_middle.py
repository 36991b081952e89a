"""Fill-in-the-middle against a plain version and an exact round trip."""

import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from peakweave.llm import fill_in_middle
from tests.llm.helpers import ODD, clash, frame, prose, stored

UNIT = re.compile(r"[^\n]*\n|[^\n]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text, rate=100, share=50):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    hexed = sha(f"7:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(hexed[a : a + 8], 16) for a in (0, 8, 16, 24))
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text, text
    if h4 % 100 < share:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}", text
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}", text


def texts():
    rng = random.Random(4)
    lines = ["\n".join(prose(rng, rng.randrange(9)) for _ in range(rng.randrange(40))) for _ in range(60)]
    marked = ["a <P> b\nc", "x\n<S>", "<M>", "almost < P> <\nS>\n<", "<\n<S\nM>\n>", "é\nüß\n日本\n\n\U0001f600\nlast", "\n", "\n\n", "a\r\nb\r\n"]
    return ODD + lines + [t + "\n" for t in lines[:20]] + marked + ["no line end " * 3000, "long\n" * 40000, "\n" * 5000]


@pytest.mark.parametrize("rate,share", [(100, 50), (60, 20)])
def test_transform_equals_plain(spark, tmp_path, rate, share):
    every = texts() + ["again\nand\nagain"] * 3
    docs = stored(clash(frame(spark, every)), tmp_path / "docs")
    out = fill_in_middle.transform(docs, rate, share)
    rows = {r["doc_id"]: r for r in out.withColumn("back", fill_in_middle.restored()).collect()}
    assert len(rows) == len(every)
    for k, text in enumerate(every):
        assert tuple(rows[k][c] for c in ("n", "form", "prefix_chars", "middle_chars", "output", "back")) == plain(k, text, rate, share)
    forms = {r["form"] for r in rows.values()}
    assert forms == {"plain", "psm", "spm"}


def test_digest_repeats_null_ids_and_no_rows(spark, tmp_path):
    rows = [(5, "a\nb\nc", "en", "s", 1)] * 2 + [(None, "a\nb\nc", "en", "s", 1), (None, None, None, None, None)]
    docs = stored(spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"), tmp_path / "a")
    got = fill_in_middle.digest(fill_in_middle.transform(docs))
    expected = [(d, *plain(d, t)[:4], sha(plain(d, t)[4]), sha(t or "")) for d, t, *_ in rows]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))
    none = fill_in_middle.digest(fill_in_middle.transform(stored(frame(spark, []), tmp_path / "b")))
    assert none.columns == got.columns and none.count() == 0


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=80).map(lambda b: bytes(10 if x % 5 == 0 else x for x in b)))
def test_rank_and_select(data):
    index = fill_in_middle.LineIndex(np.frombuffer(data, dtype=np.uint8))
    at = np.arange(len(data) + 1)
    assert index.rank(at).tolist() == [data[:a].count(b"\n") for a in at]
    ends = [k for k, b in enumerate(data) if b == 10]
    assert index.select(np.arange(1, len(ends) + 1)).tolist() == ends
    assert index.select(np.array([], dtype=np.int64)).tolist() == []


def test_slices_hold_a_bounded_number_of_bytes():
    lengths = np.array([3, fill_in_middle.SLICE, 1, 2, fill_in_middle.SLICE + 5, 7])
    assert list(fill_in_middle._slices(lengths)) == [(0, 1), (1, 2), (2, 4), (4, 5), (5, 6)]
    assert list(fill_in_middle._slices(np.array([], dtype=int))) == []
