"""Licenses, personal data and decontamination against plain scans."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from peakweave.llm import decontamination, licenses, pii
from tests.llm.helpers import ODD, clash, frame, lower, prose, words

LICENSE_TEXTS = [
    "Released under the MIT License. Then again UNDER THE MIT LICENSE", "Licensed under the Apache License, Version 2.0",
    "CC BY-NC 4.0 and cc by nc", "GNU General Public License, version 3", "gnu general public license version 2",
    "Permission is hereby granted, free of charge, to any new person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction", "under the mi license",
    "under the mitK license", "cc by", "apache license version two",
]


def plain_places(text):
    ws, found = words(text), []
    for label, phrase in licenses.PHRASES:
        p = phrase.split()
        found += [(i, label) for i in range(len(ws) - len(p) + 1) if ws[i : i + len(p)] == p]
    return found


def test_license_places_equal_a_plain_scan(spark):
    rng = random.Random(1)
    texts = LICENSE_TEXTS + ODD + [prose(rng, 200) + " under the MIT license " + prose(rng, 50)] + LICENSE_TEXTS[:2]
    rows = {r["doc_id"]: r for r in licenses.scan(clash(frame(spark, texts))).collect()}
    assert len(rows) == len(texts)
    for k, text in enumerate(texts):
        found, r = plain_places(text), rows[k]
        starts = [i for i, _ in found]
        assert (r["n_words"], r["n_base"]) == (len(words(text)), len(found))
        assert (r["first_word"], r["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1
    assert [rows[k]["labels"] for k in range(7)] == ["mit", "apache-2", "cc-by-nc", "gpl-3", "gpl-2", "mit", ""]


def test_long_notice_survives_an_inserted_word_on_a_neighbouring_diagonal(spark):
    spans = licenses.spans(frame(spark, [LICENSE_TEXTS[5]])).filter("label is not null").collect()
    assert [s["label"] for s in spans] == ["mit"] and 0.8 <= spans[0]["coverage"] <= 1 and spans[0]["start"] == 0


def test_license_scan_of_an_empty_table(spark):
    assert licenses.scan(frame(spark, [])).count() == 0


PII_TEXTS = [
    "mail a.b+c@ex-1.co.uk, x@y and @z.com a@b.com_x@d.org", "1.2.3.4 256.1.1.1 01.002.3.4.5.6.7.8 10.0.0.999",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112 5500005555555559", "+1 (555) 123-4567 +12 +123456789012345678",
    "IBAN GB82 WEST 1234 5698 7654 32 and GB82 WEST 1234 5698 7654 33", "ssn 123-45-6789" + " word" * 20 + " part 123-45-6789",
    "é😀 me@host.org 😀", "a" * 5000 + "@" + "b" * 5000, "@" * 3000, "+1" + " " * 4000, "1." * 3000,
]
PLAIN = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(re.sub(r"\D", "", m)) <= 19 and luhn(re.sub(r"\D", "", m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15),
]


def luhn(digits):
    total = 0
    for k, d in enumerate(map(int, digits[::-1])):
        total += d if k % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def plain_spans(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, pattern, ok) in enumerate(PLAIN)
             for m in re.finditer(pattern, text or "") if ok(m[0])]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def test_base_spans_equal_plain_regular_expressions(spark):
    texts = PII_TEXTS + ODD
    rows = {r["doc_id"]: r for r in pii.digest(pii.spans(clash(frame(spark, texts)))).collect()}
    for k, text in enumerate(texts):
        base = plain_spans(text)
        assert rows[k]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest(), text
        assert [rows[k][f"n_{kind}"] for kind, _, _ in PLAIN] == [sum(s.startswith(f"{n}:") for s in base) for n, _, _ in PLAIN]
        assert set(base) <= set(rows[k]["spans"].split(",")) | {""}
    assert "iban:5:32" in rows[4]["spans"] and rows[4]["spans"].count("iban") == 1
    assert rows[5]["spans"].count("ssn") == 1  # the second has no context word in its favour


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab1 2.@+-_()é0", max_size=60))
def test_any_text_gives_the_plain_spans(text):
    assert [f"{k}:{a}:{b}" for a, b, k, _ in pii.find(text) if k in pii.BASE] == plain_spans(text)


def test_redaction_removes_all_spans_and_keeps_columns(spark):
    docs = clash(frame(spark, PII_TEXTS + ODD))
    out = pii.redact(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        assert r["n_chars"] == len(r["text"] or "")
        assert (r["text"] is None) == ((PII_TEXTS + ODD)[r["doc_id"]] is None)
    assert pii.redacted("x a@b.co 1.2.3.4 y", pii.find("x a@b.co 1.2.3.4 y")) == "x <EMAIL> <IP> y"
    assert pii.redact(frame(spark, [])).count() == 0


def plain_hits(text, items, window=10):
    ws, hit, found = words(text), set(), set()
    for item_id, item in items:
        it = words(item)
        n = min(window, len(it))
        grams = {tuple(it[i : i + n]) for i in range(len(it) - n + 1)} if it else set()
        for i in range(len(ws) - n + 1 if grams else 0):
            if tuple(ws[i : i + n]) in grams:
                hit.update(range(i, i + n))
                found.add("" if item_id is None else str(item_id))
    return len(ws), len(hit), sorted(found)


def benchmark_case(seed):
    rng = random.Random(seed)
    items = [(k, prose(rng, 30)) for k in range(6)] + [(6, "short one"), (7, None), (8, ""), (None, "no id here"), (9, prose(rng, 12, 3))]
    items.append((10, items[0][1]))
    texts = ODD + [prose(rng, 80) + " " + items[k % 6][1].upper() + " " + prose(rng, 5) for k in range(8)]
    texts += [prose(rng, 40, 3), "a Short ONE, no id here", items[1][1][: len(items[1][1]) // 2], items[2][1] * 3]
    return texts, items


def test_hits_equal_a_plain_window_scan(spark, monkeypatch):
    texts, items = benchmark_case(5)
    docs, bench = clash(frame(spark, texts)), spark.createDataFrame(items, "item_id bigint, text string")
    expected = {k: plain_hits(t, items) for k, t in enumerate(texts)}
    for block in (decontamination.BLOCK_BYTES, 300):  # one block, and several
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", block)
        for r in decontamination.digest(decontamination.find_matches(docs, bench)).collect():
            n, hit, found = expected[r["doc_id"]]
            assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(found), hit > 0)
            assert r["items_sha256"] == hashlib.sha256(",".join(found).encode()).hexdigest()
        kept = decontamination.clean(docs, bench)
        assert kept.columns == docs.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == [k for k, e in expected.items() if not e[1]]
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.clean(docs, none).count() == len(texts)
    assert decontamination.find_matches(frame(spark, []), bench).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=4))
def test_occurrences_of_small_alphabets(ids, items):
    bench = decontamination.Benchmark([(k, " ".join(x)) for k, x in enumerate(items)], 4)
    ws = ["abcx"[i] for i in ids]
    position, window = decontamination.occurrences(bench.ids([w.encode() for w in ws]), bench)
    assert len(position) == len(set(zip(position.tolist(), bench.length[window].tolist())))
    found = {(p, item, int(at - bench.first[bench.owner[at]])) for p, w in zip(position.tolist(), window.tolist())
             for at in bench.places(w) for item in bench.items[bench.owner[at]]}
    expected = {(p, str(k), s) for k, x in enumerate(items) if x for n in [min(4, len(x))] for s in range(len(x) - n + 1)
                for p in range(len(ws) - n + 1) if ws[p : p + n] == x[s : s + n]}
    assert found == expected


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.lists(st.lists(st.sampled_from("ab"), max_size=14), max_size=5))
def test_longest_matches_of_small_alphabets(ids, items):
    """Stretches of a document that stand in an item and in no longer such stretch."""
    rows = [(k, " ".join(x)) for k, x in enumerate(items)]
    ws = ["abx"[i] for i in ids]
    bench = decontamination.Benchmark(rows, 3)
    found = decontamination.search_shard([[w.encode() for w in ws], [], [w.encode() for w in ws]], [bench])
    assert found[0] == found[2] and found[1] == {"n_words": 0, "hits": [], "items": [], "matches": []}
    long = [x for x in items if len(x) >= 3]
    reach = [max((n for x in long for n in range(3, len(x) + 1) if len(ws) >= p + n
                  and any(x[s : s + n] == ws[p : p + n] for s in range(len(x) - n + 1))), default=0) for p in range(len(ws))]
    stretches = {(p, n) for p, n in enumerate(reach) if n}
    stretches = {(p, n) for p, n in stretches if not any((q, m) != (p, n) and q <= p and q + m >= p + n for q, m in stretches)}
    full = [m for m in found[0]["matches"] if m["length"] >= 3]
    assert sorted((m["start"], m["length"]) for m in full) == sorted(stretches)
    for m in found[0]["matches"]:
        words_ = items[int(m["item_id"])]
        assert words_[m["item_start"] : m["item_start"] + m["length"]] == ws[m["start"] : m["start"] + m["length"]]


def test_matches_grow_with_words_not_with_items(spark):
    text = "same " * 4000
    for n in (50, 200):
        bench = spark.createDataFrame([(k, "same") for k in range(n)] + [(n, "same " * 300)], "item_id bigint, text string")
        row = decontamination.find_matches(frame(spark, [text]), bench).first()
        assert len(row["items"]) == n + 1 and [tuple(h) for h in row["hits"]] == [(0, 4000)]
        assert len([m for m in row["matches"] if m["length"] == 1]) == 4000
        assert 4000 // 300 <= len([m for m in row["matches"] if m["length"] > 1]) <= 4000


def test_suffix_array_orders_suffixes():
    a = np.array([2, 1, 2, 1, 0, 3, 2, 1, 1, 0], dtype=np.int32)
    order = decontamination.suffix_array(a, 16)
    rows = [a[i:].tolist() + [0] * 16 for i in order]
    assert rows == sorted(rows) and sorted(order.tolist()) == list(range(len(a)))


def test_longest_match_and_its_place(spark):
    item = " ".join(f"q{k}" for k in range(25))
    found = decontamination.find_matches(
        frame(spark, [f"before {item} after", " ".join(f"q{k}" for k in range(3, 20))]),
        spark.createDataFrame([(4, item)], "item_id bigint, text string"))
    matches = {r["doc_id"]: [tuple(m) for m in r["matches"]] for r in found.collect()}
    assert matches == {0: [("4", 0, 1, 25)], 1: [("4", 3, 0, 17)]}
    assert lower("AÉ") == "aÉ"


def test_an_iban_ends_before_a_word_in_capitals():
    ibans = ("BE68 5390 0754 7034", "BE68539007547034", "DE89 3704 0044 0532 0130 00", "AT61 1904 3002 3457 3201",
             "NO93 8601 1117 947", "GB82 WEST 1234 5698 7654 32", "MT84 MALT 0110 0001 2345 MTLC AST0 01S")
    for iban in ibans:
        for behind in ("", " BIC GEBABEBB", " BANK", " BANK OF X", " A", " TRANSFER", " 2024 1234 ABC", f" {ibans[0]} END"):
            for before in ("", "IBAN ", "XY12 3456 ABCD "):
                text = f"{before}{iban}{behind}"
                found = [text[a:b] for a, b, kind, _ in pii.find(text) if kind == "iban"]
                assert found == [iban, *ibans[:1] * (ibans[0] in behind)], text
    text = "BE68 5390 0754 7034 BIC GEBABEBB"
    assert pii.redacted(text, pii.find(text)) == "<IBAN> BIC GEBABEBB"
    assert not list(pii.ibans("BE68 5390 0754 7035 BIC"))
