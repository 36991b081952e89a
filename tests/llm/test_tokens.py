"""Token ids, section counts and packing against the tokenizer itself."""

import random
import zlib

import numpy as np
import pytest

from peakweave.llm import packing, token_counts, tokens
from tests.llm.helpers import ODD, clash, frame, prose, stored

TEXTS = ODD + ["  x  \n\n y 日本語 ½ ² it's we'll ﬁ\x1c\x85z 😀😀    <|endoftext|> naïve Ⅷ", "\n\n\n", " 'sx 's' 1a2 _b_ __"]


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    t.encode_special_tokens = True
    return t


def texts():
    rng = random.Random(2)
    return TEXTS + [prose(rng, rng.randrange(1, 900)) for _ in range(40)] + [prose(rng, 9000)]


def test_ids_and_spans_equal_the_tokenizers(tokenizer):
    plain = [t or "" for t in texts()]
    expected = tokenizer.encode_batch(plain, add_special_tokens=False)
    encoder = tokens.pieces(spans=True)
    for each in (encoder, tokens.pieces()):
        assert [x.tolist() for x in tokens.encode_batch(plain, each)] == [e.ids for e in expected]
    for (ids, a, b), e in zip(tokens.encode_spans(plain, encoder), expected):
        assert list(zip(a.tolist(), b.tolist())) == e.offsets


def test_sections_hold_every_token_once(spark, tokenizer):
    all_ = texts()
    rows = token_counts.sections(clash(frame(spark, all_))).collect()
    for k, text in enumerate(all_):
        mine = sorted((r for r in rows if r["doc_id"] == k), key=lambda r: r["section"])
        encoded = tokenizer.encode(text or "", add_special_tokens=False)
        assert [r["section"] for r in mine] == list(range((text or "").count("\n") + 1))
        assert sum(r["n_tokens"] for r in mine) == len(encoded.ids) == mine[0]["doc_tokens"]
        assert mine[0]["start"] == 0 and mine[-1]["end"] == len(text or "")
        expected = [0] * len(mine)
        for a, b in encoded.offsets:
            held = [max(0, min(b, r["end"]) - max(a, r["start"])) for r in mine]
            expected[held.index(max(held))] += 1
        assert [r["n_tokens"] for r in mine] == expected
    both = token_counts.sections(frame(spark, ["one\ntwo"]), fields=("source", "text")).collect()
    assert [(r["field"], r["section"]) for r in both] == [("source", 0), ("text", 1), ("text", 2)]
    assert token_counts.sections(frame(spark, [])).count() == 0


def test_crossing_tokens_go_to_the_larger_share_and_to_the_earlier_of_equals():
    section, crossing = token_counts.attribute_tokens(np.array([0, 2, 5]), np.array([2, 6, 7]), np.array([0, 3, 6, 8]))
    assert section.tolist() == [0, 1, 1] and crossing.tolist() == [False, True, True]


def test_packing_loses_nothing_and_pads_only_the_last(spark, tokenizer, tmp_path):
    all_ = texts() + ["copy of one text"] * 300
    docs = stored(clash(frame(spark, all_)), tmp_path / "docs")
    rows = packing.pack(docs, size=256).collect()
    ids = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == len(ids.get(r["doc_id"], []))
        ids.setdefault(r["doc_id"], []).extend(np.frombuffer(bytes(r["ids"]), "<u4").tolist())
        assert r["length"] * 4 == len(r["ids"])
    assert [ids[k] for k in range(len(all_))] == [
        [*e.ids, 1] for e in tokenizer.encode_batch([t or "" for t in all_], add_special_tokens=False)]
    assert all(r["doc_tokens"] == len(ids[r["doc_id"]]) for r in rows)
    sequences = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == sequences.get(r["sequence_id"], 0)
        sequences[r["sequence_id"]] = r["offset"] + r["length"]
    lengths = [sequences[k] for k in range(len(sequences))]
    assert set(lengths[:-1]) <= {256} and 0 < lengths[-1] <= 256
    copies = sorted({r["sequence_id"] for r in rows if r["doc_id"] >= len(texts())})
    assert len(copies) <= 300 * 6 // 256 + 2  # equal texts are neighbours on the curve
    crc = packing.digest(packing.pack(docs)).filter("doc_id = 3").first()
    assert crc["ids_crc32"] == zlib.crc32(np.array(ids[3], "<u4").tobytes())


def test_packing_an_empty_table(spark, tmp_path):
    assert packing.pack(stored(frame(spark, []), tmp_path / "none")).count() == 0


def test_hilbert_key_steps_to_a_neighbour_cell():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    keys = packing.hilbert_key(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_added_tokens_have_one_id_in_the_queries_setting(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    from peakweave.llm import queries

    default = Tokenizer.from_file(public_tokenizers.path(tokens.VOCABULARY))
    end = "<|endoftext|>"
    all_ = [*TEXTS, end, f"a {end}", f"{end}{end}  b\n", f"日本 \n {end} \n ½ <|endoftext|", f"x{end}y 's"]
    plain = [t or "" for t in all_]
    expected = default.encode_batch(plain, add_special_tokens=False)
    encoder = tokens.pieces(encode_special_tokens=False, spans=True)
    for each in (encoder, tokens.pieces(encode_special_tokens=False)):
        assert [x.tolist() for x in tokens.encode_batch(plain, each)] == [e.ids for e in expected]
    for (ids, a, b), e in zip(tokens.encode_spans(plain, encoder), expected):
        assert list(zip(a.tolist(), b.tolist())) == e.offsets
    encoder.forget()
    assert tokens.encode_batch([end], encoder)[0].tolist() == [50256]
    frame(spark, all_).write.parquet(str(tmp_path / "documents.parquet"))
    packed = queries.op3_packing(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["doc_tokens"]) for r in packed} == {(k, len(e.ids) + 1) for k, e in enumerate(expected)}
    counted = queries.op7_token_counts(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["doc_tokens"]) for r in counted} == {(k, len(e.ids)) for k, e in enumerate(expected)}
