"""Nucleotide character tokens, padding, cropping and variant offsets as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Special token ids, then the nucleotide ids in vocabulary order.
SPECIAL_IDS = {"[CLS]": 0, "[SEP]": 1, "[BOS]": 2, "[MASK]": 3, "[PAD]": 4, "[RESERVED]": 5, "[UNK]": 6}
BASE_IDS = {"A": 7, "C": 8, "G": 9, "T": 10, "N": 11}
CLS, SEP, PAD, UNK = (SPECIAL_IDS[t] for t in ("[CLS]", "[SEP]", "[PAD]", "[UNK]"))


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode(seq: str | Column) -> Column:
    """One id per character; anything but A, C, G, T, N (case-sensitive) is unknown; '' gives [].

    The bases have consecutive ids in vocabulary order, right after the unknown id, so
    the place of a character among them (0: none) is its distance from that id.
    """
    seq = _col(seq)
    bases = F.lit("".join(BASE_IDS))
    tokens = F.transform(F.split(seq, ""), lambda c: F.lit(UNK) + F.instr(bases, c))
    return F.when(F.length(seq) == 0, F.array().cast("array<int>")).otherwise(tokens)


def decode(ids: str | Column) -> Column:
    """Ids back to text; special ids appear by name."""
    names = {i: t for t, i in {**SPECIAL_IDS, **BASE_IDS}.items()}
    table = F.create_map(*[x for i, t in names.items() for x in (F.lit(i), F.lit(t))])
    return F.array_join(F.transform(_col(ids), lambda i: F.coalesce(F.try_element_at(table, i), F.lit("[UNK]"))), "")


def attention_mask(ids: str | Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(_col(ids)))


def add_special_tokens(a: str | Column, b: str | Column | None = None) -> Column:
    """[CLS] a [SEP], or [CLS] a [SEP] b [SEP]."""
    parts = [F.array(F.lit(CLS)), _col(a), F.array(F.lit(SEP))]
    if b is not None:
        parts += [_col(b), F.array(F.lit(SEP))]
    return F.concat(*parts)


def special_tokens_mask(a: str | Column, b: str | Column | None = None) -> Column:
    """1 where `add_special_tokens` put a special token."""
    parts = [F.array(F.lit(1)), F.array_repeat(F.lit(0), F.size(_col(a))), F.array(F.lit(1))]
    if b is not None:
        parts += [F.array_repeat(F.lit(0), F.size(_col(b))), F.array(F.lit(1))]
    return F.concat(*parts)


def token_type_ids(a: str | Column, b: str | Column | None = None) -> Column:
    """0 for [CLS] a [SEP], 1 for b [SEP]."""
    first = F.array_repeat(F.lit(0), F.size(_col(a)) + 2)
    if b is None:
        return first
    return F.concat(first, F.array_repeat(F.lit(1), F.size(_col(b)) + 1))


def pad_left(ids: str | Column, max_len: int, pad_id: int = PAD) -> Column:
    """Exactly max_len ids: padded on the left, or the last max_len of a longer list."""
    ids = _col(ids)
    n = F.size(ids)
    padded = F.concat(F.array_repeat(F.lit(pad_id), F.greatest(F.lit(max_len) - n, F.lit(0))), ids)
    return F.when(n > max_len, F.slice(ids, -max_len, max_len)).otherwise(padded)


def cropped_length(ids: str | Column, max_len: int) -> Column:
    return F.least(F.size(_col(ids)), F.lit(max_len))


def pad_right(ids: str | Column, width: int | str | Column, pad_id: int = PAD) -> Column:
    ids = _col(ids)
    width = F.lit(width) if isinstance(width, int) else _col(width)
    return F.concat(ids, F.array_repeat(F.lit(pad_id), F.greatest(width - F.size(ids), F.lit(0))))


def pad_mask(ids: str | Column, width: int | str | Column) -> Column:
    """Ones for the tokens, zeros for the right padding."""
    return pad_right(F.array_repeat(F.lit(1), F.size(_col(ids))), width, 0)


def trim_right_padded(rows: str | Column, length: str | Column) -> Column:
    return F.slice(_col(rows), F.lit(1), _col(length))


def trim_left_padded(rows: str | Column, length: str | Column) -> Column:
    rows, length = _col(rows), _col(length)
    return F.slice(rows, F.size(rows) - length + 1, length)


def variant_offset(variant_id: str | Column, phenotype_id: str | Column) -> Column:
    """Position of `chrN_pos` inside the window `chrN:start-end`."""
    pos = F.split(_col(variant_id), "_")[1].cast("int")
    start = F.split(F.translate(_col(phenotype_id), "-", ":"), ":")[1].cast("int")
    return pos - start


def parse_interval(pos: str | Column) -> Column:
    """`chrN:start-end` as a struct<chrom,start,end>."""
    pos = _col(pos)
    chrom = F.substring_index(pos, ":", 1)
    span = F.split(F.substring_index(pos, ":", -1), "-")
    return F.struct(chrom.alias("chrom"), span[0].cast("long").alias("start"), span[1].cast("long").alias("end"))


def base_name(path: str | Column) -> Column:
    """File name up to its first dot."""
    return F.substring_index(F.substring_index(_col(path), "/", -1), ".", 1)
