"""Text normalisation, tokenisation, n-grams and sequence alignment helpers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The ASCII punctuation characters.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# The entity replacements and token rules of the mteval v13a convention.
ENTITIES_13A = (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))
RULES_13A = (
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
)
# Python's idea of white space and of a word character, which cover all of Unicode
SPACES = r"(?U)\s+"

Tokenizer = Callable[[Column], Column]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def squeeze(text: str | Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(_col(text), SPACES, " "))


def words(text: str | Column) -> Column:
    """Split on white space; an empty text has no words."""
    return F.filter(F.split(squeeze(text), " "), lambda w: w != "")


def remove_punctuation(text: str | Column) -> Column:
    return F.translate(_col(text), PUNCTUATION, "")


def normalize_answer(text: str | Column) -> Column:
    """Lower case, no ASCII punctuation, no articles, single spaces."""
    bare = remove_punctuation(F.lower(_col(text)))
    return squeeze(F.regexp_replace(bare, r"(?U)\b(a|an|the)\b", " "))


def strip_text(text: str | Column, regexes: list[str] | None = None, ignore_case: bool = False,
               ignore_punctuation: bool = False, ignore_numbers: bool = False) -> Column:
    """Remove the given patterns, then case, punctuation and digits, in this order."""
    text = _col(text)
    for pattern in regexes or []:
        text = F.regexp_replace(text, pattern, "")
    if ignore_case:
        text = F.lower(text)
    if ignore_punctuation:
        text = remove_punctuation(text)
    if ignore_numbers:
        text = F.translate(text, "0123456789", "")
    return text


def tokenize_13a(text: str | Column) -> Column:
    text = _col(text)
    for old, new in (("<skipped>", ""), ("-\n", ""), ("\n", " "), *ENTITIES_13A):
        text = F.replace(text, F.lit(old), F.lit(new))
    text = F.concat(F.lit(" "), text, F.lit(" "))
    for pattern, replacement in RULES_13A:
        text = F.regexp_replace(text, pattern, replacement)
    return words(text)


def rouge_tokens(text: str | Column) -> Column:
    """Lower-cased runs of a-z and 0-9."""
    clean = F.regexp_replace(F.lower(_col(text)), "[^a-z0-9]+", " ")
    return F.filter(F.split(clean, " "), lambda w: w != "")


def characters(text: str | Column) -> Column:
    """All characters but white space."""
    return F.filter(F.split(F.regexp_replace(_col(text), SPACES, ""), ""), lambda c: c != "")


def ngrams(tokens: str | Column, n: int, separator: str = " ") -> Column:
    tokens = _col(tokens)
    starts = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
    grams = F.transform(starts, lambda i: F.array_join(F.slice(tokens, i, n), separator))
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def jaccard(a: str | Column, b: str | Column) -> Column:
    """Overlap of the space-separated token sets, after dropping . , ; : and splitting at slashes."""
    def tokens(c):
        return F.split(F.translate(F.lower(F.translate(c, ".,;:", "")), "/", " "), " ", -1)

    a, b = tokens(_col(a)), tokens(_col(b))
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def edit_counts(a, b) -> int:
    """Edit distance of two sequences; one numpy pass per element of `a`."""
    if len(a) == 0 or len(b) == 0:
        return max(len(a), len(b))
    codes: dict = {}
    x = [codes.setdefault(t, len(codes)) for t in a]
    y = np.array([codes.setdefault(t, len(codes)) for t in b])
    ramp = np.arange(len(y) + 1)
    row = ramp.copy()
    for i, t in enumerate(x):
        step = np.empty_like(row)
        step[0] = i + 1
        step[1:] = np.minimum(row[:-1] + (y != t), row[1:] + 1)
        row = np.minimum.accumulate(step - ramp) + ramp  # insertions, all at once
    return int(row[-1])


def _pairwise(count: Callable, a: pa.Array, b: pa.Array) -> pa.Array:
    """`count` of each pair of lists; only one pair at a time stands as Python objects."""
    return pa.array([count(x.as_py(), y.as_py()) for x, y in zip(a, b)], pa.int64())


@F.arrow_udf(T.LongType())
def word_edit_distance(a: pa.Array, b: pa.Array) -> pa.Array:
    """Edit distance over two token-array columns."""
    return _pairwise(edit_counts, a, b)


def _lcs_rows(a, b):
    """After each token of `b`, an integer whose bit i is 0 where a[i] lengthens the common subsequence."""
    where: dict = {}
    for i, t in enumerate(a):
        where[t] = where.get(t, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    yield row
    for t in b:
        hit = row & where.get(t, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def lcs_size(a, b) -> int:
    """Length of the longest common subsequence."""
    row = 0
    for row in _lcs_rows(a, b):
        pass
    return len(a) - row.bit_count()


@F.arrow_udf(T.LongType())
def lcs_length(a: pa.Array, b: pa.Array) -> pa.Array:
    return _pairwise(lcs_size, a, b)


def _lcs_positions(ref, hyp) -> set[int]:
    """Positions of `ref` on one longest common subsequence with `hyp`, taken from the ends.

    Equal tokens are always paired; otherwise the candidate is shortened if that loses
    nothing, else the reference. One bit per cell of the table is kept.
    """
    rows = list(_lcs_rows(ref, hyp))
    found, i, j = set(), len(ref), len(hyp)
    while i and j:
        if ref[i - 1] == hyp[j - 1]:
            found.add(i - 1)
            i, j = i - 1, j - 1
        elif rows[j] >> (i - 1) & 1:
            i -= 1
        else:
            j -= 1
    return found


def union_lcs_hits(ref_sentences, hyp_sentences) -> int:
    """Reference tokens covered by the union of LCS with every candidate sentence, each token used up once."""
    left_ref, left_hyp = {}, {}
    for s in ref_sentences:
        for t in s:
            left_ref[t] = left_ref.get(t, 0) + 1
    for s in hyp_sentences:
        for t in s:
            left_hyp[t] = left_hyp.get(t, 0) + 1
    hits = 0
    for ref in ref_sentences:
        covered: set[int] = set()
        for hyp in hyp_sentences:
            covered |= _lcs_positions(list(ref), list(hyp))
        for i in sorted(covered):
            t = ref[i]
            if left_ref.get(t, 0) > 0 and left_hyp.get(t, 0) > 0:
                hits += 1
                left_ref[t] -= 1
                left_hyp[t] -= 1
    return hits


@F.arrow_udf(T.LongType())
def summary_lcs_hits(ref: pa.Array, hyp: pa.Array) -> pa.Array:
    return _pairwise(union_lcs_hits, ref, hyp)
