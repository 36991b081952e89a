"""Personal data: regular expressions propose spans, checksums confirm them, words nearby adjust the score.

Kinds, in this order: `email`, `ip`, `card` (Luhn), `phone`, and two the method adds: `iban` (mod 97) and `ssn` (nine
digits in the written form 3-2-4, kept only where a context word stands nearby). Matches of one kind are leftmost and do
not overlap; a match that fails its check is dropped and the search goes on behind it. An `iban` may be any run of whole
groups of its match, the longest one from the earliest group on: words in capitals may stand before and behind it. Spans
count code points, the end is exclusive.

Every span has a score: a base value per kind, raised when one of the kind's context words stands within CONTEXT
characters before it or behind it, lowered when a word that speaks against it does. Kinds with a base pattern are
reported at any score; the added kinds need at least MIN_ADDED.

Defined cases: a null or empty text has no spans; several kinds may cover the same characters, each is reported, and
`redact` replaces their union once, under the first kind; repeated rows give repeated results; other columns are left as
they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
BASE = KINDS[:4]
CONTEXT = 40
MIN_ADDED = 0.5

# Characters of the local part, the patterns and the letters' values of an IBAN.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# Possessive quantifiers and the lookbehind change no match: a run that fails at its start fails at each later start.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[0-9A-Z]{4}){2,7}(?:\x20?[0-9A-Z]{1,3})?(?![0-9A-Za-z])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
NO_DIGITS = str.maketrans("", "", " -().+")

PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "ssn": 0.3}
FOR = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "address", "host", "server", "login"),
    "card": ("card", "visa", "mastercard", "credit", "payment", "cvv"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "whatsapp"),
    "iban": ("iban", "account", "bank", "bic", "transfer"),
    "ssn": ("ssn", "social", "security"),
}
AGAINST = {"email": ("example",), "ip": ("version", "release"), "card": ("isbn", "order", "serial"),
           "phone": ("version",), "iban": (), "ssn": ("part", "serial", "order")}
FOR_RE = {k: re.compile(r"\b(?:" + "|".join(v) + r")\b", re.I) for k, v in FOR.items()}
AGAINST_RE = {k: re.compile(r"\b(?:" + "|".join(v) + r")\b", re.I) if v else None for k, v in AGAINST.items()}


def luhn(digits: str) -> bool:
    total = 0
    for n, d in enumerate(reversed(digits)):
        value = int(d) * (1 + n % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def mod_97(iban: str) -> bool:
    compact = iban.replace(" ", "")
    moved = compact[4:] + compact[:4]
    return 15 <= len(compact) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+`, found from each `@` backwards in linear time."""
    low, at = 0, text.find("@")
    while at >= 0:
        before = text[low:at]
        start = low + len(before.rstrip(LOCAL))
        low = at + 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            low = m.end()
        at = text.find("@", low)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Confirmed matches of `IBAN`: the longest part that ends with a group; the search goes on behind it, and behind the
    first four characters where there is none."""
    m = IBAN.search(text)
    while m:
        start, end = m.span()
        while end > start and not mod_97(text[start:end]):
            end = text.rfind(" ", start, end)
        if end > start:
            yield start, end
        m = IBAN.search(text, end if end > start else start + 4)


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Confirmed spans, kind by kind."""
    for start, end in emails(text):
        yield "email", start, end
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            yield "ip", *m.span()
    for m in CARD.finditer(text):
        digits = m[0].translate(NO_DIGITS)
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield "card", *m.span()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(m[0].translate(NO_DIGITS)) <= 15:
                yield "phone", *m.span()
    for start, end in ibans(text):
        yield "iban", start, end
    for m in SSN.finditer(text):
        yield "ssn", *m.span()


def score(text: str, kind: str, start: int, end: int) -> float:
    """Between 0 and 1: the kind's prior, moved by context words on either side."""
    near = (text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT])
    value = PRIOR[kind]
    if any(FOR_RE[kind].search(x) for x in near):
        value += 0.3
    if AGAINST_RE[kind] and any(AGAINST_RE[kind].search(x) for x in near):
        value -= 0.3
    return min(1.0, max(0.0, value))


def find(text: str) -> list[tuple[int, int, str, float]]:
    """(start, end, kind, score) by start, then kind."""
    found = [(start, KINDS.index(kind), end, score(text, kind, start, end)) for kind, start, end in proposals(text)]
    return [(start, end, KINDS[k], s) for start, k, end, s in sorted(found) if KINDS[k] in BASE or s >= MIN_ADDED]


def redacted(text: str, spans: list[tuple[int, int, str, float]]) -> str:
    """The text with every group of overlapping spans replaced by the first one's kind in angle brackets."""
    out, done = [], 0
    group: list = []
    for start, end, kind, _ in spans:
        if group and start < group[1]:
            group[1] = max(group[1], end)
            continue
        if group:
            out += [text[done : group[0]], f"<{group[2].upper()}>"]
            done = group[1]
        group = [start, end, kind]
    if group:
        out += [text[done : group[0]], f"<{group[2].upper()}>"]
        done = group[1]
    return "".join([*out, text[done:]])


def spans(docs: DataFrame) -> DataFrame:
    """One row per document: its id and `found`, an array of (kind, start, end, score)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches):
        for batch in batches:
            found = [[{"kind": k, "start": a, "end": b, "score": s} for a, b, k, s in find(t or "")]
                     for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, kind)], names=["doc_id", "found"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, "
             "found array<struct<kind:string,start:bigint,end:bigint,score:double>>")


def redact(docs: DataFrame) -> DataFrame:
    """The documents with their personal data replaced; `n_chars`, where there is one, follows the new text."""
    count = "n_chars" in docs.columns

    def run(batches):
        for batch in batches:
            texts = [t if t is None else redacted(t, find(t)) for t in batch.column("text").to_pylist()]
            columns = dict(zip(batch.schema.names, batch.columns))
            columns["text"] = pa.array(texts, batch.schema.field("text").type)
            if count:
                length = pc.utf8_length(columns["text"]).cast(columns["n_chars"].type)
                columns["n_chars"] = pc.if_else(pc.is_null(columns["text"]), columns["n_chars"], length)
            yield pa.RecordBatch.from_arrays(list(columns.values()), schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts and span lists as the query returns them."""
    written = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda *kinds: lambda s: s["kind"].isin(*kinds)
    base = F.filter("found", of(*BASE))
    return found.select(
        "doc_id",
        *[F.size(F.filter("found", of(kind))).cast("bigint").alias(f"n_{kind}") for kind in BASE],
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"), written(F.col("found")).alias("spans"),
        F.coalesce(F.array_max(F.transform("found", lambda s: s["score"])), F.lit(0.0)).alias("top_score"))

