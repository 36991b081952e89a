"""Byte-level BPE ids of whole texts, piece by piece.

The `tokenizers` model splits a text into pieces (words with their blank) and encodes each on its own, so a piece met
before needs no second encoding. Pieces are found with `re` where a text has only characters whose class is known here,
and with the vocabulary's own pattern otherwise. The vocabulary's added tokens, such as `<|endoftext|>`, are cut out of a
text first and have one id each, unless `encode_special_tokens` is set: then they are text like any other. Ids equal those
of `Tokenizer.encode(text, add_special_tokens=False)` with the same setting, whose own default is False.
"""

from __future__ import annotations

import re
from array import array

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
#: Pieces remembered by a Python worker; beyond that it starts afresh between batches.
REMEMBERED = 500_000

# The pieces of this vocabulary, over letters and digits that are surely such.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PIECES = re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+|'(?:s|t|re|ve|m|ll|d)| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")
_OTHER = re.compile(rf"[^\t\n\r\x20-\x7e¡-©«-±´¶·»¿{_LETTERS}×÷–—‘’“”„…€]")


def byte_alphabet() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones themselves, others from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: b if b in own else next(others) for b in range(256)}


class Pieces(dict):
    """Piece -> number of its entry; the ids of all entries lie in a flat array."""

    columns = ("ids",)

    def __init__(self, path: str, encode_special_tokens: bool = True):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        tokenizer = Tokenizer.from_file(path)
        self.tokenize = tokenizer.model.tokenize
        self.general = regex.compile(public_tokenizers.PATTERN)
        self.alphabet = byte_alphabet()
        self.added: dict[str, int] = {}
        for number, token in tokenizer.get_added_tokens_decoder().items():
            if not (encode_special_tokens and token.special):
                if token.single_word or token.lstrip or token.rstrip:
                    raise ValueError(f"added token {token.content!r} is not matched literally")
                self.added[token.content] = number
        # the longest of those that start at one place
        longest = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.forget()

    def forget(self) -> None:
        self.clear()
        for name in self.columns:
            setattr(self, name, array("i"))
        self.at = array("q", [0])

    def __missing__(self, piece: str) -> int:
        if piece in self.added:
            # no other piece is equal to one: all places where it stands are cut out
            self.ids.append(self.added[piece])
            self.place(piece)
        else:
            data = piece.encode()
            tokens = self.tokenize(data.decode("latin-1").translate(self.alphabet))
            self.ids.extend([t.id for t in tokens])
            self.place(piece, data, tokens)
        self.at.append(len(self.ids))
        entry = self[piece] = len(self.at) - 2
        return entry

    def place(self, piece: str, data: bytes = b"", tokens: list | None = None) -> None:
        """Note where the tokens of a piece stand; without `tokens` it is one token."""

    def split(self, text: str) -> list[str]:
        if not any(token in text for token in self.added):
            return self.ordinary(text)
        # every second part is an added token
        parts = self.cut.split(text)
        return [piece for n, part in enumerate(parts) for piece in ([part] if n % 2 else self.ordinary(part))]

    def ordinary(self, text: str) -> list[str]:
        return (self.general if _OTHER.search(text) else _PIECES).findall(text)

    def entries(self, pieces: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, pieces), dtype=np.int64, count=len(pieces))

    def gather(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each token of the entries in a row: its place in the flat arrays and the number of its piece."""
        at = np.frombuffer(self.at, dtype=np.int64)
        first, count = at[entries], at[entries + 1] - at[entries]
        owner = np.repeat(np.arange(len(entries)), count)
        return np.arange(len(owner)) + (first - (np.cumsum(count) - count))[owner], owner

    def column(self, name: str) -> np.ndarray:
        """A copy of a flat array, which may grow afterwards."""
        return np.array(getattr(self, name), dtype=np.int32)


class PlacedPieces(Pieces):
    """Pieces with the first characters and ends of their tokens."""

    columns = ("ids", "starts", "ends")

    def place(self, piece: str, data: bytes = b"", tokens: list | None = None) -> None:
        if tokens is None:
            self.starts.append(0)
            self.ends.append(len(piece))
            return
        # a token's value has one character per byte; a character cut by a token boundary belongs to both sides
        char = range(len(data)) if len(data) == len(piece) else [n for n, c in enumerate(piece) for _ in c.encode()]
        byte = 0
        for t in tokens:
            self.starts.append(char[byte])
            byte += len(t.value)
            self.ends.append(char[byte - 1] + 1)


_LOADED: dict[tuple[str, bool, bool], Pieces] = {}


def pieces(vocabulary: str = VOCABULARY, encode_special_tokens: bool = True, spans: bool = False) -> Pieces:
    """The worker's encoder; the vocabulary is a file of the public tokenizers or a path. Spans are kept where asked for."""
    key = (vocabulary, encode_special_tokens, spans)
    if key not in _LOADED:
        import os

        import public_tokenizers

        _LOADED[key] = (PlacedPieces if spans else Pieces)(
            vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary), encode_special_tokens)
    found = _LOADED[key]
    if len(found) > REMEMBERED:
        found.forget()
    return found


def encode_batch(texts: list[str], encoder: Pieces) -> list[np.ndarray]:
    """The ids of each text."""
    entries = [encoder.entries(encoder.split(t)) for t in texts]
    ids = encoder.column("ids")
    return [ids[encoder.gather(e)[0]] for e in entries]


def encode_spans(texts: list[str], encoder: PlacedPieces) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Ids, first characters and ends of each text's tokens."""
    split = [encoder.split(t) for t in texts]
    entries = [encoder.entries(p) for p in split]
    ids, starts, ends = (encoder.column(c) for c in ("ids", "starts", "ends"))
    out = []
    for parts, e in zip(split, entries):
        flat, owner = encoder.gather(e)
        widths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        base = (np.cumsum(widths) - widths)[owner]
        out.append((ids[flat], base + starts[flat], base + ends[flat]))
    return out
