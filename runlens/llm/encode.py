"""Encoding whole texts with a public tokenizer, with a cache of word pieces.

Texts of Latin letters are cut at white space; each different word is cut with the tokenizer's own rule
(letters, single digits, other signs) into pieces, each different piece is encoded once, and the
ids are joined. Words and pieces share one cache of two generations: when the young one is full, it becomes the old one,
and what is used again moves back, so frequent words stay and memory is bounded. A piece never reaches over white space and the tokenizer treats every piece on its own,
so this equals encoding the whole text.
Texts with other characters, or with the spelling of a special token, go to the tokenizer whole, and so
does everything when the tokenizer file has another rule than the one known here.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
CACHE_WORDS = 600_000       # words of a generation; longer ones than CACHE_LETTERS are not kept
CACHE_LETTERS = 200

# The rule of the tokenizer file, and the same for Latin-1 text in lower case.
KNOWN_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LETTERS, DIGITS = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
PIECE = re.compile(f"[{LETTERS}]+|[{DIGITS}]|'(?:s|t|re|ve|m|ll|d)|[^ \t\n\r{LETTERS}{DIGITS}]+")
KNOWN_BYTES = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0x100)])


class Encoder:
    """Ids of texts as little-endian bytes of `dtype`."""

    def __init__(self, name: str = TOKENIZER):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        path = public_tokenizers.path(name)
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            rule = json.load(f)
        steps = (rule.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        norm = [x.get("type") for x in (rule.get("normalizer") or {}).get("normalizers", [])]
        self.known = (steps[0].get("pattern") == {"Regex": KNOWN_RULE} and norm == ["NFC", "Replace", "Lowercase"]
                      and rule["model"].get("end_of_word_suffix") == "</w>")
        self.ends = np.zeros(size, dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return self._encode(text).tobytes()

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)

    def _pieces(self, pieces: list[str]) -> dict[str, bytes]:
        ids = self._encode(" ".join(pieces))
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(pieces) or stops[-1] != len(ids):
            return {piece: self.whole(piece) for piece in pieces}
        raw, size = ids.tobytes(), self.dtype.itemsize
        cuts = [0, *(stops * size).tolist()]
        return {piece: raw[a:b] for piece, a, b in zip(pieces, cuts, cuts[1:])}

    def _learn(self, words: list[str]) -> None:
        """Put words that are not in the young generation there, from the old one or encoded."""
        young, old = self.young, self.old
        for w in words:
            if (ids := old.get(w)) is not None:
                young[w] = ids
        cut = {w: (w,) if w.isalpha() else PIECE.findall(w) for w in words if w not in young}
        known = {p: young.get(p) or old.get(p) for c in cut.values() for p in c}
        new = [p for p, ids in known.items() if ids is None]
        if new:
            known |= self._pieces(new)
        young.update(known)
        young.update({w: b"".join(map(known.__getitem__, c)) for w, c in cut.items()})

    def _plain(self, text: str) -> bool:
        if not self.known or "<|" in text:
            return False
        try:
            return not text.encode("latin-1").translate(None, KNOWN_BYTES)
        except UnicodeEncodeError:
            return False

    def one(self, text: str) -> bytes:
        if not self._plain(text):
            return self.whole(text)
        words = text.lower().split()
        try:
            return b"".join(map(self.young.__getitem__, words))
        except KeyError:
            new = [w for w in dict.fromkeys(words) if w not in self.young]
            self._learn(new)
            ids = b"".join(map(self.young.__getitem__, words))
            for w in new:
                if len(w) > CACHE_LETTERS:
                    del self.young[w]
            if len(self.young) > CACHE_WORDS:
                self.young, self.old = {}, self.young
            return ids

    def many(self, texts: list[str], end_id: int | None = END_ID) -> list[bytes]:
        """Ids of each text, with the end id behind them."""
        tail = b"" if end_id is None else np.array([end_id], dtype=self.dtype).tobytes()
        return [self.one(t) + tail for t in texts]

    def as_u4(self, ids: bytes) -> bytes:
        return ids if self.dtype.itemsize == 4 else np.frombuffer(ids, self.dtype).astype("<u4").tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(name: str = TOKENIZER) -> Encoder:
    """One encoder per worker process."""
    if name not in _ENCODERS:
        _ENCODERS[name] = Encoder(name)
    return _ENCODERS[name]
