"""Exact word-level encoding with a public BPE tokenizer, fast enough for a corpus.

The tokenizer drops white space and never merges across it, so ids of a text are the ids of
its white-space pieces in order. Pieces repeat, and are encoded once while they stay in a
bounded two-generation cache, whose size does not follow the corpus."""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import public_tokenizers

DEFAULT_PATH = public_tokenizers.path("word_bpe_49k.json")

# What the piece path was proved for; any other set-up takes the whole-text path.
_NORMALIZER = ["NFC", "Replace", "Lowercase"]
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# The same split for lower-case text of U+0021-7E and U+00A1-FF, where NFC changes nothing.
_LETTER = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_NUMBER = "0-9\xb2\xb3\xb9\xbc-\xbe"
_PLAIN = re.compile("[\x21-\x7e\xa1-\xff]+")
_LAST = ".,;:!?$%&*#|"
_ENDS = _LAST.encode()
_WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^{_LETTER}{_NUMBER}]+")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100."""
    keep = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Pieces(dict):
    """ids of pieces by their bytes, made when first asked for; ``old`` is the generation before."""

    def __init__(self, make, word, old: dict):
        self.make, self.word, self.old = make, word, old

    def __missing__(self, piece: bytes) -> bytes:
        got = self.old.get(piece)
        if got is None:
            got = self.word(piece) if piece.isalpha() and piece.islower() else self.make(piece)
        self[piece] = got
        return got


class Encoder:
    """ids as packed little-endian unsigned integers of ``dtype``; equal to the library's on whole texts."""

    def __init__(self, path: str = DEFAULT_PATH, pieces: int = 300_000, dtype: str | None = "<u4", end_id: int = 0):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        if dtype is None:  # the narrowest that holds every id
            dtype = "<u2" if max(self.tok.get_vocab_size(with_added_tokens=True) - 1, end_id) < 1 << 16 else "<u4"
        self.dtype, self.cap = np.dtype(dtype), pieces
        self.code = {2: "H", 4: "I"}[self.dtype.itemsize]
        self.tokenize, self.letters = self.tok.model.tokenize, byte_letters()
        spec = json.loads(self.tok.to_str())
        norm = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_piece = norm == _NORMALIZER and [x["type"] for x in pre] == ["Split", "ByteLevel"] and pre[0]["pattern"] == {"Regex": _SPLIT} and pre[0]["behavior"] == "Removed" and not any(a["content"] != "".join(a["content"].split()) or a["lstrip"] or a["rstrip"] for a in spec["added_tokens"])
        self.tokens = [(self.tok.id_to_token(i) or "").encode() for i in range(self.tok.get_vocab_size(with_added_tokens=True))]
        self.plain_decode = not spec.get("decoder")
        self.release()

    def release(self) -> None:
        """Empties the cache."""
        self.new = Pieces(self._piece, self._word, {})

    def library(self, text: str) -> bytes:
        return array(self.code, self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, w: bytes) -> bytes:
        """Ids of one word of the split."""
        text = w.decode() if w.isascii() else w.decode("latin-1").translate(self.letters)  # printable ASCII letters stand for themselves
        return array(self.code, [t.id for t in self.tokenize(text)]).tobytes()

    def _piece(self, piece: bytes) -> bytes:
        """Ids of a piece without white space. The words that it splits into are pieces of their own, and kept as such."""
        word = piece.rstrip(_ENDS)
        if word.isalpha():  # of bytes: A-Z and a-z alone
            if len(word) < len(piece):
                return self.new[word.lower()] + self.new[piece[len(word) :]]
            return self._word(word.lower())
        s = piece.decode("utf-8")
        if "<|" in s or not _PLAIN.fullmatch(s):
            return self.library(s)
        s = s.lower()
        word = s.rstrip(_LAST)
        if not word.isalpha():
            subs = _WORD.findall(s)
            return self._word(s.encode()) if len(subs) == 1 else b"".join([self.new[w.encode()] for w in subs])
        if len(word) == len(s):
            return self._word(s.encode())
        return self.new[word.encode()] + self.new[s[len(word) :].encode()]

    def encode(self, text: bytes) -> bytes:
        if not self.by_piece:
            return self.library(text.decode("utf-8"))
        if b"<|" not in text and b"\xcc" not in text and b"\xcd" not in text:
            text = text.lower()  # A-Z only: without combining marks this and NFC commute, and fewer pieces differ
        out = b"".join(map(self.new.__getitem__, text.split()))
        if len(self.new) > self.cap:
            self.new = Pieces(self._piece, self._word, self.new)
            self.new.old.old = {}
        return out

    def ids(self, text: bytes) -> np.ndarray:
        return np.frombuffer(self.encode(text), self.dtype)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the library's decode(ids, skip_special_tokens=False)."""
        if not self.plain_decode:
            return self.tok.decode(ids.tolist(), skip_special_tokens=False).encode()
        return b" ".join(map(self.tokens.__getitem__, ids.tolist()))


_held: dict[tuple, Encoder] = {}


def encoder(path: str = DEFAULT_PATH, dtype: str | None = "<u4", end_id: int = 0) -> Encoder:
    """One encoder for each worker process."""
    if (path, dtype, end_id) not in _held:
        _held.clear()
        _held[path, dtype, end_id] = Encoder(path, dtype=dtype, end_id=end_id)
    return _held[path, dtype, end_id]


def release() -> None:
    """What a worker held for encoding goes: later steps of a job need the memory."""
    _held.clear()
