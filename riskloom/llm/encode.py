"""Token ids of whole texts with a given tokenizer file, as little-endian id bytes.

Most words occur many times, and the library spends most of its time on
them. Where the tokenizer never joins characters across a space, a text is
cut there and each distinct piece goes through the library's own stages
(normalizer, pre-tokenizer, model) once; a bounded memo keeps its ids. The
ids equal ``Tokenizer.encode(text, add_special_tokens=False)`` with special
tokens' strings as ordinary text. Where white space only separates and the
file says what a word is, a text is normalized and cut into words as a whole
and the memo holds words alone: far fewer than pieces with their capitals and
punctuation.

``spaces`` tells what a space does: "leads" (byte-level BPE: one space may
begin the next word), "dropped" (white space only separates), or "joins"
(no assumption: whole texts go to the library).
"""

from __future__ import annotations

import json
import re
from array import array

import numpy as np
import regex

MEMO = 700_000
# A normalizer that only lower-cases ASCII text (white space separates words anyway).
_LOWERING = ["NFC", "Replace", "Lowercase"]
# White space before a space: there the pre-tokenizer splits the run itself.
_RUN = re.compile(r"[^\S\x1c-\x1f] ")
_PIECES = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")

# Fixed values of byte-level BPE: the pattern of its words, and the letters that stand for bytes.
_BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: chr(b) for b in _PRINTED} | {
    b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTED)
}


def _word_pattern(spec: dict) -> str | None:
    """The pattern of a tokenizer file's words where words are all that it matches, mapped byte by byte; else None."""
    split = spec.get("pre_tokenizer") or {}
    if split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space"):
        return _BYTE_LEVEL
    steps = split.get("pretokenizers") or []
    if [x["type"] for x in steps] == ["Split", "ByteLevel"]:
        cut, level = steps
        plain = not level.get("use_regex") and not level.get("add_prefix_space")
        if plain and cut["behavior"] == "Removed" and cut["invert"] and "Regex" in cut["pattern"]:
            return cut["pattern"]["Regex"]
    return None


# White space of the library's patterns: Python's without the four information separators.
_SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def _in_sets(pattern: str) -> bool:
    """Whether all character classes of a pattern stand inside brackets."""
    return re.search(r"\\[a-zA-Z]", re.sub(r"\[[^\]]*\]", "", pattern)) is None


class _Memo(dict):
    """Two generations: what was not asked for since the last turn goes, so frequent pieces stay and memory is bounded."""

    def __init__(self, make, limit):
        super().__init__()
        self._make, self._limit, self._old = make, limit // 2, {}

    def __missing__(self, key):
        value = self._old.get(key)
        if value is None:
            value = self._make(key)
        if len(self) >= self._limit:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value


class Encoder:
    def __init__(self, tokenizer_json: str, spaces: str = "joins", memo: int = MEMO):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True
        top = max(max(json.loads(tokenizer_json)["model"]["vocab"].values()), 0)
        self.dtype = np.dtype("<u2" if top < 2**16 else "<u4")
        self._code = "H" if self.dtype.itemsize == 2 else "I"
        self.spaces = spaces
        pattern, self._normal = _word_pattern(json.loads(tokenizer_json)), None
        if self.tokenizer.normalizer:
            self._normal = self.tokenizer.normalizer.normalize_str
        self._split = regex.compile(pattern).findall if pattern else None
        self._words = self._ascii_words = None
        if pattern and spaces == "dropped" and _in_sets(pattern):
            self._words = regex.compile(pattern.replace(r"\s", _SPACE)).findall
            plain = pattern.replace(r"\p{L}", "a-zA-Z").replace(r"\p{N}", "0-9").replace(r"\s", r"\t-\r ")
            self._ascii_words = re.compile(plain).findall if r"\p" not in plain else self._words
        self._model = self.tokenizer.model.tokenize
        self._simple = [x["type"] for x in (json.loads(tokenizer_json).get("normalizer") or {}).get("normalizers", [])] == _LOWERING
        self._plain = _Memo(self._word if self._words else self._piece, memo)
        self._led = _Memo(lambda x: self._piece(" " + x), memo)

    def _word(self, word: str) -> bytes:
        letters = word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return array(self._code, [t.id for t in self._model(letters)]).tobytes()

    def _whole(self, text: str) -> bytes:
        return array(self._code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if self._split is None:
            return self._whole(piece)
        if self._normal:
            piece = piece.lower() if self._simple and piece.isascii() else self._normal(piece)
        words = self._split(piece)
        if len(words) == 1:
            return self._word(words[0])
        led = self.spaces == "leads"
        return b"".join([self._led[w[1:]] if led and w[0] == " " else self._plain[w] for w in words])

    def encode(self, text: str | None) -> bytes:
        """All ids of ``text`` as ``dtype`` bytes."""
        if not text:
            return b""
        if self._words:
            if text.isascii() and (self._simple or not self._normal):
                words = self._ascii_words(text.lower() if self._normal else text)
            else:
                words = self._words(self._normal(text) if self._normal else text)
            return b"".join(map(self._plain.__getitem__, words))
        if self.spaces == "dropped":
            return b"".join(map(self._plain.__getitem__, text.split(" ")))
        if self.spaces == "leads":
            if _RUN.search(text):
                return b"".join(map(self._plain.__getitem__, _PIECES.findall(text)))
            first, *rest = text.split(" ")
            return self._plain[first] + b"".join(map(self._led.__getitem__, rest))
        return self._whole(text)


_BUILT: dict[tuple[int, str], Encoder] = {}


def encoder(broadcast, spaces: str) -> Encoder:
    """One encoder per Python worker: its memo outlives the task."""
    key = (broadcast.value.__hash__(), spaces)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Encoder(broadcast.value, spaces)
    return _BUILT[key]
