"""Token ids of whole texts, with the ids of whitespace-separated words kept from text to text.

The vocabulary drops white space and never joins across it, so a text's ids are those of its
words, one after the other. Words come from a Zipf-like distribution: most are found in the cache
and only new ones reach the tokenizer.
"""

from __future__ import annotations

import json
import string
import sys
import unicodedata
from array import array
from pathlib import Path

import numpy as np

DEFAULT = "word_bpe_49k.json"
CACHE_WORDS = 150_000  # of each of two generations, about 30 MB

MARKS = string.punctuation.encode()
# With these steps before the model letters are one run, marks after a letter or a digit another, and
# the model sees bytes as characters.
STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
LAST_LATIN = "\u024f"  # up to here letters are whole in NFC and never join a neighbour
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE_LEVEL = {b: 0x100 + i for i, b in enumerate(b for b in range(0x100) if b not in _SHOWN)}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT)


class WordIds(dict):
    """Maps a word (bytes, ASCII letters in lower case) to its ids as little-endian integers."""

    def __init__(self, path: str | None = None, dtype: str = "<u4") -> None:
        super().__init__()
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path or default_path())
        self.tokenizer.encode_special_tokens = True
        told = json.loads(Path(path or default_path()).read_text(encoding="utf-8"))
        known = told["model"].get("type") == "BPE" and not told["model"].get("dropout") and all(told.get(k) == v for k, v in STEPS.items())
        known = known and not any(x["content"].isalpha() or not x["content"].isascii() for x in told["added_tokens"])
        self.model = self.tokenizer.model if known else None
        self.kind = {"<u4": "I", "<u2": "H"}[dtype]
        self.older: dict[bytes, bytes] = {}
        self.most = CACHE_WORDS

    def _bytes(self, numbers: list[int]) -> bytes:
        ids = array(self.kind, numbers)
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _direct(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, text: str) -> bytes:
        """Ids of a word; Latin letters alone need no step before the model."""
        if self.model is not None and text.isalpha() and max(text) <= LAST_LATIN and (text := text.lower()).isalpha():
            return self._bytes([x.id for x in self.model.tokenize(text.encode().decode("latin-1").translate(BYTE_LEVEL))])
        return self._direct(text)

    def _ends(self, core: bytes) -> bool:
        """Whether a run of the splitting pattern ends with ``core``, before marks."""
        if core[-1] < 0x80:
            return core[-1:].isalnum()
        last = core[-4:].decode(errors="ignore")[-1]
        return last <= LAST_LATIN and last.isalpha() and last.lower().isalpha()

    def __missing__(self, word: bytes) -> bytes:
        if (ids := self.older.get(word)) is not None:
            self[word] = ids
            return ids
        # "word," is two runs of the splitting pattern, a mark after a letter begins another.
        if self.model is not None:
            core = word.rstrip(MARKS)
            cut = 0 < len(core) < len(word) and self._ends(core)
        else:
            core = word[:-1]
            cut = len(word) > 2 and word[-1:] in b".,;!" and core[-1:].isalpha()
        ids = self[core] + self[word[len(core) :]] if cut else self._word(word.decode())
        if len(word) < 64:
            self[word] = ids
        return ids

    def encode(self, text: bytes | None) -> bytes:
        """All ids of a UTF-8 text, None counts as empty."""
        if not text:
            return b""
        if b"<|" in text:
            return self._direct(text.decode())
        if len(self) > self.most:
            self.older = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, text.lower().split()))


_KEPT: dict[tuple, WordIds] = {}


def word_ids(path: str | None, dtype: str = "<u4", words: int = CACHE_WORDS) -> WordIds:
    """One cache for each Python worker, kept between its tasks, of twice ``words`` words at most."""
    if (path, dtype) not in _KEPT:
        _KEPT[path, dtype] = WordIds(path, dtype)
    _KEPT[path, dtype].most = words
    return _KEPT[path, dtype]


def is_letter_table() -> np.ndarray:
    """True at each code point of a letter."""
    return np.frombuffer(bytes(unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool)
