"""Token ids of whole texts, as little-endian bytes, with a memory of words.

The tokenizer is the library's; its file's path is a parameter. For a
tokenizer that drops white space and never joins across it, a text's ids are
its pieces' ids in order. Texts of ASCII and Latin-1 letters are cut by the
tokenizer's own pattern, and each distinct piece goes through the library's
merge model once a worker and is remembered (a bounded memory, cleared when
full). In any other text, words with other characters go through the whole
library one by one.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array

import numpy as np

#: Pieces remembered by a worker; 300,000 take about 60 MB.
REMEMBERED = 300_000
#: Longer pieces aren't remembered.
LONG = 64
DEFAULT = "word_bpe_49k.json"
#: Id that ends a document.
END = 2

# the tokenizer's alternatives; letters and digits first, as none of its endings begins with one
_PIECE = re.compile("[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^ \t-\ra-zß-öø-ÿ0-9]+")
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")


def default_path() -> str:
    """Where the public tokenizer file lies on this machine; every executor has its own copy."""
    import public_tokenizers

    return public_tokenizers.path(DEFAULT)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the rest for U+0100 on."""
    same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(same)]
    return {b: chr(b) for b in same} | {b: chr(0x100 + k) for k, b in enumerate(rest)}


def drops_space(path: str) -> bool:
    """Whether the file's tokenizer keeps only matches of a pattern that excludes white space."""
    spec = json.load(open(path))  # noqa: SIM115
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    return bool(steps) and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True and "|[^\\s" in json.dumps(steps[0]["pattern"]).replace("\\\\", "\\")


class _Memory(dict):
    """piece -> ids as bytes; a miss encodes."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece):
        value = self.encode(piece)
        if len(piece) <= LONG:
            self[piece] = value
        return value


class Encoder:
    """Encodes texts (UTF-8 bytes) to ids; ``dtype`` is uint16 where the vocabulary fits it."""

    def __init__(self, path: str, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 65536 else "<u4")
        self.pack = "H" if self.dtype.itemsize == 2 else "I"
        self.by_word = drops_space(path) and sys.byteorder == "little"
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = str.maketrans({chr(b): s for b, s in _byte_letters().items()})
        self.model = self.tokenizer.model
        self.pieces = _Memory(self._piece)

    def _library(self, text: str) -> bytes:
        return array(self.pack, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return array(self.pack, [t.id for t in self.model.tokenize(mapped)]).tobytes()

    def _plain(self, text: str) -> bool:
        return _PLAIN.fullmatch(text) is not None and not ("<" in text and any(s in text for s in self.special))

    def ids(self, data: bytes) -> bytes:
        """The text's ids, without an end id."""
        text = data.decode("utf-8", "replace")
        if not self.by_word:
            return self._library(text)
        if len(self.pieces) >= REMEMBERED:
            self.pieces.clear()
        if self._plain(text):
            return b"".join(map(self.pieces.__getitem__, _PIECE.findall(text.lower())))
        return b"".join([b"".join(map(self.pieces.__getitem__, _PIECE.findall(w.lower()))) if self._plain(w) else self._library(w) for w in re.split("[ \t-\r]+", text)])


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, special: bool = True) -> Encoder:
    """This worker's encoder of a file. special: strings of special tokens in a text become their ids."""
    if (path, special) not in _encoders:
        _encoders[path, special] = Encoder(path, special)
    return _encoders[path, special]
