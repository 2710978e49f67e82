"""Token ids of whole texts: the tokenizers library encodes each distinct fragment once, and texts are put together.

Pre-tokenizers of the two kinds below never join what a single space or line break parts, so a text's ids are its
fragments' ids in order. A text for which that is not certain (runs of white space, a special token's string) is given to
the library whole, and so is every text if the file describes another kind of tokenizer. Results are the library's.
"""

from __future__ import annotations

import json
import re
import struct
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

#: Fragments that one Python worker remembers; later ones are encoded again each time.
MAX_REMEMBERED = 800_000
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIGNS = "!-&(-/:-@\\[-`{-~"
_PLAIN = re.compile(f"(?:[{_LETTERS}]+)?[{_SIGNS}]*")
_CORE = re.compile(f"[{_LETTERS}]*")
_LOOSE = re.compile(r"\s\s|\A\s|\s\Z")
_OTHER_SPACE = re.compile(r"[^\S \n]")
_PAIRS = ("  ", "\n\n", " \n", "\n ")
_SPACES = re.compile(r"\s (?:\s|\Z)")


def _byte_letters() -> dict[int, int]:
    """The printable stand-in of each byte in byte-level vocabularies: itself if visible, else the next from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: 256 + n for n, b in enumerate(hidden)}


_STAND_IN = _byte_letters()
_SPACE = chr(_STAND_IN[ord(" ")])


def _is_loose(text: str) -> bool:
    """Whether white space stands in a run or at an end. Spaces and line breaks are looked up as they are, which is quicker
    than the pattern; a text with any other white space is left to it."""
    if _OTHER_SPACE.search(text):
        return _LOOSE.search(text) is not None
    return text[0] in " \n" or text[-1] in " \n" or any(pair in text for pair in _PAIRS)


class _Remembered(dict):
    """Fragment to id bytes; a missing one is encoded, and kept while there is room."""

    def __init__(self, encoder: Encoder, prefix: str) -> None:
        super().__init__()
        self.encoder, self.prefix = encoder, prefix

    def __missing__(self, fragment: str) -> bytes:
        ids = self.encoder.fragment(fragment, self)
        if len(self) < MAX_REMEMBERED:
            self[fragment] = ids
        return ids


class Encoder:
    """Ids of texts, as arrays of the smallest unsigned type that holds the vocabulary."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.kind = self._kind(described)
        self.specials = [t["content"] for t in described["added_tokens"]]
        self.first, self.rest = _Remembered(self, ""), _Remembered(self, " ")
        self.model = self.tokenizer.model
        self.line_break = self._library("\n") if self.kind == "bytes" else b""

    @staticmethod
    def _kind(described: dict) -> str:
        steps = described["pre_tokenizer"] or {}
        names = [x["type"] for x in steps.get("pretokenizers", [steps])if x]
        if described["model"]["type"] != "BPE" or described["model"].get("dropout") or described["post_processor"]:
            return "whole"
        if names == ["ByteLevel"] and described["normalizer"] is None:
            return "bytes" if steps["use_regex"] and not steps["add_prefix_space"] else "whole"
        if names == ["Split", "ByteLevel"] and described["model"].get("end_of_word_suffix"):
            split, level = steps["pretokenizers"]
            rules = [x["type"] for x in (described["normalizer"] or {}).get("normalizers", [])]
            plain = not level["use_regex"] and not level["add_prefix_space"] and rules == ["NFC", "Replace", "Lowercase"]
            return "words" if plain and split["invert"] and split["behavior"] == "Removed" else "whole"
        return "whole"

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of letters only or signs only, perhaps after a space: one piece for the model."""
        if not piece.isascii():
            spelled = piece.encode().decode("latin-1").translate(_STAND_IN)
        else:  # letters and signs stand for themselves
            spelled = _SPACE + piece[1:] if piece[0] == " " else piece
        ids = [t.id for t in self.model.tokenize(spelled)]
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def fragment(self, fragment: str, known: _Remembered) -> bytes:
        """Ids of a fragment that `known` lacks; a word and the signs after it are looked up there one by one."""
        if not fragment or not _PLAIN.fullmatch(fragment):
            return self._library(known.prefix + fragment)
        cut = _CORE.match(fragment).end()
        core, signs = fragment[:cut], fragment[cut:]
        core, prefix = (core.lower(), "") if self.kind == "words" else (core, known.prefix)
        if core + signs == fragment and not (core and signs):
            return self._piece(prefix + fragment)
        return known[core] + (self.first[signs] if signs else b"")

    def encode(self, text: str) -> np.ndarray:
        """The ids of one whole text."""
        return np.frombuffer(self._encode(text), dtype=self.dtype)

    def _encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.kind == "whole" or any(s in text for s in self.specials):
            return self._library(text)
        if self.kind == "words":
            return b"".join(map(self.first.__getitem__, text.replace("\n", " ").split(" ")))
        if not _is_loose(text):
            lines = []
            for line in text.split("\n"):
                words = line.split(" ")
                lines.append(b"".join([self.first[words[0]], *map(self.rest.__getitem__, words[1:])]))
            return self.line_break.join(lines)
        if not _SPACES.search(text):
            words = text.split(" ")
            return b"".join([self.first[words[0]] if words[0] else b"", *map(self.rest.__getitem__, words[1:])])
        return self._library(text)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per file and Python worker, so that later tasks find the fragments it knows."""
    return Encoder(path)
