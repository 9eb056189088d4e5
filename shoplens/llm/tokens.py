"""Token ids of whole texts with the ``tokenizers`` library and a bounded word cache."""

from __future__ import annotations

import os
import re
import sys
from array import array

ID_BYTES = 4
# ASCII signs that no pre-token joins to a letter or digit (the apostrophe does).
_TAIL = re.compile(r"[.,;:!?#$%&*|)]+\Z")
ODD_SPACE = re.compile(r"[^\S \n]|[ \n][ \n]|\A[ \n]|[ \n]\Z")


def byte_letters() -> dict[int, str]:
    """Byte-level BPE's printable stand-in for each byte (the public scheme)."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = byte_letters()


def packed(ids) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder != "little":
        out.byteswap()
    return out.tobytes()


class WordCache(dict):
    """Encoded bytes by space-free part of a text; emptied when it is full.

    A part is encoded alone, which gives the ids it has in its text: both
    vocabularies used here start a new pre-token at every single space or
    newline.  With ``spaced`` the space before a part belongs to its first
    token (a part that starts with a newline has none).  Strings of special
    tokens are found as the library finds them (a text that holds one is
    encoded whole); without ``special`` they are ordinary text.
    """

    def __init__(self, path: str, spaced: bool, limit: int = 800_000, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one Spark task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        self.special = re.compile("|".join(map(re.escape, added)), re.I) if added else None
        self.model = self.tokenizer.model
        self.lead, self.mark = (" ", _LETTERS[32]) if spaced else ("", "")
        self.limit = limit

    def whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __missing__(self, part: str) -> bytes:
        if part.isascii() and part.isalpha():  # letters that stand for themselves
            ids = packed([t.id for t in self.model.tokenize(self.mark + part if self.mark else part.lower())])
            if len(self) >= self.limit:
                self.clear()
            self[part] = ids
            return ids
        if not part:
            return b""
        tail = _TAIL.search(part)
        body = part[1:] if part[0] == "\n" else part
        if tail and tail.start() and part[tail.start() - 1].isalnum() and part[tail.start() - 1] < "Ā":
            ids = self[part[: tail.start()]] + self.tail(tail[0])
        elif body.isalpha() and max(body) < "Ā":
            # one pre-token of Latin-1 letters: straight to the merges
            ids = b"" if body is part else self.tail("\n")
            word = (self.lead if body is part else "") + body if self.lead else body.lower()
            units = word.encode().decode("latin-1").translate(_LETTERS)
            ids += packed([t.id for t in self.model.tokenize(units)])
        else:
            ids = self.whole(part if body is not part else self.lead + part)
        if len(self) >= self.limit:
            self.clear()
        self[part] = ids
        return ids

    def tail(self, signs: str) -> bytes:
        key = "\0" + signs  # not a part: the sign run has no space before it
        ids = self.get(key)
        if ids is None:
            ids = self[key] = self.whole(signs)
        return ids

    def encode(self, text: str) -> bytes:
        """All ids of ``text``, packed."""
        if self.special and self.special.search(text):
            return self.whole(text)
        if not self.lead:
            return b"".join(map(self.__getitem__, text.replace("\n", " ").split(" ")))
        if not text:
            return b""
        if ODD_SPACE.search(text):
            return self.whole(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        return self.whole(first) + b"".join(map(self.__getitem__, rest))

    def encode_behind_space(self, text: str) -> bytes:
        """All ids of a space and ``text``, of a cache with ``spaced``."""
        if not text or ODD_SPACE.search(text) or (self.special and self.special.search(text)):
            return self.whole(" " + text)
        return b"".join(map(self.__getitem__, text.replace("\n", " \n").split(" ")))


_CACHES: dict[tuple[str, bool], WordCache] = {}


def word_cache(path: str, spaced: bool) -> WordCache:
    """This Python worker's cache for a vocabulary file, kept across tasks."""
    key = (path, spaced)
    if key not in _CACHES:
        _CACHES[key] = WordCache(path, spaced)
    return _CACHES[key]
