"""Token ids of whole texts from the word-level byte-pair vocabulary, with a memory of words."""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

from tokenizers import Tokenizer

MEMORY = 300_000  # words and pre-tokens remembered; only speed depends on it

# Characters for which composition and lower case leave one character each.
_PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-įı-ſ]+")
_PRE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ]+")


def _byte_letters() -> dict[int, str]:
    """How the byte-level vocabulary writes each byte: printable ones as themselves, others from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    letters = {b: chr(b if b in shown else next(hidden)) for b in range(256)}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0x180)}


_WRITTEN = _byte_letters()


class Words:
    """Ids (little-endian unsigned 32 bits, as bytes) of texts.

    The vocabulary drops white space and never joins across it, so a text's ids are those of its
    words in a row. A word of plain Latin letters is normalised and cut here and handed to the
    model; any other word, or one that may hold a special token, goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content[:2] for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def word(self, raw: bytes) -> bytes:
        word = raw.decode()
        if not _PLAIN.fullmatch(word) or any(s in word for s in self.special):
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        found = b""
        for part in _PRE.findall(word.lower()):
            ids = self.parts.get(part)
            if ids is None:
                ids = array("I", [t.id for t in self.model.tokenize(part.translate(_WRITTEN))]).tobytes()
                self.parts[part] = ids
            found += ids
        return found

    def ids(self, text: str | None) -> bytes:
        words = text.encode().split() if text else []
        known = self.words
        try:
            return b"".join(map(known.__getitem__, words))
        except KeyError:
            if len(known) > MEMORY:
                known.clear()
            if len(self.parts) > MEMORY:
                self.parts.clear()
            out = []
            for w in words:
                ids = known.get(w)
                if ids is None:
                    ids = known[w] = self.word(w)
                out.append(ids)
            return b"".join(out)


@lru_cache(maxsize=2)
def words(path: str) -> Words:
    """One per Python worker and vocabulary."""
    return Words(path)
