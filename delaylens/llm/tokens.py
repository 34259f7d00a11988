"""Token ids of whole texts by the tokenizers library, with a bounded cache for the life of a worker.

A tokenizer splits a text with a pattern before it merges anything, so the ids of a text
are those of its parts. Texts of code points below 384, where the pattern's classes are
fixed, are split here with the same pattern and every new part is given to the library's
model once; any other text goes to the library whole.
"""

from __future__ import annotations

import re
import struct
from functools import cache

HALF_CACHE = 400_000

# The letters, numbers and white space below code point 384 (of it, 28 to 31 and 133 are left out).
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ſ"
NUMBERS = "0-9²³¹¼-¾"
SPACES = "\t\n\x0b\x0c\r \xa0"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
PLAIN = re.compile("[\x00-\x1b\x20-\x84\x86-ſ]*")
#: Byte-level: parts keep one space before them.
SPACED = re.compile(
    f"{CONTRACTIONS}| ?[{LETTERS}]+| ?[{NUMBERS}]+| ?[^{SPACES}{LETTERS}{NUMBERS}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+"
)
#: Words, single digits and runs of marks, in lower case and without white space.
UNSPACED = re.compile(f"{CONTRACTIONS}|[{LETTERS}]+|[{NUMBERS}]|[^{SPACES}{LETTERS}{NUMBERS}]+")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else the next from 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable}
    others = (b for b in range(256) if b not in printable)
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


def packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Parts(dict):
    """Ids of parts, found by the tokenizer's model when a part is new.

    When half the room is used, parts not asked for since the last time are dropped.
    """

    def __init__(self, model) -> None:
        super().__init__()
        self.model, self.old = model, {}
        self.letters = {byte: letter for letter, byte in byte_letters().items()}

    def __missing__(self, part: str) -> bytes:
        found = self.old.get(part)
        if found is None:
            letters = part.encode().decode("latin-1").translate(self.letters)
            found = packed([t.id for t in self.model.tokenize(letters)])
        self[part] = found
        return found

    def make_room(self) -> None:
        if len(self) > HALF_CACHE:
            self.old = dict(self)
            self.clear()


class TextIds:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    ``spaced`` says whether the tokenizer is a byte-level one, or one that lowers letters
    and drops white space. Special tokens in a text are ids of their own unless ``plain_specials``.
    """

    def __init__(self, path: str, spaced: bool, plain_specials: bool = False) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.specials = () if plain_specials else tuple(t.content for t in added)
        self.spaced = spaced
        self.parts = Parts(self.tokenizer.model)

    def of(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts."""
        self.parts.make_room()
        return [self._ids(text) for text in texts]

    def _ids(self, text: str) -> bytes:
        if not PLAIN.fullmatch(text) or any(s in text for s in self.specials):
            return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = SPACED.findall(text) if self.spaced else UNSPACED.findall(text.lower())
        return b"".join(map(self.parts.__getitem__, parts))


@cache
def text_ids(path: str, spaced: bool, plain_specials: bool = False) -> TextIds:
    """One for each tokenizer and worker, so that later tasks know the parts of earlier ones."""
    return TextIds(path, spaced, plain_specials)
