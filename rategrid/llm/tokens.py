"""Token ids of whole texts, through a word table that each Python worker keeps.

The tokenizer splits at white space before it does anything else across characters,
so a text's ids are those of its words, one after another. A word that has been seen
is looked up; only new words go through the library. The table holds at most
``WORDS`` words and starts anew beyond.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import public_tokenizers
from tokenizers import Tokenizer, pre_tokenizers

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END = 1
END_BYTES = END.to_bytes(4, "little")
WORDS = 800_000
#: Lower-case letters that no normalisation changes, then marks: one or two pieces for the model.
PLAIN = re.compile("([a-zß-öø-ÿ]+)([-.,;:!?%$&*#|()]*)")


class Words(dict[bytes, bytes]):
    """Words with their little-endian 32-bit ids; a word that is missing is encoded."""

    def __init__(self, path: str, words: int = WORDS) -> None:
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words = words
        self.tokenize = self.tokenizer.model.tokenize
        # The byte-level step shows a byte as a character of its own.
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.shown = {
            ord(c): "".join(p for p, _ in as_bytes.pre_tokenize_str(c)) for c in map(chr, range(0xC0, 0x100))
        }
        self.marks: dict[str, bytes] = {"": b""}
        self.added = [
            token.content.encode().lower() for token in self.tokenizer.get_added_tokens_decoder().values()
        ]

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.words:
            self.clear()
        text = word.decode()
        plain = PLAIN.fullmatch(text if text.isascii() else text.lower())
        if plain is None:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        else:
            letters, marks = plain.groups()
            if marks:
                if marks not in self.marks:
                    self.marks[marks] = self.piece(marks)
                ids = self[letters.encode()] + self.marks[marks]
            else:
                ids = self.piece(letters if letters.isascii() else letters.translate(self.shown))
        self[word] = ids
        return ids

    def piece(self, text: str) -> bytes:
        return array("I", [t.id for t in self.tokenize(text)]).tobytes()

    def split(self, text: str) -> list[bytes]:
        """Words at white space, A-Z folded; not so beside added tokens, which are found as written."""
        raw = text.encode()
        plain = raw.lower()
        return (raw if any(m in plain for m in self.added) else plain).split()

    def ids(self, text: str) -> bytes:
        return b"".join([self[w] for w in self.split(text)])


@lru_cache(maxsize=4)
def words(path: str, most: int = WORDS) -> Words:
    """The table of this worker process."""
    return Words(path, most)
