"""Token ids by the ``tokenizers`` library, asked once for each distinct pre-token.

The pattern splits a text into pre-tokens, and each is encoded by itself, so the ids of a text
are those of its pre-tokens put together. Frequent pre-tokens are kept with their ids. What is
kept is bounded; what has no room is encoded anew. Pre-tokens of common characters go to the
library's model without being parted again; others go through the whole library.

As in the library, strings of added tokens (such as ``<|endoftext|>``) part a text first, and are their one id.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from functools import lru_cache
from itertools import compress, islice

WORDS_KEPT = 400_000


def _byte_characters() -> dict[int, str]:
    """The character of each byte in a byte-level vocabulary: itself if it can be seen, else one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)).difference(seen))
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


BYTE_CHARACTERS = _byte_characters()


def _plain_pattern() -> tuple[str, str]:
    """For texts of common Latin characters: the characters, and the pattern without \\p classes."""
    chars = [chr(c) for c in (*range(0x21, 0x7F), *range(0xA1, 0x250), *range(0x2010, 0x2028), 0x20AC)]
    letters = "".join(c for c in chars if unicodedata.category(c)[0] == "L")
    numbers = "".join(c for c in chars if unicodedata.category(c)[0] == "N")
    plain = re.escape("".join(chars))
    letter, number = re.escape(letters), re.escape(numbers)
    return (f"[\\t\\n\\r {plain}]*",
            f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{number}]+| ?[^\\s{letter}{number}]+|\\s+(?!\\S)|\\s+")


class WordEncoder:
    """``encode(texts)``: for each text its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: str, pattern: str, kept: int = WORDS_KEPT):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        import regex
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(vocabulary)
        added = {t.content: (number, t) for number, t in self.tokenizer.get_added_tokens_decoder().items()}
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for _, t in added.values()):
            raise ValueError("added tokens that depend on what is around them are not supported")
        longest_first = sorted(added, key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, longest_first))) if added else None
        self.words = regex.compile(pattern).findall
        characters, plain = _plain_pattern()
        self.is_plain, self.plain_words = re.compile(characters).fullmatch, re.compile(plain).findall
        splitter = self.tokenizer.pre_tokenizer
        self.byte_level = (isinstance(self.tokenizer.model, models.BPE) and self.tokenizer.normalizer is None
                           and isinstance(splitter, pre_tokenizers.ByteLevel) and not splitter.add_prefix_space)
        self.known = _Known()
        self.known.added = {content: number.to_bytes(4, "little") for content, (number, _) in added.items()}
        self.kept = kept

    def encode(self, texts: list[str]) -> list[bytes]:
        self.known.missed = missed = {}
        ids = [list(map(self.known.__getitem__, self.parted(t))) for t in texts]
        if missed:
            fresh = dict(zip(missed, self.ids_of(list(missed))))
            for word, gap in missed.items():
                gap += fresh[word]
            self.known.update(islice(fresh.items(), max(0, self.kept - len(self.known))))
            self.known.missed = {}
        return list(map(b"".join, ids))

    def parted(self, text: str) -> list[str]:
        """Pre-tokens and added tokens of a text, in order."""
        if self.added is None or not self.added.search(text):
            return (self.plain_words if self.is_plain(text) else self.words)(text)
        out, at = [], 0
        for found in self.added.finditer(text):
            out += [*self.words(text[at:found.start()]), found[0]]
            at = found.end()
        return [*out, *self.words(text[at:])]

    def ids_of(self, words: list[str]) -> list[bytes]:
        """Ids of pre-tokens. Those of common characters, which the library would not part again, go to its model at once."""
        if not self.byte_level:
            return self.ids_by_library(words)
        if self.is_plain("".join(words)):
            return self.ids_by_model(words)
        plain = list(map(bool, map(self.is_plain, words)))
        by_model = iter(self.ids_by_model(list(compress(words, plain))))
        by_library = iter(self.ids_by_library([w for w, known in zip(words, plain) if not known]))
        return [next(by_model if known else by_library) for known in plain]

    def ids_by_library(self, words: list[str]) -> list[bytes]:
        return [as_bytes(e.ids) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def ids_by_model(self, words: list[str]) -> list[bytes]:
        """As the library does it after it has parted a text: bytes to characters, and these to the model."""
        if not words:
            return []
        # No UTF-8 text has the byte 255.
        characters = b"\xff".join(map(str.encode, words)).decode("latin-1").translate(BYTE_CHARACTERS)
        split = characters.split(BYTE_CHARACTERS[255])
        return [as_bytes([token.id for token in tokens]) for tokens in map(self.tokenizer.model.tokenize, split)]


class _Known(dict):
    """Ids that are kept, and those of added tokens; for others a gap, to be filled, that is noted."""

    missed: dict[str, bytearray]
    added: dict[str, bytes]

    def __missing__(self, word: str) -> bytes | bytearray:
        gap = self.missed.get(word)
        if gap is None:
            if word in self.added:
                return self.added[word]
            gap = self.missed[word] = bytearray()
        return gap


def as_bytes(ids: list[int]) -> bytes:
    return array("I", ids).tobytes()


@lru_cache(maxsize=2)
def word_encoder(vocabulary: str, pattern: str, kept: int = WORDS_KEPT) -> WordEncoder:
    return WordEncoder(vocabulary, pattern, kept)
