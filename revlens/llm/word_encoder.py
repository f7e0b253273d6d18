"""Word-level BPE ids through the ``tokenizers`` library, cached by white-space chunk.

The vocabulary's normalizer collapses white space and its pre-tokens never hold any, so the
ids of a text are the ids of its white-space chunks, one after the other. Chunks repeat, so a
bounded cache answers most of them. A chunk of Latin-1 characters (stable under NFC, one-to-one
under lower case) is split by the vocabulary's own pattern and handed to the library's BPE
model; every other chunk goes through the whole library pipeline. A text that holds one of the
vocabulary's added tokens is encoded by the library as it is, added tokens and all.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import regex

from revlens.llm.common import worker_state

#: The pre-token pattern of the word vocabulary file.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
#: The same for ASCII text in lower case.
ASCII_PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+"
#: Entries held by the caches of one Python worker (about 200 bytes an entry).
CACHED_WORDS = 500_000
CACHED_CHUNKS = 250_000
#: Longer chunks are encoded without being kept.
CACHE_CHARS = 64
#: str.split() splits at these, the library's pattern does not.
_ODD_SPACE = re.compile("[\x1c-\x1f]")


def _byte_letters() -> dict[int, str]:
    """Byte -> printable letter, as byte-level pre-tokenizers write bytes."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Cache(dict):
    """A dict that computes missing values and keeps the first ``entries`` of them."""

    def __init__(self, compute, entries: int):
        super().__init__()
        self.compute, self.entries = compute, entries

    def __missing__(self, key: str) -> bytes:
        value = self.compute(key)
        if len(self) < self.entries and len(key) <= CACHE_CHARS:
            self[key] = value
        return value


class WordEncoder:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.pattern = regex.compile(PRE_TOKEN)
        self.ascii = re.compile(ASCII_PRE_TOKEN)
        #: the vocabulary's added tokens; they are found in the text as it stands
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = _Cache(self._word, CACHED_WORDS)
        self.chunks = _Cache(self._chunk, CACHED_CHUNKS)

    def encode(self, text: str) -> bytes:
        if _ODD_SPACE.search(text) or any(a in text for a in self.added):
            return self._library(text)
        return b"".join(map(self.chunks.__getitem__, text.split()))

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        plain = chunk.isascii()
        if not plain and max(chunk) > "\xff":
            return self._library(chunk)
        low = chunk.lower()
        if low.isalpha():
            return self.words[low]
        return b"".join(map(self.words.__getitem__, (self.ascii if plain else self.pattern).findall(low)))

    def _word(self, word: str) -> bytes:
        written = word if word.isascii() and word.isprintable() else \
            word.encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.model.tokenize(written)]
        return struct.pack(f"<{len(ids)}I", *ids)


def word_encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker: its caches live on from task to task."""
    return worker_state(("words", path), lambda: WordEncoder(path))
