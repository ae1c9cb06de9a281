"""Token ids of whole texts for a word-level BPE vocabulary file, as little-endian 32-bit ids.

The file's own library defines the ids. No word crosses white space and texts repeat their words, so
each white-space-free chunk is encoded once per worker and joined by dictionary look-ups. New chunks
go through a byte-pair engine that merges by the rank of the joined bytes; the end of a word is a
byte that UTF-8 never holds. Chunks with signs beyond Latin letters and common punctuation, chunks that may
name a special token (which the library turns into its id), and texts with the four separators that only
Python counts as white space go to the library itself, with the settings of its file.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

CACHED_CHUNKS = 500_000
#: How the vocabulary file splits a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_END = b"\xff"
#: How the special tokens of the file begin; they match as they are, before any change of the text.
SPECIAL = "<|"


def printable_bytes() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    stand_in = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return stand_in | {chr(256 + i): b for i, b in enumerate(rest)}


class WordBpe(dict):
    """Maps a chunk without white space to its ids; a mapping so that look-ups stay in C."""

    def __init__(self, path: str) -> None:
        import regex
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        byte_of, end = printable_bytes(), model["end_of_word_suffix"]

        def raw(token: str) -> bytes:
            ended = token.endswith(end)
            body = token[: -len(end)] if ended else token
            return bytes(byte_of[c] for c in body) + _WORD_END * ended

        special = {t["content"] for t in json.loads(self.whole.to_str())["added_tokens"]}
        vocab = {raw(t): i for t, i in model["vocab"].items() if t not in special}
        ranks = {bytes([b]): b for b in range(256)}
        ends = sorted(t for t in vocab if len(t) == 2 and t.endswith(_WORD_END))
        merged = ("".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"])
        for token in [*ends, *map(raw, merged)]:
            ranks.setdefault(token, len(ranks))
        encoding = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})
        self.encode_word = encoding._core_bpe.encode_single_piece
        self.id_bytes = [vocab.get(t, 0).to_bytes(4, "little") for t in sorted(ranks, key=ranks.get)]
        self.words = regex.compile(WORDS)
        self.odd = regex.compile(r"[^\t\n\r\x20-\x7e\xa1-\xffĀ-įı-ňŊ-ž‐-‧€]")

    def __missing__(self, chunk: str) -> bytes:
        if SPECIAL in chunk or (not (chunk.isascii() and chunk.isprintable()) and self.odd.search(chunk)):
            ids = self.by_library(chunk)
        else:
            low = chunk.lower()
            words = (low,) if low.isalpha() else self.words.findall(low)
            ids = b"".join([self.id_bytes[i] for w in words for i in self.encode_word(w.encode() + _WORD_END)])
        if len(self) >= CACHED_CHUNKS:
            self.clear()
        self[chunk] = ids
        return ids

    def by_library(self, text: str) -> bytes:
        return b"".join([i.to_bytes(4, "little") for i in self.whole.encode(text, add_special_tokens=False).ids])

    def ids(self, text: str) -> bytes:
        """The ids of a whole text."""
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return self.by_library(text)
        return b"".join(map(self.__getitem__, text.split()))


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """One encoder per worker process and file."""
    return WordBpe(path)
