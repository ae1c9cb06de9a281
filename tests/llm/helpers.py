"""Small tables with every awkward row, and brute-force versions to compare with."""

from __future__ import annotations

import re

import duckdb
import public_tokenizers

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark, texts=()):
    """Documents with nulls in any column, empty and long texts, ties, repeated rows and clashing columns."""
    long_text = " ".join(f"word{i % 977} and more" for i in range(30_000))
    rows = [
        (1, "plain words in a row that mean little to anybody here", "en", "a", 53),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, "   \n\t ", "en", None, 6),
        (5, long_text, "en", "a", len(long_text)),
        (6, "plain words in a row that mean little to anybody here", "en", "b", 53),
        (6, "plain words in a row that mean little to anybody here", "en", "b", 53),
        (None, "a row without an id", "en", "a", 19),
        (8, "x", "en", "a", 1),
        (9, "ünï çødé — 日本語 😀 \u0000 \x1c end", "xx", "a", 20),
        *[(100 + i, t, "en", "a", len(t)) for i, t in enumerate(texts)],
    ]
    clash = "keep_id string, score string, kept string, rank string, size string, label string, ids string, _near string"
    values = [(*r, "k", "s", "t", "r", "z", "l", "i", "n") for r in rows]
    return spark.createDataFrame(values, f"{DOCUMENTS}, {clash}")


def nothing(spark):
    return spark.createDataFrame([], DOCUMENTS)


def rows_of(sf_dir: str, table: str, columns: str = "*"):
    return duckdb.sql(f"SELECT {columns} FROM '{sf_dir}/{table}.parquet'").fetchall()


def shingles(text: str | None) -> frozenset:
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not words:
        return frozenset()
    k = min(5, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def near_components(texts: dict[int, str | None]) -> dict[int, int]:
    """The smallest id that each id reaches by links, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return {i: find(i) for i in ids}
