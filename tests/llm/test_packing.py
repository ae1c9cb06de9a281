import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from helpers import WORD_BPE, awkward, nothing, rows_of
from txnsieve.llm import packing
from txnsieve.llm.queries import QUERIES
from txnsieve.llm.word_bpe import word_bpe


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(WORD_BPE)  # as it stands in its file
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_equal_the_library(library, sf_dir):
    random.seed(3)
    alphabet = "abcDEé'ßÇ.,!?-_19 \n\tœ“Σİ\x00\x1ć日😀　"
    texts = [t or "" for (t,) in rows_of(sf_dir, "documents", "text")]
    texts += ["".join(random.choice(alphabet) for _ in range(random.randint(0, 40))) for _ in range(2000)]
    texts += ["Don't I'LL ''s 12km", "x" * 400, "!?" * 200]
    texts += ["hello <|endoftext|> world", "a<|startoftext|>b<|endoftext|><|endoftext|>", "<|ENDOFTEXT|> <|endoftext |>", "<|", "é<|endoftext|>日"]
    encoder = word_bpe(WORD_BPE)
    assert library("hello <|endoftext|> world") == [3306, 49407, 1002]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), np.uint32).tolist() == library(text), text[:80]


def check_pieces(rows, documents, library, window):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc_id, text in documents:
        ids = np.array([*library(text or ""), 2], dtype="<u4")
        pieces = sorted(by_doc.pop(doc_id), key=lambda r: r["start"])
        assert [p["start"] for p in pieces] == [sum(q["length"] for q in pieces[:i]) for i in range(len(pieces))]
        assert sum(p["length"] for p in pieces) == len(ids)
        for p in pieces:
            assert p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes())
    assert not by_doc
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [p["offset"] for p in pieces] == [sum(q["length"] for q in pieces[:i]) for i in range(len(pieces))]
        assert sum(p["length"] for p in pieces) <= window
    return by_sequence


def test_whole_table(spark, sf_dir, library):
    rows = QUERIES["op2_packing"](spark, sf_dir).collect()
    sequences = check_pieces(rows, rows_of(sf_dir, "documents", "doc_id, text"), library, 4096)
    tokens = sum(r["length"] for r in rows)
    assert len(sequences) <= -(-tokens // 4096) + 1


def test_awkward_rows(spark, library):
    docs = awkward(spark)
    rows = packing.pack(docs, WORD_BPE, window=64, bins=16).collect()
    assert sum(r["length"] for r in rows if r["doc_id"] == 6) == 2 * (len(library(docs.where("doc_id = 1").first()["text"])) + 1)
    places = [(r["sequence_id"], r["offset"] + i) for r in rows for i in range(r["length"])]
    assert len(places) == len(set(places))
    assert [(r["length"], r["doc_tokens"]) for r in rows if r["doc_id"] == 2] == [(1, 1)]
    assert packing.pack(nothing(spark), WORD_BPE).count() == 0


def test_least_squares_and_plan():
    rng = np.random.default_rng(1)
    a, x = rng.random((30, 40)), np.maximum(0, rng.normal(size=40))
    b = a @ x
    assert np.abs(a @ packing.non_negative_least_squares(a, b) - b).max() < 1e-4
    combos = {tuple(c) for c in packing.combinations(6, 3)}
    assert combos == {(6, 0, 0), (5, 1, 0), (4, 2, 0), (3, 3, 0), (4, 1, 1), (3, 2, 1), (2, 2, 2)}
    for n in (1, 50, 5000):
        lengths = np.clip(rng.lognormal(5.5, 1.2, n).astype(int), 1, 4096)
        values, counts = np.unique(lengths, return_counts=True)
        layout = packing.plan(dict(zip(values.tolist(), counts.tolist())))
        rank = np.concatenate([np.arange(c) for c in counts])
        sequence, offset = packing.place(layout, np.repeat(values, counts), rank, int(counts.max()) + 1)
        filled = np.zeros((sequence.max() + 1, 4096), dtype=np.int8)
        for s, o, v in zip(sequence, offset, np.repeat(values, counts)):
            filled[s, o : o + v] += 1
        assert filled.max() == 1 and len(filled) <= -(-lengths.sum() // 4096) * 1.01 + 1
        assert (filled == (np.arange(4096) < filled.sum(axis=1)[:, None])).all()
