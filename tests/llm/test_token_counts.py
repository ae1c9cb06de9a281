import random

from helpers import BYTE_BPE, awkward, nothing, rows_of
from txnsieve.llm.queries import QUERIES
from txnsieve.llm.token_counts import LongestMatch, byte_pieces, count_tokens


def greedy(word: bytes, pieces: set[bytes], longest: int) -> int:
    word, at, count = b" " + word, 0, 0
    while at < len(word):
        at += next(n for n in range(min(longest, len(word) - at), 0, -1) if word[at : at + n] in pieces)
        count += 1
    return count


def test_equals_greedy_longest_match(spark, sf_dir):
    pieces = set(byte_pieces(BYTE_BPE))
    longest = max(map(len, pieces))
    got = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in QUERIES["op8_token_counts"](spark, sf_dir).collect()}
    for doc_id, text in rows_of(sf_dir, "documents", "doc_id, text"):
        words = (text or "").encode().split()
        assert got.pop(doc_id) == (len(words), sum(greedy(w, pieces, longest) for w in words))
    assert not got


def test_small_vocabularies():
    random.seed(6)
    for _ in range(20):
        pieces = {bytes([b]) for b in range(256)} | {bytes(random.choices(b" aab", k=random.randint(2, 6))) for _ in range(25)}
        automaton = LongestMatch(sorted(pieces))
        for _ in range(200):
            word = bytes(random.choices(b"aab", k=random.randint(0, 20)))
            assert automaton[word] == greedy(word, pieces, 6)


def test_awkward_rows(spark):
    docs = awkward(spark).selectExpr("*", "'x' AS n_words")
    out = count_tokens(docs, BYTE_BPE)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == docs.count() and rows[1]["score"] == "s"
    assert [(rows[i]["n_words"], rows[i]["n_tokens"]) for i in (2, 3, 4)] == [(0, 0)] * 3
    assert rows[5]["n_words"] == 90_000
    assert count_tokens(nothing(spark), BYTE_BPE).count() == 0
