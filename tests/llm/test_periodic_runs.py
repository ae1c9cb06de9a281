import hashlib
import random
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import awkward, nothing, rows_of
from txnsieve.llm import periodic_runs
from txnsieve.llm.queries import QUERIES


def brute(words, least=12):
    """Every run by comparing all pairs of words of each distance."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            part = words[i : i + length]
            if length >= max(least, 2 * q) and not any(part[r:] == part[: length - r] for r in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda run: (run[0], run[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(0, 59), st.integers(1, 20), st.sampled_from([2, 5, 12]))
def test_equals_brute_force(words, a, p, least):
    looped = [w if i < a else words[a + (i - a) % min(p, len(words) - a)] for i, w in enumerate(words)]
    for text in (words, looped):
        assert periodic_runs.word_runs(text, least) == brute(text, least)


def test_automaton_counts_suffixes():
    words = [1, 2, 1, 1, 2, 1, 2, 1]
    length, link, prefixes = periodic_runs.suffix_automaton(words)
    factors = {tuple(words[i:j]) for i in range(8) for j in range(i + 1, 9)}
    assert sum(length[s] - length[link[s]] for s in range(1, len(length))) == len(factors)
    assert [length[s] for s in prefixes] == list(range(1, 9))


def test_access_gives_last_occurrences():
    random.seed(5)
    words = [random.randrange(3) for _ in range(120)]
    length, link, prefixes = periodic_runs.suffix_automaton(words)
    tree = periodic_runs.LastOccurrences(length, link)
    for at, state in enumerate(prefixes):
        met = dict((n, end) for n, end in tree.access(state, at))
        for n in range(1, at + 1):
            ends = [e for e in range(n - 1, at) if words[e - n + 1 : e + 1] == words[at - n + 1 : at + 1]]
            longer = [length for length in met if length >= n]
            assert (met[min(longer)] if longer else None) == (max(ends) if ends else None)


def expected(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(((-length, s, q) for s, length, q in runs), default=None)
    longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc_id, len(runs), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_equals_brute_force(spark, sf_dir):
    short = {i: t for i, t in rows_of(sf_dir, "documents", "doc_id, text") if len((t or "").split()) < 900}
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, sf_dir).collect()}
    assert len(got) == len(rows_of(sf_dir, "documents", "doc_id"))
    for doc_id, text in short.items():
        assert got[doc_id] == expected(doc_id, text)


def test_awkward_rows(spark):
    phrase = "one two three four five six seven"
    docs = awkward(spark, [f"{phrase} {phrase}\t{phrase} end", "a " * 40, "x y " * 8, "p q\x1cr " * 7])
    got = periodic_runs.periodic_runs(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    rows = got.collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    for empty in (2, 3, 4):
        assert (by_id[empty]["n_words"], by_id[empty]["runs"], by_id[empty]["collapsed"]) == (0, [], "")
    assert [tuple(r) for r in by_id[100]["runs"]] == [(0, 21, 7)] and by_id[100]["collapsed"] == f"{phrase} end"
    assert [tuple(r) for r in by_id[101]["runs"]] == [(0, 40, 1)] and by_id[101]["collapsed"] == "a"
    assert by_id[102]["n_words"] == 8 and [tuple(r) for r in by_id[103]["runs"]] == [(0, 14, 2)]  # only ASCII white space parts words
    assert by_id[None]["n_words"] == 5 and by_id[9]["collapsed"].startswith("ünï çødé")
    assert [r["doc_id"] for r in rows].count(6) == 2
    assert by_id[5]["n_words"] == 90_000 and by_id[5]["runs"]
    assert periodic_runs.periodic_runs(nothing(spark)).count() == 0


def test_shorter_runs_on_demand(spark):
    docs = spark.createDataFrame([(1, "x a b a b y")], "id long, body string")
    row = periodic_runs.periodic_runs(docs, "id", "body", min_length=4).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 4, 2)] and row["collapsed"] == "x a b y"
