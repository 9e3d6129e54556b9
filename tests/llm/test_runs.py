"""Periodic runs against a direct search over all periods."""

import random
import re
import zlib

import numpy as np
import pytest

from shelfwise.llm import queries, runs


def direct(words):
    """Every (start, length, period): for each period the longest stretches of words equal to those one period on."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(12, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def cases(n=1500):
    draw = random.Random(11)
    for i in range(n):
        letters, size, words = draw.choice([1, 2, 2, 3, 4, 6]), draw.randint(0, 90), []
        if i % 3 == 0:
            words = [draw.randrange(letters) for _ in range(size)]
        elif i % 3 == 1:
            while len(words) < size:
                cycle = [draw.randrange(letters) for _ in range(draw.randint(1, 12))]
                words += (cycle * draw.randint(1, 6))[: draw.randint(1, 60)]
        else:
            words = [draw.randrange(letters) for _ in range(draw.randint(1, 40))] * 4
            for _ in range(draw.randint(0, 3)):
                words[draw.randrange(len(words))] = 9
        yield words


def test_runs_of_random_and_periodic_sequences():
    for words in cases():
        got = [tuple(map(int, r)) for r in zip(*runs.runs_of(np.array(words, np.int64)))]
        assert got == direct(words), words


def test_sequences_full_of_runs():
    a, b = [0], [0, 1]
    while len(b) < 300:
        a, b = b, b + a
    for words in (b, [0] * 500, ([0] * 50 + [1]) * 9, [0, 1, 1, 0] * 80):
        assert [tuple(map(int, r)) for r in zip(*runs.runs_of(np.array(words)))] == direct(words)


def test_wavelet_tree():
    draw = np.random.default_rng(3)
    values = draw.permutation(200)
    tree = runs.WaveletTree(values)
    lo = draw.integers(0, 200, 300)
    hi = lo + 1 + draw.integers(0, 200 - lo)
    bound = draw.integers(0, 201, 300)
    assert tree.below(lo, hi, bound).tolist() == [int((values[a:b] < x).sum()) for a, b, x in zip(lo, hi, bound)]
    nth = draw.integers(0, hi - lo)
    assert tree.smallest(lo, hi, nth).tolist() == [int(np.sort(values[a:b])[k]) for a, b, k in zip(lo, hi, nth)]


TEXTS = [
    "", " \t\n", "one", "a " * 5000, "a b c " * 4, "a b c " * 3, "x\x0by\x0cz\r" * 9, "A a " * 12, "é é é " * 20,
    "the end of a line\n" * 40 + "and the end " * 3 + "of it", "ab ab ab ab " * 6, "p q r s t u " * 3 + "p q r s t v " * 3,
    " ".join(str(i) for i in range(3000)) + " " + " ".join(str(i) for i in range(3000)),
]


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (51, "b " * 20), (51, "b " * 20), (None, "n m " * 9)]
    docs = spark.createDataFrame([(i, t, [1], "x", 2) for i, t in rows], "doc_id long, text string, runs array<int>, collapsed string, n_words int")
    return rows, docs


def test_word_runs(found):
    rows, docs = found
    want = []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        want.append((i, len(words), direct(words), collapsed(words, direct(words))))
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.word_runs(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    assert runs.word_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_echoes(spark, found):
    rows, docs = found
    rows = rows + [(i, f"{i} b c d e f g h " * (i % 7)) for i in range(100, 400)]
    echoed = docs.select("doc_id", "text").union(spark.createDataFrame(rows[len(found[0]):], "doc_id long, text string"))
    got = sorted(((r["doc_id"], r["text"]) for r in queries.with_echoes(echoed).collect()), key=str)
    want = []
    for i, text in rows:
        h, words = zlib.crc32(str(i).encode()), re.findall(r"[^\x20\x09-\x0D]+", text or "")
        if i is not None and h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            text = " ".join(w if i < a else words[a + (i - a) % p] for i, w in enumerate(words))
        want.append((i, text))
    assert got == sorted(want, key=str)
