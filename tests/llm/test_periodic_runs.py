import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from pricetide.llm.periodic_runs import CommonExtension, RangeMinimum, SuffixTree, periodic_runs, runs_of_words
from pricetide.llm.queries import QUERIES

COLUMNS = "doc_id long, text string, start long, runs string"


def brute_force(words, least_words=24, least_periods=3):
    """Every period at every place, kept where no smaller one holds in the whole stretch."""
    size, found = len(words), set()
    for q in range(1, size // least_periods + 1):
        i = 0
        while i + q < size:
            first = i
            while i + q < size and words[i] == words[i + q]:
                i += 1
            length = i - first + q
            if length >= max(least_words, least_periods * q):
                stretch = words[first : first + length]
                if not any(stretch[r:] == stretch[:-r] for r in range(1, q)):
                    found.add((first, length, q))
            i += 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def expected_row(doc_id, text, plant):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if plant and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_force(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    rest = " ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (lines, rest)))


def test_range_minima_against_slices():
    values = np.array([random.Random(3).randrange(50) for _ in range(1000)])
    minimum = RangeMinimum(values)
    first = np.array([random.Random(i).randrange(1000) for i in range(3000)])
    last = np.array([random.Random(-i - 1).randrange(a, 1000) for i, a in enumerate(first)])
    assert minimum.of(first, last).tolist() == [values[a : b + 1].min() for a, b in zip(first, last)]


def test_common_extensions_against_comparing():
    pick = random.Random(4)
    for size in (2, 3, 17, 200):
        words = [pick.randrange(1, 4) for _ in range(size)]
        common = CommonExtension(SuffixTree(words))
        for _ in range(100):
            a, b = pick.sample(range(size), 2)
            shared = next((k for k in range(size) if max(a, b) + k == size or words[a + k] != words[b + k]), size)
            assert common.of(np.array([a]), np.array([b])).tolist() == [shared]


@pytest.mark.parametrize("least_words, least_periods", [(24, 3), (6, 2), (2, 2), (9, 4)])
def test_runs_against_brute_force(least_words, least_periods):
    pick = random.Random(least_words)
    for _ in range(600):
        size, letters = pick.randrange(1, 70), pick.choice([1, 2, 2, 3, 5])
        words = [pick.choice("abcde"[:letters]) for _ in range(size)]
        if pick.random() < 0.5:
            a, p = pick.randrange(size), pick.randrange(1, 9)
            b = pick.randrange(a, size + 1)
            words = [words[a + (i - a) % p] if a <= i < b and a + (i - a) % p < size else words[i] for i in range(size)]
        assert runs_of_words(words, least_words, least_periods) == brute_force(words, least_words, least_periods)


def test_runs_inside_runs_and_fibonacci_words():
    one, two = "a", "ab"
    for _ in range(9):
        one, two = two, two + one
    assert runs_of_words(list(two), 6, 2) == brute_force(list(two), 6, 2)
    nested = (["x"] * 30 + ["y"]) * 4
    assert runs_of_words(nested) == brute_force(nested) and len(runs_of_words(nested)) == 5


def test_operator_on_odd_rows(spark):
    ten = "one two three " * 10
    texts = [
        (None, ten, 1, ""),
        (1, None, 1, ""),
        (2, "", 1, ""),
        (3, " \n\t\x0b\x0c\r ", 1, ""),
        (4, ten, 1, ""),
        (4, ten, 1, ""),
        (5, "head " + ten + "tail \u0085  ", 1, ""),
        (6, "word " * 100_000, 1, ""),
        (7, "é\x00 " * 30 + "中文 " * 30, 1, ""),
    ]
    got = periodic_runs(spark.createDataFrame(texts, COLUMNS).repartition(3)).collect()
    assert len(got) == len(texts)
    for row in got:
        text = next(t for i, t, *_ in texts if i == row.doc_id)
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert row.n_words == len(words)
        if row.doc_id == 6:
            assert [tuple(r) for r in row.runs] == [(0, 100_000, 1)] and row.collapsed == "word"
        else:
            assert [tuple(r) for r in row.runs] == brute_force(words)
    rests = {r.doc_id: r.collapsed for r in got}
    assert rests[5] == "head one two three tail \u0085  " and rests[3] == "" and rests[7] == "é\x00 中文"
    assert periodic_runs(spark.createDataFrame([], COLUMNS)).collect() == []


def test_query_against_brute_force(spark, rows, tmp_path):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    docs = [d for d in docs if len((d[1] or "").split()) < 1500]
    docs += [(None, "a b " * 20), (10, None), (22, ""), (31, " \t"), (40, "q " * 99 + "r " * 30)]
    docs += [(i, "aa bb cc dd ee ff " * (i % 9)) for i in range(5000, 5040)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted((expected_row(*d, True) for d in docs), key=repr)
    assert sum(r.n_runs > 0 for r in got) > 20
