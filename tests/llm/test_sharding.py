import random
import zlib

import numpy as np
import pytest

from pricetide.llm import sharding
from pricetide.llm.sharding import places_in, sharded, splitters_of, write_shards

COLUMNS = "doc_id long, text string, shard int, record string"


def check(rows, texts, shards=16):
    """Every row once, right sizes and sums, gapless slots, shard sizes near the mean."""
    assert sorted((repr(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (repr(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in texts
    )
    slots, sizes = {}, [0] * shards
    for r in rows:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
        sizes[r.shard] += r.size
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return sizes


def test_places_against_comparing_every_splitter():
    pick = random.Random(1)
    low = np.iinfo(np.int64).min
    splitters = sorted({(pick.randrange(6), pick.randrange(4), pick.randrange(4)) for _ in range(30)} | {(3, low, low), (7, low, low)})
    rows = [(pick.randrange(9), pick.randrange(5), pick.randrange(5)) for _ in range(2000)]
    got = places_in(np.array(splitters, np.int64), *np.array(rows, np.int64).T)
    assert got.tolist() == [sum(s <= r for s in splitters) for r in rows]


def test_splitters_are_weighted_quantiles():
    low = np.iinfo(np.int64).min
    sample = [(i, 0, i, 1.0) for i in range(100)]
    assert splitters_of(sample, 4) == [(24, low, low), (49, low, low), (74, low, low)]
    hot = [(5, i, i, 1.0) for i in range(100)]
    assert splitters_of(hot, 4) == [(5, low, low), (5, 49, 49), (5, 74, 74)]


def test_shards_of_varied_texts_are_near_equal_and_keep_small_groups(spark):
    pick = random.Random(2)
    texts = [(i, f"text {i % 1500} " + "x" * (i % 1500 * 37 % 400), 1, "r") for i in range(4000)]
    pick.shuffle(texts)
    rows = sharded(spark.createDataFrame(texts, COLUMNS).repartition(5)).collect()
    sizes = check(rows, texts)
    mean = sum(sizes) / 16
    assert max(abs(s - mean) for s in sizes) < 0.035 * mean + 1200
    shard_of = {}
    text_of = {i: t for i, t, *_ in texts}
    for r in rows:
        shard_of.setdefault(text_of[r.doc_id], set()).add(r.shard)
    assert all(len(v) == 1 for v in shard_of.values())


def test_a_third_of_all_rows_equal_or_empty(spark):
    hot = "a passage that everybody copies " * 5
    texts = [(i, hot if i % 3 == 0 else (None if i % 3 == 1 else f"own {i} " + "y" * (i % 200)), 0, "") for i in range(3000)]
    sizes = check(sharded(spark.createDataFrame(texts, COLUMNS)).collect(), texts)
    mean = sum(sizes) / 16
    assert max(abs(s - mean) for s in sizes) < 0.035 * mean + 400


def test_overfull_ranges_are_cut_again(spark, monkeypatch):
    monkeypatch.setattr(sharding, "KEYS_PER_RANGE", 1)
    texts = [(i, f"{i} " + "z" * (i * 7 % 300), 0, "") for i in range(3000)]
    sizes = check(sharded(spark.createDataFrame(texts, COLUMNS)).collect(), texts)
    mean = sum(sizes) / 16
    assert max(abs(s - mean) for s in sizes) < 0.06 * mean


def test_same_result_from_other_partitions(spark, rows):
    texts = [(i, f"text {i % 300}", 0, "") for i in range(900)]
    frame = spark.createDataFrame(texts, COLUMNS)
    assert rows(sharded(frame.repartition(7))) == rows(sharded(frame.coalesce(1)))


def test_odd_rows_and_no_rows(spark):
    texts = [(None, "a"), (None, None), (1, ""), (1, ""), (2, "é" * 100_000), (3, "b"), (3, "b")]
    texts = [(*t, 5, "clash") for t in texts]
    check(sharded(spark.createDataFrame(texts, COLUMNS)).collect(), texts)
    none = sharded(spark.createDataFrame([], COLUMNS))
    assert none.collect() == [] and none.columns[-1] == "grown_shard"


def test_shards_are_written_with_all_columns(spark, tmp_path):
    texts = [(i, f"text {i % 40}" if i % 9 else None, i % 3, "own") for i in range(200)]
    path = str(tmp_path / "shards")
    write_shards(spark.createDataFrame(texts, COLUMNS), path, shards=4)
    back = spark.read.parquet(path).collect()
    assert sorted(map(repr, (tuple(r.record) for r in back))) == sorted(map(repr, texts))
    for shard in range(4):
        assert sorted(r.slot for r in back if r.shard == shard) == list(range(sum(r.shard == shard for r in back)))


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_query_over_all_documents(spark, folder):
    from pricetide.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    sizes = check(QUERIES["op11_sharding"](spark, folder).collect(), docs)
    mean = sum(sizes) / 16
    longest = max(len((t or "").encode()) + 1 for _, t in docs)
    assert max(abs(s - mean) for s in sizes) < 0.035 * mean + longest
