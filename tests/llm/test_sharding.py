"""Sharding against best fit decreasing group by group."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from shelfwise.llm import sharding


def one_by_one(sizes, capacity):
    """Shard loads when each group, by falling size, enters the fullest shard that still holds it."""
    loads = []
    for size in sorted(sizes, reverse=True):
        fitting = [i for i, load in enumerate(loads) if load + size <= capacity]
        if fitting:
            i = max(fitting, key=lambda i: (loads[i], -i))
            loads[i] += size
        else:
            loads.append(size)
    return loads


def loads_of(placed, sizes):
    loads = Counter()
    for which, shard, groups in placed:
        loads[shard] += sizes[which] * groups
    return [loads[i] for i in range(len(loads))]


def classes(groups):
    count = Counter(groups)
    sizes = sorted(count, reverse=True)
    return sizes, [count[s] for s in sizes]


def test_classes_are_placed_as_single_groups():
    draw = random.Random(2)
    for _ in range(300):
        groups = [draw.choice([draw.randint(17, 60), draw.randint(17, 400), 20]) for _ in range(draw.randint(0, 120))]
        capacity = draw.randint(20, 700)
        sizes, counts = classes(groups)
        got = loads_of(sharding.best_fit_decreasing(sizes, counts, capacity), sizes)
        # Groups beyond the capacity stand alone in shards that are full.
        assert got == one_by_one(groups, capacity)


def test_even_shards():
    draw = random.Random(3)
    for shards in (1, 2, 7, 40):
        groups = [draw.randint(17, 3000) for _ in range(2000)] + [17] * 500
        sizes, counts = classes(groups)
        loads = loads_of(sharding.even_shards(sizes, counts, shards), sizes)
        assert len(loads) == shards and sum(loads) == sum(groups) and max(loads) - min(loads) <= 40
        sizes, counts = classes(groups + [10**7, 10**7 + 5])  # two groups above any mean
        loads = loads_of(sharding.even_shards(sizes, counts, shards), sizes)
        assert sum(loads) == sum(groups) + 2 * 10**7 + 5 and len(loads) == shards
        if shards > 2:
            rest = sorted(loads)[:-2]
            assert sorted(loads)[-2:] == [10**7, 10**7 + 5] and max(rest) - min(rest) <= 40
    assert sharding.even_shards([], [], 40) == []
    assert loads_of(sharding.even_shards([30, 20], [1, 1], 40), [30, 20]) == [30, 20]


def documents(spark):
    draw = random.Random(5)
    texts = ["".join(draw.choice("abé ") for _ in range(draw.randint(0, 300))) for _ in range(900)]
    texts += ["hot text " * 5] * 700 + ["", None, None, "x" * 200_000, "x" * 200_000]
    rows = [(None if i % 50 == 0 else i // 2, t, 1.0, "a", 3, b"k") for i, t in enumerate(texts)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, size double, shard string, slot int, key binary").repartition(7)


def test_shard(spark):
    rows, docs = documents(spark)
    got = sharding.shard(docs, shards=6).collect()
    utf8 = lambda t: (t or "").encode()
    assert Counter((i, len(utf8(t)) + 16, zlib.crc32(utf8(t))) for i, t, *_ in rows) == Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)
    slots, of_text = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        of_text[r["size"], r["text_crc32"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(6))
    assert all(len(s) == 1 for s in of_text.values())
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    own = sorted(load.values())
    assert own[-1] == 2 * (200_000 + 16) and own[-2] - own[0] <= 40


def test_capacity_and_files(spark, tmp_path):
    rows, docs = documents(spark)
    utf8 = lambda t: (t or "").encode()
    groups = Counter()
    for _, t, *_ in rows:
        groups[utf8(t)] += len(utf8(t)) + 16
    got = sharding.shard(docs, capacity=50_000).collect()
    load = Counter()
    for r in got:
        load[r["shard"]] += r["size"]
    assert sorted(load.values()) == sorted(one_by_one(groups.values(), 50_000))
    sharding.write_shards(docs, str(tmp_path / "out"), capacity=50_000)
    back = spark.read.parquet(str(tmp_path / "out")).collect()
    assert Counter((r["doc_id"], r["text"]) for r in back) == Counter((i, t) for i, t, *_ in rows)
    load = Counter()
    for r in back:
        load[r["shard"]] += len(utf8(r["text"])) + 16
    assert sorted(load.values()) == sorted(one_by_one(groups.values(), 50_000))


def test_empty_and_wrong_arguments(spark):
    nothing = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard(nothing, shards=4).count() == 0
    assert sharding.shard(nothing, capacity=100).count() == 0
    for wrong in ({}, {"shards": 2, "capacity": 9}, {"shards": 0}):
        with pytest.raises(ValueError):
            sharding.shard(nothing, **wrong)
