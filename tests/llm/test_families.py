"""The search of unsettled families by points at several resolutions, in many blocks."""

import random

import numpy as np
import pyarrow as pa
import pytest

from shelfwise.llm import jaccard
from test_llm import brute_components


def test_points_of_any_resolution_sum_to_the_coarse_ones():
    draw = np.random.default_rng(3)
    for n in (0, 1, 100, 5000, 100_000):
        found = np.unique(draw.integers(0, 2**64, n, np.uint64))
        coarse = jaccard.point(found) if n else np.zeros(jaccard.GROUPS, np.uint8)
        for groups in (256, 1024, jaccard.FINEST):
            if n:
                fine = jaccard.points([jaccard.point(found, groups).tobytes()], groups)[0]
                assert fine.sum() == n and (fine.reshape(256, -1).sum(axis=1) == coarse).all()


def test_fine_groups_follow_the_size_class():
    classes = [jaccard.fine_groups(c, 80) for c in range(-1, 80)]
    assert classes == sorted(classes) and classes[0] == jaccard.GROUPS and classes[-1] == jaccard.FINEST


@pytest.mark.parametrize("block", [1, 400, 3000])
def test_survivors_are_all_linked_pairs_of_different_parts(block):
    draw, percent, size = random.Random(block), 80, 25  # sets of about 1.25 ** 25 = 270 shingles
    base = [draw.getrandbits(64) for _ in range(320)]
    sets = []
    for i in range(60):
        changed = draw.choice([0.02, 0.05, 0.1, 0.3])
        some = [x if draw.random() > changed else draw.getrandbits(64) for x in base[: draw.randint(265, 320)]]
        sets.append(np.unique(np.array(some, np.uint64)))
    stray, part = [i % 3 == 0 for i in range(60)], [i % 7 for i in range(60)]
    groups, blocks = jaccard.fine_groups(size, percent), block % 5 + 3
    met = set()
    for wide_i in range(-(-blocks // jaccard.WIDE)):
        for wide_j in range(-(-blocks // jaccard.WIDE)):
            rows = [i for i in range(60) if (i % blocks) // jaccard.WIDE == (wide_i if stray[i] else wide_j)]
            group = pa.table({
                "family": [5] * len(rows), "size": pa.array([size] * len(rows), pa.int32()), "doc_id": rows, "part": [part[i] for i in rows],
                "stray": [stray[i] for i in rows], "block": pa.array([i % blocks for i in rows], pa.int32()), "last": [0] * len(rows),
                "n": [len(sets[i]) for i in rows], "point": [jaccard.point(sets[i], groups).tobytes() for i in rows],
                "wide_i": [wide_i] * len(rows), "wide_j": [wide_j] * len(rows)})
            if rows:
                met |= {(r["doc_id"], r["stray"], r["i"], r["j"]) for r in jaccard._surviving(percent)(group).to_pylist()}
    linked = 0
    for a in (i for i in range(60) if stray[i]):
        for b in (i for i in range(60) if not stray[i] and part[i] != part[a]):
            common = len(np.intersect1d(sets[a], sets[b]))
            if common >= jaccard.needed(len(sets[a]), len(sets[b]), percent):
                linked += 1
                assert {(a, True, a % blocks, b % blocks), (b, False, a % blocks, b % blocks)} <= met
    assert linked


@pytest.mark.parametrize("block", [700, 1_500_000])
def test_unsettled_families_in_many_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(jaccard, "HEADS", 1)
    draw, rows = random.Random(31), []
    for family in range(4):
        base = [f"w{family}_{i}" for i in range(draw.choice([30, 120, 400]))]
        chain = list(base)
        for _ in range(30):  # a chain whose ends have little in common, with copies beside it
            for _ in range(max(1, len(chain) // 14)):
                chain[draw.randrange(len(chain))] = f"x{draw.getrandbits(40)}"
            rows.append((len(rows), " ".join(chain)))
            if draw.random() < 0.3:
                rows.append((len(rows), " ".join(chain[: -max(1, len(chain) // 50)])))
    draw.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.similar_groups(docs, 1, 80).collect()}
    assert got == brute_components(rows, 1, 80)
