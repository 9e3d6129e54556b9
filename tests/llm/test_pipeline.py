"""The stages of the corpus pipeline on small tables: nulls, repeated rows, clashing columns, empty tables."""

import random
import zlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

COLUMNS = "doc_id long, url string, text string, lang string, source string, n_chars long"


def words(draw, n, of="abcdefghiklmnopr"):
    return " ".join("".join(draw.choice(of) for _ in range(draw.randint(3, 7))) for _ in range(n))


def written(spark, folder, rows, labels, items, extra=False):
    docs = spark.createDataFrame([(i, f"u{i}", t, "en", "s", None if t is None else len(t)) for i, t in rows], COLUMNS)
    if extra:  # names that the stages use themselves
        docs = docs.withColumn("score", F.lit(9)).withColumn("component_id", F.lit("x")).withColumn("copy", F.lit(1)).withColumn("row", F.lit(2))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(21)
    rows, labels = [], []
    for i in range(300):
        toxic = i % 5 == 0
        rows.append((i, words(draw, 60) + (" zuzzu wuwu vuxy" * 4 if toxic else "")))
        labels.append((i, 1, int(toxic)))
    item = words(draw, 30).capitalize() + "? " + words(draw, 12).capitalize() + "."
    rows += [(1000, rows[1][1]), (1001, rows[1][1] + " tail"), (1002, rows[2][1]), (1002, rows[2][1])]  # copies, near copies, repeated rows
    rows += [(1003, "b " + words(draw, 40)), (1003, "a " + words(draw, 40)), (1004, None), (1005, ""), (None, words(draw, 30))]
    rows += [(1006, words(draw, 40) + " " + item + " " + words(draw, 40)), (1007, words(draw, 30) + " mail john.smith@example.com now")]
    rows += [(1008, words(draw, 20_000))]
    return rows, labels, [(1, item), (2, None), (3, "")]


def stages(spark, folder):
    """Name -> rows of each stage, every one on what the one before kept."""
    docs, out = corpus_pipeline.table(spark, folder, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.cut(stage(spark, docs, folder))
        out[name] = docs
    return out


@pytest.mark.parametrize("extra", [False, True])
def test_stages(spark, corpus, tmp_path, extra):
    rows, labels, items = corpus
    folder = written(spark, tmp_path, rows, labels, items, extra)
    out = stages(spark, folder)
    columns = corpus_pipeline.table(spark, folder, "documents").columns
    assert all(out[name].columns == columns for name in list(out)[:-1])
    kept = {name: sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out[name].select("doc_id").collect()) for name in list(out)[:-1]}
    ids = {name: [i for null, i in found if not null] for name, found in kept.items()}

    toxic = {i for i, _, y in labels if y}
    learnt = {i for i in toxic if zlib.crc32(str(i).encode()) % 3 != 1}
    assert not learnt & set(ids["toxicity"]) and len(ids["toxicity"]) >= len(rows) - 1 - len(toxic)
    assert set(i for i, _ in rows if i is not None) - toxic <= set(ids["toxicity"])

    near = ids["n-gram Jaccard join"]
    assert len(near) == len(set(near)) and (True, 0) in kept["n-gram Jaccard join"]
    assert set(ids["toxicity"]) - set(near) == {1000, 1001, 1002}
    texts = {r["doc_id"]: r["text"] for r in out["n-gram Jaccard join"].collect()}
    assert texts[1003].startswith("a ") and texts[1004] is None and texts[1005] == "" and len(texts[1008]) > 90_000

    assert set(near) - set(ids["benchmark decontamination"]) == {1006}
    assert ids["pseudonyms"] == ids["benchmark decontamination"]
    hidden = {r["doc_id"]: r for r in out["pseudonyms"].collect()}
    assert "john.smith@" not in hidden[1007]["text"] and hidden[1007]["n_chars"] == len(hidden[1007]["text"])

    pieces = out["best-fit packing"].collect()
    assert {p["doc_id"] for p in pieces} == {r["doc_id"] for r in out["pseudonyms"].select("doc_id").collect()}
    filled = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == filled.get(p["sequence_id"], 0)
        filled[p["sequence_id"]] = p["offset"] + p["length"]
    assert max(filled.values()) <= 2048


def test_empty_tables(spark, tmp_path):
    folder = written(spark, tmp_path, [], [], [])
    assert corpus_pipeline.run(spark, folder).count() == 0
