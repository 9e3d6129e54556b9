"""Likeness against multisets of paragraphs; long names and long lines of personal data."""

import random
import time
from collections import Counter

from pyspark.sql import functions as F

from shelfwise.llm import fingerprints, pii


def edited_texts(rows):
    """(id, text, edited text, next text) by falling id, the first after the last."""
    rows = sorted(rows, reverse=True)
    for i, (id, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 3
        yield id, text, text[: len(text) - cut] + following[:cut], following


def test_likeness_of_texts_with_repeated_paragraphs(spark):
    draw = random.Random(12)
    word = lambda: "".join(draw.choice("abcefghiklmno") for _ in range(draw.randint(3, 8)))
    line = lambda: " ".join(word() for _ in range(draw.randint(2, 6))) + ".\n"
    rows = []
    for id in range(120):
        own = [line() for _ in range(draw.randint(20, 120))]
        often = [line() for _ in range(draw.randint(0, 3))]  # lines that come many times
        lines = own + [draw.choice(often) for _ in range(draw.randint(0, 300))] if often else own
        draw.shuffle(lines)
        rows.append((id, "".join(lines)))
    found = {r["doc_id"]: r for r in fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    flat = [(id, i, t) for id, *texts in edited_texts(rows) for i, t in enumerate(texts)]
    pieces = {(r["id"], r["i"]): Counter(r["p"]) for r in spark.createDataFrame(flat, "id long, i int, t string").select(
        "id", "i", fingerprints.paragraphs(F.col("t")).alias("p")).collect()}
    errors = {"near_edited": [], "near_next": []}
    for id in range(120):
        for i, name in ((1, "near_edited"), (2, "near_next")):
            a, b = pieces[id, 0], pieces[id, i]
            share = 2 * (a & b).total() / (a.total() + b.total())
            errors[name].append(abs(found[id][name] - share))
    # The estimate is off by about an eighth of the share that is not common.
    mean = {name: sum(e) / len(e) for name, e in errors.items()}
    assert max(errors["near_edited"]) < 0.25 and mean["near_edited"] < 0.06
    assert max(errors["near_next"]) < 0.45 and mean["near_next"] < 0.12


def test_copies_of_a_paragraph_count_once_each(spark):
    rows = [(2, "same line.\n" * 300 + "a.\nb.\nc.\n"), (1, "same line.\n" * 100), (0, "same line.\n" * 300 + "a.\nb.\nc.\n")]
    found = {r["doc_id"]: r for r in fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[2]["fingerprint"] == found[0]["fingerprint"] != found[1]["fingerprint"]
    assert abs(found[2]["near_next"] - 2 * 100 / 403) < 0.15 and found[0]["near_next"] == 1.0


def test_long_names_keep_no_letters():
    permute = pii.Permutation(b"key")
    for length in (20, 40, 64, 100, 200):
        name = ("johnsmith" * 30)[:length]
        for other in (name, name[:-1] + "q", "q" + name[1:]):
            ((_, end, kind, new),) = pii.spans(other + "@x.com", permute)
            assert kind == "email" and end == length + 6 and new.endswith("@x.com") and len(new) == end
            assert sum(a == b for a, b in zip(other, new[:length])) < 6 + length // 8
            assert new == pii.spans(other + "@x.com", permute)[0][3]
        # Names that differ in one letter have pseudonyms that differ nearly everywhere.
        one, two = (pii.spans(n + "@x.com", permute)[0][3] for n in (name, name[:-1] + "q"))
        assert sum(a == b for a, b in zip(one[:length], two)) < 6 + length // 8


def test_lines_of_many_values_take_linear_time():
    draw, permute = random.Random(1), pii.Permutation(b"key")
    address = lambda: ".".join(str(draw.randrange(256)) for _ in range(4))
    took = {}
    for size in (1500, 15_000):
        text = " ".join(address() for _ in range(size))
        contacts = "\n".join(f"a{k}@b.com {address()} 2020-01-{k % 28 + 1:02d}, +1 212 555 {k % 10000:04d}" for k in range(size // 4))
        start = time.process_time()
        assert len(pii.spans(text, permute)) == size and len(pii.spans(contacts, permute)) == size // 4 * 4
        took[size] = time.process_time() - start
    assert took[15_000] < 30 * took[1500] + 1
