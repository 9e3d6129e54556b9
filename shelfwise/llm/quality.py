"""Text quality by a sparse ensemble of rules over statistics of the text.

Statistics of every whole text are written once. A small forest is grown on those of the labelled
rows; each path from a root to a node is a rule, a conjunction of comparisons. Logistic regression
under an L1 penalty keeps few of them, and these become one Spark column expression.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from shelfwise.functions.storage import cut
from shelfwise.llm.arrow import over_texts, table
from shelfwise.llm.texts import NOT_SPACE, Words, combined, distinct, text_bytes

TREES, DEPTH, SEED = 12, 4, 7
PENALTY = 0.002
THRESHOLD = 0.7
STATISTICS = ["bytes", "words", "word_length", "letters", "upper", "digits", "symbols", "stops", "wordless", "decorated", "short_words",
              "distinct_words", "top_word", "lines", "line_words", "repeated_lines", "repeated_pairs"]
_byte = np.arange(256)
_UPPER, _DIGIT = (_byte >= 65) & (_byte <= 90), (_byte >= 48) & (_byte <= 57)
_LETTER = _UPPER | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)
_SYMBOL = (_byte > 32) & (_byte < 127) & ~_LETTER & ~_DIGIT
_STOP = np.isin(_byte, np.frombuffer(b".!?,;:", np.uint8))
_LINE = _byte != 10


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _distinct_share(row: np.ndarray, hashes: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values per value, share of the most frequent value) of each row."""
    order = np.lexsort((hashes, row))
    row, hashes = row[order], hashes[order]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1])])[: len(row)]
    at = np.flatnonzero(new)
    times = np.diff(np.append(at, len(row)))
    most = np.zeros(rows)
    np.maximum.at(most, row[at], times)
    total = np.bincount(row, minlength=rows)
    return _share(np.bincount(row[at], minlength=rows), total), _share(most, total)


def text_statistics(column: pa.Array) -> np.ndarray:
    """One row of STATISTICS per text; an empty text has zeros."""
    offsets, data = text_bytes(column)
    words, lines, rows = Words(offsets, data, NOT_SPACE), Words(offsets, data, _LINE), len(column)
    data, bounds = words.data, words.bounds

    def of_bytes(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind[data])])
        return total[bounds[1:]] - total[bounds[:-1]]

    def of_words(kind: np.ndarray) -> np.ndarray:
        return np.bincount(words.row, kind, rows)

    size, n, n_lines = np.diff(bounds), np.diff(words.first), np.diff(lines.first)
    letters_to = np.concatenate([[0], np.cumsum(_LETTER[data])])
    last = data[words.end - 1]
    second = data[np.maximum(words.end - 2, 0)]
    length = words.end - words.start
    letter = letters_to[words.end] - letters_to[words.start] > 0
    distinct_words, top = _distinct_share(words.row, words.hash, rows)
    distinct_lines, _ = _distinct_share(lines.row, lines.hash, rows)
    pair = np.flatnonzero(words.row[:-1] == words.row[1:])
    pairs = combined([words.hash[pair], words.hash[pair + 1]]) if len(pair) else words.hash[:0]
    distinct_pairs, _ = _distinct_share(words.row[pair], pairs, rows)
    letters = of_bytes(_LETTER)
    return np.stack([
        np.log1p(size), np.log1p(n), _share(of_words(length), n), _share(letters, size), _share(of_bytes(_UPPER), letters),
        _share(of_bytes(_DIGIT), size), _share(of_bytes(_SYMBOL), size), _share(of_words(_STOP[last]), n), _share(of_words(~letter), n),
        _share(of_words(_SYMBOL[last] & _SYMBOL[second] & (length > 1)), n), _share(of_words(length <= 3), n), distinct_words, top,
        np.log1p(n_lines), _share(n, n_lines), np.where(n_lines > 0, 1 - distinct_lines, 0), np.where(n > 1, 1 - distinct_pairs, 0)], axis=1)


def statistics(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, STATISTICS ...) of every whole text, null as empty."""
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_statistics(batch.column("text"))
            yield table(doc_id=batch.column("doc_id"), **{s: pa.array(found[:, i]) for i, s in enumerate(STATISTICS)})

    return over_texts(docs, measured, "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS), id, text)


Rule = tuple[tuple[int, str, float], ...]  # (statistic, '<=' or '>', bound)


def tree_rules(description: str) -> set[Rule]:
    """Paths to all nodes but the root, from a tree's printed form; of several bounds on a statistic the tightest."""
    rules, path = set(), []
    for line in description.splitlines():
        if found := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+0-9.Ee]+)\)", line):
            depth = len(found[1])
            path = [p for p in path if p[0] < depth] + [(depth, int(found[2]), found[3], float(found[4]))]
            tight: dict[tuple[int, str], float] = {}
            for _, statistic, sign, bound in path:
                best = min if sign == "<=" else max
                tight[statistic, sign] = best(bound, tight.get((statistic, sign), bound))
            rules.add(tuple(sorted((k, s, b) for (k, s), b in tight.items())))
    return rules


def rule_column(rule: Rule) -> Column:
    """1.0 where the rule holds, else 0.0."""
    holds = F.lit(True)
    for statistic, sign, bound in rule:
        value = F.col(STATISTICS[statistic])
        holds = holds & (value <= bound if sign == "<=" else value > bound)
    return holds.cast("double")


@dataclass
class RuleEnsemble:
    """Rules with their weights, and the intercept."""

    rules: list[tuple[Rule, float]]
    intercept: float

    def score(self) -> Column:
        """Probability of good quality, over the columns of ``statistics``."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + rule_column(rule) * weight
        return 1 / (1 + F.exp(-total))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None, id: str = "doc_id") -> RuleEnsemble:
    """Fits on the labelled rows of ``stats`` that ``learn``, a condition on doc_id, allows.

    Rows with a null id or label are left out, of several labels of one id the larger holds. With
    labels of one kind only, or none, the score is the smoothed share of label 1 everywhere.
    """
    known = labels.select(labels[id].alias("doc_id"), labels[label].cast("double").alias("y")).where("doc_id is not null and y is not null")
    if learn is not None:
        known = known.where(learn)
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))
    rows = cut(VectorAssembler(inputCols=STATISTICS, outputCol="features").transform(stats.join(known, "doc_id")).select(*STATISTICS, "features", "y"))
    seen = rows.agg(F.count("y").alias("n"), F.sum("y").alias("ones")).first()
    n, ones = seen["n"], seen["ones"] or 0.0
    if ones in (0, n):
        return RuleEnsemble([], float(np.log((ones + 1) / (n - ones + 1))))
    forest = RandomForestClassifier(labelCol="y", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="0.5").fit(rows)
    rules = sorted(set().union(*(tree_rules(t.toDebugString) for t in forest.trees)))
    if not rules:
        return RuleEnsemble([], float(np.log((ones + 1) / (n - ones + 1))))
    marked = rows.select("y", *[rule_column(r).alias(f"r{i}") for i, r in enumerate(rules)])
    marked = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(marked).select("y", "features")
    lasso = LogisticRegression(labelCol="y", elasticNetParam=1.0, regParam=PENALTY, maxIter=60).fit(marked)
    return RuleEnsemble([(r, float(w)) for r, w in zip(rules, lasso.coefficients) if w], float(lasso.intercept))


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", learn: Column | None = None, threshold: float = THRESHOLD,
          id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every whole text, by rules fitted as by ``fit``.

    Null and empty texts are scored by their zero statistics; rows are kept one for one; an empty
    table gives an empty result; other columns are ignored.
    """
    stats = cut(statistics(docs, id, text))
    model = fit(stats, labels, label, learn)
    scored = stats.select("doc_id", model.score().alias("score"))
    return scored.select("doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
