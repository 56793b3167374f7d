"""Quality scores from a sparse ensemble of rules.

Statistics of a text are column expressions. A small forest over them gives candidate rules: every path from a root to a node is a
conjunction of thresholds. Logistic regression with an L1 penalty weighs the rules, most of them with zero, and what is left is compiled
into one column expression, so scoring is a projection without Python.

The forest and the weights are fitted on at most ``SAMPLE_ROWS`` labelled rows, those with the smallest hash of their id.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from faultline.llm.tables import WORD, fresh_name, held_out, n_words
from faultline.session import stored

SAMPLE_ROWS = 10_000
TREES = 16
DEPTH = 3
PENALTY = 0.002
SUPPORT = 0.01
THRESHOLD = 0.3
SEED = 42

#: Words in a window in which distinct words are counted, so that the share does not sink with a text's length.
NEARBY = 64
#: Counted characters; each count is taken relative to the text's code points.
CHARACTERS = {
    "symbols": r"[#*$%&|<>]", "uppercase": r"\p{Lu}", "digits": r"\p{Nd}", "marks": r"[!?]", "stops": r"[.,;:]", "line_feeds": r"\n",
}


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics; a null or empty text has zeros."""
    text = F.coalesce(text, F.lit(""))
    chars, words = F.char_length(text), n_words(text)
    rate = lambda part, whole: F.when(whole > 0, part / whole).otherwise(0.0)
    found = {name: rate(F.regexp_count(text, F.lit(pattern)), chars) for name, pattern in CHARACTERS.items()}
    listed = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    in_window = lambda some, at: F.size(F.array_distinct(F.slice(some, at, F.lit(NEARBY))))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), words.cast("int")), F.lit(NEARBY))
    # The outer lambda holds the word list, which would else be made anew for every window.
    distinct = F.element_at(F.transform(F.array(listed), lambda some: F.aggregate(starts, F.lit(0), lambda total, at: total + in_window(some, at))), 1)
    return found | {"chars_per_word": rate(chars, words), "distinct_nearby": rate(distinct, words), "log_words": F.log1p(words.cast("double"))}


@dataclass(frozen=True)
class Condition:
    feature: int
    threshold: float
    above: bool

    def holds(self, values: np.ndarray) -> np.ndarray:
        return (values[:, self.feature] > self.threshold) == self.above

    def column(self, names: list[str]) -> Column:
        value = F.col(names[self.feature])
        return value > self.threshold if self.above else value <= self.threshold


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class RuleEnsemble:
    """``weights`` of conjunctions of thresholds over ``names``."""

    names: list[str]
    intercept: float
    weights: list[tuple[Rule, float]]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights:
            held = rule[0].column(self.names)
            for condition in rule[1:]:
                held = held & condition.column(self.names)
            total = total + F.when(held, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def paths(model) -> list[Rule]:
    """The conjunctions of all nodes but the roots."""
    rules: dict[frozenset, Rule] = {}

    def walk(node, path: Rule) -> None:
        if path:
            rules.setdefault(frozenset(path), path)
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        feature, threshold = int(split.featureIndex()), float(split.threshold())
        walk(node.leftChild(), (*path, Condition(feature, threshold, False)))
        walk(node.rightChild(), (*path, Condition(feature, threshold, True)))

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), ())
    return list(rules.values())


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> RuleEnsemble:
    """Learn from labelled rows that are not held out. Without two classes the score is the share of label 1, without labels 0.5."""
    spark = docs.sparkSession
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    stats = statistics(F.col("text"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(known), F.col("doc_id") == F.col("id"))
    sample = rows.select("id", "label", *[c.alias(n) for n, c in stats.items()]).orderBy(F.xxhash64("id"), "id", *stats).limit(sample_rows).toPandas()
    names, target = list(stats), sample["label"].to_numpy(dtype=float)
    if not 0 < target.sum() < len(target):
        share = float(np.clip(target.mean() if len(target) else 0.5, 0.01, 0.99))
        return RuleEnsemble(names, float(np.log(share / (1 - share))), [])
    values = sample[names].to_numpy(dtype=float)
    table = _vectors(spark, values, target)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=64, minInstancesPerNode=5, featureSubsetStrategy="onethird", seed=SEED).fit(table)
    rules = [r for r in paths(forest) if SUPPORT <= _held(r, values).mean() <= 1 - SUPPORT]
    if not rules:
        share = float(target.mean())
        return RuleEnsemble(names, float(np.log(share / (1 - share))), [])
    marks = np.stack([_held(r, values) for r in rules], axis=1).astype(float)
    model = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=100, standardization=True).fit(_vectors(spark, marks, target))
    weights = [(rule, float(w)) for rule, w in zip(rules, model.coefficients) if w]
    return RuleEnsemble(names, float(model.intercept), weights)


def _held(rule: Rule, values: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([c.holds(values) for c in rule])


def _vectors(spark, values: np.ndarray, target: np.ndarray) -> DataFrame:
    """The sample as one stored file: a fit's many jobs read it there, where rows held by the driver would be sent again with the tasks of each."""
    arrow = pa.table({"label": pa.array(target), "x": pa.FixedSizeListArray.from_arrays(pa.array(values.ravel()), values.shape[1]).cast(pa.list_(pa.float64()))})
    rows = stored(spark.createDataFrame(arrow, "label double, x array<double>").coalesce(1))
    return rows.select("label", array_to_vector("x").alias("features")).coalesce(1)


def scored(docs: DataFrame, model: RuleEnsemble, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted. Null and empty texts have zero statistics and a score like any other."""
    stats = statistics(F.col("text"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *[c.alias(n) for n, c in stats.items()])
    rows = rows.select("doc_id", "held_out", model.score().alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: RuleEnsemble, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the model does not reject, all columns."""
    stats = {fresh_name(docs, f"stat_{name}"): column for name, column in statistics(F.col(text_col)).items()}
    named = RuleEnsemble(list(stats), model.intercept, model.weights)
    return docs.withColumns(stats).filter(named.score() >= threshold).select(*[f"`{c}`" for c in docs.columns])
