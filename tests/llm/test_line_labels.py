"""Base counts against a plain version, decoding against all label sequences, and the verdict on held-out rows."""

import random
import re
from itertools import product

import numpy as np

from edge_tables import edge_documents
from faultline.llm import line_labels
from faultline.llm.queries import QUERIES
from faultline.llm.tables import held_out
from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.01"


def slow_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_base_counts(spark):
    docs = edge_documents(spark).filter("doc_id is null or doc_id not in (9, 10)")
    draw = random.Random(4)
    texts = [" ".join(draw.choice("ab#\n") * draw.randint(1, 2) for _ in range(draw.randint(0, 60))) for _ in range(150)] + [r.text for r in docs.collect()]
    for text in texts:
        counts = line_labels.read_text(text or "")[0]
        assert counts == slow_counts(text), text
    got = line_labels.judged(docs, line_labels.ALL_CONTENT).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(slow_counts(r.text) for r in docs.collect())
    assert all(r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and r.kept == (not r.base_failed) for r in got)


def test_decoding_finds_the_best_sequence():
    draw = np.random.default_rng(2)
    for _ in range(60):
        chain = line_labels.Chain(draw.normal(size=len(line_labels.FEATURES)), draw.normal(size=(2, 2)))
        features = draw.normal(size=(draw.integers(1, 8), len(line_labels.FEATURES)))
        value = lambda states: sum(s * f @ chain.emit for s, f in zip(states, features)) + sum(chain.move[a, b] for a, b in zip(states, states[1:]))
        best = max(product((0, 1), repeat=len(features)), key=value)
        assert np.isclose(value(chain.labels(features.tolist())), value(best))


def test_held_out_verdicts(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    got = QUERIES["op3_line_labels"](spark, DATA).filter(~F.col("base_failed")).join(labels, "doc_id").filter(held_out(F.col("doc_id"))).collect()
    assert np.mean([r.kept == bool(r.quality) for r in got]) >= 0.95
    assert np.mean([r.kept for r in got if r.quality]) >= 0.97


def test_empty_tables_and_no_labels(spark):
    docs, labels = edge_documents(spark, rows=False), spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert line_labels.judged(docs, line_labels.learned(docs, labels)).count() == 0
    docs = edge_documents(spark)
    chain = line_labels.learned(docs, labels)
    assert chain is line_labels.ALL_CONTENT
    assert line_labels.judged(docs, chain).count() == docs.count()
