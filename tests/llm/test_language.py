"""Language profiles: held-out accuracy, vectors against a plain version, and edge cases."""

from collections import Counter

import numpy as np

from edge_tables import edge_documents
from faultline.llm import language
from faultline.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"


def slow_vector(text):
    symbols = [c if c.isalpha() else " " for c in text.lower()]
    kept = [" "]
    for c in [*symbols, " "]:
        if c != " " or kept[-1] != " ":
            kept.append(c)
    out = np.zeros(language.DIMENSIONS, dtype=np.int64)
    for (a, b, c), n in Counter(zip(kept, kept[1:], kept[2:])).items():
        one, two, three = (language.letter_vector(ord(x)).astype(np.int64) for x in (a, b, c))
        out += n * np.roll(one, 2) * np.roll(two, 1) * three
    return out


def test_vectors(monkeypatch):
    texts = ["The cat sat.", "", "x", "Ünïcode  straße\n\n\U0001f600 naïve 12", "a b  c" * 9]
    want = np.stack([slow_vector(t) if any(map(str.isalpha, t)) else np.zeros(language.DIMENSIONS) for t in texts])
    assert np.array_equal(language.text_vectors(texts), want)
    monkeypatch.setattr(language, "CHARS_AT_ONCE", 3)
    assert np.array_equal(language.text_vectors(texts), want)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = QUERIES["op10_language"](spark, DATA).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) >= 0.98


def test_edge_cases(spark):
    docs = edge_documents(spark)
    got = language.identified(docs).collect()
    assert len(got) == docs.count()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in got:
        lettered = any(map(str.isalpha, texts[r.doc_id] or ""))
        assert (r.lang_pred != "und") == lettered and 0 <= r.score <= 1
    assert language.identified(edge_documents(spark, rows=False)).count() == 0
    from pyspark.sql import functions as F

    unknown = language.identified(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unknown} == {("und", 0.0)}
