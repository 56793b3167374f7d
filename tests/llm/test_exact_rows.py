"""Exact duplicates: of rows that share an id, the one with most code points stays."""

import pytest

from faultline.llm import exact_dedup


@pytest.mark.parametrize("doc_id", [7, None])
def test_longest_of_rows_with_one_id_stays(spark, doc_id):
    texts = ["a b c", "abc", "a  b  c  ", "ab c", "other"]
    for order in (texts, texts[::-1]):
        docs = spark.createDataFrame([(doc_id, t) for t in order], "doc_id bigint, text string")
        assert sorted(r.text for r in exact_dedup.drop_exact_duplicates(docs).collect()) == ["a  b  c  ", "other"]
