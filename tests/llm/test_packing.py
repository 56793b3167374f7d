"""Packing: ids against the tokenizer library, whole coverage, and the bin filling."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from edge_tables import edge_documents
from faultline.llm import packing
from faultline.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found.encode_special_tokens = True
    return found


def check(rows, docs, library):
    """Pieces cover every document's ids once, sequences are gapless and at most full."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    texts = defaultdict(list)
    for doc in docs:
        texts[doc.doc_id].append(doc.text or "")
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        same = len(texts[doc_id])
        assert len(set(texts[doc_id])) == 1
        ids = np.array(library.encode(texts[doc_id][0], add_special_tokens=False).ids + [0], dtype="<u4")
        pieces.sort(key=lambda r: r.start)
        assert {r.doc_tokens for r in pieces} == {len(ids)} and sum(r.length for r in pieces) == same * len(ids)
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
        assert [r.start for r in pieces][::same] == [0, *np.cumsum([r.length for r in pieces][::same])[:-1]]
    for parts in by_sequence.values():
        parts.sort()
        assert parts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:]))
        assert parts[-1][0] + parts[-1][1] <= packing.CAPACITY
    return sum(packing.CAPACITY - sum(n for _, n in parts) for parts in by_sequence.values()) / packing.CAPACITY / len(by_sequence)


def test_query_round_trip(spark, library):
    padding = check(QUERIES["op9_packing"](spark, DATA).collect(), spark.read.parquet(f"{DATA}/documents.parquet").collect(), library)
    assert padding < 0.02  # 200 documents leave a few windows of long rests


def test_edge_cases(spark, library):
    docs = edge_documents(spark)
    check(packing.packed(docs).collect(), docs.collect(), library)
    assert packing.packed(edge_documents(spark, rows=False)).count() == 0


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from("ab Z9é'st\n\t\r .,!<|>　\x85\x1c\U0001f600"), max_size=40))
def test_ids_equal_the_library(library, text):
    assert packing.tokenizer(packing.VOCABULARY).ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_special_strings_are_ordinary(library):
    text = "a <|endoftext|> b"
    assert packing.tokenizer(packing.VOCABULARY).ids(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_fullest_matches_brute_force():
    draw = random.Random(3)
    for _ in range(200):
        counts = {draw.randint(1, 40): draw.randint(1, 4) for _ in range(draw.randint(1, 6))}
        first = max(counts)
        sums = {first}
        for length, n in counts.items():
            n -= length == first
            sums |= {s + length * k for s in list(sums) for k in range(1, n + 1) if s + length * k <= 64}
        pattern = packing.fullest(counts, first, 64)
        assert sum(length * n for length, n in pattern.items()) == max(sums)
        assert pattern[first] >= 1 and all(n <= counts[length] for length, n in pattern.items())


def test_patterns_use_every_length():
    counts = {n: 1 + n * 7919 % 50 for n in range(1, 1025)}
    used = defaultdict(int)
    for pattern, times in packing.patterns(counts):
        assert sum(length * n for length, n in pattern.items()) <= 1024
        for length, n in pattern.items():
            used[length] += n * times
    assert used == counts


@pytest.fixture(scope="module")
def unchanged_library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


SPECIAL = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y  ", "a  <|endoftext|>  b\tc", "<|endoftext|", "<<|endoftext|>>"]


def test_special_strings_get_the_ids_of_the_unchanged_library(spark, unchanged_library):
    docs = spark.createDataFrame(list(enumerate(SPECIAL)), "doc_id bigint, text string")
    check(packing.packed(docs).collect(), docs.collect(), unchanged_library)


@settings(max_examples=300, deadline=None)
@given(parts=st.lists(st.sampled_from(["<|endoftext|>", "a", " ", "\n", "é", "'s", "<|", "|>", "\t ", "9"]), max_size=12))
def test_ids_with_special_equal_the_unchanged_library(unchanged_library, parts):
    text = "".join(parts)
    assert packing.tokenizer(packing.VOCABULARY).ids_with_special(text).tolist() == unchanged_library.encode(text, add_special_tokens=False).ids
