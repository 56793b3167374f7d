"""SimHash components against brute force over all pairs."""

import random
from pathlib import Path

import pytest
import xxhash

from edge_tables import edge_documents
from faultline.llm import simhash
from faultline.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for white in "\t\n\x0b\x0c\r":
        words = words.replace(white, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(fps):
    root = list(range(len(fps)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[max(top(i), top(j))] = min(top(i), top(j))
    return [top(i) for i in range(len(fps))]


def expected(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    fps = [slow_fingerprint(text) for _, text in rows]
    return sorted(((doc, f"{fp:016x}", rows[top][0]) for (doc, _), fp, top in zip(rows, fps, slow_components(fps))), key=repr)


def got(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


def test_query_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert got(QUERIES["op1_simhash"](spark, DATA)) == expected(rows)


def test_edge_cases(spark):
    docs = edge_documents(spark)
    assert got(simhash.near_duplicates(docs)) == expected([(r.doc_id, r.text) for r in docs.collect()])
    assert simhash.near_duplicates(edge_documents(spark, rows=False)).count() == 0


@pytest.mark.parametrize("limit", [4, 512])
def test_links_connect_what_brute_force_connects(spark, limit):
    draw = random.Random(5)
    values = [draw.getrandbits(64) for _ in range(60)]
    for centre in values[:12]:
        for _ in range(12):
            values.append(centre ^ sum({1 << draw.randrange(64) for _ in range(draw.randrange(4))}))
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), limit).collect()
    place = {v: i for i, v in enumerate(signed)}
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in links)
    parts = slow_components(values)
    root = list(range(len(values)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        i, j = top(place[a]), top(place[b])
        root[max(i, j)] = min(i, j)
    assert [top(i) for i in range(len(values))] == parts


def test_one_document_of_each_component_stays(spark):
    docs = edge_documents(spark)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    fps = [slow_fingerprint(r.text) for r in docs.collect()]
    assert kept.count() == len(set(slow_components(fps)))


def test_tree_finds_all_within_radius():
    draw = random.Random(1)
    values = [draw.getrandbits(10) for _ in range(300)]
    tree = simhash.BkTree(values[0])
    for value in values:
        tree.add(value)
    for value in values[:50]:
        assert sorted(tree.within(value, 2)) == sorted({v for v in values if (v ^ value).bit_count() <= 2})
