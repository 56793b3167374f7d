"""Similarity join on word n-grams: rare-first prefix filtering with length, positional and suffix filters.

A text is the set of its distinct n-grams, as 64-bit hashes. All sets are put in one global order, rare n-grams first; two sets that are similar
enough share an n-gram in short prefixes of that order. The order needs only classes of document counts that all sets agree on:

1. texts are dealt by row number to batches of about ``BATCH_BYTES``. A batch names each hash once, by 32 bits besides its part of the hash
   range, in rows sorted and packed as differences; the part answers with a class of counts per hash. So a passage that a third of all
   documents hold costs a part one number per batch. Two hashes that share those bits only share a class, which harms nothing;
2. an n-gram of a single set can join nothing. It counts in sizes and positions but is never sent. A set whose prefix holds no other is done;
3. the rest post the shared n-grams of their prefixes. Two postings of one n-gram are a candidate if the smaller set has it in its index prefix and the
   length, positional and suffix filters leave the required overlap possible. The suffix filter bounds the sets' Hamming distance from below: in the
   join by bits that each hash flips, then by counts per section of the global order. Each candidate pair is verified once, by intersecting the hashes.

Sets that are equal are one node from the start. Links are wanted for what they connect, so postings are first paired with one hub per n-gram,
in rounds with other hubs while these halve what is open, and only pairs that are still in different components, and not yet verified, are joined with each
other at the end. A group of thousands of similar sets is thus settled by the hubs instead of by all its pairs; nothing is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from faultline.llm.components import connected
from faultline.session import TEXT_BYTES, ship_package, stored

SHINGLE = 4
SIMILARITY = Fraction(17, 20)
BATCH_BYTES = 16 << 20
#: The last join waits until the pairs between components are at most so many per posting, or, after ``LEAST_ROUNDS`` rounds, hubs no longer halve them.
PAIRS_PER_POSTING = 4
ROUNDS, LEAST_ROUNDS = 8, 4
BITS = 512  # that hashes flip, and sections of the hash range per class of counts, for the suffix filter
SECTIONS = 8
KEYS_AT_ONCE = 1 << 16  # n-grams that a task names at a time
SHORT = np.uint64((1 << 32) - 1)
KEPT = ["gram", "node", "size", "single", "bits", "at", "indexed", "root"]
SETS = "node bigint, digest binary, size bigint, single bigint, prefix array<bigint>, bits array<bigint>, shared binary, classes binary, ids array<bigint>"


def spread(values: np.ndarray) -> np.ndarray:
    """Every bit of the outcome depends on every bit of the value."""
    for _ in range(2):
        values = (values ^ (values >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def hashed_set(text: bytes, shingle: int) -> np.ndarray:
    """The text's distinct n-grams of lower-cased words, sorted; with fewer words all of them are one n-gram, without words there is none."""
    words = text.lower().split()
    if len(words) < shingle:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))][: len(words)], dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    total = np.zeros(len(words) - shingle + 1, dtype=np.uint64)
    for i in range(shingle):
        total = spread(total + hashes[i : i + len(total)])
    return np.unique(total)


class Batch:
    """A batch's distinct sets: all hashes in one buffer, and for each set a digest, where its hashes begin and end, and the ids of the documents that have it."""

    def __init__(self, table: pa.Table, shingle: int):
        found: dict[bytes, tuple] = {}
        self.without: list = []
        packed = bytearray()
        for doc_id, text in zip(table.column("doc_id").to_pylist(), (t for chunk in table.column("text").chunks for t in chunk)):
            hashes = hashed_set(text.as_buffer().to_pybytes() if text.is_valid else b"", shingle)
            if not len(hashes):
                self.without.append(doc_id)
                continue
            values = hashes.tobytes()
            digest = hashlib.blake2b(values, digest_size=16).digest()
            if digest not in found:
                found[digest] = (len(packed) // 8, len(packed) // 8 + len(hashes), [])
                packed += values
            found[digest][2].append(doc_id)
        self.sets = sorted((digest, *of) for digest, of in found.items())
        self.hashes = np.frombuffer(packed, dtype=np.uint64)


def named(hashes: np.ndarray, parts: int) -> np.ndarray:
    """The hashes' keys, sorted, in place of the hashes, as these are the most that a task holds."""
    for at in range(0, len(hashes), KEYS_AT_ONCE):
        hashes[at : at + KEYS_AT_ONCE] = key_of(hashes[at : at + KEYS_AT_ONCE], parts)
    hashes.sort()
    return hashes


def key_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    return (spread(hashes + np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % np.uint64(parts) << np.uint64(32) | hashes & SHORT


def planes(values: np.ndarray) -> bytes:
    """32-bit numbers byte by byte, lowest bytes first: small numbers leave planes of zeros, which compress."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(packed: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


def flipped(hashes: np.ndarray) -> np.ndarray:
    """Bits that an odd number of the hashes flips, as 64-bit numbers; those of two sets differ in at most as many bits as the sets in hashes."""
    odd = np.bincount((hashes % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _fresh(owners: np.ndarray) -> np.ndarray:
    return np.concatenate([[True], owners[1:] != owners[:-1]]) if len(owners) else np.empty(0, dtype=bool)


def _begins(owners: np.ndarray) -> np.ndarray:
    return np.flatnonzero(_fresh(owners))


def sent_rows(number: int, keys: np.ndarray, parts: int) -> list[tuple]:
    """Per part a batch's n-grams as differences, and in how many of its sets each is."""
    edges = np.searchsorted(keys, np.arange(parts + 1, dtype=np.uint64) << np.uint64(32))
    rows = []
    for part in np.flatnonzero(np.diff(edges)):
        own = keys[edges[part] : edges[part + 1]]
        begins = _begins(own)
        short = (own[begins] & SHORT).astype(np.int64)
        rows.append((number, int(part), planes(np.diff(short, prepend=0)), planes(np.diff(begins, append=len(own)))))
    return rows


def prefix_sizes(size: int, similarity: Fraction) -> tuple[int, int]:
    """How long the prefix must be that is indexed, against sets of this size or larger, and the one that probes."""
    t = similarity
    return size - -(-2 * t.numerator * size // (t.numerator + t.denominator)) + 1, size - -(-t.numerator * size // t.denominator) + 1


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, field.type) for c, field in zip(columns, schema)], schema=schema)


SENT = pa.schema([("batch", pa.int64()), ("part", pa.int64()), ("steps", pa.binary()), ("counts", pa.binary())])
TOLD = pa.schema([("batch", pa.int64()), ("part", pa.int64()), ("classes", pa.binary())])
FOUND = pa.schema([("node", pa.int64()), ("digest", pa.binary()), ("size", pa.int64()), ("single", pa.int64()), ("prefix", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64())),
                   ("shared", pa.binary()), ("classes", pa.binary()), ("ids", pa.list_(pa.int64()))])


def found_sets(docs: DataFrame, id_col: str, text_col: str, shingle: int, similarity: Fraction, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Per batch and distinct set: a node number, the shared n-grams in global order with their classes, the posted prefix, and the documents' ids.

    Sets that can have no partner have no lists; documents without a word are one row without a digest.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    batches = -(-size // batch_bytes) or 1
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), batches)
    # The row number only deals the rows; nothing else depends on it.
    dealt = docs.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(batches)).alias("batch"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def send(table: pa.Table) -> pa.Table:
        return _table(sent_rows(table.column("batch")[0].as_py(), named(Batch(table, shingle).hashes, parts), parts), SENT)

    def count(table: pa.Table) -> pa.Table:
        steps, counts = ([from_planes(v.as_py()) for v in table.column(c)] for c in ("steps", "counts"))
        values = np.concatenate([np.cumsum(s.astype(np.int64)) for s in steps])
        order = np.argsort(values, kind="stable")
        begins = _begins(values[order])
        total = np.add.reduceat(np.concatenate(counts).astype(np.int64)[order], begins)
        classes = np.empty(len(values), dtype=np.uint8)
        classes[order] = np.repeat(np.floor(2 * np.log2(total)).astype(np.uint8), np.diff(np.append(begins, len(values))))
        ends = np.cumsum([len(s) for s in steps])
        rows = [(b, p, classes[e - len(s) : e].tobytes()) for b, p, s, e in zip(table.column("batch").to_pylist(), table.column("part").to_pylist(), steps, ends)]
        return _table(rows, TOLD)

    def ordered(table: pa.Table, told: pa.Table) -> list[tuple]:
        batch, number = Batch(table, shingle), table.column("batch")[0].as_py()
        keys = named(batch.hashes.copy(), parts)
        keys = keys[_fresh(keys)]
        answers = sorted(zip(told.column("part").to_pylist(), told.column("classes").to_pylist()))
        classes = np.frombuffer(b"".join(a for _, a in answers), dtype=np.uint8)
        rows = []
        for at, (digest, begin, end, ids) in enumerate(batch.sets):
            hashes = batch.hashes[begin:end]
            of = classes[np.searchsorted(keys, key_of(hashes, parts))]
            shared = np.flatnonzero(of)
            single = len(hashes) - len(shared)
            posted = prefix_sizes(len(hashes), similarity)[1] - single
            if posted > 0 and len(shared):
                shared = shared[np.lexsort((hashes[shared], of[shared]))]
                rows.append((number << 32 | at, digest, len(hashes), single, hashes[shared[:posted]].view(np.int64), flipped(hashes), hashes[shared].astype("<u8").tobytes(), of[shared].tobytes(), ids))
            else:
                rows.append((number << 32 | at, digest, len(hashes), single, None, None, None, None, ids))
        if batch.without:
            rows.append((number << 32 | len(batch.sets), None, 0, 0, None, None, None, None, batch.without))
        return rows

    def order(table: pa.Table, told: pa.Table) -> pa.Table:
        return _table(ordered(table, told) if table.num_rows else [], FOUND)

    sent = dealt.groupBy("batch").applyInArrow(send, "batch bigint, part bigint, steps binary, counts binary")
    told = sent.groupBy("part").applyInArrow(count, "batch bigint, part bigint, classes binary")
    return dealt.groupBy("batch").cogroup(told.groupBy("batch")).applyInArrow(order, SETS)


def _possible(a: str, b: str, similarity: Fraction) -> str:
    """SQL: set a, the smaller one by (size, node), may be similar to set b by index prefix, length, n-grams of their own, position, and suffix."""
    n, d = similarity.numerator, similarity.denominator
    apart = " + ".join(f"bit_count({a}.bits[{i}] ^ {b}.bits[{i}])" for i in range(BITS // 64))
    return f"""struct({a}.size, {a}.node) < struct({b}.size, {b}.node) and {a}.indexed and {a}.size * {d} >= {b}.size * {n}
      and least({a}.size - {a}.single, {b}.size - {b}.single, {a}.size - {a}.at, {b}.size - {b}.at) * {n + d} >= ({a}.size + {b}.size) * {n}
      and ({a}.size + {b}.size - ({apart})) * {n + d} >= 2 * ({a}.size + {b}.size) * {n}"""


def _verifier(similarity: Fraction):
    n, d = similarity.numerator, similarity.denominator

    def sections(shared: np.ndarray, classes: bytes) -> np.ndarray:
        of = np.frombuffer(classes, dtype=np.uint8).astype(np.int64) * SECTIONS + (shared >> np.uint64(61)).astype(np.int64)
        return np.bincount(of, minlength=256 * SECTIONS)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, right, right_sections = None, None, None
        for batch in batches:
            similar = []
            for b, size_a, single_a, shared_a, classes_a, size_b, single_b, shared_b, classes_b in zip(*(
                    batch.column(c).to_pylist() for c in ("b", "size_a", "single_a", "shared_a", "classes_a", "size_b", "single_b", "shared_b", "classes_b"))):
                if b != last:
                    last, right = b, np.frombuffer(shared_b, dtype="<u8")
                    right_sections = sections(right, classes_b)
                left = np.frombuffer(shared_a, dtype="<u8")
                apart = single_a + single_b + np.abs(sections(left, classes_a) - right_sections).sum()
                enough = (size_a + size_b) * n
                possible = (size_a + size_b - apart) // 2 * (n + d) >= enough
                similar.append(bool(possible) and len(np.intersect1d(left, right, assume_unique=True)) * (n + d) >= enough)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(similar, pa.bool_())], ["a", "b", "similar"])

    return verify


def _verified(pairs: DataFrame, sets: DataFrame, similarity: Fraction) -> DataFrame:
    """a, b, similar: every pair once. One side's list is sent with the pair; the other joins last, and is read once for all pairs that follow it."""
    pairs = stored(pairs)  # its size decides how the lists are joined
    lists = sets.select("node", "size", "single", "shared", "classes")
    left, right = (lists.toDF(side, *[f"{c}_{side}" for c in lists.columns[1:]]) for side in ("a", "b"))
    return stored(pairs.join(left, "a").join(right, "b").mapInArrow(_verifier(similarity), "a bigint, b bigint, similar boolean"), TEXT_BYTES)


def links(sets: DataFrame, similarity: Fraction, first: DataFrame | None = None) -> DataFrame:
    """Links a, b between nodes that connect all sets that are similar. Pairs a > b of ``first`` are verified before any other."""
    index = F.expr(f"size - cast(ceil({2 * similarity.numerator} * size / {similarity.numerator + similarity.denominator}) as bigint) + 1")
    posted = sets.select("node", "size", "single", "bits", F.posexplode("prefix").alias("place", "gram")).withColumn("at", F.col("single") + F.col("place"))
    posted = posted.select("gram", "node", "size", "single", "bits", "at", (F.col("at") < index).alias("indexed"))
    useful = posted.groupBy("gram").agg(F.count("*").alias("n"), F.max("indexed").alias("some")).filter("n > 1 and some").select("gram")
    posted = stored(posted.join(useful, "gram", "left_semi"))
    tried = roots = before = None
    if first is not None:
        tried = _verified(first, sets, similarity)
        roots = connected(tried.filter("similar").select("a", "b"))
    for turn in range(ROUNDS + 1):
        named = posted.withColumn("root", F.col("node")) if roots is None else posted.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        per_root = named.groupBy("gram", "root").agg(F.count("*").alias("n"))
        open_grams = per_root.groupBy("gram").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("within"), F.count("*").alias("roots")).filter("roots > 1")
        members = stored(named.join(open_grams.select("gram", "n", "within"), "gram"))
        rows, pairs = members.agg(F.count("*"), F.sum((F.col("n") - F.col("within") / F.col("n")) / 2)).first()
        if not rows:
            break
        few = pairs <= PAIRS_PER_POSTING * rows or turn == ROUNDS or (turn > LEAST_ROUNDS and pairs > before / 2)
        before = pairs
        members = members.select(*KEPT)
        if few:
            other = members
        else:
            # The first hubs are the same for many n-grams, which links most of a group at one pair per set; later ones differ, so a set meets many.
            hub = F.struct(F.xxhash64("node", *(["gram"] if turn else []), F.lit(turn)), *KEPT[1:])
            other = members.groupBy("gram").agg(F.min(F.when(F.col("indexed"), hub)).alias("hub")).select("gram", *[f"hub.{c}" for c in KEPT[1:]])
        one, two = _possible("x", "y", similarity), _possible("y", "x", similarity)
        rule = f"x.gram = y.gram and x.root != y.root and ({one if few else f'({one}) or ({two})'})"
        met = members.alias("x").join(other.alias("y"), F.expr(rule)).select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")).distinct()
        if tried is not None:
            met = met.join(tried.select("a", "b"), ["a", "b"], "left_anti")
        fresh = _verified(met, sets, similarity)
        tried = fresh if tried is None else tried.union(fresh)
        if few:
            break
        roots = connected(tried.filter("similar").select("a", "b"))
    if tried is None:
        return posted.select(F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    return tried.filter("similar").select("a", "b")


def _nodes_of(candidates: DataFrame, found: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs a > b of the nodes that stand for the documents' sets. Equal sets and those without a possible partner give none."""
    of = found.filter("prefix is not null").select("digest", F.explode("ids").alias("id")).join(groups.select("digest", "node"), "digest").select("id", "node")
    ends = candidates.join(of.toDF("a", "node_a"), "a").join(of.toDF("b", "node_b"), "b").filter("node_a != node_b")
    return ends.select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b")).distinct()


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, similarity: Fraction = SIMILARITY,
                   batch_bytes: int = BATCH_BYTES, candidates: DataFrame | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id that links of similar texts reach, its own included).

    ``candidates``: pairs a, b of ids that another method holds to be similar. They are verified first; the join goes on between what they leave apart.

    Equal n-grams are those with equal 64-bit hashes. A null or wordless text has no n-grams and links with nothing, not even its like. Repeated rows are
    documents of their own that link with each other; a null id is larger than any other, and a component of such has a null
    component_id. No rows give no rows; other columns are ignored, whatever their names. A text of any length is one set.
    """
    ship_package(docs.sparkSession)
    found = stored(found_sets(docs, id_col, text_col, shingle, similarity, batch_bytes), TEXT_BYTES)
    low = F.array_min("ids")  # skips nulls
    groups = found.filter("digest is not null").groupBy("digest").agg(F.min("node").alias("node"), F.min(low).alias("low"))
    groups = stored(groups)
    again = found.filter("prefix is not null").select("node", "digest").join(groups.select("digest", F.col("node").alias("first")), "digest").filter("node != first")
    again = stored(again.select("node"))
    sets = found.filter("prefix is not null").select("node", "size", "single", "prefix", "bits", "shared", "classes").join(again, "node", "left_anti")
    first = None if candidates is None else _nodes_of(candidates, found, groups)
    roots = connected(links(sets, similarity, first))
    rooted = groups.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    named = rooted.join(lowest, "root").select(F.col("digest").alias("of"), "component_id")
    rows = found.select("digest", "size", "ids").join(named, F.col("digest") == F.col("of"), "left")
    listed = rows.select(F.explode("ids").alias("doc_id"), F.col("size").alias("n_shingles"), "digest", "component_id")
    return listed.select("doc_id", "n_shingles", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
