"""Substring dedup on bytes with a logarithmic family of suffix arrays.

Suffixes are sampled where the content says so: of all grams of ``GRAM`` bytes in a window of ``WINDOW`` bytes, the one with the
smallest hash (the last of several) is the window's anchor. Equal windows have their anchors at equal places, so a repeated window
shows among the suffixes of one gram, and every window belongs to one anchor. What lies around an anchor is its context: all bytes of its windows.

Texts are read once for anchors. Anchors meet by gram: contexts that are the same throughout (copies) are settled by a hash, and one of each
distinct context goes on if its gram has several. Those come to the gram's shard in batches. A batch gets a suffix array (its suffixes in
order, with the common prefixes of neighbours, and likewise for what is before the anchors), is merge-scanned with every level of the index for
windows that occur twice, and enters as the lowest level; two levels of one generation merge to one of the next, so a shard keeps
logarithmically many. Should a gram have more than ``HOT_CONTEXTS`` distinct contexts, as at the edges of a passage that very many documents
hold, its windows go to shards of their own, each by its hash, and are counted there, so that no shard gathers such a group. Two windows at offset o are equal when their suffixes share the first WINDOW - o bytes and what precedes the anchors the
first o, so runs of neighbours with long enough common prefixes, in both orders, name all windows without comparing pairs.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from faultline.llm.batches import answers, batched, by_batch, in_order, mixed_bits, part_of, rows_by_part, runs, texts_of, unpacked
from faultline.session import ship_package

WINDOW = 200
GRAM = 40
REACH = WINDOW - GRAM  # an anchor is at most so far from its window's start
STARTS_AT_ONCE = 1 << 18
BATCH_CONTEXTS = 4096
HOT_CONTEXTS = 1024
OFFSETS_AT_ONCE = 23
PLACE = np.dtype([("doc", "<u4"), ("start", "<u4"), ("starts", "<u2"), ("offset", "<u2")])
RANGE = np.dtype([("doc", "<u4"), ("start", "<u4"), ("starts", "<u4")])
_BASE = 0x5851F42D4C957F2D
SETTLED, SENT, HOT = 1, 2, 4


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse."""
    found = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        steps = np.full(STARTS_AT_ONCE + WINDOW + 1, base, dtype=np.uint64)
        steps[0] = 1
        found.append(np.multiply.accumulate(steps))
    return found[0], found[1]


def _smallest_from(keys: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` keys the smallest."""
    span = 1
    while 2 * span <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    return np.minimum(keys[: -(width - span)], keys[width - span :]) if span < width else keys


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of at most ``STARTS_AT_ONCE`` windows: gram hash, context hash, first start, how many starts, and the first's offset, per anchor."""
    power, inverse = _powers()
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    grams = (sums[GRAM:] - sums[:-GRAM]) * inverse[: len(sums) - GRAM]
    low = np.uint64(STARTS_AT_ONCE * 2 - 1)
    spread = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    keys = (spread & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
    at = (low - (_smallest_from(keys, REACH + 1) & low)).astype(np.int64)
    first, _ = runs(at)
    ends = np.append(first[1:], len(at))
    at, starts = at[first], ends - first
    context = mixed_bits((sums[ends - 1 + WINDOW] - sums[first]) * inverse[first])
    context = mixed_bits(context + (starts.astype(np.uint64) << np.uint64(16)) + (at - first).astype(np.uint64))
    return mixed_bits(grams[at]), context, first, starts, at - first


class Contexts:
    """Contexts around anchors, in the order of the suffixes at the anchors; what is before an anchor is kept backwards."""

    FIELDS = ("gram", "after", "before", "offset", "starts", "label", "seen")

    def __init__(self, generation: int, **fields: np.ndarray):
        self.generation = generation
        for name in self.FIELDS:
            setattr(self, name, fields[name])

    @classmethod
    def of(cls, gram: np.ndarray, text: np.ndarray, at: np.ndarray, offset: np.ndarray, starts: np.ndarray, label: np.ndarray) -> Contexts:
        """``text`` holds the contexts end to end, ``at`` where each begins."""
        size = starts + WINDOW - 1
        after = np.arange(WINDOW) + offset[:, None]
        before = offset[:, None] - 1 - np.arange(REACH)
        take = lambda places, held: np.where(held, text[np.minimum(np.maximum(at[:, None] + places, 0), len(text) - 1)], 0).astype(np.uint8)
        fields = {"after": take(after, after < size[:, None]), "before": take(before, before >= 0)}
        seen = np.zeros((len(at), REACH + 1), dtype=bool)
        return cls(0, gram=gram, offset=offset, starts=starts, label=label, seen=seen, **fields).sorted()

    def __len__(self) -> int:
        return len(self.gram)

    def take(self, rows: np.ndarray) -> Contexts:
        return Contexts(self.generation, **{name: getattr(self, name)[rows] for name in self.FIELDS})

    def sorted(self) -> Contexts:
        return self.take(suffix_order(self.after))

    @staticmethod
    def merged(parts: list[Contexts], generation: int) -> Contexts:
        return Contexts(generation, **{name: np.concatenate([getattr(p, name) for p in parts]) for name in Contexts.FIELDS}).sorted()

    def mark_repeats(self) -> None:
        """Mark windows that another context here holds too."""
        n = len(self)
        back = suffix_order(self.before)
        after, before = common_prefixes(self.after), common_prefixes(self.before[back])
        for low in range(0, REACH + 1, OFFSETS_AT_ONCE):
            offsets = np.arange(low, min(low + OFFSETS_AT_ONCE, REACH + 1))
            held = (offsets[:, None] <= self.offset) & (offsets[:, None] > self.offset - self.starts)
            if not held.any():
                continue
            same_after = np.zeros((len(offsets), n), dtype=np.int64)
            np.cumsum(after[None, :] < WINDOW - offsets[:, None], axis=1, out=same_after[:, 1:])
            same_before = np.zeros((len(offsets), n), dtype=np.int64)
            np.cumsum(before[None, :] < offsets[:, None], axis=1, out=same_before[:, 1:])
            key = same_after * (n + 1)
            key[:, back] += same_before
            key = np.where(held, key, -1 - np.arange(n))
            order = np.argsort(key, axis=1)
            key = np.take_along_axis(key, order, axis=1)
            equal = key[:, 1:] == key[:, :-1]
            twice = np.zeros((len(offsets), n), dtype=bool)
            twice[:, 1:] |= equal
            twice[:, :-1] |= equal
            found = np.zeros_like(twice)
            np.put_along_axis(found, order, twice, axis=1)
            self.seen[:, offsets] |= found.T


def suffix_order(rows: np.ndarray) -> np.ndarray:
    return np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel(), kind="stable")


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """How many bytes each row shares with the one before, from the second on."""
    differs = rows[1:] != rows[:-1]
    return np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1])


class IndexFamily:
    """Levels of suffix arrays; new batches are scanned against all, and levels of one generation merge."""

    def __init__(self) -> None:
        self.levels: list[Contexts] = []

    def add(self, batch: Contexts) -> None:
        batch.mark_repeats()
        for level in self.levels:
            new, old = np.isin(batch.gram, level.gram), np.isin(level.gram, batch.gram)
            if new.any():
                both = Contexts.merged([batch.take(new), level.take(old)], 0)
                both.mark_repeats()
                told = dict(zip(both.label.tolist(), both.seen))
                for part, rows in ((batch, new), (level, old)):
                    part.seen[rows] |= np.stack([told[label] for label in part.label[rows].tolist()])
        self.levels.append(batch)
        while len(self.levels) > 1 and self.levels[-1].generation == self.levels[-2].generation:
            last = [self.levels.pop(), self.levels.pop()]
            self.levels.append(Contexts.merged(last, last[0].generation + 1))


def repeated_ranges(gram: np.ndarray, text: np.ndarray, offset: np.ndarray, starts: np.ndarray, batch_contexts: int = BATCH_CONTEXTS) -> np.ndarray:
    """A row per context and a column per start: whether its window occurs in another context too."""
    family, out = IndexFamily(), np.zeros((len(gram), REACH + 1), dtype=bool)
    at = np.concatenate([[0], np.cumsum(starts + WINDOW - 1)[:-1]]) if len(gram) else np.empty(0, dtype=np.int64)
    for low in range(0, len(gram), batch_contexts):
        some = slice(low, low + batch_contexts)
        family.add(Contexts.of(gram[some], text, at[some], offset[some], starts[some], np.arange(len(gram))[some]))
    for level in family.levels:
        start = np.arange(REACH + 1)
        places = level.offset[:, None] - start
        held = (places >= 0) & (start < level.starts[:, None])
        out[level.label] = np.where(held, np.take_along_axis(level.seen, np.clip(places, 0, REACH), axis=1), False)
    return out


def removable(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A byte goes if a string of 200 bytes that covers it also starts elsewhere, in any document or its own; strings are judged on the
    input. A null text is empty, repeated rows are copies of each other, other columns are ignored, and no rows give no rows.
    """
    ship_package(docs.sparkSession)
    batches, parts = batched(docs, id_col, text_col)

    def sample(table: pa.Table) -> pa.Table:
        grams, contexts, places = [], [], []
        for doc, text in enumerate(texts_of(in_order(table))):
            for low in range(0, len(text) - WINDOW + 1, STARTS_AT_ONCE):
                data = np.frombuffer(text, dtype=np.uint8)[low : low + STARTS_AT_ONCE + WINDOW - 1]
                gram, context, first, starts, offset = anchors(data)
                place = np.empty(len(gram), dtype=PLACE)
                place["doc"], place["start"], place["starts"], place["offset"] = doc, first + low, starts, offset
                grams.append(gram)
                contexts.append(context)
                places.append(place)
        if not grams:
            return _EMPTY_ANCHORS
        gram, context, place = map(np.concatenate, (grams, contexts, places))
        order = np.lexsort((context, gram))
        gram, context, place = gram[order], context[order], place[order]
        fresh = np.concatenate([[True], (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])])
        begins = np.flatnonzero(fresh)
        count = np.diff(np.append(begins, len(gram))).astype("<u4")
        batch, part = table.column("batch")[0].as_py(), part_of(gram, parts)
        found = rows_by_part(batch, part[begins], {"gram": gram[begins], "context": context[begins], "count": count})
        return found.append_column("places", rows_by_part(batch, part, {"places": place}).column("places"))

    def meet(table: pa.Table) -> pa.Table:
        (gram, sizes), context, count = unpacked(table, "gram", "<u8"), unpacked(table, "context", "<u8")[0], unpacked(table, "count", "<u4")[0]
        place = unpacked(table, "places", PLACE)[0]
        row = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((context, gram))
        begins, of_gram = runs(gram[order])
        fresh = np.concatenate([[True], (gram[order][1:] != gram[order][:-1]) | (context[order][1:] != context[order][:-1])])
        firsts, of_context = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        copies = np.add.reduceat(count[order].astype(np.int64), firsts)[of_context]
        distinct = np.add.reduceat(fresh.astype(np.int64), begins)[of_gram]
        code = np.empty(len(gram), dtype=np.uint8)
        code[order] = SETTLED * (copies > 1) + fresh * np.where(distinct > HOT_CONTEXTS, HOT, SENT * (distinct > 1))
        told = np.flatnonzero(code)
        owner = np.repeat(np.arange(len(gram)), count)
        spot = np.flatnonzero(code[owner])
        picked = {"code": code[told], "gram": gram[told], "count": count[told]}
        return answers(table, {**{k: (v, row[told]) for k, v in picked.items()}, "places": (place[spot], row[owner[spot]])})

    def entries(found: pa.Table) -> tuple[np.ndarray, ...]:
        code, gram, count = unpacked(found, "code", "u1")[0], unpacked(found, "gram", "<u8")[0], unpacked(found, "count", "<u4")[0].astype(np.int64)
        return code, gram, count, unpacked(found, "places", PLACE)[0]

    def send(table: pa.Table, found: pa.Table) -> pa.Table:
        code, gram, count, place = entries(found)
        if not len(code) or not table.num_rows:
            return _EMPTY_CONTEXTS
        first = np.cumsum(count) - count
        texts, batch = texts_of(in_order(table)), table.column("batch")[0].as_py()
        hot = _windows(texts, place[first[np.flatnonzero(code & HOT)]], batch, parts)
        sent = np.flatnonzero(code & SENT)
        if not len(sent):
            return hot
        sent = sent[np.argsort(part_of(gram[sent], parts), kind="stable")]
        spots = place[first[sent]]
        bodies = [texts[p["doc"]][int(p["start"]) : int(p["start"]) + int(p["starts"]) + WINDOW - 1] for p in spots]
        part = part_of(gram[sent], parts)
        columns = {"gram": gram[sent], "settled": code[sent] & SETTLED, "places": spots}
        out = rows_by_part(batch, part, columns)
        begins, _ = runs(part)
        ends = np.append(begins[1:], len(part))
        out = out.append_column("text", pa.array([b"".join(bodies[b:e]) for b, e in zip(begins, ends)], pa.binary()))
        return pa.concat_tables([out, hot])

    def scan(table: pa.Table) -> pa.Table:
        single = pc.is_null(table.column("settled"))
        return pa.concat_tables([scan_contexts(table.filter(pc.invert(single))), count_windows(table.filter(single))])

    def count_windows(table: pa.Table) -> pa.Table:
        """Windows of hot grams: those that occur twice, in whatever batches."""
        (value, sizes), count = unpacked(table, "gram", "<u8"), unpacked(table, "text", "<u4")[0]
        place = unpacked(table, "places", PLACE)[0]
        order = np.argsort(value)
        begins, run = runs(value[order])
        twice = np.empty(len(value), dtype=bool)
        if len(value):
            twice[order] = (np.add.reduceat(count[order].astype(np.int64), begins) > 1)[run]
        owner = np.repeat(np.arange(len(value)), count)
        spot = np.flatnonzero(twice[owner])
        row = np.repeat(np.arange(len(sizes)), sizes)
        return answers(table, {"ranges": (_ranges(place[spot]), row[owner[spot]])})

    def scan_contexts(table: pa.Table) -> pa.Table:
        (gram, sizes), settled, place = unpacked(table, "gram", "<u8"), unpacked(table, "settled", "u1")[0], unpacked(table, "places", PLACE)[0]
        text = unpacked(table, "text", "u1")[0]
        seen = repeated_ranges(gram, text, place["offset"].astype(np.int64), place["starts"].astype(np.int64))
        seen[settled > 0] = False
        edges = np.diff(np.pad(seen, ((0, 0), (1, 1))).astype(np.int8), axis=1)
        (which, begin), end = np.nonzero(edges == 1), np.nonzero(edges == -1)[1]
        ranges = np.empty(len(which), dtype=RANGE)
        ranges["doc"], ranges["start"], ranges["starts"] = place["doc"][which], place["start"][which] + begin, end - begin
        return answers(table, {"ranges": (ranges, np.repeat(np.arange(len(sizes)), sizes)[which])})

    def copies(table: pa.Table) -> pa.Table:
        rows = []
        for at in range(table.num_rows):
            code, _, count, place = entries(table.slice(at, 1))
            rows.append(_ranges(place[np.repeat((code & SETTLED) > 0, count)]).tobytes())
        return pa.Table.from_arrays([table.column("batch"), pa.array(rows, pa.binary())], ["batch", "ranges"])

    def copied(batches_of_rows):
        for batch in batches_of_rows:
            yield from copies(pa.Table.from_batches([batch])).to_batches()

    def cut(table: pa.Table, found: pa.Table) -> pa.Table:
        table, ranges = in_order(table), unpacked(found, "ranges", RANGE)[0]
        ranges = ranges[np.argsort(ranges["doc"], kind="stable")]
        ids, texts, rows = table.column("doc_id").to_pylist(), texts_of(table), []
        edges = np.searchsorted(ranges["doc"], np.arange(len(texts) + 1))
        for doc, text in enumerate(texts):
            own = ranges[edges[doc] : edges[doc + 1]]
            removed = spans = 0
            if len(own):
                change = np.zeros(len(text) + 1, dtype=np.int32)
                np.add.at(change, own["start"], 1)
                np.add.at(change, own["start"].astype(np.int64) + own["starts"] + (WINDOW - 1), -1)
                gone = np.cumsum(change[:-1]) > 0
                removed, spans = int(gone.sum()), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                text = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
            rows.append((ids[doc], len(text) + removed, removed, spans, hashlib.sha256(text).hexdigest()))
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    sampled = batches.groupBy("batch").applyInArrow(sample, "batch bigint, part bigint, gram binary, context binary, count binary, places binary")
    met = sampled.groupBy("part").applyInArrow(meet, "batch bigint, code binary, gram binary, count binary, places binary")
    sent = by_batch(batches, met, send, "batch bigint, part bigint, gram binary, settled binary, places binary, text binary")
    scanned = sent.groupBy("part").applyInArrow(scan, "batch bigint, ranges binary")
    ranges = met.mapInArrow(copied, "batch bigint, ranges binary").unionByName(scanned)
    return by_batch(batches, ranges, cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def _ranges(place: np.ndarray) -> np.ndarray:
    ranges = np.empty(len(place), dtype=RANGE)
    for name in RANGE.names:
        ranges[name] = place[name]
    return ranges


def _windows(texts: list[bytes], spots: np.ndarray, batch: int, parts: int) -> pa.Table:
    """Each window of some contexts by its hash, equal ones of a batch once with their count and places; no column ``settled``."""
    power, inverse = _powers()
    values, places = [], []
    for spot in spots:
        low, starts = int(spot["start"]), int(spot["starts"])
        data = np.frombuffer(texts[spot["doc"]], dtype=np.uint8)[low : low + starts + WINDOW - 1].astype(np.uint64)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((data + np.uint64(1)) * power[: len(data)])])
        values.append(mixed_bits((sums[WINDOW:] - sums[:-WINDOW]) * inverse[:starts]))
        place = np.zeros(starts, dtype=PLACE)
        place["doc"], place["start"], place["starts"] = spot["doc"], low + np.arange(starts), 1
        places.append(place)
    if not values:
        return _EMPTY_CONTEXTS
    value, place = np.concatenate(values), np.concatenate(places)
    order = np.argsort(value, kind="stable")
    value, place = value[order], place[order]
    begins, _ = runs(value)
    count = np.diff(np.append(begins, len(value))).astype("<u4")
    part = part_of(value, parts)
    found = rows_by_part(batch, part[begins], {"gram": value[begins], "text": count})
    columns = {**{name: found.column(name) for name in ("batch", "part", "gram")}, "settled": pa.nulls(len(found), pa.binary())}
    return pa.table({**columns, "places": rows_by_part(batch, part, {"places": place}).column("places"), "text": found.column("text")})


def _empty(**columns: pa.DataType) -> pa.Table:
    return pa.Table.from_pylist([], pa.schema(list(columns.items())))


_EMPTY_ANCHORS = _empty(batch=pa.int64(), part=pa.int64(), gram=pa.binary(), context=pa.binary(), count=pa.binary(), places=pa.binary())
_EMPTY_CONTEXTS = _empty(batch=pa.int64(), part=pa.int64(), gram=pa.binary(), settled=pa.binary(), places=pa.binary(), text=pa.binary())
