"""Quality rules over line labels from a linear-chain conditional random field.

Each line with a word is a step of a chain with two states, content and boilerplate. A line's features (length, symbols, capitals, digits,
marks, repetition ...) speak for a state, neighbouring lines pull towards each other, and Viterbi decoding picks the likeliest
labels of the whole text. A text stays if it passes the base rules and at least ``CONTENT_SHARE`` of its words stand in content lines.

Weights are fitted by maximum likelihood (forward-backward) on at most ``SAMPLE_ROWS`` labelled texts, those with the smallest hash of their
id; no line has a label of its own, so all lines of a text take its quality label.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from math import log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faultline.llm.tables import WHITE, held_out
from faultline.session import ship_package

SAMPLE_ROWS = 4_000
CONTENT_SHARE = 0.5
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
ROUNDS = 200
RATE = 0.1
DECAY = 0.001

FEATURES = ["one", "log_words", "symbols", "capitals", "digits", "marks", "stop_at_end", "word_length", "seen_before", "repeats_last", "distinct"]
_CAPITALS, _DIGITS, _MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!?"
_SYMBOLS = SYMBOLS.encode()


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of five that are found twice or more in the text, the first included."""
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = end = 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            covered += at + WINDOW - max(end, at)
            end = at + WINDOW
    return covered


def line_features(line: bytes, words: list[bytes], seen: bool) -> list[float]:
    n, chars = len(words), len(line)
    share = lambda kind: (chars - len(line.translate(None, kind))) / chars
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    return [
        1.0, log1p(n), share(_SYMBOLS), share(_CAPITALS), share(_DIGITS), share(_MARKS), float(words[-1][-1:] in b".:;,!?"),
        chars / n / 10, float(seen), repeats / n, len(set(words)) / n,
    ]


def read_text(text: str) -> tuple[tuple[int, int, int, int, int], list[list[float]], list[int]]:
    """The base counts (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), and features and words of each line with a word."""
    words, features, sizes = [], [], []
    seen: set[bytes] = set()
    duplicates = 0
    for line in text.encode().split(b"\n"):
        own = line.split()
        if own:
            again = line in seen
            duplicates += again
            seen.add(line)
            features.append(line_features(line, own, again))
            sizes.append(len(own))
            words += own
    counts = (len(words), len(text) - sum(map(text.count, WHITE)), sum(map(text.count, SYMBOLS)), duplicates, repeated_words(words))
    return counts, features, sizes


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < MIN_WORDS or 100 * n_repeat_words > REPEAT_PERCENT * n_words


@dataclass(frozen=True)
class Chain:
    """Weights: ``emit`` for content against boilerplate by feature, ``move[from][to]``; state 1 is content."""

    emit: np.ndarray
    move: np.ndarray

    def labels(self, features: list[list[float]]) -> list[int]:
        """The likeliest states of one text's lines (Viterbi); ties go to content."""
        scores = (np.array(features) @ self.emit).tolist()
        (from0to0, from0to1), (from1to0, from1to1) = self.move.tolist()
        off, on = 0.0, scores[0]
        back: list[tuple[int, int]] = []
        for score in scores[1:]:
            to0, to1 = on + from1to0 >= off + from0to0, on + from1to1 >= off + from0to1
            back.append((int(to0), int(to1)))
            off, on = (on + from1to0 if to0 else off + from0to0), (on + from1to1 if to1 else off + from0to1) + score
        state = int(on >= off)
        found = [state]
        for step in reversed(back):
            state = step[state]
            found.append(state)
        return found[::-1]


#: Without labels of both kinds every line is content and only the base rules speak.
ALL_CONTENT = Chain(np.eye(len(FEATURES))[0], np.zeros((2, 2)))


def fit_chain(texts: list[np.ndarray], labels: list[int]) -> Chain:
    """Maximum likelihood with a small L2 penalty; ``texts`` are line-by-feature tables, all lines of a text share its label.

    Features are standardised for the ascent and the weights returned for plain ones.
    """
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    steps = len(texts[order[0]])
    every = np.concatenate(texts)
    middle, spread = every.mean(axis=0), np.maximum(every.std(axis=0), 1e-6)
    middle[0], spread[0] = 0.0, 1.0  # the constant
    data = np.zeros((steps, len(texts), len(FEATURES)))
    for row, i in enumerate(order):
        data[: len(texts[i]), row] = (texts[i] - middle) / spread
    alive = [int(sum(len(texts[i]) > t for i in order)) for t in range(steps)]  # texts are sorted, so those that last are in front
    goal = np.array([labels[i] for i in order])
    lines = sum(alive)
    emit, move = np.zeros(len(FEATURES)), np.zeros((2, 2))
    memory = [np.zeros(len(FEATURES)), np.zeros(len(FEATURES)), np.zeros((2, 2)), np.zeros((2, 2))]
    same = np.zeros((2, 2))
    for t in range(1, steps):
        same[1, 1] += goal[: alive[t]].sum()
        same[0, 0] += alive[t] - goal[: alive[t]].sum()
    observed = sum(goal[: alive[t]] @ data[t, : alive[t]] for t in range(steps))
    for round_ in range(1, ROUNDS + 1):
        score = data @ emit
        forward = [np.stack([np.zeros(alive[0]), score[0, : alive[0]]], axis=1)]
        for t in range(1, steps):
            last = forward[-1][: alive[t]]
            into = np.logaddexp(last[:, 0:1] + move[0], last[:, 1:2] + move[1])
            into[:, 1] += score[t, : alive[t]]
            forward.append(into)
        behind = np.zeros((alive[-1], 2))
        expected, moved = np.zeros(len(FEATURES)), np.zeros((2, 2))
        for t in range(steps - 1, -1, -1):
            if t < steps - 1:
                ahead = behind + np.stack([np.zeros(alive[t + 1]), score[t + 1, : alive[t + 1]]], axis=1)
                joint = forward[t][: alive[t + 1], :, None] + move + ahead[:, None, :]
                total = np.logaddexp.reduce(joint.reshape(len(joint), 4), axis=1)
                moved += np.exp(joint - total[:, None, None]).sum(axis=0)
                behind = np.zeros((alive[t], 2))
                behind[: alive[t + 1]] = np.logaddexp(move[:, 0] + ahead[:, 0:1], move[:, 1] + ahead[:, 1:2])
            both = forward[t] + behind
            expected += np.exp(both[:, 1] - np.logaddexp(both[:, 0], both[:, 1])) @ data[t, : alive[t]]
        for weight, gradient, first, second in ((emit, observed - expected, *memory[:2]), (move, same - moved, *memory[2:])):
            slope = gradient / lines - DECAY * weight
            first += 0.1 * (slope - first)
            second += 0.001 * (slope * slope - second)
            weight += RATE * (first / (1 - 0.9**round_)) / (np.sqrt(second / (1 - 0.999**round_)) + 1e-8)
    emit = emit / spread
    emit[0] -= emit @ middle
    return Chain(emit, move)


def learned(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Chain:
    """A chain fitted on a bounded sample of labelled texts that are not held out."""
    ship_package(docs.sparkSession)
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    rows = rows.join(F.broadcast(known), F.col("doc_id") == F.col("id")).select("id", "label", "text")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tables = [[x for line in read_text(text.as_py())[1] for x in line] for text in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("id").cast(pa.int64()), batch.column("label"), pa.array(tables, pa.list_(pa.float64()))], ["id", "label", "lines"])

    found = rows.mapInArrow(read, "id bigint, label int, lines array<double>").filter(F.size("lines") > 0)
    found = found.orderBy(F.xxhash64("id"), "id").limit(sample_rows).collect()
    targets = [r.label for r in found]
    if len(set(targets)) < 2:
        return ALL_CONTENT
    return fit_chain([np.array(r.lines).reshape(-1, len(FEATURES)) for r in found], targets)


def judged(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, content_words.

    A null, empty or wordless text has zeros and fails the base rules. Repeated rows stay repeated; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                counts, features, sizes = read_text(text.as_py() or "")
                content = sum(size for size, label in zip(sizes, chain.labels(features)) if label) if sizes else 0
                failed = base_failed(counts[0], counts[4])
                rows.append((*counts, failed, not failed and content >= CONTENT_SHARE * counts[0], content))
            columns = list(zip(*rows)) or [()] * 8
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.int64()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], ["doc_id", *names, "base_failed", "kept", "content_words"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(judge, "doc_id bigint, " + ", ".join(f"{n} bigint" for n in names) + ", base_failed boolean, kept boolean, content_words bigint")
