"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram's vector binds its letters' vectors, each rotated by its place, by multiplication; a
text's vector bundles its trigrams by addition; a language's prototype bundles the unit vectors of its sample texts. The
prototype with the largest cosine names the language.

Prototypes are learned from about ``PER_LANGUAGE`` texts of each language, picked by a hash of the id; prediction reads every whole text.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from faultline.llm.tables import held_out
from faultline.session import ship_package, stored

DIMENSIONS = 1024
PER_LANGUAGE = 1000
SEED = 42
UNDETERMINED = "und"
CHARS_AT_ONCE = 1 << 20
TEXTS_AT_ONCE = 128
UNIT = 1_000_000
#: Up to so many languages their counts are broadcast; beyond, rows meet them by a shuffle.
BROADCAST_LANGUAGES = 10_000


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), dtype=bool, count=sys.maxunicode + 1)


@lru_cache(maxsize=1 << 14)
def letter_vector(code: int) -> np.ndarray:
    return (2 * np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS) - 1).astype(np.int8)


def trigram_vectors(keys: np.ndarray) -> np.ndarray:
    """A row per trigram key (three code points of 21 bits)."""
    codes = np.stack([keys >> 42, keys >> 21 & (1 << 21) - 1, keys & (1 << 21) - 1])
    letters, places = np.unique(codes, return_inverse=True)
    places = places.reshape(codes.shape)
    table = np.stack([letter_vector(int(c)) for c in letters])
    return np.roll(table, 2, axis=1)[places[0]] * np.roll(table, 1, axis=1)[places[1]] * table[places[2]]


def trigrams(text: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct trigram keys and their counts, by pieces of a long text. Letters are lowered, all else between them is one space."""
    last = np.array([32], dtype=np.int64)
    for at in range(0, len(text), CHARS_AT_ONCE):
        codes = np.frombuffer(text[at : at + CHARS_AT_ONCE].lower().encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        codes = np.concatenate([last, np.where(_letters()[codes], codes, 32)])
        fresh = np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])
        fresh[: len(last)] = True
        codes = codes[fresh]
        last = codes[-2:]
        if len(codes) > 2:
            yield np.unique(codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:], return_counts=True)


def text_vectors(texts: list[str]) -> np.ndarray:
    """A row per text; zero for a text without a letter. A space is put after every text, so that one letter is a trigram."""
    found = [(row, *part) for row, text in enumerate(texts) for part in trigrams(text + " ")]
    out = np.zeros((len(texts), DIMENSIONS), dtype=np.float32)
    if found:
        keys = np.unique(np.concatenate([keys for _, keys, _ in found]))
        table = trigram_vectors(keys).astype(np.float32)
        for row, own, counts in found:
            out[row] += counts.astype(np.float32) @ table[np.searchsorted(keys, own)]
    return out


def _with_letters(texts: list[str | None]) -> list[str]:
    return [text if text and any(map(str.isalpha, text)) else "" for text in texts]


def prototypes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """lang and its prototype (an array of longs), learned from rows that are not held out and have a language."""
    ship_package(docs.sparkSession)
    readable = ~held_out(F.col(id_col)) & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull()
    known = docs.filter(readable).select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sizes = stored(known.groupBy("lang").agg(F.count("*").alias("n")).withColumnRenamed("lang", "of"))
    sizes = F.broadcast(sizes) if sizes.count() <= BROADCAST_LANGUAGES else sizes
    place = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    # The sample is picked on ids and languages alone; texts meet only its ids, which Spark broadcasts while they are few.
    picked = known.select("doc_id", "lang").join(sizes, F.col("lang") == F.col("of")).filter(place * F.col("n") < per_language)
    sample = known.join(stored(picked.select("doc_id", "lang").distinct()), ["doc_id", "lang"]).select("lang", "text")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                vectors = text_vectors(_with_letters(batch.column("text").slice(at, TEXTS_AT_ONCE).to_pylist()))
                lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
                units = np.rint(UNIT * vectors / np.maximum(lengths, 1e-9)).astype(np.int64)
                for lang, unit in zip(langs[at : at + TEXTS_AT_ONCE], units):
                    sums[lang] = sums.get(lang, 0) + unit
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], ["lang", "bundle"])

    parts = sample.mapInArrow(bundle, "lang string, bundle array<bigint>").select("lang", F.posexplode("bundle").alias("place", "value"))
    summed = parts.groupBy("lang", "place").agg(F.sum("value").alias("value"))
    return summed.groupBy("lang").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "value"))), lambda x: x["value"]).alias("prototype"))


def identified(docs: DataFrame, learn_from: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (the cosine, 0 at least).

    A null text, one without a letter, and any text when no language was learned, are ``und`` with score 0. Ties go to the first language
    by name; repeated rows are repeated, and no column but id and text is read for a prediction.
    """
    found = prototypes(docs if learn_from is None else learn_from, id_col, text_col, lang_col, per_language).collect()
    learned = sorted((r.lang, r.prototype) for r in found if any(r.prototype))
    names = [lang for lang, _ in learned]
    table = np.array([p for _, p in learned], dtype=np.float64).reshape(len(names), DIMENSIONS)
    table = (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs: list[str] = []
            scores: list[float] = []
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                texts = _with_letters(batch.column("text").slice(at, TEXTS_AT_ONCE).to_pylist())
                if not names:
                    langs += [UNDETERMINED] * len(texts)
                    scores += [0.0] * len(texts)
                    continue
                vectors = text_vectors(texts)
                cosines = vectors @ table.T / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
                best = cosines.argmax(axis=1)
                langs += [names[b] if text else UNDETERMINED for b, text in zip(best, texts)]
                scores += [min(1.0, max(0.0, float(c[b]))) if text else 0.0 for c, b, text in zip(cosines, best, texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(predict, "doc_id bigint, held_out boolean, lang_pred string, score double")
