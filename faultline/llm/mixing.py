"""Mixing sources to target weights by Sainte-Lague apportionment, in DataFrame operations only.

Targets: every source has a weight and shares all words by it; a target stops at ``MAX_REPEAT`` times its source's
size and the excess is shared again. Equal-token blocks are then dealt to the sources by highest quotients
target / (2 k + 1), and each source's blocks to its shards by highest quotients of the shards' sizes. Within a shard the
documents lie end to end in a seeded order, cut in blocks of that length. A quota first takes the whole shard as often as it
fits, then blocks at equal distances from a seeded start. What a document gives is thus a closed form of its place.

Highest quotients need no list of all quotients: dealing by a divisor that is a little too large leaves at most
as many blocks as there are claimants, and only the next few quotients of each compete for those.

A shard holds about ``SHARD_DOCS`` documents, so a source with a third of all rows is many shards.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window as W, functions as F

from faultline.llm.tables import WORD, fresh_name, n_words, numbered
from faultline.session import stored

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK_WORDS = 16
SHARD_DOCS = 4096
SEED = 42


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Per source (null is one): source_size, docs, weight, target, total.

    Sources in code-point order, null last, take the weights in turn. With ratios size / weight in rising order, the first
    k sources are held at their limit and the others share what is left by weight; k is the first for which that
    leaves the next source under its limit. There is one row per source, in one ordered window.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))
    place = F.row_number().over(W.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    limit = F.lit(MAX_REPEAT) * F.col("source_size")
    ratio = limit / F.col("weight")
    rising = W.orderBy(ratio, F.col("source").isNull(), "source")
    before, onward = rising.rowsBetween(W.unboundedPreceding, -1), rising.rowsBetween(0, W.unboundedFollowing)
    level = (F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum(limit).over(before), F.lit(0))) / F.sum("weight").over(onward)
    return (
        per_source.withColumn("weight", weight)
        .withColumn("level", level)
        .withColumn("free", F.col("level") < ratio)
        .withColumn("level", F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(rising.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
        .withColumn("total", F.sum("source_size").over(W.partitionBy()))
        .withColumn("target", F.least(limit.cast("double"), F.coalesce(F.col("weight") * F.col("level"), limit.cast("double"))))
        .drop("level", "free")
    )


def sainte_lague(claims: DataFrame, group: list[str], order: list[str], votes: str, seats: str, out: str) -> DataFrame:
    """``claims`` with the seats that each row of a group gets by highest quotients votes / (2 k + 1).

    ``seats`` (one value per group) are dealt; ties go by ``order``. A divisor that deals too few is taken first, then each row's
    next quotients compete for the rest, about three candidates per row.
    """
    whole = W.partitionBy(*group)
    total, rows = F.sum(votes).over(whole), F.count("*").over(whole)
    share = F.when(F.col("__total") > 0, F.col(votes) / F.col("__total")).otherwise(F.lit(0.0))
    sure = F.greatest(F.lit(0), F.floor(share * (F.col(seats) - F.col("__rows") / 2) + 0.5)).cast("long")
    dealt = (
        claims.withColumn("__total", total).withColumn("__rows", rows).withColumn("__share", share).withColumn("__sure", sure)
        .withColumn("__rest", F.col(seats) - F.sum("__sure").over(whole))
    )
    tries = F.when((F.col("__rest") > 0) & (F.col(votes) > 0), F.ceil(F.col("__share") * F.col("__rows")).cast("int") + 1).otherwise(0)
    tried = dealt.select("*", F.explode(F.sequence(F.lit(0), tries)).alias("__try"))
    quotient = F.col(votes) / (2 * (F.col("__sure") + F.col("__try") - 1) + 1)
    candidate = tried.withColumn("__q", F.when(F.col("__try") > 0, quotient))
    best_first = whole.orderBy(F.col("__q").desc_nulls_last(), *order, "__try")
    won = candidate.withColumn("__won", (F.col("__q").isNotNull() & (F.row_number().over(best_first) <= F.col("__rest"))).cast("long"))
    return won.groupBy(*claims.columns).agg((F.max("__sure") + F.sum("__won")).alias(out))


def seeded(seed: int, *parts: str) -> str:
    """SQL for a hexadecimal hash of the seed and some columns."""
    return f"md5(concat_ws(':', '{seed}', " + ", ".join(f"coalesce(cast({p} as string), '?')" for p in parts) + "))"


def number(digest: str) -> str:
    """SQL for the first 32 bits of a hexadecimal hash."""
    return f"cast(conv(substring({digest}, 1, 8), 16, 10) as bigint)"


def picked_before(position: str) -> str:
    """SQL for the words picked, beyond whole turns, from the first ``position`` words of a shard."""
    block = f"(({position}) div block)"
    count = lambda k: f"((({k}) * picks + turn) div blocks)"
    return f"least(rest, block * {count(block)} + (({position}) - {block} * block) * ({count(block + ' + 1')} - {count(block)}))"


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", carry: tuple[str, ...] = (),
          weights: tuple[int, ...] = WEIGHTS, block_words: int = BLOCK_WORDS, shard_docs: int = SHARD_DOCS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, the ``carry`` columns, and how its shard is picked.

    ``taken`` counts words with repeats. ``start`` is the document's place among its shard's words; the shard is taken ``turns`` times
    whole, then ``rest`` words of it in ``picks`` of its ``blocks``, from the seeded ``turn``. A null text has no words and a null source
    is a source of its own, last in order. Repeated rows and ids are documents of their own; no rows give no rows. Reruns agree: a
    shard is ordered by a seeded hash of the id, then by size, and rows that tie in both are interchangeable here.
    """
    columns = [F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(F.col(text_col)).alias("size")]
    sizes = stored(docs.select(*columns, *[F.col(c).alias(f"carry_{c}") for c in carry]))
    per_source = targets(sizes, weights)
    seats = F.when(F.col("total") > 0, F.greatest(F.lit(1), F.round(F.col("total") / block_words))).otherwise(0).cast("long")
    quotas = sainte_lague(per_source.withColumn("all_blocks", seats), [], ["source"], "target", "all_blocks", "source_quota")
    quotas = quotas.withColumn("shards", F.ceil(F.col("docs") / shard_docs)).withColumn("block", F.lit(block_words).cast("long"))
    quotas = quotas.select(F.col("source").alias("of"), "source_size", "target", "source_quota", "shards", "block")
    rows = sizes.join(stored(quotas), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows = rows.withColumn("shard", F.expr(f"{number(seeded(seed, 'doc_id'))} % shards"))

    per_shard = rows.groupBy("source", "source_quota", "shard", "block").agg(F.sum("size").alias("shard_size"))
    per_shard = sainte_lague(per_shard, ["source"], ["shard"], "shard_size", "source_quota", "quota")
    per_shard = (
        per_shard.withColumn("words", F.expr(f"least(quota * block, {MAX_REPEAT} * shard_size)"))
        .withColumn("turns", F.expr("if(shard_size > 0, words div shard_size, 0)"))
        .withColumn("rest", F.expr("words - turns * shard_size"))
        .withColumn("blocks", F.expr("greatest(1, (shard_size + block - 1) div block)"))
        .withColumn("picks", F.expr("if(rest > 0, least(blocks, (rest + block - 1) div block + 1), 0)"))
        .withColumn("turn", F.expr(f"{number(seeded(seed, 'source', 'shard'))} % blocks"))
        .select(F.col("source").alias("of"), F.col("shard").alias("of_shard"), "turns", "rest", "blocks", "picks", "turn")
    )
    order = W.partitionBy("source", "shard").orderBy(F.expr(seeded(seed + 1, "doc_id")), "doc_id", "size")
    placed = rows.withColumn("start", F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("size"))
    placed = placed.join(per_shard, F.col("source").eqNullSafe(F.col("of")) & (F.col("shard") == F.col("of_shard"))).drop("of", "of_shard")
    taken = F.expr(f"turns * size + {picked_before('start + size')} - {picked_before('start')}")
    kept = ["doc_id", "size", "source_size", "target", "taken", "source", "shard", "start", "block", "turns", "rest", "blocks", "picks", "turn"]
    return placed.withColumn("taken", taken).select(*kept, *[F.col(f"carry_{c}").alias(c) for c in carry])


def mixed_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents as the mix takes them, one row each, all columns: the text as often as it is taken whole, then its picked blocks.

    Copies are parted by a line feed; white space inside a block stays. Documents that the mix leaves out have no row.
    """
    row, mix, listed = (fresh_name(docs, n) for n in ("row", "mix", "words"))
    rows = numbered(docs, row)
    found = mixed(rows, id_col, text_col, source_col, carry=(row,), **options).filter("taken > 0")
    found = found.select(row, F.struct("size", "taken", "start", "block", "turns", "rest", "blocks", "picks", "turn").alias(mix))
    found = stored(found)
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    joined = rows.join(found, row).withColumn(listed, F.when(F.expr(f"{mix}.taken != {mix}.turns * {mix}.size"), words))
    named = lambda sql: re.sub(r"\b(start|size|block|rest|blocks|picks|turn)\b", rf"{mix}.\1", sql)
    low = "greatest(start, k * block)"
    length = f"{picked_before('least(start + size, (k + 1) * block)')} - {picked_before(low)}"
    pieces = named(f"transform(sequence(start div block, (start + size - 1) div block), k -> slice({listed}, cast({low} - start + 1 as int), cast({length} as int)))")
    extra = F.when(F.col(listed).isNotNull(), F.regexp_replace(F.array_join(F.flatten(F.expr(pieces)), ""), r"^[\x20\x09-\x0D]+", ""))
    text = F.concat_ws("\n", F.array_repeat(F.col(text_col), F.col(f"{mix}.turns").cast("int")), extra)
    return joined.withColumn(text_col, text).select(*[f"`{c}`" for c in docs.columns])
