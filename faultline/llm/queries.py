"""One query per operator, over whole tables with production parameters, and its SQL where SQL can express it."""

from __future__ import annotations

from faultline.llm import block_anchors, exact_dedup, html_text, language, line_labels, mixing, ngram_join, packing, quality, simhash, suffix_family, turns, whitening
from faultline.llm.tables import table


def op1_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op2_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op3_line_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return line_labels.judged(docs, line_labels.learned(docs, table(spark, sf_dir, "labels")))


def op4_block_anchors(spark, sf_dir):
    return block_anchors.removable(table(spark, sf_dir, "documents"))


def op5_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.fitted(docs, table(spark, sf_dir, "labels")))


def op6_mixing(spark, sf_dir):
    mix = mixing.mixed(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken")


def op7_suffix_family(spark, sf_dir):
    return suffix_family.removable(table(spark, sf_dir, "documents"))


def op8_html_text(spark, sf_dir):
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op9_packing(spark, sf_dir):
    return packing.packed(table(spark, sf_dir, "documents"))


def op10_language(spark, sf_dir):
    return language.identified(table(spark, sf_dir, "documents"))


def op11_ngram_join(spark, sf_dir):
    return ngram_join.similar_groups(table(spark, sf_dir, "documents"))


def op12_turns(spark, sf_dir):
    return turns.damaged_and_repaired(table(spark, sf_dir, "conversations"))


def op13_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_simhash, op2_exact_dedup, op3_line_labels, op4_block_anchors, op5_quality, op6_mixing, op7_suffix_family, op8_html_text, op9_packing, op10_language,
    op11_ngram_join, op12_turns, op13_whitening,
)}

ORACLES = {
    "op2_exact_dedup": r"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS code_points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS digest
  FROM documents
), ranked AS (
  SELECT *, row_number() OVER best AS place, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY digest) AS group_size
  FROM rows WINDOW best AS (PARTITION BY digest ORDER BY code_points DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, digest AS text_sha256 FROM ranked
""",
    "op4_block_anchors": r"""
WITH split AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), listed AS (
  SELECT row_id, doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM split
), windows AS (
  SELECT row_id, doc_id, i, string_agg(word, ' ') OVER ahead AS w, count(*) OVER ahead AS n
  FROM listed WINDOW ahead AS (PARTITION BY row_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)
), firsts AS (
  SELECT w, min(doc_id) AS low FROM windows WHERE n = 13 GROUP BY w
), gone AS (
  SELECT DISTINCT row_id, i + unnest(range(13)) AS i FROM windows JOIN firsts USING (w) WHERE n = 13 AND low < coalesce(doc_id, 9223372036854775807)
), kept AS (
  SELECT row_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n FROM listed ANTI JOIN gone USING (row_id, i) GROUP BY row_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, len(words)::BIGINT - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM split LEFT JOIN kept USING (row_id)
""",
    # All quotients are listed and sorted here, which only a small table allows.
    "op6_mixing": r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
), per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS docs, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM sizes GROUP BY source
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM per_source
), found AS (
  SELECT *, (SELECT arg_min(level, 3 * source_size / weight) FROM levels WHERE level < 3 * source_size / weight) AS held FROM levels
), aimed AS (
  SELECT source, source_size, docs, least(3.0::DOUBLE * source_size, coalesce((weight * held)::DOUBLE, 3.0::DOUBLE * source_size)) AS target,
    greatest(1, round(sum(source_size) OVER () / 16))::BIGINT AS seats FROM found
), source_seats AS (
  SELECT source, count(*) AS quota FROM (
    SELECT source, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source, k) AS place, seats
    FROM (SELECT source, target, seats, unnest(range(seats + 1)) AS k FROM aimed WHERE target > 0)
  ) WHERE place <= seats GROUP BY source
), sharded AS (
  SELECT doc_id, size, s.source, ('0x' || md5('42:' || coalesce(doc_id::VARCHAR, '?'))[:8])::BIGINT % ceil(docs / 4096)::BIGINT AS shard, a.source_size, target, coalesce(quota, 0) AS quota
  FROM sizes s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source LEFT JOIN source_seats q ON a.source IS NOT DISTINCT FROM q.source
), shard_sizes AS (
  SELECT source, shard, quota, sum(size)::BIGINT AS shard_size FROM sharded GROUP BY ALL
), shard_seats AS (
  SELECT source, shard, count(*) AS blocks_taken FROM (
    SELECT source, shard, row_number() OVER (PARTITION BY source ORDER BY shard_size / (2 * k + 1) DESC, shard, k) AS place, quota
    FROM (SELECT source, shard, shard_size, quota, unnest(range(quota + 1)) AS k FROM shard_sizes WHERE shard_size > 0)
  ) WHERE place <= quota GROUP BY ALL
), shards AS (
  SELECT *, if(rest > 0, least(blocks, (rest + 15) // 16 + 1), 0) AS picks,
    ('0x' || md5('42:' || coalesce(source, '?') || ':' || shard)[:8])::BIGINT % blocks AS turn
  FROM (
    SELECT *, words - turns * shard_size AS rest, greatest(1, (shard_size + 15) // 16) AS blocks FROM (
      SELECT *, if(shard_size > 0, words // shard_size, 0) AS turns FROM (
        SELECT z.source, z.shard, shard_size, least(16 * coalesce(blocks_taken, 0), 3 * shard_size) AS words
        FROM shard_sizes z LEFT JOIN shard_seats c ON z.source IS NOT DISTINCT FROM c.source AND z.shard = c.shard)))
), placed AS (
  SELECT doc_id, size, d.source_size, target, turns, rest, blocks, picks, turn,
    (sum(size) OVER (PARTITION BY d.source, d.shard ORDER BY md5('43:' || coalesce(doc_id::VARCHAR, '?')), doc_id, size ROWS UNBOUNDED PRECEDING))::BIGINT AS stop
  FROM sharded d JOIN shards s ON d.source IS NOT DISTINCT FROM s.source AND d.shard = s.shard
)
SELECT doc_id, size, source_size, target, (turns * size
  + least(rest, 16 * ((stop // 16 * picks + turn) // blocks) + stop % 16 * (((stop // 16 + 1) * picks + turn) // blocks - (stop // 16 * picks + turn) // blocks))
  - least(rest, 16 * (((stop - size) // 16 * picks + turn) // blocks)
      + (stop - size) % 16 * ((((stop - size) // 16 + 1) * picks + turn) // blocks - ((stop - size) // 16 * picks + turn) // blocks)))::BIGINT AS taken
FROM placed
""",
}
