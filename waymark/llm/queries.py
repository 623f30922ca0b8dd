"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from waymark.llm import (
    conversation_repair,
    decision_list,
    decontaminate,
    html_template,
    language_id,
    lexical_search,
    mixing,
    packing,
    ppm,
    sharding,
    suffix_dedup,
    superminhash,
    token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_documents(_table(spark, sf_dir, "documents"))


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_template.extract_pages(_table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_list.judge_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.predict_documents(_table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.group_documents(_table(spark, sf_dir, "documents"))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_documents(_table(spark, sf_dir, "documents"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_documents(_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(_table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(_table(spark, sf_dir, "conversations"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def queries() -> dict[str, Query]:
    return {
        name: q
        for name, q in globals().items()
        if name.startswith("op") and name[2].isdigit()
    }


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


SQL: dict[str, str] = {}

SQL["op9_mixing"] = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, ''))) AS own_key
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS source_rank FROM totals
), weighed AS (
  SELECT *, (1 + (source_rank - 1) % 3)::DOUBLE AS weight FROM ranked
), levels AS (
  SELECT *,
    (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (
        ORDER BY source_size / weight, source_rank
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY source_size / weight, source_rank
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed
), targets AS (
  SELECT source, source_size,
         least((3 * source_size)::DOUBLE, max(level) OVER () * weight) AS target
  FROM levels
), keyed AS (
  SELECT s.*, t.source_size, t.target,
         sum(size) OVER (PARTITION BY s.source
           ORDER BY md5('mix:' || own_key), size
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), cut AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
  FROM keyed
), dealt AS (
  SELECT *, least(3, epochs + CASE WHEN size > 0
      AND upto - size / 2.0::DOUBLE < target - epochs * source_size THEN 1 ELSE 0 END)::INT AS copies
  FROM cut
)
SELECT doc_id, source, size, source_size, target, copies, (size * copies)::BIGINT AS taken
FROM dealt
"""

SQL["op10_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n,
         array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win
  FROM b, LATERAL (SELECT unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i) r
  WHERE len(w) > 0
), sizes AS (SELECT DISTINCT n FROM item_windows
), doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM d, sizes, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS i) r
), hits AS (
  SELECT dw.doc_id, dw.i, dw.n, iw.item_id
  FROM doc_windows dw JOIN item_windows iw ON dw.n = iw.n AND dw.win = iw.win
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hits))
  GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM hits GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

SQL["op6_near_duplicates"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS s
  FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 4, 0) + 2)) AS i) r
  WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS inter
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * inter >= 80 * (x.n + y.n - inter)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), reached AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id,
       doc_id = component_id AS kept
FROM reached LEFT JOIN sizes USING (doc_id)
"""

SQL["op2_html_extraction"] = r"""
WITH marked AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(
    regexp_extract(html, '(?s)<article[^>]*>(.*)</article>', 1),
    '(?s)<!--.*?-->', '', 'g'), '</?(p|h1|br)[^>]*>', chr(1), 'g'), '<[^>]+>', '', 'g') AS t
  FROM pages
), plain AS (
  SELECT page_id, url, replace(replace(replace(replace(replace(replace(replace(replace(t,
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&#x27;', ''''),
    '&nbsp;', ' '), '&copy;', chr(169)), '&amp;', '&') AS t
  FROM marked
), joined AS (
  SELECT page_id, url, coalesce(array_to_string(list_filter(list_transform(
    string_split(t, chr(1)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))),
    lambda x: x <> ''), ' '), '') AS text
  FROM plain
)
SELECT page_id, url, text, length(text)::BIGINT AS n_chars FROM joined
"""

SQL["op5_sharding"] = r"""
WITH crc AS (
  SELECT list(list_reduce(list_concat([i], range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)
), sized AS (
  SELECT doc_id, octet_length(encode(coalesce(text, '')))::BIGINT + 1 AS size,
    xor(list_reduce(list_concat([4294967295], list_transform(
      regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT)),
      lambda c, b: xor(c >> 8, crc.t[xor(c & 255, b) + 1])), 4294967295)::BIGINT AS text_crc32
  FROM documents, crc
), summed AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32 ROWS UNBOUNDED PRECEDING) AS upto,
    sum(size) OVER () AS total
  FROM sized
), dealt AS (
  SELECT *, least(7, ((2 * upto - size) * 8) // (2 * total))::INT AS shard FROM summed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY upto) - 1 AS slot, NULL::INT AS grown_shard
FROM dealt
"""

SQL["op13_lexical_search"] = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), b AS (
  SELECT item_id, unnest(list_distinct(regexp_extract_all(translate(text,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term FROM benchmark
), tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM d GROUP BY ALL
), sizes AS (SELECT doc_id, count(*)::BIGINT AS n FROM d GROUP BY doc_id
), totals AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS len FROM sizes
), m AS (SELECT doc_id, 50 + (50 * n * n_docs) // len AS m FROM sizes, totals
), w AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, totals GROUP BY term, n_docs
), scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM b JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""
