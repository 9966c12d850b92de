"""The thin opN queries over the given tables, and the SQL each must agree with where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from questmart.llm import bpe
from questmart.llm.chat import format_conversations, summarise
from questmart.llm.exact_dedup import exact_dedup
from questmart.llm.infill import fill_in_middle, restored
from questmart.llm.line_dedup import dedup_lines
from questmart.llm.mixing import mix_plan
from questmart.llm.quality import quality_verdicts
from questmart.llm.sentencepiece import digest_documents
from questmart.llm.sharding import ShardTree, shard_rows
from questmart.llm.simhash import near_duplicates
from questmart.llm.spelling import spelling_variants
from questmart.llm.substrings import dedup_substrings
from questmart.llm.warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model() -> str:
    """Where the public tokenizer files are installed, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def byte_ranks() -> tuple[str, str]:
    """The rank file, installed at the same place on every machine, and the pattern that splits text for it."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest_documents(_table(spark, sf_dir, "documents"), piece_model())


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_verdicts(_table(spark, sf_dir, "documents"), trusted)


@query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "source", "size", "source_size", "target", "taken")


SQL["op4_mix_sources"] = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix') AS shuffle
  FROM documents
),
sums AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rnk FROM sums),
weighed AS (
  SELECT *, CAST(CASE (rnk - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS BIGINT) AS weight, source_size * 3 AS cap FROM ranked
),
levels AS (
  SELECT *, cap / weight AS dry_at,
         ((SELECT sum(source_size) FROM weighed) - coalesce(sum(cap) OVER earlier, 0))
           / ((SELECT sum(weight) FROM weighed) - coalesce(sum(weight) OVER earlier, 0)) AS lvl
  FROM weighed WINDOW earlier AS (ORDER BY cap / weight, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
fill AS (SELECT lvl FROM levels WHERE lvl <= dry_at ORDER BY dry_at, rnk LIMIT 1),
queued AS (
  SELECT s.*, w.rnk, w.weight, w.source_size, least(w.weight * (SELECT lvl FROM fill), CAST(w.cap AS DOUBLE)) AS target,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.shuffle, s.doc_id) AS upto
  FROM sized s JOIN weighed w ON s.source IS NOT DISTINCT FROM w.source
),
copies AS (SELECT q.*, c, (source_size * c + upto) / weight AS finish FROM queued q, range(0, 3) AS r(c)),
placed AS (SELECT *, sum(size) OVER (ORDER BY finish, rnk, c, shuffle, doc_id ROWS UNBOUNDED PRECEDING) AS words FROM copies)
SELECT doc_id, source, size, source_size, target,
       CAST(sum(CASE WHEN words <= (SELECT sum(source_size) FROM sums) THEN size ELSE 0 END) AS BIGINT) AS taken
FROM placed GROUP BY doc_id, source, size, source_size, target
"""


@query
def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "pages")).drop("payload")


SQL["op5_warc_round_trip"] = r"""
WITH digests AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
),
owned AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS owner FROM digests)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> owner THEN owner END AS refers_to
FROM owned
"""


@query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    added = spark.sql(f"SELECT -1L AS conv_id, turn, role, '{text}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    return summarise(format_conversations(given.unionByName(added)))


SQL["op6_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(9 + sum(17 + length(replace(replace(role, '&', '&amp;'), '<', '&lt;'))
                    + length(replace(replace(text, '&', '&amp;'), '<', '&lt;'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""


@query
def op7_dedup_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(_table(spark, sf_dir, "documents")).drop("removed")


SQL["op7_dedup_substrings"] = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (
  SELECT doc_id, p, array_to_string(words[p : p + 19], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS p FROM texts WHERE len(words) >= 20)
),
repeats AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, p + i AS p FROM repeats, range(0, 20) AS r(i)),
numbered AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM texts),
kept AS (
  SELECT n.doc_id, string_agg(word, ' ' ORDER BY n.p) AS kept, count(*) AS n_kept
  FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.p = g.p WHERE g.p IS NULL GROUP BY n.doc_id
)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""


@query
def op8_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = ShardTree.regular(regions=2, racks=5, shards=4)
    rows = shard_rows(_table(spark, sf_dir, "documents"), tree, tree.grown())
    return rows.withColumn("law", F.lit("key"))


@query
def op9_dedup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup_lines(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL["op9_dedup_lines"] = r"""
WITH lines AS (
  SELECT doc_id, n, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents)
),
owners AS (SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key),
marked AS (SELECT l.*, coalesce(o.owner <> l.doc_id, false) AS dropped FROM lines l LEFT JOIN owners o ON l.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


SQL["op10_exact_dedup"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS plain FROM documents
),
ranked AS (
  SELECT doc_id, plain, first_value(doc_id) OVER (PARTITION BY plain ORDER BY length(text) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY plain) AS group_size
  FROM texts
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(plain) AS text_sha256 FROM ranked
"""


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(_table(spark, sf_dir, "documents"), *byte_ranks())


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_in_middle(_table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n",
        "form",
        F.col("prefix_units").alias("prefix_chars"),
        F.col("middle_units").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )


SQL["op12_fill_in_middle"] = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
),
drawn AS (
  SELECT *, CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM texts
),
cut AS (
  SELECT *, least(a, b) AS p, greatest(a, b) AS q,
         CASE WHEN least(a, b) > 0 THEN left(text, least(a, b)) ELSE '' END AS prefix,
         substring(text, least(a, b) + 1, greatest(a, b) - least(a, b)) AS middle,
         substring(text, greatest(a, b) + 1) AS suffix
  FROM drawn
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))
