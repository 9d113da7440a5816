"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filingweave.llm.alignment import alignments
from filingweave.llm.common import ready
from filingweave.llm.decontamination import contamination
from filingweave.llm.language_model import lm_scores
from filingweave.llm.line_dedup import drop_repeated_lines
from filingweave.llm.packing import pack
from filingweave.llm.passages import shared_passages
from filingweave.llm.sharding import shard_by_bytes
from filingweave.llm.simhash import near_duplicates
from filingweave.llm.token_counts import token_counts
from filingweave.llm.topk import top_products
from filingweave.llm.toxicity import toxicity
from filingweave.llm.url_filter import url_verdicts
from filingweave.llm.variants import spelling_variants

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(ready(spark), folder)

        QUERIES[fn.__name__] = run
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return lm_scores(table(spark, folder, "documents"))


@query()
def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query()
def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_verdicts(table(spark, folder, "pages"))


#: DuckDB's list functions give the same integer products.
_TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query(_TOP_SQL)
def op4_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_products(table(spark, folder, "embeddings"))


@query()
def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query()
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = pack(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"), with_ids=False)
    return packed.drop("ids")


@query()
def op7_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shard_by_bytes(table(spark, folder, "documents"), shards=40)


@query()
def op8_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return shared_passages(table(spark, folder, "documents"))


@query()
def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


#: Every window of every item against every place of every document.
_CONTAMINATION_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM (SELECT *, least(13, len(w)) AS n FROM b WHERE len(w) > 0))
), places AS (
  SELECT r, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d JOIN (SELECT DISTINCT n FROM windows) ON len(w) >= n)
), found AS (
  SELECT r, i, n, item_id FROM places JOIN windows USING (n, g)
), hit AS (
  SELECT r, count(DISTINCT spot) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS spot FROM found) GROUP BY r
), named AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
    array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS names
  FROM found WHERE item_id IS NOT NULL GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""


@query(_CONTAMINATION_SQL)
def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query()
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return alignments(table(spark, folder, "documents"), *files, with_groups=False).drop("groups")


@query()
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants(table(spark, folder, "documents"))


_LINE_SQL = """
WITH cut AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS a FROM documents
), lines AS (
  SELECT doc_id, r, unnest(a) AS line, unnest(range(len(a))) AS pos FROM cut
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), often AS (
  SELECT k, max(doc_id) AS holder FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT keyed.*, often.k IS NOT NULL AND doc_id IS DISTINCT FROM holder AS gone
  FROM keyed LEFT JOIN often ON keyed.k = often.k
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""


@query(_LINE_SQL)
def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
