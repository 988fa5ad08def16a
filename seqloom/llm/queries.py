"""The registered queries of this subpackage, each over its whole table, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify

    return identify(_table(spark, sf_dir, "documents"))


@_query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import report

    return report(_table(spark, sf_dir, "documents"))


@_query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import assess

    # which rule rejects first depends on the plan's order: the verdicts alone are compared
    return assess(_table(spark, sf_dir, "documents")).drop("rejected_by", "n_rules_run")


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLES["op6_quality_rules"] = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
g AS (SELECT doc_id, i, x || ' ' || lead(x) OVER o || ' ' || lead(x, 2) OVER o AS g FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM g WHERE g IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS dup FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^ 	-]') GROUP BY doc_id),
m AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(lines.dup, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, greatest(coalesce(lines.n, 0), 1) AS n_lines,
    length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS upper, len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS alpha
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 100 * n_symbols <= 25 * n_words AND 100 * n_dup_lines <= 50 * n_lines AND 100 * upper <= 60 * word_chars AND 100 * alpha >= 60 * n_words AS kept
FROM b"""


@_query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "passes", "draws")


@_query
def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import search

    vectors = _table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 100 = 0"), k=10)


ORACLES["op3_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@_query
def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import similar

    return similar(_table(spark, sf_dir, "documents"), words=3, percent=90)


ORACLES["op4_ngram_join"] = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i+2], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT w.doc_id, count(s.g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 190 * c >= 90 * (p.n + q.n)),
r AS (SELECT doc_id, doc_id AS root FROM n UNION SELECT l.x, r.root FROM l JOIN r ON l.y = r.doc_id)
SELECT doc_id, n AS n_shingles, min(root) AS component_id FROM r JOIN n USING (doc_id) GROUP BY 1, 2"""


@_query
def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_extract import extract

    return extract(_table(spark, sf_dir, "pages"))


@_query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import report

    return report(_table(spark, sf_dir, "documents"))


@_query
def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_score import score

    return score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id"))
