"""The functions under names that SQL can call."""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import stats

#: SQL functions, as SQL: they stay inside the optimizer.
MACROS = {
    "phred": ("p DOUBLE", "DOUBLE", "-10 * log10(greatest(p, 1e-307D))"),
    "error_prob": ("q DOUBLE", "DOUBLE", "power(10D, -q / 10)"),
    "log_sum": ("a DOUBLE, b DOUBLE", "DOUBLE", "greatest(a, b) + log1p(exp(-abs(a - b)))"),
    "safe_frac": ("a DOUBLE, b DOUBLE", "DOUBLE", "coalesce(try_divide(a, b), 0D)"),
    "revcomp": ("s STRING", "STRING", "reverse(translate(s, 'ACGTUacgtu', 'TGCAAtgcaa'))"),
    "genotype_index": ("i INT, j INT", "INT", "cast(greatest(i, j) * (greatest(i, j) + 1) / 2 as int) + least(i, j)"),
    "pair_name": ("s STRING", "STRING", "regexp_replace(s, '/[0-9]$', '')"),
    "best_alt": (
        "ref STRING, a BIGINT, c BIGINT, t BIGINT, g BIGINT",
        "STRING",
        "CASE ref WHEN 'A' THEN CASE WHEN t > greatest(c, g) THEN 'T' WHEN c > g THEN 'C' ELSE 'G' END WHEN 'C' THEN CASE WHEN t > greatest(a, g) THEN 'T' WHEN a > g THEN 'A' ELSE 'G' END "
        "WHEN 'T' THEN CASE WHEN g > greatest(a, c) THEN 'G' WHEN a > c THEN 'A' ELSE 'C' END WHEN 'G' THEN CASE WHEN t > greatest(a, c) THEN 'T' WHEN a > c THEN 'A' ELSE 'C' END END",
    ),
}


def register(spark: SparkSession) -> list[str]:
    """Make the functions known to the session; returns their names."""
    for name, (args, kind, body) in MACROS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {kind} RETURN {body}")
    for name, f, kind in (("binom_upper", stats.binom_upper, "double"), ("fisher_exact", stats.fisher, "double"), ("continuous_quality", stats.continuous_quality, "int"), ("continuous_strand_bias", stats.continuous_strand_bias, "double")):
        spark.udf.register(name, f, kind)
    return [*MACROS, "binom_upper", "fisher_exact", "continuous_quality", "continuous_strand_bias"]
