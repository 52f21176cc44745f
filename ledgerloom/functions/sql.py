"""SQL functions for the key expressions; Catalyst inlines them."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .exprs import WEIGHTS_FIRST, WEIGHTS_SECOND


def _digit(text: str, weights: tuple[int, ...]) -> str:
    """SQL of the check digit of a text."""
    total = " + ".join(f"(ascii(substring({text}, {i + 1}, 1)) - 48) * {w}" for i, w in enumerate(weights))
    return f"CAST((11 - ({total}) % 11) % 11 % 10 AS STRING)"


_PLAIN = "upper(regexp_replace(c, '[./-]', ''))"
_BODIES = {
    "clean_key(c STRING)": ("STRING", "regexp_replace(coalesce(c, ''), '[^0-9A-Za-z]', '')"),
    "normalize_key(c STRING)": ("STRING", f"CASE WHEN trim(coalesce(c, '')) = '' THEN '' ELSE {_PLAIN} END"),
    "has_key_format(c STRING)": (
        "BOOLEAN",
        rf"coalesce(NOT rlike(c, '[^A-Za-z0-9./-]') AND rlike({_PLAIN}, '^[A-Z0-9]{{12}}[0-9]{{2}}\\z') AND NOT rlike({_PLAIN}, '^(.)\\1{{13}}\\z'), false)",
    ),
    "first_key_digit(c STRING)": ("STRING", _digit("c", WEIGHTS_FIRST)),
    "second_key_digit(c STRING)": ("STRING", _digit("c", WEIGHTS_SECOND)),
    "is_valid_key(c STRING)": (
        "BOOLEAN",
        f"has_key_format(c) AND first_key_digit(substring({_PLAIN}, 1, 12)) = substring({_PLAIN}, 13, 1) AND second_key_digit(substring({_PLAIN}, 1, 13)) = substring({_PLAIN}, 14, 1)",
    ),
    "mask_key(c STRING)": (
        "STRING",
        "CASE WHEN length(regexp_replace(c, '[./-]', '')) = 14 THEN regexp_replace(upper(regexp_replace(c, '[./-]', '')), '^(.{2})(.{3})(.{3})(.{4})(.{2})$', '$1.$2.$3/$4-$5') ELSE c END",
    ),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create clean_key, normalize_key, mask_key, has_key_format and is_valid_key (check digits, as in Python), and what they call;
    returns their names."""
    for head, (kind, body) in _BODIES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
    return [head.partition("(")[0] for head in _BODIES]
