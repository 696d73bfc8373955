"""The text functions by name for SQL: tw_collapse_ws, tw_clean_html, tw_chunk_payload, tw_clean_name."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidewire import fixed_values as fixed


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _replace(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {_quoted(pattern)}, '{by}')"


def _collapse(text: str) -> str:
    return f"trim({_replace(text, f'[{fixed.WHITESPACE}]+', ' ')})"


def register_sql_functions(spark: SparkSession) -> None:
    """Temporary SQL functions; calls are inlined into the plan like built-ins."""
    suffix = r"(?iU)\b(" + "|".join(fixed.LEGAL_SUFFIXES) + r")\b\.?"
    page = _replace("x", fixed.HTML_BLOCK_PATTERN, " ")
    page = _replace(page, fixed.HTML_IMAGE_PATTERN, "")
    page = _replace(page, fixed.HTML_TAG_PATTERN, " ")
    head = "substring(x, 1, n)"
    after_stop = f"(instr(reverse({head}), '.') - 1)"
    chunk = (
        f"CASE WHEN length(x) <= n THEN x WHEN {after_stop} >= 0 "
        f"THEN substring({head}, 1, length({head}) - {after_stop}) ELSE {head} END"
    )
    name = _replace(_replace("x", fixed.NAME_PUNCTUATION, " "), suffix, " ")
    bodies = {
        "tw_collapse_ws(x STRING)": _collapse("x"),
        "tw_clean_html(x STRING)": _collapse(page),
        "tw_chunk_payload(x STRING, n INT)": chunk,
        "tw_clean_name(x STRING)": _collapse(name),
    }
    for signature, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURNS STRING RETURN {body}")
