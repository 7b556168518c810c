"""Queries stated once in SQL, planned by Catalyst and checked by DuckDB.

The text is DuckDB SQL over the tables of a data folder.  ``to_spark`` renames
the few functions that the two engines spell differently; everything else is
common to both.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from caseflux.plans.registry import query
from caseflux.sources.tables import table

TABLES = (
    "decisions", "batches", "extracted_event_details", "match_evidence", "snapshots", "entities", "documents", "embeddings", "events", "orders", "lineitem", "customer", "part", "supplier", "nation", "region", "eval_items", "doc_labels",
    "asd_risk_classifications_20251118_153149", "asd_risk_classifications_20251118_154100",
)
# DuckDB's spelling and Spark's.
RENAMED = {
    "list_filter": "filter", "list_transform": "transform", "list_distinct": "array_distinct", "list_intersect": "array_intersect", "list_contains": "array_contains", "list_sort": "array_sort", "list_value": "array", "list_concat": "concat",
    "list_slice": "slice", "list_extract": "try_element_at", "list_has_any": "arrays_overlap", "array_to_string": "array_join", "list": "collect_list", "string_split": "split", "regexp_split_to_array": "split", "unnest": "explode", "len": "size",
    "regexp_matches": "regexp_like", "json_extract_string": "get_json_object", "starts_with": "startswith", "ends_with": "endswith", "arg_max": "max_by", "arg_min": "min_by", "bool_or": "bool_or", "list_position": "array_position", "struct_pack": "struct",
}
_NAME = re.compile(r"\b(" + "|".join(sorted(RENAMED, key=len, reverse=True)) + r")\(")


def to_spark(sql: str) -> str:
    """The same query in Spark's spelling."""
    sql = _NAME.sub(lambda m: RENAMED[m[1]] + "(", sql)
    sql = re.sub(r"collect_list\(distinct ", "collect_set(", sql)
    sql = re.sub(r"date_diff\('day', ", "datediff(DAY, ", sql)
    sql = re.sub(r"strftime\(([\w.]+), '%Y-%m'\)", r"date_format(\1, 'yyyy-MM')", sql)
    sql = re.sub(r"json_valid\(([\w.]+)\)", r"(try_parse_json(\1) is not null)", sql)
    sql = re.sub(r"sha256\(([^()]*)\)", r"sha2(\1, 256)", sql)
    sql = re.sub(r"json_object\(([^()]*)\)::varchar", r"to_json(named_struct(\1))", sql)
    sql = re.sub(r"lambda (\w+), (\w+):", r"(\1, \2) ->", sql)
    sql = re.sub(r"lambda (\w+):", r"\1 ->", sql)
    sql = sql.replace(", 'g')", ")").replace("::varchar[]", "::array<string>").replace("::varchar", "::string").replace("'\\1'", "'$1'")
    return sql.replace("\\", "\\\\")


def tables_of(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_0-9]+", sql))
    return [t for t in TABLES if t in words]


def run(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """The plan of a DuckDB text over the tables of a folder."""
    for name in tables_of(sql):
        table(spark, folder, name).createOrReplaceTempView(name)
    return spark.sql(to_spark(sql))


def sql_query(name: str, sql: str, doc: str = "") -> None:
    """Registers a query whose plan and oracle are one text."""

    def plan(spark: SparkSession, folder: str) -> DataFrame:
        return run(spark, folder, sql)

    plan.__doc__ = doc
    plan.__name__ = name
    query(name, sql)(plan)
