"""Sinks: filtered table export, partitioned snapshots, quarantine of rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("parquet", "json", "csv", "orc")


def export_table(rows: DataFrame, path: str, fmt: str = "parquet", between: tuple[str, object, object] | None = None, equal: dict[str, object] | None = None, isin: dict[str, list] | None = None, partition_by: list[str] | None = None) -> None:
    """Writes the rows that pass the filters; the filters reach the scan."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt}; known: {', '.join(FORMATS)}")
    if between:
        rows = rows.where(F.col(between[0]).between(between[1], between[2]))
    for k, v in (equal or {}).items():
        rows = rows.where(F.col(k) == v)
    for k, v in (isin or {}).items():
        rows = rows.where(F.col(k).isin(*v))
    w = rows.write.mode("overwrite")
    if fmt == "csv":
        w = w.option("header", True)
    (w.partitionBy(*partition_by) if partition_by else w).format(fmt).save(path)


def split_rejects(rows: DataFrame, valid: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) by a SQL condition; null counts as rejected."""
    ok = F.coalesce(F.expr(valid), F.lit(False))
    return rows.where(ok), rows.where(~ok)


def write_html_report(sections: dict[str, DataFrame], path: str, title: str = "report") -> None:
    """One HTML file under ``path`` with the rows of each section embedded as JSON.

    Sections are small aggregates; each becomes one list of JSON rows before
    the page is put together in a single row and written.
    """
    page = None
    for name, rows in sections.items():
        one = rows.agg(F.array_sort(F.collect_list(F.to_json(F.struct(*rows.columns)))).alias(name))
        page = one if page is None else page.crossJoin(one)  # one row each
    data = F.replace(F.to_json(F.struct(*sections)), F.lit("</"), F.lit("<\\/"))
    html = F.concat(F.lit(f'<!doctype html><meta charset="utf-8"><title>{title}</title><script type="application/json">'), data, F.lit("</script>"))
    page.select(html.alias("value")).coalesce(1).write.mode("overwrite").text(path)


def wipe(spark: SparkSession, paths: dict[str, str], allowed: tuple[str, ...], order: list[str]) -> dict[str, int]:
    """Empties the named tables, deepest reference first; gives the rows each had.

    A table that is not on the allow-list is an error and nothing is touched.
    """
    strange = sorted(set(paths) - set(allowed))
    if strange:
        raise ValueError(f"not to be wiped: {', '.join(strange)}")
    had: dict[str, int] = {}
    for name in sorted(paths, key=order.index):
        rows = spark.read.parquet(paths[name])
        had[name] = rows.count()
        rows.limit(0).write.mode("overwrite").parquet(f"{paths[name]}.empty")
        fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        old, new = fs_path(paths[name]), fs_path(f"{paths[name]}.empty")
        fs = old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(old, True)
        fs.rename(new, old)
    return had
