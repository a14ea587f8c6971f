"""Exports: CSV, JSON, a sheet's cells, an HTML page. Rows are shaped by expressions; only a single-file export of a
published selection is brought together, by one writing task."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundmill.functions.deals import column_letter, sheet_cell
from roundmill.operators.analytics import PUBLIC_COLUMNS, SEP, export_order

MAX_PAGE_ROWS = 100_000  # rows that one HTML page can hold


def csv_rows(rows: DataFrame) -> DataFrame:
    """The public columns as text: lists joined, sums as plain decimals, nothing as an empty string."""
    money = F.when(F.col("amount_usd").isNull(), "").otherwise(F.regexp_replace(F.col("amount_usd").cast("decimal(24,2)").cast("string"), r"(\.\d)0$", "$1"))
    shown = {"amount_usd": money, "investors": F.array_join("investors", SEP), "sources": F.array_join("sources", SEP), "confidence": F.col("confidence").cast("string")}
    return rows.select(*[F.coalesce(shown.get(c, F.col(c)), F.lit("")).alias(c) for c in PUBLIC_COLUMNS])


def write_csv(rows: DataFrame, path: str, *, single: bool = True) -> None:
    """CSV with a header; quotes as RFC 4180 asks. The rows' order is that of the export."""
    ordered = rows.orderBy(*export_order("company_name"))
    out = csv_rows(ordered)
    (out.coalesce(1) if single else out).write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def write_json(rows: DataFrame, path: str) -> None:
    """One object per line with lists kept."""
    rows.drop("amount_usd_raw").write.mode("overwrite").json(path)


def json_document(rows: DataFrame, max_rows: int = MAX_PAGE_ROWS) -> DataFrame:
    """One row: the JSON array of a selection of at most ``max_rows`` rows, in the order of the export. More is an error, not a
    cut; use ``write_json`` for it."""
    n = rows.limit(max_rows + 1).count()
    if n > max_rows:
        raise ValueError(f"more than {max_rows} rows don't fit one document; write_json takes any number")
    return rows.drop("amount_usd_raw").agg(F.to_json(F.array_sort(F.collect_list(F.struct((-F.col("confidence")).alias("_order"), *[c for c in rows.columns if c != "amount_usd_raw"])))).alias("document"))


def write_dashboard(rows: DataFrame, meta: DataFrame, path: str, title: str = "Deals") -> None:
    """A page that embeds a selection's rows and totals as JSON."""
    document = json_document(rows).first()["document"]
    totals = meta.select(F.to_json(F.struct(*meta.columns)).alias("j")).first()["j"]
    safe = lambda t: t.replace("</", "<\\/")
    Path(path).write_text(
        f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{title}</title></head><body><h1>{title}</h1><table id="rows"></table>'
        f'<script id="data" type="application/json">{safe(document)}</script><script id="meta" type="application/json">{safe(totals)}</script>'
        "<script>const rows=JSON.parse(document.getElementById('data').textContent);const t=document.getElementById('rows');"
        "for(const r of rows){const x=t.insertRow();for(const k of ['company_name','stage','amount','announced_on','lead_investor'])x.insertCell().textContent=r[k]||'';}</script></body></html>",
        encoding="utf-8",
    )


def sheet_cells(rows: DataFrame) -> DataFrame:
    """Cells of a sheet's values as text, a header above: (row, column letter, value). Replaces the sheet as a whole."""
    text = csv_rows(rows)
    numbered = text.withColumn("row", F.row_number().over(_in_order()) + 1)
    cells = numbered.select("row", F.posexplode(F.array(*[sheet_cell(F.col(c)) for c in PUBLIC_COLUMNS])).alias("pos", "value"))
    head = rows.sparkSession.createDataFrame([(1, i, c) for i, c in enumerate(PUBLIC_COLUMNS)], "row int, pos int, value string")
    return head.unionByName(cells).select("row", column_letter(F.col("pos") + 1).alias("column"), "value")


def _in_order():  # noqa: ANN202
    from pyspark.sql import Window

    return Window.orderBy(F.desc("confidence"), "company_name")  # one selection that a sheet can hold


def sheet_widths(rows: DataFrame) -> DataFrame:
    """One row: width of each public column (longest text plus 2, at most 50), its heading counted."""
    text = csv_rows(rows)
    width = lambda c: F.least(F.lit(50), F.greatest(F.lit(len(c)), F.coalesce(F.max(F.length(c)), F.lit(0))) + 2).cast("bigint").alias(c)
    return text.agg(*[width(c) for c in PUBLIC_COLUMNS])


def shade(confidence):  # noqa: ANN001, ANN201
    """red below 0.35, green from 0.85 on, else none."""
    return F.when(confidence < 0.35, "red").when(confidence >= 0.85, "green").otherwise("none")
