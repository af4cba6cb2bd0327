"""Report sinks (W8, W9): the rows of the validation report and the batch-error log.

Report rows are DataFrames built with ``concat`` / ``to_json``; writing them is a
``write.text`` / ``write.json`` of those rows — no per-row Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The report marks.
OK_MARK = "✓"
FAIL_MARK = "✗"


def _mark(c: str):
    return F.when(F.col(c), F.lit(OK_MARK)).otherwise(F.lit(FAIL_MARK))


def validation_report_rows(validation: DataFrame) -> DataFrame:
    """One HTML table row per table — name, both counts (thousands separators), the
    three checks and overall consistency; the row class marks ok / error."""
    cls = F.when(F.col("data_consistency"), F.lit("status-ok")).otherwise(F.lit("status-error"))
    html = F.concat(
        F.lit('<tr class="'), cls, F.lit('">'),
        F.lit("<td>"), F.col("table_name"), F.lit("</td>"),
        F.lit("<td>"), F.format_number(F.col("source_count"), 0), F.lit("</td>"),
        F.lit("<td>"), F.format_number(F.col("target_count"), 0), F.lit("</td>"),
        F.lit("<td>"), _mark("record_count_match"), F.lit("</td>"),
        F.lit("<td>"), _mark("sample_data_match"), F.lit("</td>"),
        F.lit("<td>"), _mark("extreme_values_match"), F.lit("</td>"),
        F.lit("<td>"), _mark("data_consistency"), F.lit("</td>"),
        F.lit("</tr>"),
    )
    return validation.select("table_name", html.alias("html_row"))


def write_validation_report(validation: DataFrame, overall: DataFrame, path: str) -> None:
    """W8 sink: header row, table rows, footer as one text file (a handful of rows per
    table, coalesced to one file)."""
    header = overall.select(
        F.concat(
            F.lit("<table><tr><th>table</th><th>source rows</th><th>target rows</th>"
                  "<th>row count</th><th>sample</th><th>extremes</th><th>consistency</th></tr>"
                  "<!-- overall: "),
            F.when(F.col("overall_success"), F.lit("success")).otherwise(F.lit("failure")),
            F.lit(" -->"),
        ).alias("value"),
        F.lit(0).alias("_o"), F.lit("").alias("_n"),
    )
    rows = validation_report_rows(validation).select(
        F.col("html_row").alias("value"), F.lit(1).alias("_o"), F.col("table_name").alias("_n")
    )
    footer = overall.select(F.lit("</table>").alias("value"), F.lit(2).alias("_o"), F.lit("").alias("_n"))
    # A handful of rows: one partition, sorted inside it, so the file's line order is fixed.
    (
        header.unionByName(rows).unionByName(footer)
        .repartition(1).sortWithinPartitions("_o", "_n")
        .select("value").write.mode("overwrite").text(path)
    )


def batch_errors(paged_quarantine: DataFrame, table_name: str) -> DataFrame:
    """W9 input: one error per page holding rejected rows.

    ``paged_quarantine`` is the quarantined table with its ``batch_no`` (S2 over the
    whole table), so batch numbers are those the legacy loader would have used."""
    return (
        paged_quarantine.groupBy("batch_no")
        .agg(F.count_if(F.col("reject_reasons").isNotNull()).alias("_n"))
        .filter(F.col("_n") > 0)
        .select(
            F.lit(table_name).alias("table_name"),
            F.col("batch_no").alias("batch_number"),
            F.concat(F.col("_n").cast("string"), F.lit(" rows rejected")).alias("error_message"),
        )
    )


def error_log_rows(errors: DataFrame) -> DataFrame:
    """Each batch error as one JSON object (table_name, batch_number, error_message);
    :func:`write_error_log` adds the time."""
    return errors.select(
        "table_name",
        "batch_number",
        F.to_json(F.struct("table_name", "batch_number", "error_message")).alias("json"),
    )


def load_errors(results: DataFrame) -> DataFrame:
    """W9 input: the tables of a run that were not loaded, or not as a whole (no batch number)."""
    return results.where(F.col("error").isNotNull()).select(
        F.col("source_table").alias("table_name"),
        F.lit(None).cast("bigint").alias("batch_number"),
        F.col("error").alias("error_message"),
    )


def write_error_log(errors: DataFrame, path: str) -> None:
    """W9 sink: one JSON line per error with the time of the write, added to the log at ``path``."""
    errors.select(
        F.current_timestamp().alias("timestamp"), "table_name", "batch_number", "error_message"
    ).write.mode("append").option("ignoreNullFields", "false").json(path)
