"""Loads (W1, W2, W7) and the quarantine sink.

A table load is one lazy pipeline scan -> conform -> write whose only action is the
write; rows are counted in the same pass with an :class:`~pyspark.sql.Observation`.

Atomicity per table (W1): file targets are written with the output committer — a failed
job commits nothing, and a strict cast (ANSI) fails the job on the first value that does
not fit, like the reference's rollback. JDBC targets commit per partition (survey fact
F12), so they are loaded into a staging table and swapped in by rename.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableferry.sources import versioned

# Fixed value: rows per INSERT batch of the current loader.
JDBC_BATCH_SIZE = 500


def observation(label: str) -> Observation:
    """A uniquely named observation: loads run concurrently from several threads, and each
    must read back its own metrics."""
    return Observation(f"{label}-{uuid.uuid4().hex}")


def write_table(df: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> int:
    """W1 (files): write ``df`` as one table; returns the rows written (same pass)."""
    obs = observation("load")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt).save(path)
    return int(obs.get["rows"])


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove one folder of the target, if it is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def write_quarantined(df: DataFrame, path: str) -> dict:
    """W4 sink: good and rejected rows in one pass, partitioned by ``rejected``."""
    obs = observation("quarantine")
    tagged = df.withColumn("rejected", F.col("reject_reasons").isNotNull())
    tagged.observe(
        obs,
        F.count_if(~F.col("rejected")).alias("good"),
        F.count_if(F.col("rejected")).alias("bad"),
    ).write.mode("overwrite").partitionBy("rejected").parquet(path)
    return {k: int(v) for k, v in obs.get.items()}


def load_rowwise(frames: list[DataFrame], path: str) -> int:
    """Rows of differently shaped frames appended, columns taken per frame (missing
    -> NULL). Append has no table-level transaction, as in the reference."""
    from functools import reduce

    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    # A row without any value is skipped, as the row-wise loader skips empty rows.
    return write_table(merged.dropna(how="all"), path, mode="append")


def _jdbc_execute(spark: SparkSession, url: str, properties: dict, statements: list[str]) -> None:
    """Run DDL on the target through one driver-side JDBC connection."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        if k in ("user", "password"):
            props.setProperty(k, v)
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        stmt = conn.createStatement()
        for s in statements:
            stmt.executeUpdate(s)
        stmt.close()
    finally:
        conn.close()


def _jdbc_exists(spark: SparkSession, url: str, table: str, properties: dict) -> bool:
    """Whether the server's own listing has the table (in any letter case, as servers fold names)."""
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in properties.items():
        if k in ("user", "password"):
            props.setProperty(k, v)
    conn = jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        wanted = [p.strip('`"') for p in table.split(".")]
        found = conn.getMetaData().getTables(None, None, "%", None)
        while found.next():
            if found.getString("TABLE_NAME").lower() == wanted[-1].lower() and (
                len(wanted) == 1 or wanted[-2].lower() in ((found.getString("TABLE_SCHEM") or "").lower(), (found.getString("TABLE_CAT") or "").lower())
            ):
                return True
        return False
    finally:
        conn.close()


def write_jdbc_atomic(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict | None = None,
    batch_size: int = JDBC_BATCH_SIZE,
    create_columns: str | None = None,
    rename_sql: str = "RENAME TABLE {stage} TO {table}",
    drop_sql: str = "DROP TABLE {table}",
) -> int:
    """W1 (JDBC): load into ``<table>__STAGE`` in ``batch_size``-row batches, then rename the
    old target away, the stage in, and drop the old one. A failure before or in the swap
    leaves the old target; any error of the server rises."""
    props = dict(properties or {})
    stage = f"{table}__STAGE"
    obs = observation("jdbc_load")
    writer = (
        df.observe(obs, F.count(F.lit(1)).alias("rows"))
        .write.format("jdbc")
        .option("url", url)
        .option("dbtable", stage)
        .option("batchsize", str(batch_size))
        .option("isolationLevel", "READ_COMMITTED")
        .mode("overwrite")
    )
    if create_columns:
        writer = writer.option("createTableColumnTypes", create_columns)
    for k, v in props.items():
        writer = writer.option(k, v)
    writer.save()
    spark = df.sparkSession
    old = f"{table}__OLD"
    if _jdbc_exists(spark, url, table, props):
        if _jdbc_exists(spark, url, old, props):  # of a swap that broke off
            _jdbc_execute(spark, url, props, [drop_sql.format(table=old)])
        _jdbc_execute(spark, url, props, [rename_sql.format(stage=table, table=old)])
        try:
            _jdbc_execute(spark, url, props, [rename_sql.format(stage=stage, table=table)])
        except Exception:
            _jdbc_execute(spark, url, props, [rename_sql.format(stage=old, table=table)])
            raise
        _jdbc_execute(spark, url, props, [drop_sql.format(table=old)])
    else:
        _jdbc_execute(spark, url, props, [rename_sql.format(stage=stage, table=table)])
    return int(obs.get["rows"])


def maintain_table(
    spark: SparkSession, name: str, path: str, target_bytes: int = versioned.TARGET_BYTES, columns: list[str] | None = None
) -> dict:
    """W7 for one target table: its small files are merged, then it is analyzed (row count and statistics of ``columns``, by
    default all that have a simple type) and stays registered under ``name`` with its statistics.

    A versioned table merges bins of files (:func:`versioned.compact`); a plain folder that holds more files than its bytes
    fill is rewritten into that many and swapped, so a failed rewrite leaves it as it was. The status is
    ``optimized`` only where nothing is left to merge and the analysis went through."""
    out = {"table_name": name, "status": "error", "error": None, "files_before": None, "files_after": None}
    try:
        told = versioned.header(path)
        if told is None:
            frame = spark.read.parquet(path)
            out["files_before"] = len(frame.inputFiles())
            wanted = files_wanted(spark, path, target_bytes)
            compact_table(spark, path, wanted)
            frame = spark.read.parquet(path)
            out["files_after"] = len(frame.inputFiles())
            left = max(0, out["files_after"] - wanted)
        else:
            merged = versioned.compact(spark, path, target_bytes)
            out.update(files_before=merged["files_before"], files_after=merged["files_after"])
            frame = versioned.read_table(spark, path)
            files = versioned.files_of(path, versioned.header(path))
            left = len(versioned.plan_bins([(f["file"], f["bytes"]) for f in files], target_bytes))
        simple = [f.name for f in frame.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]
        wanted_columns = simple if columns is None else [c for c in columns if c in simple]
        spark.sql(f"DROP TABLE IF EXISTS `{name}`")
        # The statistics of a versioned table are those of its file list, which each commit brings up to date.
        if told is None:
            spark.sql(f"CREATE TABLE `{name}` USING parquet LOCATION '{path}'")
            spark.sql(f"ANALYZE TABLE `{name}` COMPUTE STATISTICS")
            if wanted_columns:
                spark.sql(f"ANALYZE TABLE `{name}` COMPUTE STATISTICS FOR COLUMNS {', '.join(f'`{c}`' for c in wanted_columns)}")
        elif frame.count() != versioned.header(path)["rows"]:
            raise ValueError("the files do not hold the rows of their list")
        if left:
            raise ValueError(f"{left} merges are left")
        out["status"] = "optimized"
    except AnalysisException as exc:
        missing = exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
        out.update(status="missing" if missing else "error", error=str(exc).splitlines()[0][:200])
    except Exception as exc:  # one table's failure is its own result row
        out["error"] = str(exc).splitlines()[0][:200]
    return out


def files_wanted(spark: SparkSession, path: str, target_bytes: int = versioned.TARGET_BYTES) -> int:
    """How many files of ``target_bytes`` the bytes of a folder fill."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return max(1, -(-fs.getContentSummary(at).getLength() // target_bytes))


def compact_table(spark: SparkSession, path: str, files: int) -> bool:
    """Rewrite a table of more than ``files`` data files; True where it was rewritten."""
    frame = spark.read.parquet(path)
    if len(frame.inputFiles()) <= files:
        return False
    stage, old = f"{path}__compact", f"{path}__before"
    frame.repartition(files).write.mode("overwrite").parquet(stage)
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(fs_path(old), True)
    if not fs.rename(fs_path(path), fs_path(old)):
        raise OSError(f"cannot move {path}")
    if not fs.rename(fs_path(stage), fs_path(path)):
        fs.rename(fs_path(old), fs_path(path))
        raise OSError(f"cannot replace {path}")
    fs.delete(fs_path(old), True)
    spark.catalog.refreshByPath(path)
    return True
