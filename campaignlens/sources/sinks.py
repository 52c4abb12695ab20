"""Stage sinks: Parquet stages, versioned tables with a "latest" view,
date-range backfills with dynamic partition overwrite, and row-count
observation.

Stage folders live under a shared location: ``campaignlens.stage.dir`` if
the session names one, else a ``stages`` folder next to the session's
checkpoint folder (``spark.checkpoint.dir`` on a cluster).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from campaignlens.session import ensure_checkpoint_dir


def stage_root(spark: SparkSession) -> str:
    configured = spark.conf.get("campaignlens.stage.dir", None)
    if configured:
        return configured.rstrip("/")
    return ensure_checkpoint_dir(spark).rstrip("/") + "/stages"


def champion_dir(spark: SparkSession) -> str:
    """Durable folder of the champion model: ``campaignlens.champion.dir``, else a folder in the warehouse."""
    configured = spark.conf.get("campaignlens.champion.dir", None)
    return (configured or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/campaignlens_champion").rstrip("/")


def write_stage(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def stage_roundtrip(df: DataFrame, name: str) -> DataFrame:
    """Write a stage to a fresh folder and read it back (cuts the lineage)."""
    path = f"{stage_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    write_stage(df, path)
    return df.sparkSession.read.parquet(path)


def qualified_name(name: str, version: int | None = None, database: str | None = None,
                   schema: str | None = None) -> str:
    """``[database.][schema.]name[_vN]``, each part back-quoted."""
    base = f"{name}_v{version}" if version is not None else name
    parts = [p for p in (database, schema, base) if p]
    return ".".join(f"`{p}`" for p in parts)


def write_versioned(
    df: DataFrame, name: str, version: int, latest_version: int, database: str | None = None,
    check: Callable[[DataFrame], bool] | None = None,
) -> str:
    """Save ``name_vN`` as a table; if N is the latest, point view ``name`` at it.

    ``check`` looks at the stored version before the view moves; where it says
    no, the view stays on the old version and ``ValueError`` is raised.  A table (not a view) already called ``name`` is dropped first, as the
    latest-version view must take its place.  Returns the view or table name
    that readers should use.
    """
    spark = df.sparkSession
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    versioned = qualified_name(name, version, database)
    df.write.mode("overwrite").saveAsTable(versioned)
    if check is not None and not check(spark.table(versioned)):
        raise ValueError(f"{versioned} did not pass its check; readers keep the version they had")
    if version != latest_version:
        return versioned
    plain = qualified_name(name, None, database)
    lookup = f"{database}.{name}" if database else name
    if spark.catalog.tableExists(lookup):
        kind = spark.catalog.getTable(lookup).tableType
        if kind != "VIEW":
            spark.sql(f"DROP TABLE {plain}")
    spark.sql(f"CREATE OR REPLACE VIEW {plain} AS SELECT * FROM {versioned}")
    return plain


# The partition column of a stored table that names no other.
PARTITION_COLUMN = "day_dt"


def partition_column(spark: SparkSession, table: str, default: str = PARTITION_COLUMN) -> str:
    """The date column that ``table`` is partitioned by: ``campaignlens.partition.<table>``, else the default."""
    return spark.conf.get(f"campaignlens.partition.{table}", None) or default


def backfill_date_range(
    df: DataFrame, path: str, date_col: str | None = None, min_date: str = "", max_date: str = "", table: str = ""
) -> int:
    """Rewrite only the date partitions in ``[min_date, max_date)``.

    The frame is filtered to the window and written with dynamic partition
    overwrite, so partitions outside the window stay as they are.  Without
    ``date_col`` the column is the one set for ``table``, or the default.
    Returns the number of rows written (observed during the write, no extra
    pass).
    """
    date_col = date_col or partition_column(df.sparkSession, table)
    c = F.col(date_col)
    window = df.where((c >= F.lit(min_date).cast("date")) & (c < F.lit(max_date).cast("date")))
    observed, obs = observe_rows(window, "backfill")
    (
        observed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_col)
        .parquet(path)
    )
    return int(obs.get["rows_affected"])


def publish(spark: SparkSession, root: str, path: str, values: dict[str, object]) -> int:
    """Point readers of ``root`` at ``path``, a version that is written and checked; returns its number.

    A pointer is one row in one file that Spark renames into place as the last
    step, so readers see the old version or the new one with its own values,
    never a mixture; a publisher that stops earlier leaves the old version.
    """
    current = published(spark, root)
    number = 1 + (current["number"] if current else 0)
    row = json.dumps({"number": number, "path": path, **values}, sort_keys=True)
    spark.range(1).select(F.lit(row).alias("value")).coalesce(1).write.mode("append").text(f"{root}/pointers")
    return number


def published(spark: SparkSession, root: str) -> dict[str, object] | None:
    """The row of the latest pointer under ``root``, if anything was published."""
    found = pointers(spark, root)
    return found[-1] if found else None


def pointers(spark: SparkSession, root: str) -> list[dict[str, object]]:
    """All pointers under ``root``, oldest first (one row per publication)."""
    try:
        rows = spark.read.text(f"{root}/pointers").collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((json.loads(r.value) for r in rows), key=lambda p: (p["number"], p["path"]))


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter filled in by whatever action runs the frame."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows_affected")), obs
