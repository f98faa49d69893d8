"""Inventories and run summaries: one CSV per run, all of one layout.

Lines that do not fit the layout, cut or with a field too many, are no rows: `bad_lines`
hands them back.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpus_health import constants as c
from corpus_health.functions import text, times
from corpus_health.schemas import INVENTORY_COLUMNS, RUN_COLUMNS

INVENTORY_FILES = "{prefix}_A_Inventario_Sitios_*.csv"
RUN_FILES = "{prefix}_B_Masivo_Resumen_*.csv"
CORRUPT = "_corrupt"
STAMP = r"_(\d{8}_\d{6})\.csv"


def latest_inventory(runs: DataFrame, version: str = "run_ts") -> DataFrame:
    """Sites of the newest run."""
    newest = runs.select(F.max(version)).scalar()
    return runs.where(F.col(version) == newest)


def read_inventory(spark: SparkSession, folder: str, prefix: str | None = None) -> DataFrame:
    """All inventories of a folder under our column names and types, with `run_ts` of each.

    A file whose header is not an inventory's is an error: one script writes them all.
    """
    rows = _read(spark, folder, INVENTORY_FILES, INVENTORY_COLUMNS, prefix)
    return rows.withColumns(
        {
            "has_group": _yes("has_group"),
            "is_hub": _yes("is_hub"),
            "storage_gb": F.col("storage_gb").try_cast("double"),
            "storage_mb": F.col("storage_mb").try_cast("double"),
            "last_activity_ts": times.parse(F.col("last_activity_ts")),
            "created_ts": times.parse(F.col("created_ts")),
        }
    )


def read_runs(spark: SparkSession, folder: str, prefix: str | None = None) -> DataFrame:
    """All run summaries of a folder, with `surveyed_ts`, the time of the run."""
    rows = _read(spark, folder, RUN_FILES, RUN_COLUMNS, prefix)
    counts = {n: F.col(n).try_cast("bigint") for n in ("run_order", "libraries", "files", "errors", "seconds")}
    typed = rows.withColumns({**counts, "storage_gb": F.col("storage_gb").try_cast("double")})
    return typed.withColumnRenamed("run_ts", "surveyed_ts")


def bad_lines(spark: SparkSession, folder: str, prefix: str | None = None) -> DataFrame:
    """kind (inventory or run), source_file and line of what `read_inventory` and `read_runs` leave out.

    A folder without files of a kind has no bad lines of it.
    """
    kinds = {"inventory": (INVENTORY_FILES, INVENTORY_COLUMNS), "run": (RUN_FILES, RUN_COLUMNS)}
    found = spark.createDataFrame([], "kind string, source_file string, line string")
    for kind, (names, columns) in kinds.items():
        try:
            rows = _raw(spark, folder, names, columns, prefix)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        bad = rows.where(F.col(CORRUPT).isNotNull())
        found = found.unionByName(bad.select(F.lit(kind).alias("kind"), "source_file", F.col(CORRUPT).alias("line")))
    return found


def _read(
    spark: SparkSession, folder: str, names: str, columns: Mapping[str, str], prefix: str | None
) -> DataFrame:
    fits = _raw(spark, folder, names, columns, prefix).where(F.col(CORRUPT).isNull())
    return fits.drop(CORRUPT, "source_file")


def _raw(
    spark: SparkSession, folder: str, names: str, columns: Mapping[str, str], prefix: str | None
) -> DataFrame:
    schema = ", ".join(f"`{name}` string" for name in [*columns, CORRUPT])
    glob = names.format(prefix="*" if prefix is None else text.client_prefix(prefix))
    rows = (
        spark.read.schema(schema)
        .options(header=True, enforceSchema=False, quote='"', escape='"', encoding="UTF-8", pathGlobFilter="*.csv")
        # lines are checked against the whole header, whatever columns a query reads
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, columnPruning=False)
    )
    found = rows.csv(f"{folder}/{glob}")
    source = F.col("_metadata.file_path")
    stamp = F.regexp_extract(source, STAMP, 1)
    run = F.to_timestamp_ntz(F.nullif(stamp, F.lit("")), F.lit("yyyyMMdd_HHmmss"))
    # Spark refuses to read the corrupt column alone: tie it to another one
    nothing = F.substring(F.coalesce(F.col(f"`{next(iter(columns))}`"), F.lit("")), 1, 0)
    return found.select(
        *[F.nullif(F.col(theirs), F.lit("")).alias(ours) for theirs, ours in columns.items()],
        F.concat(CORRUPT, nothing).alias(CORRUPT),
        source.alias("source_file"),
        run.alias("run_ts"),
    )


def _yes(name: str) -> Column:
    return F.coalesce(F.col(name) == c.YES, F.lit(False))
