"""Incremental versions of the batch jobs.

Streams read landed Parquet only. All sinks are idempotent: a replayed batch
overwrites exactly what its first attempt wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from corpus_health.operators import clean, health, refresh, tenant
from corpus_health.params import Params
from corpus_health.plans.skew import salted_join
from corpus_health.schemas import FILES
from corpus_health.streaming import metrics
from corpus_health.streaming.changes import PLACE, ChangeLog, lay_out, site_bucket

#: What tells files apart.
KEYS = ["site_url", "path"]
#: Up to so many sites of a batch are sent to all tasks, to read rows of these only.
FEW_SITES = 100_000


def stream_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str = FILES,
    max_files_per_trigger: int = 1000,
) -> DataFrame:
    """Survey batches as they land, each exactly once."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", True)
    return reader.option("maxFilesPerTrigger", max_files_per_trigger).parquet(folder)


def land(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the stream to a Parquet folder and stop when it has caught up."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )


def changed_files(rows: DataFrame, old: DataFrame, version: str = "survey_no", buckets: int = 64) -> DataFrame:
    """The newest row of each file of a batch that `old`, rows of the state before, does not have as new or newer.

    Files are told apart as `refresh.latest_snapshot` does. Of `old` only keys, version and a digest
    of the rest are moved. A row that is older than the kept one, or equal to it, is not
    handed on; one of the same version with other values is, as a digest does not tell which is first.
    Rows are laid out by buckets; `waste` is 1 where a row meets an older one.
    """
    others = _others(rows, version)
    digest = F.xxhash64(*others, *[F.col(name).isNull() for name in others])  # a hash passes over nulls
    known = old.select(*KEYS, version, digest.alias("_digest"), F.lit(True).alias("_old"))
    every = rows.withColumn("_old", F.lit(False)).unionByName(known, allowMissingColumns=True)
    file = [*PLACE, *KEYS]
    first = Window.partitionBy(*file, "_old").orderBy(*[F.desc_nulls_last(name) for name in (version, *others)])
    placed = lay_out(every, buckets, ["path"], KEYS).withColumn("_n", F.row_number().over(first))
    seen = F.struct(F.col(version).alias("version"), F.when(F.col("_old"), F.col("_digest")).otherwise(digest).alias("digest"))
    had = F.collect_set(F.when(F.col("_old"), seen)).over(Window.partitionBy(*file))
    met = placed.where("_old OR _n = 1").withColumn("_had", had).where("NOT _old")
    last = F.array_max("_had")["version"]
    newer = (F.col(version) > last) | (F.col(version).isNotNull() & last.isNull())
    other = F.col(version).eqNullSafe(last) & ~F.array_contains("_had", seen)
    known = F.size("_had") > 0
    changed = met.where(~known | F.coalesce(newer, F.lit(False)) | other)
    return changed.select(*PLACE, *rows.columns, F.lit(1).alias("sign"), known.cast("int").alias("waste"))


def stream_snapshot(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    version: str = "survey_no",
    drop_missing: bool = False,
    buckets: int = 64,
) -> StreamingQuery:
    """Keep the newest row of each file current; `read_snapshot` reads it.

    A batch is held against keys and versions of the files of its sites (see `changed_files`) and
    writes the files that it changes. They lie in buckets of sites; a bucket is merged when what
    no longer counts has become large beside the rest of it (see `ChangeLog`), so what is written
    over time stays in proportion to what changes. With `drop_missing` a file that the
    newest survey of its site no longer lists is gone.

    Choose `buckets` so that one holds what a few tasks can merge; it stays for the
    life of `out`. A bucket is merged as a distributed job, a large site in it is no limit.
    """
    settings = _settle(stream, out, version, drop_missing, buckets)

    def update(batch: DataFrame, batch_id: int) -> None:
        log = _files(batch.sparkSession, out, **settings)
        old = _rows_of_sites(log, batch, batch_id)
        numbers = log.append(changed_files(batch, old, version, buckets), batch_id)
        log.fold(batch_id, numbers, _logged(batch.schema))

    return _run(stream, update, checkpoint)


def read_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """The live rows: the newest of each file of those that are kept."""
    log = _files(spark, out, **_settings(spark, out))
    return log.merge(log.rows()).drop(*PLACE, "sign", "waste")


def stream_site_metrics(
    stream: DataFrame,
    params: Params,
    out: str,
    checkpoint: str,
    version: str = "survey_no",
    drop_missing: bool = False,
    buckets: int = 64,
) -> StreamingQuery:
    """Keep the snapshot, and what summary and health index of every site are made of, current.

    A batch turns its changes into signed rows, new ones and the ones they replace, and
    adds them up in the cells of their sites. Rows of other sites are not looked at;
    `read_metrics` makes the metrics from cells alone, for any day.
    """
    settings = _settle(stream, out, version, drop_missing, buckets)

    def update(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        log, parts = _files(spark, out, **settings), _cells(spark, out, buckets)
        old = _rows_of_sites(log, batch, batch_id)
        numbers = log.append(signed_changes(batch, old, version, drop_missing, buckets), batch_id)
        sums = metrics.cells(log.changes(batch_id, numbers, _logged(batch.schema)), params)
        parts.fold(batch_id, parts.append(sums, batch_id), sums.schema)
        log.fold(batch_id, numbers, _logged(batch.schema))

    return _run(stream, update, checkpoint)


def read_metrics(spark: SparkSession, out: str, sites: DataFrame, accounts: DataFrame, params: Params) -> DataFrame:
    """Summary and health index of each site that has files, on the day of `params`."""
    parts = _cells(spark, out, _settings(spark, out)["buckets"])
    return metrics.site_metrics(parts.merge(parts.rows()), sites, accounts, params)


def signed_changes(
    new: DataFrame, old: DataFrame, version: str = "survey_no", drop_missing: bool = False, buckets: int = 64
) -> DataFrame:
    """Rows with a `sign`: 1 for those that a batch makes live, -1 for those it takes out of the snapshot.

    `new` has the rows of the batch, `old` rows of the state before, of these sites at
    least. Both meet in one shuffle; rows that are late or known, and files that stay as they are,
    go before anything is compared by site. Rows are laid out by buckets; `waste` is
    the number of rows that count no longer, a row of sign -1 itself included.
    """
    others = _others(old, version)
    every = new.select(*old.columns, F.lit(False).alias("_old")).unionByName(old.withColumn("_old", F.lit(True)))
    file = [*PLACE, *KEYS]
    first = Window.partitionBy(*file, "_old").orderBy(*[F.desc_nulls_last(name) for name in (version, *others)])
    placed = lay_out(every, buckets, ["path"], KEYS).withColumn("_n", F.row_number().over(first)).where("_n = 1")
    both = Window.partitionBy(*file).orderBy("_old")
    row = F.struct(version, *others)
    met = placed.withColumns({"_came": F.lag(row).over(both), "_was": F.lead(row).over(both)})
    comes = ~F.col("_old") & (F.col("_was").isNull() | (row > F.col("_was")))
    leaves = F.col("_old") & F.coalesce(F.col("_came") > row, F.lit(False))
    waste = F.when(F.col("_old") | F.col("_was").isNotNull(), 1).otherwise(0)
    if drop_missing:
        newest = F.max(F.when(F.col("_old"), F.col(version))).alias("_last"), F.max(version).alias("_next")
        met = salted_join(met, every.groupBy("site_url").agg(*newest), ["site_url"], "inner")
        live, missing = F.coalesce(F.col(version) >= F.col("_last"), F.col("_last").isNull()), F.col(version) < F.col("_next")
        comes = comes & F.coalesce(F.col(version) >= F.col("_next"), F.col("_next").isNull())
        waste = waste + F.when(~leaves & F.col("_old"), 1).otherwise(0)
        leaves = F.col("_old") & live & (leaves | F.coalesce(missing, F.lit(False)))
    signs = met.withColumns({"sign": F.when(comes, 1).when(leaves, -1), "waste": waste}).where("sign IS NOT NULL")
    return signs.select(*PLACE, *old.columns, "sign", "waste")


def site_metrics(
    files: DataFrame, sites: DataFrame, accounts: DataFrame, params: Params
) -> DataFrame:
    """Summary and index of each site that has files."""
    ready = clean.enrich(files, params)
    indexed = health.health_index(ready, sites, accounts, params).drop("bytes")
    return tenant.site_summary(ready).join(indexed, "site_url", "left")


def _run(stream: DataFrame, update, checkpoint: str) -> StreamingQuery:
    adaptive = "spark.sql.adaptive.enabled"
    wanted = stream.sparkSession.conf.get(adaptive)

    def sized(batch: DataFrame, batch_id: int) -> None:
        """Spark may turn adaptive plans off in a stream; without them nothing is rebalanced, and each task writes a file for each bucket."""
        conf = batch.sparkSession.conf
        fixed = conf.get(adaptive)
        conf.set(adaptive, wanted)
        try:
            update(batch, batch_id)
        finally:
            conf.set(adaptive, fixed)

    return (
        stream.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(sized)
        .trigger(availableNow=True)
        .start()
    )


def _others(rows: DataFrame, version: str) -> list[str]:
    return [name for name in rows.columns if name not in (*KEYS, version)]


def _logged(schema: T.StructType) -> T.StructType:
    """Rows as they lie in the log."""
    return T.StructType([*schema.fields, T.StructField("sign", T.IntegerType()), T.StructField("waste", T.IntegerType())])


def _rows_of_sites(log: ChangeLog, batch: DataFrame, batch_id: int) -> DataFrame:
    """Rows of the state before a batch, of its sites at least; of very many sites the rows of their buckets."""
    touched = batch.select("site_url").distinct()
    found = touched.groupBy(site_bucket(log.buckets).alias("bucket")).count().collect()  # a row for each bucket
    rows = log.rows(batch_id, [r["bucket"] for r in found], _logged(batch.schema))
    rows = rows.where("sign > 0").select(*batch.columns)
    if sum(r["count"] for r in found) > FEW_SITES:
        return rows
    sites = F.broadcast(touched.select(F.col("site_url").alias("_site")))
    return rows.join(sites, F.col("site_url").eqNullSafe(F.col("_site")), "left_semi")


def _files(spark: SparkSession, out: str, version: str, drop_missing: bool, buckets: int) -> ChangeLog:
    def merge(rows: DataFrame) -> DataFrame:
        live = rows.where("sign > 0").drop("sign", "waste")
        if drop_missing:
            newest = refresh.latest_snapshot(live, version, drop_missing)
        else:
            newest = refresh.latest_snapshot(lay_out(live, buckets, ["path"], KEYS), version, within=PLACE)
        return newest.withColumns({"sign": F.lit(1), "waste": F.lit(0)})

    return ChangeLog(spark, f"{out}/files", buckets, merge, "waste")


def _cells(spark: SparkSession, out: str, buckets: int) -> ChangeLog:
    return ChangeLog(spark, f"{out}/cells", buckets, metrics.merged)


def _settle(stream: DataFrame, out: str, version: str, drop_missing: bool, buckets: int) -> dict:
    """What a snapshot is kept by stays for its life."""
    spark = stream.sparkSession
    wanted = {"version": version, "drop_missing": drop_missing, "buckets": buckets}
    row = spark.createDataFrame([tuple(wanted.values())], "version string, drop_missing boolean, buckets int")
    row.coalesce(1).write.mode("ignore").parquet(f"{out}/settings")
    if (found := _settings(spark, out)) != wanted:
        raise ValueError(f"{out} is kept with {found}")
    return wanted


def _settings(spark: SparkSession, out: str) -> dict:
    return spark.read.parquet(f"{out}/settings").first().asDict()
