"""Mixing sources to target weights by Poisson replication.

A source's rate is the mean number of times each of its documents is repeated so
that the source has its target share of the mix. A document's number of copies is
drawn from the Poisson distribution with that mean: a hash of its id and the seed
gives a uniform number, and the count is where the distribution function passes it.
Each copy then gets a hash as its place in the mix, and the rows are sorted by it.
Every draw depends on the document alone, so a task that runs again repeats it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_health.llm.common import land

#: Sources whose rates are broadcast: the rows of rates are bounded by this; more are joined by shuffle.
BROADCAST_SOURCES = 10_000
#: Rate that the distribution is tabled for at once; greater rates are sums of draws at this rate or less.
RATE_STEP = 16.0
#: Entries of the table: past these the chance at RATE_STEP is under 2 ** -52, the step of the uniform numbers.
STEPS = 80
SEED = "mix-1"


def uniform(*parts: Column) -> Column:
    """A number from 0 to 1 (exclusive), in steps of 2 ** -52, from the MD5 of the parts."""
    text = F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("\x00")) for p in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint").cast("double") / F.lit(float(1 << 52))


def inverse_poisson(u: Column, rate: Column) -> Column:
    """The least k whose Poisson distribution function at the rate (up to RATE_STEP) is over u."""
    zero = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("cdf"), F.lit(0).alias("k"))

    def step(s: Column, i: Column) -> Column:
        p = s["p"] * rate / i
        more = u >= s["cdf"]
        return F.struct(p.alias("p"), F.when(more, s["cdf"] + p).otherwise(s["cdf"]).alias("cdf"), F.when(more, i).otherwise(s["k"]).alias("k"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), zero, step, lambda s: s["k"])


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, size: int | None = None, source: str = "source") -> DataFrame:
    """_source, _rate: the mean number of copies of a document of each source.

    `weights` are the target shares, up to a common factor; sources without a weight
    leave the mix. Without weights all sources get the same share. `size` is the
    target number of rows, by default as many as there are. Null is a source.
    """
    counts = docs.groupBy(F.col(source).alias("_source")).agg(F.count(F.lit(1)).alias("_n"))
    if weights is None:
        weighed = counts.withColumn("_weight", F.lit(1.0))
    else:
        spark = docs.sparkSession
        targets = spark.createDataFrame([(s, float(w)) for s, w in weights.items()], "_name string, _weight double")
        weighed = counts.join(F.broadcast(targets), F.col("_source").eqNullSafe(F.col("_name"))).drop("_name")
    weighed = land(weighed, "mix-rates")
    total = weighed.agg(F.sum("_weight").alias("w"), F.sum("_n").alias("n")).first()
    goal = size if size is not None else docs.count() if weights is not None else (total.n or 0)
    return weighed.select("_source", (F.lit(float(goal)) * F.col("_weight") / F.lit(total.w or 1.0) / F.col("_n")).alias("_rate"))


def copies(rate: Column, seed: str, *key: Column) -> Column:
    """A document's number of copies: a draw for each RATE_STEP of the rate, and one for the rest."""

    def draw(sum_: Column, i: Column) -> Column:
        part = F.least(F.lit(RATE_STEP), rate - i * RATE_STEP)
        return sum_ + inverse_poisson(uniform(F.lit(seed), *key, i), part)

    last = F.ceil(rate / RATE_STEP).cast("int") - 1
    return F.when(rate > 0, F.aggregate(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), F.lit(0), draw)).otherwise(F.lit(0))


def _drawn(docs: DataFrame, weights, size, seed: str, key: str, source: str) -> DataFrame:
    """_doc (a row as one value, so that its columns clash with none of ours), _copy and _place, in the mix's order."""
    by = rates(docs, weights, size, source)
    few = by.count() <= BROADCAST_SOURCES
    rows = docs.select(F.struct("*").alias("_doc"), F.col(key).alias("_key"), F.col(source).alias("_of"))
    rated = rows.join(F.broadcast(by) if few else by, F.col("_of").eqNullSafe(F.col("_source")))
    many = rated.select("_doc", "_key", copies(F.col("_rate"), seed, F.col("_key")).alias("_copies")).where("_copies > 0")
    each = many.select("_doc", "_key", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("_copy"))
    text = F.concat_ws(
        "|", F.lit(f"{seed}/place"), F.coalesce(F.col("_key").cast("string"), F.lit("\x00")), F.col("_copy").cast("string")
    )
    order = F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")
    placed = each.withColumn("_place", order).repartition(F.col("_place"))
    return placed.sortWithinPartitions("_place", "_key", "_copy").drop("_key")


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    size: int | None = None,
    seed: str = SEED,
    key: str = "doc_id",
    source: str = "source",
    copy: str | None = "copy",
    place: str | None = "place",
) -> DataFrame:
    """Each document as often as it is drawn, in random order: its columns, the copy's number from 0, its place.

    Rows with the same key and source are drawn alike, nulls being a key and a source
    too. Documents drawn 0 times are absent, an empty table stays empty. Columns named
    like `copy` and `place` are replaced; where these are None, nothing is added.
    """
    docs = docs.drop(*(n for n in (copy, place) if n and n not in (key, source)))
    drawn = _drawn(docs, weights, size, seed, key, source)
    added = [F.col(c).alias(n) for c, n in (("_copy", copy), ("_place", place)) if n]
    return drawn.select("_doc.*", *added)
