"""Document fingerprints by one-permutation MinHash, in built-in expressions only.

Each five-word shingle is hashed once. The top bits of the hash name a bin, and a
bin keeps its least hash. Empty bins are filled by optimal densification: bin j
asks the bins that a fixed random sequence of its own names, and takes the value
of the first that has one itself; borrowed values are never lent on. The sequence
is ASKED independent draws and then all bins in an order of j's own, so it always
comes to a filled bin. Of each bin the low bits are kept and packed as text,
one hexadecimal digit a bin. Two fingerprints' likeness is the share of equal
bins, corrected for the bits that agree by chance.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_health.llm.words import SHINGLE, words

#: Bins (a power of two) and bits kept of each; a bin's bits are one hexadecimal digit.
BIN_BITS = 8
BINS = 1 << BIN_BITS
KEPT_BITS = 4
#: Draws of an empty bin before it goes through the filled bins in its own order.
ASKED = 16

_REST = 63 - BIN_BITS
_MASK = (1 << _REST) - 1


def _asks(bin_: Column, k: int) -> Column:
    """The bin that an empty bin asks in its k-th try: a multiply-shift hash of its number."""
    factor = random.Random(k).getrandbits(31) | 1
    return F.shiftright(((bin_ + 1).cast("bigint") * factor).bitwiseAND(F.lit((1 << 31) - 1)), 31 - BIN_BITS).cast("int")


def _densified(bins: str, filled: str) -> Column:
    """The bins, empty ones with the value of the first filled one in their sequence."""

    def fill(x: Column, j: Column) -> Column:
        draws = (F.get(F.col(bins), _asks(j, k)) for k in range(ASKED))
        ordered = F.transform(filled, lambda f: F.struct(F.xxhash64(f["bin"], j).alias("order"), f["value"].alias("value")))
        return F.coalesce(x, *draws, F.array_min(ordered)["value"])

    return F.transform(bins, fill)


def with_bins(df: DataFrame, text: str, into: str) -> DataFrame:
    """Adds the fingerprint of a text column as an array of BINS small numbers, empty for a text without words.

    A text with fewer than five words is one shingle. Null is the empty text.
    """
    w, h, s, p, m, f, d = (f"_{into}_{x}" for x in "whspmfd")
    n = F.size(h)
    df = df.withColumn(w, words(F.col(text)))
    df = df.withColumn(h, F.transform(w, lambda x: F.xxhash64(x)))
    each = F.transform(
        F.slice(h, 1, F.greatest(n - (SHINGLE - 1), F.lit(1))),
        lambda x, i: F.xxhash64(x, *(F.get(F.col(h), i + k) for k in range(1, SHINGLE))).bitwiseAND(F.lit((1 << 63) - 1)),
    )
    df = df.withColumn(s, each)
    # one value above all others closes each bin, so that each bin has a least value after sorting
    ends = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.shiftleft(b.cast("bigint"), _REST) + F.lit(_MASK))
    df = df.withColumn(p, F.sort_array(F.concat(F.col(s), ends)))
    firsts = F.filter(
        p, lambda x, i: (i == 0) | (F.shiftright(x, _REST) != F.shiftright(F.get(F.col(p), i - 1), _REST))
    )
    rest = F.transform(firsts, lambda x: F.nullif(x.bitwiseAND(F.lit(_MASK)), F.lit(_MASK)))
    df = df.withColumn(m, rest)
    own = F.transform(m, lambda x, j: F.struct(j.alias("bin"), x.alias("value")))
    df = df.withColumn(f, F.filter(own, lambda x: x["value"].isNotNull())).withColumn(d, _densified(m, f))
    # the bin's number goes into its bits, so that one value in many bins agrees by chance in each anew
    low = F.transform(
        d,
        lambda x, j: F.xxhash64(x, j).bitwiseAND(F.lit((1 << KEPT_BITS) - 1)).cast("tinyint"),
    )
    df = df.withColumn(into, F.when(n > 0, low).otherwise(F.array().cast("array<tinyint>")))
    return df.drop(w, h, s, p, m, f, d)


def packed(bins: Column) -> Column:
    """The fingerprint as text: a hexadecimal digit for each bin; empty for a text without words."""
    digits = F.array(*map(F.lit, "0123456789abcdef"))
    return F.array_join(F.transform(bins, lambda x: F.get(digits, x.cast("int"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingles; 1 for two texts without words, 0 for one."""
    chance = 1.0 / (1 << KEPT_BITS)
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) / F.lit(float(BINS))
    corrected = F.greatest(F.lit(0.0), (same - chance) / (1.0 - chance))
    return (
        F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
        .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
        .otherwise(corrected)
    )


def fingerprint(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of each document's text."""
    return with_bins(docs.select("doc_id", "text"), "text", "_bins").select(
        "doc_id", packed(F.col("_bins")).alias("fingerprint")
    )


def _runs(docs: DataFrame, runs: int | None) -> tuple[DataFrame, DataFrame]:
    """The rows with `_run`, the number of the range of ids they are in, and of each range the first rows again.

    Ranges are cut at approximate quantiles of the ids, so they are about equal. The
    first rows of a range come again with `_again` in the range before it, which is
    where the order goes on; those of the first range come again in the last.
    """
    spark = docs.sparkSession
    runs = runs or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = max(1, min(runs, 1 << 14))  # the cuts are literals of the plan
    shares = [i / runs for i in range(1, runs)]
    cuts = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 100 * runs)).first()[0] or [])) if shares else []
    step = max(1, int(len(cuts) ** 0.5))
    if cuts:
        every, coarse = F.array(*map(F.lit, cuts)), F.array(*map(F.lit, cuts[::step]))
        block = F.size(F.filter(coarse, lambda c: c <= F.col("doc_id"))) - 1
        within = F.size(F.filter(F.slice(every, F.greatest(block, F.lit(0)) * step + 1, step), lambda c: c <= F.col("doc_id")))
        run = F.when(F.col("doc_id").isNull(), -1).when(block < 0, 0).otherwise(block * step + within)
    else:
        run = F.when(F.col("doc_id").isNull(), -1).otherwise(0)
    numbered = docs.withColumn("_run", run)
    first = sorted(((r._run, r.head) for r in numbered.groupBy("_run").agg(F.max("doc_id").alias("head")).collect()), reverse=True)
    goes = [(head, first[i - 1][0]) for i, (_, head) in enumerate(first)]  # the first one's goes to the last
    heads = F.broadcast(spark.createDataFrame(goes, "_head bigint, _to int"))
    again = docs.join(heads, F.col("doc_id").eqNullSafe(F.col("_head"))).withColumn("_run", F.col("_to")).drop("_head", "_to")
    return numbered, again


def compare_edited(docs: DataFrame, runs: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness to each other and to the next document.

    The next document is the one with the next lower doc_id; equal ids follow each
    other by text, nulls first, null ids come last of all, and after the last comes
    the first (a single document follows itself). The edited text ends with the start
    of the next document's text instead of its own last half. Null texts are empty.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    numbered, again = _runs(rows, runs)
    every = numbered.withColumn("_again", F.lit(False)).unionByName(again.withColumn("_again", F.lit(True)))
    order = Window.partitionBy("_run").orderBy("_again", F.col("doc_id").desc_nulls_last(), "text")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.expr("left(text, length(text) - _half)"), F.expr("left(_next, _half)"))
    out = (
        every.withColumn("_next", F.lead("text", 1, "").over(order))
        .withColumn("_half", half)
        .withColumn("_edited", edited)
        .drop("_next", "_half")
    )
    out = out.withColumns({"n_chars": F.length("text").cast("bigint"), "edited_sha256": F.sha2("_edited", 256)})
    out = with_bins(with_bins(out, "text", "_own"), "_edited", "_changed").drop("_edited")
    out = out.withColumn("_after", F.lead("_own").over(order)).where(~F.col("_again"))
    return out.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        packed(F.col("_own")).alias("fingerprint"),
        packed(F.col("_changed")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_changed")).alias("near_edited"),
        likeness(F.col("_own"), F.col("_after")).alias("near_next"),
    )
