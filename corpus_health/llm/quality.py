"""Quality rules with thresholds that follow each language and source, in built-in expressions only.

Base figures of each text are counted, the shares made of them go into mergeable
quantile sketches for each (language, source), and a share's limits are the
quartiles of its group widened by a multiple of their distance. The limits are
joined to the documents, and a document outside its group's limits fails.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_health.llm.common import land
from corpus_health.llm.words import GAPS, words

#: What counts as a symbol, words of a window, fewest words, greatest share of repeated words.
SYMBOLS = "#*$%&|<>"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED = 50

#: Size of the sketches: rank error is about 0.2 %.
SKETCH_K = 1024
#: Quartile distances that a limit lies beyond the quartile.
REACH = 3.0
#: Shares judged, with the least distance from the quartile to a limit, and whether there is a lower limit too.
SHARES = {
    "symbol_share": (0.05, False),
    "dup_line_share": (0.5, False),
    "repeat_share": (0.3, False),
    "capital_share": (0.3, False),
    "word_length": (1.5, True),
}


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def figures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_capitals, n_symbols, n_lines, n_dup_lines, n_repeat_words of each text.

    A null text has no words. Lines are those with a word. Every row gets its own figures.
    """
    text = F.coalesce("text", F.lit(""))
    df = docs.select("doc_id", "lang", "source", text.alias("_text"))
    df = df.withColumns(
        {
            "_words": words(F.col("_text")),
            "_lines": F.filter(F.split("_text", "\n"), lambda x: F.length(_without(x, GAPS)) > 0),
            "word_chars": F.length(_without(F.col("_text"), GAPS)).cast("bigint"),
            "n_capitals": F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("bigint"),
            "n_symbols": (F.length("_text") - F.length(_without(F.col("_text"), SYMBOLS))).cast("bigint"),
        }
    ).drop("_text")
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("bigint"),
            "n_lines": F.size("_lines").cast("bigint"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
            "_windows": F.sort_array(
                F.transform(
                    F.slice("_words", 1, F.greatest(F.size("_words") - (WINDOW - 1), F.lit(0))),
                    lambda w, i: F.struct(
                        F.xxhash64(w, *(F.get(F.col("_words"), i + k) for k in range(1, WINDOW))).alias("h"), i.alias("i")
                    ),
                )
            ),
        }
    ).drop("_lines", "_words")

    def twice(x: Column, i: Column) -> Column:
        before, after = F.get(F.col("_windows"), i - 1)["h"], F.get(F.col("_windows"), i + 1)["h"]
        return F.coalesce((i > 0) & (before == x["h"]), F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

    starts = F.sort_array(F.transform(F.filter("_windows", twice), lambda x: x["i"]))
    df = df.withColumn("_starts", starts).drop("_windows")
    covered = F.aggregate(
        "_starts",
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, s: F.struct((a["n"] + F.least(F.lit(WINDOW), s - a["last"])).alias("n"), s.alias("last")),
        lambda a: a["n"].cast("bigint"),
    )
    return df.withColumn("n_repeat_words", covered).drop("_starts")


def _shares() -> dict[str, Column]:
    one = lambda c: F.greatest(F.col(c), F.lit(1)).cast("double")
    return {
        "symbol_share": F.col("n_symbols") / one("word_chars"),
        "dup_line_share": F.col("n_dup_lines") / one("n_lines"),
        "repeat_share": F.col("n_repeat_words") / one("n_words"),
        "capital_share": F.col("n_capitals") / one("word_chars"),
        "word_length": F.col("word_chars") / one("n_words"),
    }


def limits(shares: DataFrame, k: int = SKETCH_K, reach: float = REACH) -> DataFrame:
    """_lang, _source and for each share its lowest and highest value, from sketches of the documents with a word.

    Sketches are made in each task and merged after, so a source with most of the
    documents is no more than one row from each task. Null is a language and a source.
    Limits are rounded outwards to hundredths, so that sketches made anew agree.
    """
    sketches = [F.kll_sketch_agg_double(c, F.lit(k)).alias(c) for c in SHARES]
    by = shares.where("n_words > 0").groupBy(F.col("lang").alias("_lang"), F.col("source").alias("_source")).agg(*sketches)
    out = ["_lang", "_source"]
    for c, (least, both) in SHARES.items():
        low, high = (F.kll_sketch_get_quantile_double(F.col(c), F.lit(q)) for q in (0.25, 0.75))
        width = F.greatest(F.lit(least), F.lit(reach) * (high - low))
        lowest = F.floor((low - width) * 100) / 100 if both else F.lit(0.0)
        out += [lowest.cast("double").alias(f"{c}_low"), (F.ceil((high + width) * 100) / 100).cast("double").alias(f"{c}_high")]
    return by.select(*out)


def judge(docs: DataFrame) -> DataFrame:
    """The figures of each document, base_failed, and kept: not base_failed and within its group's limits.

    A document of a group without limits (none of its documents has a word) has no
    word itself and is base_failed. Repeated ids are judged row by row.
    """
    known = land(figures(docs), "quality-figures").withColumns(_shares())
    # few rows of limits come from one row a task and group; they are landed, so each task judges by the same
    cut = land(limits(known), "quality-limits")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    within = F.lit(True)
    for c in SHARES:
        within = within & F.col(c).between(F.col(f"{c}_low"), F.col(f"{c}_high"))
    joined = known.join(
        cut, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left"
    )
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.coalesce(within, F.lit(False))).alias("kept"),
    )
