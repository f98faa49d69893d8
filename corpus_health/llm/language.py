"""Language identification by rank-order profiles.

A profile is the list of a language's most frequent character n-grams (one to
three characters of lower-cased words, padded by a space), most frequent first.
A document gets the same kind of list from its whole text, and the distance to a
language is the sum over the document's n-grams of how far each is out of place
in the language's list; n-grams the list lacks count as far as a place can be.
The language with the least distance wins; ties go to the first by name.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpus_health.llm.common import map_rows

#: Places in a profile.
PLACES = 400
#: Texts whose n-grams are counted at once, and n-grams whose counts a task holds before it hands them on.
TOGETHER = 64
MOST_COUNTED = 1 << 20
#: Languages a model may have; the model's size is PLACES times this at most.
MOST_LANGUAGES = 1000
#: Score below which a document is rejected as no language of the model, whatever the learnt documents score.
LEAST_SCORE = 0.1
#: A language's own least score lies below this quantile of its documents' scores, by so many times the median's distance to it.
LOW = 0.05
MARGIN = 2.0
#: A language's quantiles count as much as those of all languages when it has so many documents, less with fewer.
STEADY = 100
UNKNOWN = "und"

_BITS = 21  # of a code point
_SPACE = 32


@cache
def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _codes(text: str) -> np.ndarray:
    """Lower-case letters, runs of anything else as one space, a space on both ends; empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, dtype=np.int64)
    padded = np.full(len(points) + 2, _SPACE, dtype=np.int64)
    padded[1:-1] = np.where(letter, points, _SPACE)
    keep = np.ones(len(padded), dtype=bool)
    keep[1:] = (padded[1:] != _SPACE) | (padded[:-1] != _SPACE)
    return padded[keep]


def _grams(text: str) -> np.ndarray:
    """All n-grams of a text as numbers: three code points of 21 bits, the unused ones zero."""
    one = _codes(text)
    if not len(one):
        return one
    two = (one[:-1] << _BITS) | one[1:]
    three = (two[:-1] << _BITS) | one[2:]
    return np.concatenate([one[one != _SPACE], two, three])


def _added(known, kinds: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts of n-grams and more of them, together."""
    if known is None:
        return kinds, counts
    every, place = np.unique(np.concatenate([known[0], kinds]), return_inverse=True)
    return every, np.bincount(place, weights=np.concatenate([known[1], counts]), minlength=len(every)).astype(np.int64)


def _counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(grams):
        return grams, grams
    grams = np.sort(grams)
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    return grams[first], np.diff(np.append(first, len(grams)))


def _ranked(text: str, places: int) -> np.ndarray:
    """A text's most frequent n-grams, ties by their number."""
    grams = _grams(text)
    if not len(grams):
        return grams
    kinds, counts = _counted(grams)
    if len(kinds) > places:  # those that can be among the first places, ties included
        least = np.partition(counts, len(counts) - places)[len(counts) - places]
        kinds, counts = kinds[counts >= least], counts[counts >= least]
    return kinds[np.argsort(-counts, kind="stable")][:places]


def profiles(docs: DataFrame, label: str = "lang", places: int = PLACES) -> DataFrame:
    """lang, gram, place: the profile of each label, learnt from all texts that have one.

    Counts are summed in each task by language and n-gram before the shuffle, so a
    language with most of the rows is no more work than another. Null labels, null
    texts and texts without a letter teach nothing; an empty table gives no profile.
    """
    labelled = docs.where(F.col(label).isNotNull() & F.col("text").isNotNull())

    def task(batches):
        schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
        by: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def out():
            for lang, (kinds, counts) in by.items():
                names = pa.array([lang] * len(kinds), pa.string())
                yield pa.RecordBatch.from_arrays([names, pa.array(kinds), pa.array(counts)], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                langs, texts = (c.to_pylist() for c in batch.slice(at, TOGETHER).columns)
                for lang in set(langs):
                    parts = [_grams(t) for x, t in zip(langs, texts, strict=True) if x == lang]
                    by[lang] = _added(by.get(lang), *_counted(np.concatenate(parts)))
            if sum(len(kinds) for kinds, _ in by.values()) > MOST_COUNTED:
                yield from out()
                by.clear()
        yield from out()

    counts = labelled.select(F.col(label).alias("lang"), "text").mapInArrow(task, "lang string, gram bigint, n bigint")
    total = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    # compared as it is, so that tasks hand on the first places of a language only
    ranked = total.withColumn("place", F.row_number().over(order)).where(F.col("place") <= places)
    return ranked.select("lang", "gram", (F.col("place") - 1).alias("place"))


class Model:
    """Profiles as a matrix: a row for each n-gram of any, a column for each language, places as values."""

    def __init__(self, rows: list[tuple[str, int, int]], places: int = PLACES):
        self.places = places
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.array(sorted({r[1] for r in rows}), dtype=np.int64)
        self.table = np.full((len(self.grams) + 1, max(1, len(self.langs))), places, dtype=np.int64)
        number = {lang: i for i, lang in enumerate(self.langs)}
        for lang, gram, place in rows:
            self.table[np.searchsorted(self.grams, gram), number[lang]] = place

    def predict(self, text: str | None) -> tuple[str, float]:
        own = _ranked(text or "", self.places)
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == own, at, len(self.grams))
        rows = self.table[at]
        away = np.where(rows == self.places, self.places, np.abs(rows - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(away))
        return self.langs[best], 1.0 - float(away[best]) / (self.places * len(own))


def learn(docs: DataFrame, label: str = "lang", places: int = PLACES) -> Model:
    """The model of a table's labelled documents: at most `places` rows of each language come to the driver."""
    rows = profiles(docs, label, places).limit(places * MOST_LANGUAGES + 1).collect()
    if len(rows) > places * MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} values of {label}")
    return Model([(r.lang, r.gram, r.place) for r in rows], places)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of each document, from its text alone.

    lang_pred is `und` with score 0 for a null text, a text without a letter, or a
    model without languages. The score is 1 minus the distance as a share of the
    greatest possible one. Every row gets its own result, repeated ids too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def begin():
        known = shared.value

        def run(ids, texts):
            made = [known.predict(t) for t in texts]
            return ids, [m[0] for m in made], [m[1] for m in made]

        return run

    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, lang_pred string, score double", begin)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept out of training: one in five, by the CRC-32 of its id as text; none without id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def predict_all(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out and predict all."""
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    return identify(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def limits(docs: DataFrame, model: Model, label: str = "lang") -> dict[str, float]:
    """The least score of each language, from what its labelled documents score: a margin below a low quantile.

    Only documents that get their own label count. A language's quantiles are drawn towards
    those of all languages together, the less the more documents it has; one without any
    has theirs. Quantiles are sketched in each task and merged; limits are rounded down to
    hundredths, so that sketches made anew agree. Where nothing is labelled there are none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def begin():
        known = shared.value

        def run(langs, texts):
            made = [(lang, *known.predict(t)) for lang, t in zip(langs, texts, strict=True)]
            own = [(lang, score) for lang, best, score in made if lang == best != UNKNOWN]
            return [o[0] for o in own], [o[1] for o in own]

        return run

    labelled = docs.where(F.col(label).isNotNull() & F.col("text").isNotNull()).select(F.col(label).alias("lang"), "text")
    scores = map_rows(labelled, "lang string, score double", begin)
    cut = F.percentile_approx("score", [LOW, 0.5], 10_000).alias("cut")
    found = scores.rollup("lang").agg(F.count(F.lit(1)).alias("n"), cut).collect()  # a row for each language, and one for all
    by = {r.lang: r for r in found if r.n}
    every = by.pop(None, None)
    if every is None:
        return {}

    def limit(lang: str) -> float:
        own = by.get(lang)
        n, cuts = (0, every.cut) if own is None else (own.n, own.cut)
        low, middle = ((n * x + STEADY * y) / (n + STEADY) for x, y in zip(cuts, every.cut, strict=True))
        return math.floor(100 * (low - MARGIN * (middle - low))) / 100

    return {lang: limit(lang) for lang in model.langs}


def keep_known(docs: DataFrame, model: Model, least: float = LEAST_SCORE, own: dict[str, float] | None = None) -> DataFrame:
    """The documents, all columns as they were, whose text is of a language that the model knows.

    Rejected are texts that get `und` and those whose score is under `least` or under
    their language's limit in `own`.
    """
    text = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast((model, own or {}))

    def task(batches):
        known, limit = shared.value
        for batch in batches:
            made = (known.predict(t.as_py()) for t in batch.column(text))
            stays = [lang != UNKNOWN and score >= max(least, limit.get(lang, least)) for lang, score in made]
            yield batch.filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(task, docs.schema)
