"""Spelling variants: words of a corpus within one edit of each other, by a scan of sorted vocabulary.

Two words one edit apart agree before and after it. Their first difference falls into
one of GAPS parts of the shorter word, and all before and after that part is equal. So
each word is listed under what lies around each of its parts (as the shorter and as the
longer word of a pair), and each list holds the parts themselves in order.

A list is scanned for each of its entries: rows of the edit matrix, three cells wide, are
kept for each character; the next entry reuses the rows of the prefix that it shares with
the one before (their LCP), and where a row has no cell under two, all entries with that
prefix are skipped at once. A pair counts only in the part with its first difference, so
it counts once.

Lists of more than LONGEST words are cut anew into parts of one character. Such lists
can't be long: their entries are at most two characters.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_health.llm.common import land

#: Fixed by the task: letters of words, the least length of words that are grouped, the least count.
LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
#: How many times as often as a word its form occurs at least.
RATIO = 10
#: Parts of a word.
GAPS = 3
#: Words of a list that is scanned as it is.
LONGEST = 5_000

#: After every letter.
_TOP = chr(0x10FFFF)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, drop: int | None = None) -> DataFrame:
    """word, n: the lower-cased runs of letters of at least `least_length`, and how often they occur.

    A null text has none, other columns are not read, repeated rows count again. With
    `drop`, a run whose crc32 with its document's id is a multiple of `drop` loses one
    letter (of which the crc32 tells the place): misspellings to try the search with. A
    null id counts as an empty one.
    """
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))).alias("run"))
    word = F.translate("run", _UPPER, _LOWER)
    if drop:
        h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
        at = (F.col("h") % F.length("run")).cast("int")
        less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        runs = runs.select("doc_id", word.alias("run")).withColumn("h", h)
        word = F.when(F.col("h") % drop == 0, less).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


_KEY = ["m", "first", "size", "last", "around"]


def _listed(words: DataFrame, first: Column, size: Column) -> DataFrame:
    """m, first, size, last, around, rest, word, n: the words by what lies around the part of `size` letters after the first `first` of m."""
    length = F.length("word")
    at = words.withColumn("first", first.cast("int")).withColumn("size", size.cast("int"))
    after = F.col("m") - F.col("first") - F.col("size")
    before, behind = F.substring("word", F.lit(1), F.col("first")), F.substring("word", length - after + 1, after)
    return at.select(
        "m",
        "first",
        "size",
        (after == 0).alias("last"),
        F.concat(before, F.lit(" "), behind).alias("around"),
        F.substring("word", F.col("first") + 1, length - F.col("first") - after).alias("rest"),
        "word",
        "n",
    )


def lists(words: DataFrame) -> DataFrame:
    """The words under all their parts; parts with too many words are cut anew into parts of one letter."""
    length = F.length("word")
    m, i = F.col("m"), F.col("i")
    least = words.agg(F.min(F.length("word"))).first()[0]
    paired = words.withColumn("m", F.explode(F.array(length, length - 1))).where(m >= F.lit(least))
    parts = paired.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(GAPS - 1))))
    first, stop = F.floor(i * m / GAPS), F.floor((i + 1) * m / GAPS)
    coarse = _listed(parts, first, stop - first)
    long = coarse.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > LONGEST).where("size > 1")
    long = land(long.drop("words"), "long-lists")
    cut = coarse.join(long, _KEY, "left_semi").select("word", "n", "m", F.explode(F.sequence("first", F.col("first") + F.col("size") - 1)).alias("i"))
    return coarse.join(long, _KEY, "left_anti").unionByName(_listed(cut, i, F.lit(1)))


def near(rests: list[str], shorter: int, last: bool) -> Iterator[tuple[int, int]]:
    """(i, j), i < j: the entries of a sorted list that are one edit apart and differ within their first `shorter` letters.

    If the list is of the `last` parts of words, they may also differ behind these.
    """
    n = len(rests)
    shared = [0] * n  # letters in common with the entry before
    for j in range(1, n):
        a, b = rests[j - 1], rests[j]
        k = 0
        while k < len(a) and k < len(b) and a[k] == b[k]:
            k += 1
        shared[j] = k
    for i in range(n - 1):
        word, size = rests[i] + "\0\0\0", len(rests[i])
        rows = [(2, 0, 1)]  # rows[d]: edits from the entry's first d letters to the word's first d - 1, d, d + 1; 2 is too many
        equal = shared[i + 1]  # letters that entry and word have in common
        have, j = 0, i + 1
        while j < n:
            entry, d = rests[j], have
            del rows[have + 1 :]
            while d < len(entry):
                letter, (a, b, c) = entry[d], rows[d]
                d += 1
                a = min(a + (letter != word[d - 2]), b + 1)
                b = min(b + (letter != word[d - 1]), c + 1, a + 1)
                c = min(c + (letter != word[d]), b + 1)
                if a > 1 and b > 1 and c > 1:
                    break
                rows.append((a, b, c))
            if len(rows) > len(entry):
                if abs(size - len(entry)) < 2 and rows[-1][size - len(entry) + 1] == 1 and min(size, len(entry)) == shorter and (last or equal < shorter):
                    yield i, j
                j += 1
                have = shared[j] if j < n else 0
            else:
                prefix = entry[:d]
                j = bisect_left(rests, prefix + _TOP, j + 1)
                have = 0
                while j < n and have < len(rests[j]) and prefix[have] == rests[j][have]:
                    have += 1
            equal = min(equal, have)


def neighbours(words: DataFrame) -> DataFrame:
    """word, n_near, best (less: minus its n, word): for each word with others one edit away their number and the most frequent of them (ties: the first)."""
    dealt = lists(words).repartition(*_KEY).sortWithinPartitions(*_KEY, "rest").select("m", "first", "size", "last", "around", "rest", "word", "n")
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("n", pa.int64()), ("best", pa.string())])

    def scan(key: tuple, rests: list[str], names: list[str], counts: list[int], out: list[tuple]) -> None:
        found: dict[int, list] = {}
        for i, j in near(rests, key[2], key[3]):
            for x, y in ((i, j), (j, i)):
                own = found.setdefault(x, [0, (1, "")])
                own[0] += 1
                own[1] = min(own[1], (-counts[y], names[y]))
        out += [(names[x], k, -best[0], best[1]) for x, (k, best) in found.items()]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rests, names, counts, out = None, [], [], [], []
        for batch in batches:
            *keys, rest, word, n = (c.to_pylist() for c in batch.columns)
            for new, r, w, k in zip(zip(*keys, strict=True), rest, word, n, strict=True):
                if new != key:
                    if len(rests) > 1:
                        scan(key, rests, names, counts, out)
                    key, rests, names, counts = new, [], [], []
                rests.append(r)
                names.append(w)
                counts.append(k)
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in out], schema=schema)
            out = []
        if len(rests) > 1:
            scan(key, rests, names, counts, out)
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row, strict=True)) for row in out], schema=schema)

    each = dealt.mapInArrow(task, "word string, n_near bigint, n bigint, best string")
    best = F.struct((-F.col("n")).alias("less"), F.col("best").alias("word"))
    return each.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(best).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where each word's forms lead in the end. Steps double from round to round, so rounds are few."""
    jumps = land(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = jumps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = jumps.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        jumps = land(further, "roots")
        if jumps.where("moved").isEmpty():
            return jumps.drop("moved")
        jumps = jumps.drop("moved")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of a vocabulary (word, n; each word once, none null).

    A word's form is the most frequent of the words one edit away (ties: the first in
    code-point order), if that one occurs `ratio` times as often or more; root is where
    forms lead. Letters are code points. Words of any length and any letters will do; an
    empty table gives none.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent than their words, else they may lead in circles")
    words = land(words.select("word", "n"), "vocabulary")
    found = words.join(neighbours(words), "word", "left")
    better = -F.col("best.less") >= ratio * F.col("n")
    found = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(better, F.col("best.word")).alias("form"),
        F.when(better, -F.col("best.less")).alias("form_n"),
    )
    found = land(found, "variants")
    ends = roots(found.where(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
