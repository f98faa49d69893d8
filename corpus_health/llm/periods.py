"""Periodic runs: stretches of words that repeat with a period, found by uniting suffixes by falling LCP.

The suffixes of a document's words are sorted, and neighbours in that order are united
from the largest common prefix down. Each class of suffixes keeps its positions in
order. Where two classes meet at prefix length c, positions i < j that become
neighbours in the new class share exactly c words; if j - i <= c, the words from i to
j + c have period j - i. It is the smallest one, since a smaller one would have put a
position of the same class between i and j; and each run is met once, at its first
two positions. Runs have LEAST words or more, so prefixes under LEAST / 2 words can't
make one, and documents that repeat no LEAST / 2 words are done without sorting.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpus_health.llm.common import map_rows
from corpus_health.llm.words import mixed, words

#: Words of the shortest run; a run also holds its period twice.
LEAST = 12
#: Documents that are looked at together in a task.
TOGETHER = 32

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _repeating(numbers: np.ndarray, owner: np.ndarray, size: int) -> np.ndarray:
    """The owners of words in which some `size` words come twice; by hashes, so at most too many."""
    n = len(numbers) - size + 1
    if n < 2:
        return np.empty(0, dtype=np.int64)
    out = mixed(owner[:n].astype(np.uint64) + np.uint64(1))
    for i in range(size):
        out = mixed(out * _STEP + numbers[i : i + n].astype(np.uint64))
    whole = owner[:n] == owner[size - 1 :]
    out, owner = out[whole], owner[:n][whole]
    order = np.argsort(out)
    again = out[order[1:]] == out[order[:-1]]
    return np.unique(owner[order[1:][again]])


def _sorted_suffixes(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes in order, and how many words each shares with the one before it (0 for the first)."""
    n = len(numbers)
    ranks = [np.append(np.unique(numbers, return_inverse=True)[1].astype(np.int64), -1)]  # by prefixes of 1, 2, 4 ... words
    order, length = np.argsort(ranks[0][:n], kind="stable"), 1
    while ranks[-1].max() < n - 1:
        last = ranks[-1]
        key = last[:n] * (n + 1)
        key[: max(0, n - length)] += last[length:n] + 1
        order = np.argsort(key, kind="stable")
        value = key[order]
        rank = np.full(n + 1, -1, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], value[1:] != value[:-1]]))
        ranks.append(rank)
        length *= 2
    shared = np.zeros(n, dtype=np.int64)
    a, b = order[:-1], order[1:]
    for level in range(len(ranks) - 1, -1, -1):
        at = shared[1:]
        ranked = ranks[level]
        shared[1:] += (ranked[np.minimum(a + at, n)] == ranked[np.minimum(b + at, n)]).astype(np.int64) << level
    return order, shared


def find(numbers: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of each maximal run of at least `least` items and two periods, in order."""
    if len(numbers) < least:
        return []
    order, shared = _sorted_suffixes(numbers)
    places = np.flatnonzero(shared >= (least + 1) // 2)
    places = places[np.argsort(-shared[places], kind="stable")]
    own: dict[int, list[int]] = {}  # the class of a position, shared by its members
    word = numbers.tolist()
    out = []
    for i, j, c in zip(order[places - 1].tolist(), order[places].tolist(), shared[places].tolist(), strict=True):
        big, small = own.get(i) or own.setdefault(i, [i]), own.get(j) or own.setdefault(j, [j])
        if len(big) < len(small):
            big, small = small, big
        last = -1
        for k, x in enumerate(small):
            at = bisect_left(big, x)
            pairs = []
            if at and big[at - 1] > last:
                pairs.append((big[at - 1], x))
            if at < len(big) and (k + 1 == len(small) or big[at] < small[k + 1]):
                pairs.append((x, big[at]))
            last = x
            for p, q in pairs:
                if q - p <= c and q - p + c >= least and (p == 0 or word[p - 1] != word[q - 1]):
                    out.append((p, q - p + c, q - p))
        for x in small:
            own[x] = big
        if len(small) == 1:
            insort(big, small[0])
        else:
            big += small
            big.sort()  # two sorted parts: one merge
    return sorted(out, key=lambda r: (r[0], r[2]))


def _kept(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay if each run keeps its first period only."""
    change = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change)[:n] == 0


def collapse(docs: DataFrame) -> DataFrame:
    """doc_id, runs (start, length, period; words count from 0), kept: the periodic runs of each text, and the text
    without what repeats a run's first period, its words joined by one space.

    Words are what stands between blanks and ASCII controls. A run is a stretch of words
    with smallest period q, of at least 12 words and two periods, that can't be extended.
    A null, empty or blank text has no run and keeps nothing; each of several equal rows,
    and rows with null ids, have results of their own. Other columns are not read. A
    document's words are held by one task, some hundred bytes each.
    """

    def begin():
        def run(ids, texts):
            parts = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]
            number: dict[bytes, int] = {}
            flat = np.array([number.setdefault(w, len(number)) for p in parts for w in p], dtype=np.int64)
            size = np.array([len(p) for p in parts])
            end = np.cumsum(size)
            owner = np.repeat(np.arange(len(parts)), size)
            runs, kept = [[] for _ in parts], [b" ".join(p) for p in parts]
            for d in _repeating(flat, owner, (LEAST + 1) // 2).tolist():
                own = flat[end[d] - size[d] : end[d]]
                if found := find(own):
                    runs[d] = [{"start": s, "length": n, "period": q} for s, n, q in found]
                    kept[d] = b" ".join([w for w, k in zip(parts[d], _kept(len(own), found).tolist(), strict=True) if k])
            return ids, runs, kept

        return run

    rows = docs.select("doc_id", "text")
    schema = "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, kept binary"
    return map_rows(rows, schema, begin, TOGETHER)


def echo(docs: DataFrame) -> DataFrame:
    """doc_id, text: the documents whose id has a crc32 that 10 divides get a periodic tail, by which the search is tried.

    Of the n words of such a text the p from number a on repeat to its end; a and p follow
    from the crc32. All other texts, and those with null ids, stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found, n, g = words(F.col("text")), F.col("n"), F.floor(h / 10)
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))

    def tail(k: Column) -> Column:
        return F.get(F.col("words"), (F.col("a") + k % F.col("p")).cast("int"))

    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    rows = docs.select("doc_id", "text", F.when(chosen, found).alias("words"))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(n > 0, a)).withColumn("p", F.when(n > 0, p))
    head = F.slice("words", 1, F.col("a").cast("int"))
    rest = F.transform(F.sequence(F.lit(0).cast("bigint"), n - F.col("a") - 1), tail)
    return rows.select("doc_id", F.when(n > 0, F.array_join(F.concat(head, rest), " ")).otherwise(F.col("text")).alias("text"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli of the longest run (ties: the first, then the shortest
    period), runs_sha256, collapsed_sha256 of each document; nulls where it has no run."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length = -F.col("best.less")
    return collapse(docs).withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        F.col("best.period").alias("period"),
        F.floor(1000 * length / F.col("best.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2("kept", 256).alias("collapsed_sha256"),
    )
