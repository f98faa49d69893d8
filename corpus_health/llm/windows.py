"""Removal of repeated word windows: Rabin-Karp hashes of all windows, counted in Spark.

1. Tasks hash the window of WINDOW words that starts at each word, with two rolling
   hashes; the second one names a bucket. Equal windows of a slice of documents are
   put together before the shuffle, so a window that a third of all documents hold is
   one entry for each slice, not for each document.
2. Each bucket sorts its entries and finds, for each window, the least doc_id that has
   it. Documents with a greater one get the window's hash back.
3. Texts and the hashes that come back meet by groups of documents; a task holds the
   hashes of one group and takes its texts one after the other. Covered words merge
   into maximal intervals.

Entries of one slice and bucket travel as one row of packed numbers, which is half of
what single rows take, and so do a bucket's answers to one group; texts move once,
compressed. The number of buckets follows the
bytes of the input, so what one bucket holds does not grow. Two windows are taken for
equal if 64 bits of the first hash and the bucket agree; with a bucket for each 64 MB
these are as good as 84 bits at 100 TB.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_health.llm.common import map_rows
from corpus_health.llm.words import mixed

#: Fixed by the task: words of a window.
WINDOW = 20
#: Words of the documents that a task looks at together.
SLICE_WORDS = 1 << 19
#: Bytes of text for each bucket: bounds what one holds.
BUCKET_BYTES = 64 << 20
#: Word hashes that a task remembers.
KNOWN_WORDS = 1 << 18

#: Texts that a task looks at together.
TOGETHER = 64

_NOTHING = np.empty(0, dtype=np.uint64)
_BASES = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: Documents without id count as ones with the greatest; this, added to their part, tells them from such.
_NO_ID, _NONE = np.iinfo(np.int64).max, 1 << 40


class _Words(dict):
    """64-bit hashes of words; those met are remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def rolling(values: np.ndarray, base: np.uint64, size: int = WINDOW) -> np.ndarray:
    """Rabin-Karp hashes, modulo 2 ** 64, of the windows that start at each value: v0 * base ** (size - 1) + ... + v(size - 1)."""
    n = len(values) - size + 1
    if n < 1:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    done = 0  # of the window, from its start
    part, length, factor = values, 1, base
    with np.errstate(over="ignore"):
        while True:  # by doubling: hashes of 1, 2, 4 ... values
            if size & length:  # the windows' next `length` values
                out = out * factor + part[done : done + n]
                done += length
            if done == size:
                return mixed(out)
            part = part[:-length] * factor + part[length:]
            factor, length = factor * factor, 2 * length


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers as differences, byte place by byte place, so that what they have in common shrinks."""
    steps = np.diff(numbers, prepend=numbers.dtype.type(0))
    planes = steps.view(np.uint8).reshape(len(steps), -1).T
    return zstandard.compress(planes.tobytes(), 1)


def _unpack(data: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8)
    size = np.dtype(kind).itemsize
    return np.cumsum(np.ascontiguousarray(planes.reshape(size, -1).T).view(kind).ravel(), dtype=kind)


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, part (a hash of the text, for ids that are not unique) and text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.hash(text).alias("part"), text.alias("text"))


def _hashes(parts: list[list[bytes]], known: _Words, bases: tuple) -> tuple[np.ndarray, ...]:
    """Of all windows of some documents, in order: number of the document, place of the first word among all, hashes by each base."""
    values = known.of([w for p in parts for w in p])
    size = np.array([len(p) for p in parts], dtype=np.int64)
    windows = np.maximum(size - WINDOW + 1, 0)
    owner = np.repeat(np.arange(len(parts)), windows)
    at = np.arange(len(owner)) + np.repeat(np.cumsum(size) - size - np.cumsum(windows) + windows, windows)
    return owner, at, *(rolling(values, b)[at] if len(at) else np.empty(0, dtype=np.uint64) for b in bases)


def _group(ids: np.ndarray, parts: np.ndarray, groups: int) -> np.ndarray:
    """Where a document's text and hashes meet."""
    return (mixed(ids.astype(np.uint64) * _BASES[0] + parts.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)


def _addresses(ids: list[int | None], parts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Ids and parts as numbers; both together also tell documents without id from those with the greatest."""
    return (
        np.array([_NO_ID if i is None else i for i in ids], dtype=np.int64),
        np.array([p + (_NONE if i is None else 0) for i, p in zip(ids, parts, strict=True)], dtype=np.int64),
    )


_ENTRIES = pa.schema(
    [
        ("bucket", pa.int32()),
        ("decided", pa.bool_()),
        ("ids", pa.binary()),
        ("parts", pa.binary()),
        ("owners", pa.binary()),
        ("hashes", pa.binary()),
    ]
)
_DDL = "bucket int, decided boolean, ids binary, parts binary, owners binary, hashes binary"


def _entries(rows: list[tuple[int | None, int, list[bytes]]], buckets: int, known: _Words) -> Iterator[tuple]:
    """Rows of _ENTRIES for a slice: what its buckets must judge, and what is decided within the slice."""
    rows = sorted(rows, key=lambda r: (_NO_ID if r[0] is None else r[0], r[1]))
    ids, parts = _addresses([r[0] for r in rows], [r[1] for r in rows])
    owner, _, one, two = _hashes([r[2] for r in rows], known, _BASES)
    if not len(owner):
        return
    bucket = (two % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((owner, one, bucket))
    owner, one, bucket = owner[order], one[order], bucket[order]
    new = np.concatenate([[True], (one[1:] != one[:-1]) | (bucket[1:] != bucket[:-1])])
    least = ids[owner[np.flatnonzero(new)]][np.cumsum(new) - 1]  # of the window, in this slice
    once = np.concatenate([[True], ~((one[1:] == one[:-1]) & (bucket[1:] == bucket[:-1]) & (owner[1:] == owner[:-1]))])
    open_ = ids[owner] == least

    ours = np.flatnonzero(once & open_)
    for at in np.split(ours, np.flatnonzero(np.diff(bucket[ours])) + 1):
        yield int(bucket[at[0]]), False, *_packed_rows(ids, parts, owner[at], one[at])
    # a document's decided windows go to one bucket, whichever slice decided them
    late = np.flatnonzero(once & ~open_)
    to = _group(ids, parts, buckets)[owner[late]]
    for which in np.unique(to).tolist():
        at = late[to == which]
        yield which, True, *_packed_rows(ids, parts, owner[at], one[at])


def _packed_rows(ids: np.ndarray, parts: np.ndarray, owner: np.ndarray, hashes: np.ndarray) -> tuple[bytes, bytes, bytes, bytes]:
    """Hashes with the documents that they are of."""
    used, own = np.unique(owner, return_inverse=True)
    return _pack(ids[used]), _pack(parts[used]), zstandard.compress(own.astype(np.uint32).tobytes(), 1), _pack(hashes)


def _unpacked_rows(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same as ids, parts and hashes, those of all rows together."""
    out = []
    for row in rows:
        own = np.frombuffer(zstandard.decompress(row["owners"]), dtype=np.uint32)
        out.append((_unpack(row["ids"], np.int64)[own], _unpack(row["parts"], np.int64)[own], _unpack(row["hashes"], np.uint64)))
    kinds = np.int64, np.int64, np.uint64
    return tuple(np.concatenate([np.empty(0, dtype=k), *c]) for k, c in zip(kinds, zip(*out, strict=True) if out else ((), (), ()), strict=True))


def _judged(rows: DataFrame, buckets: int) -> DataFrame:
    """For each group of documents, packed: the windows that also start in a document with a smaller id."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, waiting, total = _Words(), [], 0

        def out(rows):
            columns = list(zip(*_entries(rows, buckets, known), strict=True)) or [()] * len(_ENTRIES)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ENTRIES, strict=True)], schema=_ENTRIES)

        for batch in batches:
            for doc, part, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = text.encode("utf-8", "surrogatepass").split()
                if len(words) < WINDOW:
                    continue
                waiting.append((doc, part, words))
                total += len(words)
                if total >= SLICE_WORDS:
                    yield out(waiting)
                    waiting, total = [], 0
        if waiting:
            yield out(waiting)

    def judge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        ids, parts, one = _unpacked_rows([r for r in rows if not r["decided"]])
        order = np.lexsort((ids, one))
        ids, parts, one = ids[order], parts[order], one[order]
        new = np.concatenate([[True], one[1:] != one[:-1]])[: len(one)]
        late = ids != ids[np.flatnonzero(new)][np.cumsum(new) - 1]
        done = _unpacked_rows([r for r in rows if r["decided"]])
        ids, parts, one = (np.concatenate([x, y[late]]) for x, y in zip(done, (ids, parts, one), strict=True))
        group = _group(ids, parts, buckets)
        order = np.lexsort((one, parts, ids, group))
        ids, parts, one, group = ids[order], parts[order], one[order], group[order]
        owner = np.cumsum(np.concatenate([[False], (ids[1:] != ids[:-1]) | (parts[1:] != parts[:-1])]))[: len(ids)]
        first = np.flatnonzero(np.concatenate([[True], np.diff(owner) > 0]))[: len(ids)]
        fresh = np.concatenate([[True], (owner[1:] != owner[:-1]) | (one[1:] != one[:-1])])[: len(ids)]
        at = np.flatnonzero(fresh)
        out = []
        for part in np.split(at, np.flatnonzero(np.diff(group[at])) + 1) if len(at) else []:
            out.append((int(group[part[0]]), *_packed_rows(ids[first], parts[first], owner[part], one[part])))
        names = [("grp", pa.int32()), *((n, pa.binary()) for n in ("ids", "parts", "owners", "hashes"))]
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, names, strict=True)], schema=pa.schema(names))

    dealt = rows.mapInArrow(deal, _DDL)
    return dealt.groupBy("bucket").applyInArrow(judge, "grp int, ids binary, parts binary, owners binary, hashes binary")


def _grouped(rows: DataFrame, groups: int) -> DataFrame:
    """The rows with their group, and their text compressed: what the shuffle below carries."""

    def begin():
        pack = zstandard.ZstdCompressor(level=1).compress

        def run(ids, parts, texts):
            group = _group(*_addresses(ids, parts), groups).tolist()
            return group, ids, parts, [pack(t.encode("utf-8", "surrogatepass")) for t in texts]

        return run

    return map_rows(rows, "grp int, doc_id bigint, part int, packed binary", begin)


def _spans(parts: list[list[bytes]], late: list[np.ndarray], known: _Words) -> list[list[tuple[int, int]]]:
    """Of each document, the maximal runs (start, end) of words under windows that start earlier in it or are among its `late` ones."""
    owner, at, one = _hashes(parts, known, _BASES[:1])
    # a window's hash together with its document's number: equal within a document only
    own = one ^ mixed(owner.astype(np.uint64) + np.uint64(1))
    order = np.argsort(own, kind="stable")
    gone = np.zeros(len(own), dtype=bool)
    gone[order[1:][own[order[1:]] == own[order[:-1]]]] = True
    numbers = np.repeat(np.arange(len(late)), [len(x) for x in late]).astype(np.uint64)
    gone |= np.isin(own, np.concatenate([np.empty(0, dtype=np.uint64), *late]) ^ mixed(numbers + np.uint64(1)))
    size = np.array([len(p) for p in parts], dtype=np.int64)
    begin = np.cumsum(size) - size
    change = np.bincount(at[gone], minlength=size.sum() + 1) - np.bincount(at[gone] + WINDOW, minlength=size.sum() + 1)
    covered = np.cumsum(change)[:-1] > 0
    of = np.repeat(np.arange(len(parts)), size)
    starts = covered & np.concatenate([[True], ~covered[:-1] | (of[1:] != of[:-1])])[: len(of)]
    ends = covered & np.concatenate([~covered[1:] | (of[1:] != of[:-1]), [True]])[-len(of) :]
    out: list[list[tuple[int, int]]] = [[] for _ in parts]
    firsts = np.flatnonzero(starts)
    whose = of[firsts]
    for d, a, b in zip(whose.tolist(), (firsts - begin[whose]).tolist(), (np.flatnonzero(ends) + 1 - begin[whose]).tolist(), strict=True):
        out[d].append((a, b))
    return out


def remove(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, spans (start, end; words count from 0), kept: each text without its repeated windows.

    Words are what stands between blanks and ASCII controls. A word goes if a window of 20
    words that covers it also starts in a document with a smaller doc_id, or earlier in the
    same document. Windows are judged on the input. `kept` joins the other words by one
    space. A null text has no words, texts under 20 words stay. Rows with the same doc_id
    don't remove each other's windows; a null id counts as the greatest one. Other columns
    are not read.
    """
    rows = _identified(docs)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    found = _judged(rows, buckets)
    # a group's hashes come before its texts
    both = found.unionByName(_grouped(rows, buckets), allowMissingColumns=True)
    met = both.repartition("grp").sortWithinPartitions("grp", F.col("packed").isNotNull())
    names = ["grp", "doc_id", "part", "packed", "ids", "parts", "owners", "hashes"]
    ddl = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"
    schema = docs.sparkSession.createDataFrame([], ddl).limit(0).toArrow().schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, group, answers = _Words(), None, []
        late: dict[tuple[int, int], np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor().decompress

        def out(rows: list[dict]) -> pa.RecordBatch:
            parts = [unpack(r["packed"]).split() for r in rows]
            keys = zip(*(c.tolist() for c in _addresses([r["doc_id"] for r in rows], [r["part"] for r in rows])), strict=True)
            spans = _spans(parts, [late.get(k, _NOTHING) for k in keys], known)
            kept = []
            for words, gone in zip(parts, spans, strict=True):
                left, at = [], 0
                for a, b in gone:
                    left += words[at:a]
                    at = b
                kept.append(b" ".join([*left, *words[at:]]))
            columns = (
                [r["doc_id"] for r in rows],
                [len(p) for p in parts],
                [sum(b - a for a, b in g) for g in spans],
                [[{"start": a, "end": b} for a, b in g] for g in spans],
                kept,
            )
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            for at in range(0, batch.num_rows, TOGETHER):
                waiting: list[dict] = []
                for row in batch.slice(at, TOGETHER).to_pylist():
                    if row["grp"] != group:
                        if waiting:
                            yield out(waiting)
                        group, answers, late, waiting = row["grp"], [], {}, []
                    if row["packed"] is None:
                        answers.append(row)
                        continue
                    if answers:
                        late, answers = _by_document(answers), []
                    waiting.append(row)
                if waiting:
                    yield out(waiting)

    return met.select(*names).mapInArrow(task, ddl)


def _by_document(answers: list[dict]) -> dict[tuple[int, int], np.ndarray]:
    ids, parts, one = _unpacked_rows(answers)
    order = np.lexsort((parts, ids))
    ids, parts, one = ids[order], parts[order], one[order]
    first = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (parts[1:] != parts[:-1])])[: len(ids)])
    return dict(zip(zip(ids[first].tolist(), parts[first].tolist(), strict=True), np.split(one, first[1:]), strict=True))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of each document."""
    return remove(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
