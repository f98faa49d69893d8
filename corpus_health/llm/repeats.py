"""Removal of repeated passages: every byte that a repeated string of LENGTH bytes covers.

A string of LENGTH bytes is known by its anchor, the k-gram in it with the least
hash (the leftmost of equals), so equal strings have equal anchors at equal places.
Strings that share an anchor at one place of a text are neighbours; together they are
its context.

1. Anchors that occur once in the corpus have no repeated string; they are dropped.
2. Equal contexts are counted. Where a context occurs twice, all its strings do.
3. What is left are contexts that occur once, but whose anchor has other contexts. They
   are cut into pieces of STARTS neighbouring strings, which share a core. Pieces whose
   core occurs once are dropped; for the others, a suffix array over the pieces (the
   core as one symbol) brings equal strings next to each other.

No step needs the rows of one key together but the third, and there a core with more
than CROWD pieces is counted by its strings instead, each a key of its own.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_health.llm.common import land, map_rows
from corpus_health.llm.suffixes import suffix_array

#: Fixed by the task: bytes of a repeated string.
LENGTH = 200
#: Bytes of the k-grams that anchors are chosen from.
GRAM = 40
#: Strings of a piece.
STARTS = 16
#: Pieces of a core that may go into one suffix array.
CROWD = 20_000
#: Symbols that one suffix array takes at once, unless one core has more.
SYMBOLS = 4096
#: Bytes that are looked at together; positions in them fit the low bits of a packed number.
CHUNK = 1 << 20

_LOW = np.uint64(CHUNK * 2 - 1)
_BITS = np.uint64(21)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position."""
    with np.errstate(over="ignore"):
        table = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        table ^= table >> np.uint64(32)
        runs, length, factor = {1: table[data]}, 1, _FACTOR
        factors = {1: factor}
        while 2 * length <= GRAM:
            h = runs[length]
            runs[2 * length] = h[:-length] * factor + h[length:]
            factor = factor * factor
            length *= 2
            factors[length] = factor
        out, done = None, 0
        for size in sorted(runs, reverse=True):
            if done + size > GRAM:
                continue
            part = runs[size][done:]
            n = len(data) - done - size + 1
            out = part[:n] if out is None else out[:n] * factors[size] + part[:n]
            done += size
            if done == GRAM:
                break
        out = (out ^ (out >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
        return out ^ (out >> np.uint64(33))


def _chosen(hashes: np.ndarray) -> np.ndarray:
    """For each string's start, the position of its anchor."""
    span = LENGTH - GRAM + 1
    packed = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    length, least = 1, packed
    while 2 * length <= span:
        least = np.minimum(least[:-length], least[length:])
        length *= 2
    n = len(hashes) - span + 1
    return (np.minimum(least[:n], least[span - length : span - length + n]) & _LOW).astype(np.int64)


def _looks(texts: list[bytes]):
    """Texts as they are looked at: lists of (text, offset, bytes).

    Texts are looked at together up to CHUNK bytes; longer ones in chunks that overlap,
    so that each string is in one.
    """
    together, total = [], 0
    for number, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), CHUNK - LENGTH):
            part = text[at : at + CHUNK - 1]
            if len(part) < LENGTH:
                continue
            if total + len(part) > CHUNK:
                yield together
                together, total = [], 0
            together.append((number, at, part))
            total += len(part)
    if together:
        yield together


def _runs(parts: list[tuple[int, int, bytes]], data: bytes):
    """The contexts in texts put together: anchors' hashes, first and last starts, anchors' positions, owner among the parts."""
    hashes = _gram_hashes(np.frombuffer(data, dtype=np.uint8))
    chosen = _chosen(hashes)
    size = np.array([len(p) for _, _, p in parts])
    end = np.cumsum(size)
    owner = np.repeat(np.arange(len(parts)), size)[: len(chosen)]
    inside = np.arange(len(chosen)) + LENGTH <= end[owner]
    new = inside.copy()
    new[1:] &= ~inside[:-1] | (chosen[1:] != chosen[:-1]) | (owner[1:] != owner[:-1])
    firsts = np.flatnonzero(new)
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | new[1:]
    anchors = chosen[firsts]
    return hashes[anchors].view(np.int64), firsts, np.flatnonzero(stop), anchors, owner[firsts], (end - size)[owner[firsts]]


def _context_columns(texts: list[bytes]):
    """(text, anchor's hash, context's hash, first start, last start, anchor's position) of the contexts, as arrays."""
    digest = xxhash.xxh3_64_intdigest
    for parts in _looks(texts):
        data = b"".join(p for _, _, p in parts)
        keys, firsts, lasts, anchors, owner, start = _runs(parts, data)
        ends = (lasts + LENGTH).tolist()
        found = [digest(data[a:z], seed) for a, z, seed in zip(firsts.tolist(), ends, (anchors - firsts).tolist(), strict=True)]
        contexts = (np.array(found, dtype=np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
        shift = np.array([at for _, at, _ in parts])[owner] - start
        yield np.array([n for n, _, _ in parts])[owner], keys, contexts, firsts + shift, lasts + shift, anchors + shift


def _contexts(texts: list[bytes]):
    """The same as tuples."""
    for columns in _context_columns(texts):
        yield from zip(*(c.tolist() for c in columns), strict=True)


def _identified(docs: DataFrame) -> DataFrame:
    """doc_id, part (a hash of the text, for ids that are not unique) and text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.hash(text).alias("part"), text.alias("text"))


def _keys(rows: DataFrame) -> DataFrame:
    """key of each row of `_anchors`, without what else is in it."""

    def begin():
        def run(texts):
            looks = _looks([t.encode("utf-8", "surrogatepass") for t in texts])
            found = [_runs(parts, b"".join(p for _, _, p in parts))[0] for parts in looks]
            return (_joined(found),)

        return run

    return map_rows(rows.select("text"), "key bigint", begin)


def _anchors(rows: DataFrame) -> DataFrame:
    def begin():
        def run(ids, parts, texts):
            found = list(_context_columns([t.encode("utf-8", "surrogatepass") for t in texts]))
            n, key, context, first, last, at = (_joined([c[i] for c in found]) for i in range(6))
            owners = n.tolist()
            own = [ids[i] for i in owners], [parts[i] for i in owners]
            return key, context, *own, first, (last - first).astype(np.int32), (at - first).astype(np.int32)

        return run

    schema = "key bigint, context bigint, doc_id bigint, part int, first bigint, more int, anchor int"
    return map_rows(rows, schema, begin)


def _joined(arrays: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(arrays) if arrays else np.empty(0, dtype=np.int64)


def _packed(rows: DataFrame) -> DataFrame:
    """The rows with their text compressed: what the shuffles below carry."""

    def begin():
        pack = zstandard.ZstdCompressor(level=1).compress
        return lambda ids, parts, texts: (ids, parts, [pack(t.encode("utf-8", "surrogatepass")) for t in texts])

    return map_rows(rows, "doc_id bigint, part int, packed binary", begin)


def _same(a: DataFrame, b: DataFrame):
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["part"] == b["part"])


def _pieces(packed: DataFrame, contexts: DataFrame) -> DataFrame:
    """key, core, left, right, several, doc_id, part, first: the pieces of contexts, cut at fixed distances from the anchor."""
    wanted = contexts.groupBy("doc_id", "part").agg(
        F.collect_list(F.struct("key", "several", "first", "more", "anchor")).alias("wanted")
    )  # as many as the document itself has
    texts = packed.join(wanted, _same(packed, wanted)).select(packed["doc_id"], packed["part"], "packed", "wanted")

    def begin():
        unpack = zstandard.ZstdDecompressor().decompress

        def run(ids, parts, blobs, wanted):
            out = [[] for _ in range(8)]
            for doc, part, blob, contexts in zip(ids, parts, blobs, wanted, strict=True):
                text = unpack(blob)
                for c in contexts:
                    first, last = c["first"], c["first"] + c["more"]
                    anchor = first + c["anchor"]
                    for step in range((anchor - last) // STARTS, (anchor - first) // STARTS + 1):
                        high = anchor - STARTS * step  # the piece's last start, where the core begins
                        a, b = max(first, high - STARTS + 1), min(last, high)
                        stop = high - STARTS + 1 + LENGTH
                        core = xxhash.xxh3_64_intdigest(text[high:stop], step) - (1 << 63)
                        values = (c["key"], core, text[a:high], text[stop : b + LENGTH], c["several"], doc, part, a)
                        for o, v in zip(out, values, strict=True):
                            o.append(v)
            return out

        return run

    schema = "key bigint, core bigint, left binary, right binary, several boolean, doc_id bigint, part int, first bigint"
    return map_rows(texts, schema, begin, 32)


def _repeated_starts(groups: list[list[tuple]]) -> list[tuple]:
    """(piece, start in it) of the strings that pieces of one core share, from one suffix array over all groups.

    A piece is (left, right, ...). Its symbols are the bytes before the core, the core, and
    the bytes after it, so each of its strings is STARTS symbols long; a mark that no string
    has stands between pieces.
    """
    symbols, owners = [], []
    for number, group in enumerate(groups):
        for piece in group:
            left, right = piece[0], piece[1]
            owners += [(piece, i) for i in range(len(left) + 1 + len(right))] + [None]
            symbols += [*(x + 2 for x in left), 258 + number, *(x + 2 for x in right), 1]
    symbols = np.array([*symbols, 0], dtype=np.int64)
    order = suffix_array(symbols)
    padded = np.concatenate([symbols, np.zeros(STARTS, dtype=np.int64)])
    strings = np.lib.stride_tricks.sliding_window_view(padded, STARTS)[order]
    whole = (strings > 1).all(axis=1)
    equal = (strings[1:] == strings[:-1]).all(axis=1) & whole[1:]
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= equal
    twice[:-1] |= equal
    return [owners[i] for i in order[twice].tolist()]


def _by_suffix_array(pieces: DataFrame) -> DataFrame:
    """doc_id, part, start: strings of lone pieces that another piece of the same core has too."""
    names = ["key", "core", "left", "right", "several", "doc_id", "part", "first"]
    dealt = pieces.select(*names).repartition("key", "core").sortWithinPartitions("key", "core")
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("start", pa.int64())])

    def task(batches):
        groups: list[list[tuple]] = []
        last, waiting = None, 0

        def found():
            rows = [(p[2], p[3], p[4] + i) for p, i in _repeated_starts(groups) if not p[5]]
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in batches:
            columns = dict(zip(names, (c.to_pylist() for c in batch.columns), strict=True))
            for key, core, left, right, several, doc, part, first in zip(*(columns[n] for n in names), strict=True):
                if (key, core) != last:
                    if waiting > SYMBOLS:
                        yield found()
                        groups, waiting = [], 0
                    groups.append([])
                    last = key, core
                groups[-1].append((left, right, doc, part, first, several))
                waiting += len(left) + len(right) + 2
        if groups:
            yield found()

    return dealt.mapInArrow(task, "doc_id bigint, part int, start bigint")


def _by_count(pieces: DataFrame) -> DataFrame:
    """The same for cores with many pieces: each string is a key, and keys that occur twice count."""
    n_left, n_right = F.octet_length("left"), F.octet_length("right")
    # the string that starts i bytes into the left part ends STARTS - 1 - (n_left - i) bytes into the right part
    skip = F.greatest(F.lit(0), n_left + n_right - (STARTS - 1))
    each = pieces.withColumn("i", F.explode(F.sequence(F.lit(0), skip)))
    key = F.struct(
        "key",
        "core",
        (F.octet_length("left") - F.col("i")).alias("before"),
        F.expr("substring(left, i + 1)").alias("l"),
        F.expr(f"substring(right, 1, {STARTS - 1} - octet_length(left) + i)").alias("r"),
    )
    strings = each.select("key", "core", F.xxhash64(key).alias("string"), "several", "doc_id", "part", (F.col("first") + F.col("i")).alias("start"))
    strings = strings.withColumnRenamed("key", "anchor")
    counts = strings.groupBy("anchor", "core", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return strings.where(~F.col("several")).join(counts, ["anchor", "core", "string"]).select("doc_id", "part", "start")


def repeated(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, part, first, last: ranges of starts of the strings that also start elsewhere."""
    rows = _identified(docs)
    anchors = _anchors(rows)
    # keys are landed before they are joined: Spark can then split a frequent one
    often = land(_keys(rows).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "often")
    flagged = land(anchors.join(often, "key"), "anchors")
    ends = F.struct("doc_id", "part", "first", "more", "anchor")
    contexts = land(flagged.groupBy("key", "context").agg(F.count(F.lit(1)).alias("n"), F.min(ends).alias("at")), "contexts")
    several = land(contexts.where("n > 1").select("key", "context"), "several")
    whole = flagged.join(several, ["key", "context"]).select("doc_id", "part", "first", (F.col("first") + F.col("more")).alias("last"))
    mixed = land(contexts.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key"), "mixed")
    open_ = contexts.join(mixed, "key").select("key", (F.col("n") > 1).alias("several"), "at.*")
    pieces = land(_pieces(_packed(rows), open_), "pieces")
    crowds = pieces.groupBy("key", "core").agg(F.count(F.lit(1)).alias("crowd")).where("crowd > 1")
    shared = land(pieces.join(crowds, ["key", "core"]), "shared")
    found = _by_suffix_array(shared.where(F.col("crowd") <= crowd)).unionByName(_by_count(shared.where(F.col("crowd") > crowd)))
    return whole.unionByName(found.select("doc_id", "part", F.col("start").alias("first"), F.col("start").alias("last")))


def _covered(size: int, ranges: list[int]) -> np.ndarray:
    """Bounds of the maximal runs that strings starting in the ranges (first, last, first, ...) cover, as (start, end) rows."""
    bounds = np.array(ranges, dtype=np.int64).reshape(-1, 2)
    change = np.bincount(bounds[:, 0], minlength=size + 1) - np.bincount(bounds[:, 1] + LENGTH, minlength=size + 1)
    gone = np.concatenate([[0], (np.cumsum(change)[:size] > 0).astype(np.int8), [0]])
    edge = np.diff(gone)
    return np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], axis=1)


def remove(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_bytes, n_removed, spans (start, end), kept: each text as UTF-8 without what is repeated.

    A byte goes if a string of LENGTH bytes that covers it also starts anywhere else, in
    the same document or in another. Strings are judged on the input. A null text is
    empty, texts under LENGTH bytes stay, equal rows repeat each other.
    """
    ranges = repeated(docs, crowd)
    pairs = F.flatten(F.collect_list(F.array("first", "last")))
    found = ranges.groupBy("doc_id", "part").agg(pairs.alias("ranges"))  # of one text
    packed = _packed(_identified(docs))
    every = packed.join(found, _same(packed, found), "left").select(packed["doc_id"], "packed", "ranges")

    def begin():
        unpack = zstandard.ZstdDecompressor().decompress

        def run(ids, blobs, ranges):
            out = [[] for _ in range(4)]
            for blob, own in zip(blobs, ranges, strict=True):
                text = unpack(blob)
                runs = _covered(len(text), own or ())
                kept, at = [], 0
                for a, b in runs.tolist():
                    kept.append(text[at:a])
                    at = b
                values = (
                    len(text),
                    int((runs[:, 1] - runs[:, 0]).sum()),
                    [{"start": a, "end": b} for a, b in runs.tolist()],
                    b"".join([*kept, text[at:]]),
                )
                for o, v in zip(out, values, strict=True):
                    o.append(v)
            return ids, *out

        return run

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start: bigint, end: bigint>>, kept binary"
    return map_rows(every, schema, begin, 64)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each document."""
    out = remove(docs)
    return out.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
