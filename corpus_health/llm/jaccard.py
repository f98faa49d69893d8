"""N-gram Jaccard join by a forest of MinHash prefix tries.

Texts with the same five-word shingles are one unit. A unit's MinHash signature
is a path in each of TREES tries. The paths of all tries are sorted once, in ranges
over all tasks, and a scan gives each path the longest prefix that it has in common
with a neighbour; paths without one go.

The search begins at the longest prefixes. Units under one node that can be near
each other become a group. Then matched prefixes are shortened, node by node: a
node is opened again only if its shorter prefix brings together units that are not
in one group yet, and only those are compared. It goes on until a pair at the
threshold meets under some node with the target recall.

In a node with few units all pairs of different groups are candidates. In a node
with many, each unit is a candidate with the node's centre, and units that are
neither near it nor of its group are compared by their sketches with all others of
the node, in blocks against blocks, so every pair under a node is looked at.

Candidates whose sketches and sizes cannot reach the threshold are dropped. Inside
each group every pair is verified exactly by its shingle sets. A large group is
verified in blocks against blocks, so no task holds more than two blocks; pairs are
counted there and never emitted.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpus_health.llm.common import land, map_rows
from corpus_health.llm.graph import components
from corpus_health.llm.words import GAPS, mixed, shingle_set

THRESHOLD = 0.8
#: Tries, hashes of each, and the share of pairs at the threshold that must meet in one of them.
TREES = 24
HASHES = 6
TARGET_RECALL = 0.99999
#: Units of a node up to which all pairs are candidates.
FEW = 8
#: How far under the threshold a sketch's estimate may be: five standard deviations of it.
SLACK = 0.25
#: Units of a block where sketches are compared.
SKETCHES = 2048
#: Units of a block in exact verification.
BLOCK = 256
#: Shingles that verification looks at together.
COLUMNS = 4096

_N = TREES * HASHES
_WORD = 48  # bits of a sketch's words
_WORDS = [f"s{i}" for i in range(_N // _WORD)]


def _factors() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240517)
    flip = draw.integers(0, 1 << 32, _N, dtype=np.uint64).astype(np.uint32)
    odd = (draw.integers(0, 1 << 32, _N, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
    return flip, odd


def depth(threshold: float = THRESHOLD, target: float = TARGET_RECALL) -> int:
    """The longest prefix at which pairs at the threshold meet in some trie with the target probability."""
    return next((d for d in range(HASHES, 1, -1) if recall(d, threshold) >= target), 1)


def recall(depth: int, similarity: float) -> float:
    """The probability that a pair of this similarity has a prefix of this length in common in some trie."""
    return 1 - (1 - similarity**depth) ** TREES


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the shingles."""
    flip, odd = _factors()
    low = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    least = np.full(_N, np.iinfo(np.uint32).max, dtype=np.uint32)
    for at in range(0, len(low), 2048):
        part = low[at : at + 2048, None] ^ flip
        part *= odd
        np.minimum(least, part.min(axis=0), out=least)
    return least


def prefixes(sig: np.ndarray, depths: tuple[int, ...]) -> list[np.ndarray]:
    """For each depth the tries' prefixes as 64-bit numbers."""
    trees = np.arange(TREES)
    key, out = mixed(trees.astype(np.uint64) + np.uint64(1)), []
    for j in range(max(depths)):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + sig[(trees * HASHES + j) % _N].astype(np.uint64))
        if j + 1 in depths:
            out.append(key.astype(np.int64))
    return out


def _sketch(sig: np.ndarray) -> list[int]:
    bits = (sig >> np.uint32(13)) & np.uint32(1)
    return [int("".join(map(str, part)), 2) for part in bits.reshape(-1, _WORD).tolist()]


def sign(docs: DataFrame, depths: tuple[int, ...]) -> DataFrame:
    """row, doc_id, set_id, n, sketch, and the prefixes of each depth; landed. set_id is null without words.

    Columns text_id and text_key go along if there are such.
    """
    own = [c for c in ("text_id", "text_key") if c in docs.columns]
    words = _N // _WORD
    columns = [f"k{d}" for d in depths]
    schema = ", ".join(
        ["doc_id bigint", *(f"{c} string" for c in own), "set_id binary, n bigint"]
        + [f"s{i} bigint" for i in range(words)]
        + [f"{c} array<bigint>" for c in columns]
    )

    def begin():
        def run(texts, *ids):
            out = [[] for _ in range(2 + words + len(columns))]
            for text in texts:
                shingles = shingle_set(text)
                if not len(shingles):
                    for o in out:
                        o.append(None)
                    continue
                sig = signature(shingles)
                values = [xxhash.xxh3_128_digest(shingles.tobytes()), len(shingles), *_sketch(sig), *prefixes(sig, depths)]
                for o, v in zip(out, values, strict=True):
                    o.append(v)
            return *ids, *out

        return run

    signed = map_rows(docs.select("text", "doc_id", *own), schema, begin)
    return land(signed.withColumn("row", F.monotonically_increasing_id()), "signed")


def sorted_paths(signed: DataFrame, depths: tuple[int, ...]) -> DataFrame:
    """unit, shared, and the prefixes of each depth, of the paths that have a prefix in common with another; landed.

    `depths` go from the shortest to the longest; `shared` is the longest of them at
    which the path agrees with the one before or after it in the order of all paths.
    The order is cut into ranges by path and unit, so a frequent prefix is spread over
    tasks. The first and the last path of a batch have neighbours elsewhere and stay as
    if they agreed with them; a prefix that no other path has is dropped later.
    """
    keys = [f"k{d}" for d in depths]
    rows = signed.select("unit", F.explode(F.arrays_zip(*keys)).alias("path")).select("unit", "path.*")
    ordered = rows.repartitionByRange(*keys, "unit").sortWithinPartitions(*keys, "unit")

    def scan(batches):
        for batch in batches:
            values = [batch.column(k).to_numpy() for k in keys]
            agree = np.ones(max(batch.num_rows - 1, 0), dtype=bool)
            common = np.zeros(batch.num_rows + 1, dtype=np.int32)  # with the path before, of each path and the end
            common[0] = common[-1] = depths[-1]
            for d, v in zip(depths, values, strict=True):
                agree &= v[1:] == v[:-1]
                common[1:-1][agree] = d
            shared = np.maximum(common[:-1], common[1:])
            kept = shared > 0
            columns = [batch.column("unit").to_numpy()[kept], shared[kept], *(v[kept] for v in values)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["unit", "shared", *keys])

    schema = ", ".join(["unit bigint, shared int", *(f"{k} bigint" for k in keys)])
    return land(ordered.mapInArrow(scan, schema), "paths")


def forest_groups(units: DataFrame, paths: DataFrame, depths: tuple[int, ...], threshold: float = THRESHOLD) -> DataFrame:
    """node, label: the units that are in a group with another, from the longest prefixes to the shortest."""
    labels = None
    for d in reversed(depths):
        rows = paths.where(F.col("shared") >= d).select(F.col(f"k{d}").alias("key"), "unit")
        if labels is None:
            rows = rows.withColumn("of", F.col("unit"))
        else:
            known = labels.select(F.col("node").alias("unit"), F.col("label").alias("of"))
            rows = rows.join(known, "unit", "left").withColumn("of", F.coalesce("of", "unit"))
        links = land(candidates(units, rows, threshold), "likely")
        if labels is None:
            labels = components(links)
        elif not links.isEmpty():
            labels = components(links.union(labels.select("node", "label")))
    return labels


def _pairs_of_few(nodes: DataFrame) -> DataFrame:
    """All pairs of units of different groups under each node: FEW units at most."""
    members = nodes.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("unit", "of"))).alias("u"))
    pairs = F.flatten(
        F.transform(
            "u",
            lambda x, i: F.transform(
                F.filter(F.slice("u", i + 2, F.size("u")), lambda y: y["of"] != x["of"]),
                lambda y: F.struct(x["unit"].alias("a"), y["unit"].alias("b")),
            ),
        )
    )
    return members.select(F.explode(pairs).alias("p")).select("p.a", "p.b")


def candidates(units: DataFrame, rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """a, b: links that connect all units that share a node and can be near, each once.

    `rows` has key (the node), unit and of (the unit's group so far). Nodes of one group
    are done. Of a full node these are the pairs with its centre. Units near the centre
    or of its group are one group and verified together; the rest are compared with
    every other unit of the node.
    """
    sizes = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("size"),
        (F.min("of") != F.max("of")).alias("open"),
        F.min(F.struct(F.xxhash64("unit").alias("h"), "unit", "of")).alias("c"),
    )
    # landed before it is joined: a join of two shuffled tables can split a frequent key
    shared = sizes.where("size > 1 and open").select("key", "size", F.col("c.unit").alias("centre"), F.col("c.of").alias("centre_of"))
    nodes = land(rows.join(land(shared, "shared"), "key"), "nodes")
    few = _pairs_of_few(nodes.where(F.col("size") <= FEW)).distinct()
    pairs = _with_facts(few, units, "a", "b").where(_near(threshold)).select("a", "b")
    star = _with_facts(nodes.where(F.col("size") > FEW).where("unit != centre"), units, "unit", "centre")
    one = F.col("of") == F.col("centre_of")
    star = land(star.select("key", "unit", "centre", one.alias("one"), (one | _near(threshold)).alias("near")), "stars")
    ends = F.least("unit", "centre").alias("a"), F.greatest("unit", "centre").alias("b")
    spokes = star.where("near and not one").select(*ends)
    return pairs.union(spokes).union(_links_of_rest(star, units, threshold)).distinct()


def _links_of_rest(star: DataFrame, units: DataFrame, threshold: float) -> DataFrame:
    """a, b: links that connect the units of each full node as do its pairs that can be near and are not both near the centre.

    The units that are neither near the centre nor of its group meet all of the node, block by block; pairs are
    not emitted, only each unit with the least that it is connected to in two blocks.
    """
    counts = star.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.count_if(~F.col("near")).alias("rest"))
    mixed = land(counts.where("rest > 0"), "mixed-nodes")
    facts = units.select("unit", "n", *_WORDS)
    rows = land(star.select("key", "unit", "near").join(mixed, "key"), "open-nodes").join(facts, "unit")
    for c in ("size", "rest"):
        rows = rows.withColumn(c, F.ceil(F.col(c) / SKETCHES).cast("int"))

    def dealt(side: DataFrame, own: str, other: str, rest: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("unit"), F.col(own)).cast("int").alias(own)
        with_all = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other)
        return side.select("key", block, with_all, F.lit(rest).alias("of_rest"), "unit", "n", *_WORDS)

    left = dealt(rows.where("not near"), "rest", "size", True)
    met = left.unionByName(dealt(rows, "size", "rest", False))

    def each(table: pa.Table) -> pa.Table:
        return _met(table, threshold)

    return met.groupBy("key", "rest", "size").applyInArrow(each, "a bigint, b bigint")


def _met(table: pa.Table, threshold: float) -> pa.Table:
    """Of a block of units of the rest and one of all: each unit that can be near one of the other block, and the least unit it reaches."""
    side = table["of_rest"].to_numpy()
    unit, n, *words = (table[c].to_numpy() for c in ("unit", "n", *_WORDS))
    label, other = unit[side], unit[~side]
    apart = sum(np.bitwise_count(w[side][:, None] ^ w[~side][None, :]).astype(np.int16) for w in words)
    a, b = n[side][:, None], n[~side][None, :]
    link = (1.0 - 2.0 * apart / _N >= threshold - SLACK) & (np.minimum(a, b) >= threshold * np.maximum(a, b))
    link &= label[:, None] != other[None, :]
    rows, columns = link.any(axis=1), link.any(axis=0)
    link, label, other = link[rows][:, columns], label[rows], other[columns]
    ends, most = np.concatenate([label, other]), np.iinfo(np.int64).max
    while link.size:
        lower = np.minimum(label, np.where(link, other[None, :], most).min(axis=1))
        least = np.minimum(other, np.where(link, lower[:, None], most).min(axis=0))
        if (lower == label).all() and (least == other).all():
            break
        label, other = lower, least
    reached = np.concatenate([label, other])
    moved = ends != reached
    return pa.table({"a": pa.array(reached[moved], pa.int64()), "b": pa.array(ends[moved], pa.int64())})


def _with_facts(pairs: DataFrame, units: DataFrame, *sides: str) -> DataFrame:
    """The pairs with the size and sketch of both units."""
    for i, side in enumerate(sides):
        facts = units.select(F.col("unit").alias(side), *(F.col(c).alias(f"{c}_{i}") for c in ("n", *_WORDS)))
        pairs = pairs.join(facts, side)
    return pairs


def _near(threshold: float) -> Column:
    """Whether two units' sizes and sketches allow for the threshold."""
    apart = sum(F.bit_count(F.col(f"{s}_0").bitwiseXOR(F.col(f"{s}_1"))) for s in _WORDS)
    sizes = F.least("n_0", "n_1") >= threshold * F.greatest("n_0", "n_1")
    return (1.0 - 2.0 * apart / _N >= threshold - SLACK) & sizes


def _verify(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Of the units of one or two blocks: the copies each is linked to in the other units, and the least unit it reaches."""
    pdf = pdf.drop_duplicates("unit").sort_values("unit")
    unit, block, copies = (pdf[c].to_numpy() for c in ("unit", "block", "copies"))
    sets = [np.frombuffer(s, dtype=np.uint64) for s in pdf["shingles"]]
    n = np.array([len(s) for s in sets], dtype=np.float64)
    owner = np.repeat(np.arange(len(sets)), n.astype(np.int64))
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.concatenate([[True], every[1:] != every[:-1]])
    column = np.cumsum(new) - 1
    size = np.bincount(column)
    keep = size[column] > 1
    column, owner = column[keep], owner[keep]
    if len(column):
        column = np.cumsum(np.concatenate([[True], column[1:] != column[:-1]])) - 1
    common = np.zeros((len(sets), len(sets)), dtype=np.float64)
    at = 0
    while at < len(column):
        first = column[at]
        stop = int(np.searchsorted(column, first + COLUMNS))
        has = np.zeros((len(sets), int(column[stop - 1] - first) + 1), dtype=np.float32)
        has[owner[at:stop], column[at:stop] - first] = 1
        common += has @ has.T
        at = stop
    link = common >= threshold * (n[:, None] + n[None, :] - common) - 1e-6
    np.fill_diagonal(link, False)
    if len(np.unique(block)) > 1:
        link &= block[:, None] != block[None, :]
    label = np.arange(len(sets))
    while True:
        lower = np.minimum(label, np.where(link, label[None, :], len(sets)).min(axis=1))
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    return pd.DataFrame({"unit": unit, "links": (link * copies[None, :]).sum(axis=1).astype("int64"), "least": unit[label]})


def verify(docs: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """unit, links, least for each unit of the groups and each pair of blocks it is in; landed.

    `groups` has unit, label (the group), set_id, copies, and doc_id and text_key of a row
    that has the unit's text; ids may be null or repeat.
    """
    # landed before it is joined, so that a large group can be split
    sizes = land(groups.groupBy("label").agg(F.count(F.lit(1)).alias("m")), "group-sizes")
    wide = groups.join(sizes, "label").withColumn("blocks", F.ceil(F.col("m") / BLOCK).cast("int"))
    wide = wide.withColumn("block", F.pmod(F.xxhash64("unit"), F.col("blocks")).cast("int")).drop("m")
    rows = docs.select(F.col("doc_id").alias("id"), _text_key().alias("key"), "text")
    texts = rows.join(wide, (F.col("key") == F.col("text_key")) & F.col("id").eqNullSafe(F.col("doc_id")))

    def begin():
        def run(texts, labels, units, set_ids, copies, blocks, block):
            sets = [shingle_set(t).tobytes() for t in texts]
            own = [i for i, s in enumerate(sets) if xxhash.xxh3_128_digest(s) == set_ids[i]]  # ids may repeat
            return [[c[i] for i in own] for c in (labels, units, copies, blocks, block, sets)]

        return run

    ordered = texts.select("text", "label", "unit", "set_id", "copies", "blocks", "block")
    schema = "label bigint, unit bigint, copies bigint, blocks int, block int, shingles binary"
    sets = map_rows(ordered, schema, begin)
    dealt = sets.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    keyed = dealt.select("label", low.alias("low"), high.alias("high"), "unit", "copies", "block", "shingles")

    def each(pdf: pd.DataFrame) -> pd.DataFrame:
        return _verify(pdf, threshold)

    return land(keyed.groupBy("label", "low", "high").applyInPandas(each, "unit bigint, links bigint, least bigint"), "verified")


def _text_key() -> Column:
    return F.xxhash64("text").cast("string")


def join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links of each document.

    n_links counts the other rows whose shingles have a Jaccard similarity of at least
    the threshold, copies included. Rows connected by such links, directly or by way of
    others, are a class, named by its least doc_id. A text with fewer than five words is
    one shingle; a null text or one without words has no links and is a class alone.
    Repeated rows are copies of each other. A null doc_id takes its class's name, which
    is null only if all of its class are.
    """
    rows = _classes(docs, threshold)
    return rows.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _classes(docs: DataFrame, threshold: float) -> DataFrame:
    """What `sign` gives of each row, with label, class_id and n_links of its class, null without words."""
    depths = tuple(range(depth(threshold), HASHES + 1))
    signed = sign(docs.withColumn("text_key", _text_key()), depths)
    sets = land(
        signed.where("set_id is not null")
        .groupBy("set_id")
        .agg(F.min("row").alias("unit"), F.min_by(F.struct("doc_id", "text_key"), "row").alias("at"), F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
        .select("*", "at.*").drop("at"),
        "sets",
    )
    one = signed.withColumnRenamed("row", "unit").join(sets.select("unit"), "unit")
    units = land(one.select("unit", "n", *_WORDS), "units")
    paths = sorted_paths(one, depths)
    groups = land(forest_groups(units, paths, depths, threshold).withColumnRenamed("node", "unit").join(sets, "unit"), "groups")
    checked = verify(docs, groups, threshold)
    links = checked.groupBy("unit").agg(F.sum("links").alias("links"))
    classes = components(checked.select(F.col("unit").alias("a"), F.col("least").alias("b")))
    of = sets.join(links, "unit", "left").join(classes.withColumnRenamed("node", "unit"), "unit", "left")
    of = land(of.withColumn("label", F.coalesce("label", "unit")), "of")
    names = land(of.groupBy("label").agg(F.min("least_id").alias("class_id")), "names")
    named = of.join(names, "label").select("set_id", "label", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return signed.select("doc_id", "set_id", *(c for c in signed.columns if c == "text_id")).join(named, "set_id", "left")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns as they were, one of each class: that of the least doc_id, nulls last.

    Of a class's rows with the same doc_id the first by text stays. Rows that share a
    doc_id but no class do not touch each other. Rows without a word are classes alone
    and stay.
    """
    text_id, blank = F.md5("text"), F.translate(F.coalesce("text", F.lit("")), GAPS, "") == ""
    classes = _classes(docs.select("doc_id", "text", text_id.alias("text_id")), threshold).where("label is not null")
    stay = classes.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    stay = land(stay.select(F.col("doc_id").alias("_stays"), F.col("text_id").alias("_as"), F.col("label").alias("_label")).distinct(), "stay")
    # the row travels as one value, so that none of its columns can clash with ours
    rows = docs.where(~blank).select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), F.col("text").alias("_text"), text_id.alias("_text_id"))
    order = Window.partitionBy("_label").orderBy("_text")
    same = F.col("_id").eqNullSafe(F.col("_stays")) & (F.col("_text_id") == F.col("_as"))
    kept = rows.join(stay, same).withColumn("_place", F.row_number().over(order))
    return kept.where("_place = 1").select("_row.*").unionByName(docs.where(blank))
