import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpus_health.llm import fingerprints, jaccard, repeats
from corpus_health.llm.graph import components
from corpus_health.llm.suffixes import suffix_array
from corpus_health.llm.words import shingle_set

from .conftest import LONG

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    found = WORD.findall(text or "")
    return {tuple(found[i : i + 5]) for i in range(max(1, len(found) - 4))} if found else set()


def brute_join(rows, threshold=0.8):
    """[(id, text)] -> sorted (id, class, links)"""
    sets = [shingles(t) for _, t in rows]
    own = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            own[x].append(i)
    linked = [set() for _ in rows]
    for i, s in enumerate(sets):
        for j, k in Counter(j for x in s for j in own[x]).items():
            if j != i and k >= threshold * (len(s) + len(sets[j]) - k) - 1e-9:
                linked[i].add(j)
    of = list(range(len(rows)))
    for _ in rows:
        new = [min([of[i], *(of[j] for j in linked[i])]) for i in range(len(rows))]
        if new == of:
            break
        of = new
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            ids[of[i]].append(doc)
    return sorted(
        (str(doc), str(min(ids[of[i]], default=None)), len(linked[i])) for i, (doc, _) in enumerate(rows)
    )


def joined(df, **options):
    return sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in jaccard.join(df, **options).collect())


def variants(n, size, seed, edits):
    """Texts that differ from one base in a few words each."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(size)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(draw.randint(0, edits)):
            words[draw.randrange(size)] = f"e{i}x{draw.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_join_of_the_table(docs, texts):
    assert joined(docs) == brute_join(list(texts.items()))


def test_join_of_odd_rows(clashing):
    rows = [(r.doc_id, r.text) for r in clashing.select("doc_id", "text").collect()]
    assert joined(clashing) == brute_join(rows)


def test_join_of_an_empty_table(empty):
    assert jaccard.join(empty).count() == 0
    assert jaccard.keep_one(empty).count() == 0


def test_large_group_in_full_nodes_and_blocks(few, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 20)
    monkeypatch.setattr(jaccard, "FEW", 3)
    rows = list(enumerate(variants(120, 200, 1, 6) + variants(30, 60, 2, 3) + variants(3, 100, 3, 1)))
    assert joined(few(*rows)) == brute_join(rows)


def test_documents_of_shared_passages(few, monkeypatch):
    """Every node is full of texts that share much and are not near: near pairs among them are still found."""
    monkeypatch.setattr(jaccard, "FEW", 3)
    monkeypatch.setattr(jaccard, "SKETCHES", 16, raising=False)
    draw = random.Random(5)
    passages = [" ".join(f"p{i}w{j}" for j in range(10)) for i in range(40)]
    rows = []
    for i in range(150):
        own = draw.sample(range(40), 30)
        twin = own[:-1] + draw.sample([p for p in range(40) if p not in own], 1)
        rows += [(2 * i + k, " ".join(passages[p] for p in sorted(c))) for k, c in enumerate((own, twin))]
    want = brute_join(rows)
    assert sum(links > 0 for _, _, links in want) > 200
    assert joined(few(*rows)) == want


def test_near_pairs_in_a_full_mixed_node(few, monkeypatch):
    """Units that share short prefixes with many others and no longer ones: none is near the centre but some pairs are."""
    signed = jaccard.sign

    def crowded(docs, depths):
        out = signed(docs, depths)
        for d in depths:
            key = F.transform(F.sequence(F.lit(1), F.lit(jaccard.TREES)), lambda t: t.cast("bigint") + F.lit(0 if d < 12 else 1) * 100 * (1 + F.col("row")))
            out = out.withColumn(f"k{d}", key)
        return out

    monkeypatch.setattr(jaccard, "sign", crowded)
    monkeypatch.setattr(jaccard, "SKETCHES", 16, raising=False)
    texts = [t for seed in range(20) for t in variants(2 if seed < 8 else 1, 160, 40 + seed, 1)]
    rows = list(enumerate(texts))
    want = brute_join(rows)
    assert sum(links > 0 for _, _, links in want) == 16
    assert joined(few(*rows)) == want


def test_recall_at_the_threshold():
    """Pairs just over the threshold share a prefix: none of 400 is missed."""
    draw = np.random.default_rng(4)
    depth = jaccard.depth()
    for _ in range(400):
        common = draw.integers(0, 2**64, 160, dtype=np.uint64)
        a, b = (np.concatenate([common, draw.integers(0, 2**64, 20, dtype=np.uint64)]) for _ in range(2))
        (pa,), (pb,) = (jaccard.prefixes(jaccard.signature(s), (depth,)) for s in (a, b))
        assert (pa == pb).any()


def test_shortening_stops_where_the_recall_is_reached():
    """The last prefix tried is the longest that reaches the target; a looser threshold needs a shorter one."""
    for threshold in (0.5, 0.7, 0.8, 0.9):
        d = jaccard.depth(threshold)
        assert d == 1 or jaccard.recall(d, threshold) >= jaccard.TARGET_RECALL
        assert d == jaccard.HASHES or jaccard.recall(d + 1, threshold) < jaccard.TARGET_RECALL


def test_paths_and_their_longest_common_prefix(spark):
    """Paths that agree with none go, the others say how far they agree with a neighbour in the sorted order."""
    paths = [(1, 10, 20, 30), (2, 10, 20, 30), (3, 10, 20, 31), (4, 10, 21, 32), (5, 11, 22, 33), (6, 12, 23, 34), (7, 12, 24, 35)]
    rows = [(u, [a, 900 + u], [b, 900 + u], [c, 900 + u]) for u, a, b, c in paths]
    # paths before and after all others, so that those of interest are inside a batch
    rows += [(0, [-1], [-1], [-1]), (99, [9999], [9999], [9999])]
    signed = spark.createDataFrame(rows, "unit bigint, k4 array<bigint>, k5 array<bigint>, k6 array<bigint>").coalesce(1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r.unit: r.shared for r in jaccard.sorted_paths(signed, (4, 5, 6)).where("k4 between 10 and 12").collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {1: 6, 2: 6, 3: 5, 4: 4, 6: 4, 7: 4}


def test_only_open_nodes_are_shortened(spark, monkeypatch):
    """A node whose units are one group is not looked at again; one with two groups is."""
    from corpus_health.llm.jaccard import _WORDS

    units = spark.createDataFrame([(u, 100, *(0 for _ in _WORDS)) for u in range(1, 7)], "unit bigint, n bigint, " + ", ".join(f"{w} bigint" for w in _WORDS))
    rows = [(7, 1, 1), (7, 2, 1), (8, 3, 3), (8, 4, 4), (9, 5, 5)]
    for few_ in (8, 1):
        monkeypatch.setattr(jaccard, "FEW", few_)
        got = jaccard.candidates(units, spark.createDataFrame(rows, "key bigint, unit bigint, of bigint"))
        assert [tuple(r) for r in got.collect()] == [(3, 4)]


@pytest.mark.parametrize("low, high", [(0.8, 0.85), (0.85, 0.9), (0.9, 1.0)])
def test_recall_by_tier(tiers, low, high):
    """Of the pairs in each tier of similarity at least nine in ten are in one class."""
    classes, pairs = tiers
    found = [classes[a] == classes[b] for a, b, s in pairs if low <= s < high]
    assert len(found) >= 20
    assert sum(found) >= 0.9 * len(found)


@pytest.fixture(scope="module")
def tiers(spark):
    """Classes of the join, and the pairs of different texts at the threshold with their exact similarity."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    edited = [(10_000_000 + 1000 * s + i, t) for s in range(12) for i, t in enumerate(variants(8, 180, 700 + s, 4))]
    docs = docs.union(spark.createDataFrame(edited, docs.schema))
    classes = {r.doc_id: r.class_id for r in jaccard.join(docs).collect()}
    sets = {r.doc_id: frozenset(shingles(r.text)) for r in docs.collect()}
    own = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            own[x].append(i)
    pairs = []
    for i, s in sets.items():
        for j, k in Counter(j for x in s for j in own[x] if j > i).items():
            similarity = k / (len(s) + len(sets[j]) - k)
            if 0.8 <= similarity < 1:
                pairs.append((i, j, similarity))
    return classes, pairs


def test_words_are_those_of_the_pattern():
    text = "a\x0bb\x1cc\xa0d e \x85f\tg\r\nh"
    assert len(shingle_set(text)) == len(shingles(text))


def test_keep_one(clashing, docs, texts):
    kept = [r.doc_id for r in jaccard.keep_one(docs).collect()]
    assert sorted(map(str, kept)) == sorted({c for _, c, _ in brute_join(list(texts.items()))})
    out = jaccard.keep_one(clashing)
    assert set(out.columns) == set(clashing.columns)
    assert Counter(r.doc_id for r in out.collect()) == Counter({1: 1, 2: 1, 3: 1, 4: 1, 6: 1, 8: 1, 9: 1, 10: 1, None: 2})


def test_keep_one_of_repeated_and_null_ids(few):
    """Different texts under one doc_id all stay; null ids are members of their classes."""
    a, b, c, d = (variants(1, 60, seed, 0)[0] for seed in range(50, 54))
    rows = [(1, a), (1, b), (1, b + " end"), (2, a), (None, a), (None, c), (None, c), (None, d), (3, d), (7, None), (7, " ")]
    kept = Counter((r.doc_id, r.text) for r in jaccard.keep_one(few(*rows)).collect())
    assert kept == Counter([(1, a), (1, b), (None, c), (3, d), (7, None), (7, " ")])


def test_near_texts_without_id_or_under_one_id(few):
    """Links are not lost where ids are null or repeat."""
    near = [variants(3, 300, seed, 2) for seed in range(60, 65)]
    ids = [(None, None, 1), (None, None, None), (3, 3, 3), (4, None, 4), (5, 6, None)]
    rows = [(i, t) for own, texts in zip(ids, near, strict=True) for i, t in zip(own, texts, strict=True)]
    want = brute_join(rows)
    assert sum(links > 0 for _, _, links in want) == 15
    assert joined(few(*rows)) == want
    assert jaccard.keep_one(few(*rows)).count() == 5


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (103, 101), (7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100, 103: 100}


# -- repeated passages ---------------------------------------------------------


def brute_repeats(rows, length=200):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[q : q + length] for b in data for q in range(len(b) - length + 1))
    out = []
    for (doc, _), b in zip(rows, data, strict=True):
        gone = np.zeros(len(b) + 2, dtype=int)
        for q in range(len(b) - length + 1):
            if seen[b[q : q + length]] > 1:
                gone[q + 1 : q + 1 + length] = 1
        kept = bytes(x for x, g in zip(b, gone[1:-1], strict=True) if not g)
        out.append((str(doc), len(b), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def removed(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.digest(df).collect())


def test_suffix_arrays():
    draw = random.Random(3)
    for _ in range(1500):
        s = [draw.randint(1, draw.choice([1, 2, 3, 9])) for _ in range(draw.randint(0, 40))] + [0]
        assert suffix_array(np.array(s)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])
    assert suffix_array(np.array([], dtype=int)).tolist() == []


def passages():
    """Passages of many lengths around the limit, at many places, with many edges."""
    draw = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz é"
    noise = lambda n: "".join(draw.choice(letters) for _ in range(n))
    shared = [noise(n) for n in (150, 199, 200, 201, 215, 230, 320, 700)]
    rows = []
    for i in range(60):
        text = noise(draw.randint(0, 300))
        for _ in range(draw.randint(0, 3)):
            p = draw.choice(shared)
            a = draw.randint(0, 12)
            text += p[a : len(p) - draw.randint(0, 12)] + noise(draw.randint(0, 90))
        rows.append((i, text))
    return rows + [(100, "ab" * 400), (101, "z" * 205), (102, "z" * 203), (103, noise(900))]


@pytest.mark.parametrize("crowd", [repeats.CROWD, 1])
def test_repeats_of_passages(few, crowd):
    rows = passages()
    out = repeats.remove(few(*rows), crowd)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in out.collect())
    assert got == brute_repeats(rows)


def test_repeats_of_long_texts_in_chunks(few, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 1 << 21)
    rows = [(1, LONG[:60_000]), (2, "start " + LONG[30_000:45_000] + " stop"), (3, "q" * 500)]
    assert removed(few(*rows)) == brute_repeats(rows)
    whole = repeats._contexts([(LONG[:60_000]).encode()])
    whole = {q for _, _, _, a, b, _ in whole for q in range(a, b + 1)}
    monkeypatch.setattr(repeats, "CHUNK", 4096)
    monkeypatch.setattr(repeats, "_LOW", np.uint64(8191))
    cut = [q for _, _, _, a, b, _ in repeats._contexts([(LONG[:60_000]).encode()]) for q in range(a, b + 1)]
    assert len(cut) == len(set(cut)) and set(cut) == whole == set(range(60_000 - 199))


def test_keys_of_repeats_are_counted_without_their_contexts(few):
    """The first pass over the texts makes anchors' hashes only, one for each row of the second."""
    rows = repeats._identified(few(*passages(), (200, ""), (201, None), (202, "short")))
    keys = repeats._keys(rows)
    assert keys.columns == ["key"]
    assert sorted(r.key for r in keys.collect()) == sorted(r.key for r in repeats._anchors(rows).collect())


def test_repeats_of_the_table(docs, texts):
    assert removed(docs) == brute_repeats(list(texts.items()))


def test_repeats_of_odd_rows(clashing, empty):
    small = clashing.where("coalesce(length(text), 0) < 60000")
    rows = [(r.doc_id, r.text) for r in small.select("doc_id", "text").collect()]
    assert removed(small) == brute_repeats(rows)
    assert repeats.digest(empty).count() == 0


# -- fingerprints --------------------------------------------------------------


def likeness(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def check_edited(df, rows, runs=None):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    got = {}
    for r in fingerprints.compare_edited(df, runs).collect():
        got.setdefault((r.doc_id, r.n_chars, r.edited_sha256), []).append(r)
    errors = []
    for at, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(at + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = got[doc, len(text), hashlib.sha256(edited.encode()).hexdigest()].pop()
        errors += [r.near_edited - likeness(shingles(text), shingles(edited)), r.near_next - likeness(shingles(text), shingles(after))]
        assert len(r.fingerprint) == (fingerprints.BINS if shingles(text) else 0)
    assert not any(got.values())
    return np.array(errors)


@pytest.mark.parametrize("runs", [None, 1, 50])
def test_fingerprints_of_the_table(docs, texts, runs):
    errors = check_edited(docs, list(texts.items()), runs)
    assert abs(errors.mean()) < 0.01 and errors.std() < 0.05 and abs(errors).max() < 0.2


def test_fingerprints_of_odd_rows(clashing, empty, few):
    rows = [(r.doc_id, r.text) for r in clashing.select("doc_id", "text").collect()]
    assert abs(check_edited(clashing, rows)).max() < 0.2
    assert fingerprints.compare_edited(empty).count() == 0
    alone = fingerprints.compare_edited(few((7, "one two three four five six"))).first()
    assert alone.near_next == 1.0


def test_equal_texts_have_equal_fingerprints(docs):
    same = fingerprints.fingerprint(docs).join(docs.select("doc_id", "text"), "doc_id")
    assert same.groupBy("text").agg(F.count_distinct("fingerprint").alias("n")).where("n > 1").count() == 0


def plain_bins(text):
    """A second version of the fingerprint: each empty bin draws until it comes to a filled one."""
    hashed = lambda data, seed: xxhash.xxh64_intdigest(data, seed)
    long = lambda v: (v & (2**64 - 1)).to_bytes(8, "little")
    short = lambda v: v.to_bytes(4, "little")
    words = [hashed(w.encode(), 42) for w in WORD.findall(text)]
    if not words:
        return []
    own = {}
    for i in range(max(1, len(words) - 4)):
        h = 42
        for w in words[i : i + 5]:
            h = hashed(long(w), h)
        h &= 2**63 - 1
        b, v = h >> 55, h & (2**55 - 1)
        own[b] = min(v, own.get(b, v))
    out = []
    for j in range(256):
        draws = (((j + 1) * (random.Random(k).getrandbits(31) | 1) & (2**31 - 1)) >> 23 for k in range(fingerprints.ASKED))
        first = j if j in own else next((b for b in draws if b in own), None)
        if first is None:
            signed = lambda h: h - 2**64 if h >> 63 else h
            first = min(own, key=lambda b: signed(hashed(short(j), hashed(short(b), 42))))
        out.append(hashed(short(j), hashed(long(own[first]), 42)) & 15)
    return out


def test_fingerprints_are_those_of_the_plain_version(docs, few):
    lone = [" ".join(f"w{n}x{i}" for i in range(n + 4)) for n in (1, 2, 5, 20, 50, 100, 300)]
    rows = [(10**7 + i, t) for i, t in enumerate([*lone, "two words", ""])]
    frame = few(*rows).union(docs.limit(40))
    got = {r.text: r.fingerprint for r in frame.join(fingerprints.fingerprint(frame), "doc_id").select("text", "fingerprint").collect()}
    assert len(got) > 40
    for text, digits in got.items():
        assert digits == "".join(f"{b:x}" for b in plain_bins(text or ""))


@pytest.mark.parametrize("n", [5, 20, 50])
def test_spread_of_short_texts(few, n):
    """The estimate of pairs of n shingles is right on average and spreads no more than n fresh draws would."""
    rows, truth = [], []
    for i in range(150):
        words = [f"a{i}x{j}" for j in range(n + 4)]
        other = words[: (n + 4) // 2 + 3] + [f"b{i}x{j}" for j in range(n + 4 - (n + 4) // 2 - 3)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
        a, b = shingles(rows[-2][1]), shingles(rows[-1][1])
        truth.append(len(a & b) / len(a | b))
    bins = {r.doc_id: np.array([int(x, 16) for x in r.fingerprint]) for r in fingerprints.fingerprint(few(*rows)).collect()}
    got = np.array([((bins[2 * i] == bins[2 * i + 1]).mean() - 1 / 16) / (15 / 16) for i in range(150)])
    error = got - np.array(truth)
    assert abs(error.mean()) < 3 * error.std() / 150**0.5 + 0.01
    assert error.std() < (truth[0] * (1 - truth[0]) / n) ** 0.5 + 0.03


def test_likeness_is_not_biased(few):
    """Pairs of known similarity, of few and of many shingles: the mean estimate is close."""
    for size in (30, 300):
        for near in (0.2, 0.8):
            rows, draw = [], random.Random(size)
            for i in range(40):
                shared = int(size * 2 * near / (1 + near))
                common = [f"c{i}w{draw.randrange(10**9)}" for _ in range(shared)]
                for side in "ab":
                    rows.append((i, " ".join([*common, *(f"{side}{i}w{draw.randrange(10**9)}" for _ in range(size - shared))])))
            bins = fingerprints.with_bins(few(*rows), "text", "bins").select("doc_id", "text", "bins")
            pairs = bins.alias("x").join(bins.alias("y"), "doc_id").where("x.text < y.text")
            found = pairs.select("x.text", F.col("y.text").alias("other"), fingerprints.likeness(F.col("x.bins"), F.col("y.bins")).alias("l"))
            errors = [r.l - likeness(shingles(r.text), shingles(r.other)) for r in found.collect()]
            assert abs(np.mean(errors)) < 0.04
