"""Spelling variants, periodic runs and repeated word windows against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from corpus_health.llm import periods, queries, spelling, windows

from .conftest import LONG, SMALL, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TO_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- spelling variants ---------------------------------------------------------


def brute_vocabulary(rows, drop=31):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(TO_LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if drop and h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += len(run) >= 7
    return {w: n for w, n in count.items() if n >= 2}


def brute_near(words):
    """Each word's near words, through all ways to leave out or replace one letter."""
    holes = {}
    for w in words:
        for i in range(len(w)):
            holes.setdefault((w[:i], w[i + 1 :]), set()).add(w)
    out = {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            out[w] |= holes[(w[:i], w[i + 1 :])]
            if (less := w[:i] + w[i + 1 :]) in out:
                out[w].add(less)
                out[less].add(w)
        out[w].discard(w)
    return out


def brute_variants(count):
    near, out = brute_near(count), {}
    form = {}
    for w, n in count.items():
        best = min(near[w], key=lambda x: (-count[x], x), default=None)
        form[w] = best if best is not None and count[best] >= 10 * n else None
    for w, n in count.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), count.get(form[w]))
    return out


def found_variants(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def vocabulary_of(spark, count):
    return spark.createDataFrame(list(count.items()), "word string, n bigint")


def test_variants_of_the_table(spark, texts):
    want = brute_variants(brute_vocabulary(texts.items()))
    assert sum(v[0] is not None for v in want.values()) >= 10
    assert found_variants(queries.op11_spelling(spark, SMALL)) == want


def test_vocabulary_of_odd_rows(clashing, empty, few):
    rows = [(r.doc_id, r.text) for r in clashing.select("doc_id", "text").collect()]
    rows += [(20, "ÉCOLEX écolex ÉcoleX÷× ÉcoleX÷×"), (21, "naïveté, NAÏVETÉ; naÏvetÉ"), (None, "misspell " * 3)]
    got = {r.word: r.n for r in spelling.vocabulary(few(*rows), drop=31).collect()}
    assert got == brute_vocabulary(rows)
    assert spelling.variants(spelling.vocabulary(clashing)).columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found_variants(spelling.variants(spelling.vocabulary(empty))) == {}


def test_lists_that_are_cut_anew(spark, monkeypatch):
    """One stem holds most words: lists over the limit are cut, and no link is lost or counted twice."""
    draw = random.Random(3)
    stem = "wortstamm"
    words = {stem[:i] + "".join(draw.choice("abcé") for _ in range(draw.randint(0, 2))) + stem[i + draw.randint(0, 1) :] for i in draw.choices(range(9), k=600)}
    words |= {"".join(draw.choice("ab") for _ in range(draw.randint(7, 9))) for _ in range(300)}
    count = {w: draw.choice([2, 3, 30, 400, 5000]) for w in sorted(words) if len(w) >= 7}
    want = brute_variants(count)
    for longest in (5000, 8):
        monkeypatch.setattr(spelling, "LONGEST", longest)
        assert found_variants(spelling.variants(vocabulary_of(spark, count))) == want


def test_chains_lead_to_their_root(spark):
    """Five steps of ten times the count each, ties by code point, short and long words."""
    count = {"aaaaaaaa"[:i] + "bbbbbbbb"[i:]: 10**i for i in range(8)} | {"zzé": 50, "zzà": 50, "zz": 5, "q" * 5000: 100, "q" * 4999 + "x": 2}
    got = found_variants(spelling.variants(vocabulary_of(spark, count)))
    assert got == brute_variants(count)
    assert got["bbbbbbbb"][1] == "aaaaaaab" and got["zz"][0] == "zzà" and got["q" * 4999 + "x"][0] == "q" * 5000
    with pytest.raises(ValueError):
        spelling.variants(vocabulary_of(spark, count), ratio=1)


def test_scan_of_a_sorted_list():
    draw = random.Random(2)
    for _ in range(400):
        size = draw.randint(1, 5)
        entries = sorted({"".join(draw.choice("abc") for _ in range(draw.choice([size, size + 1]))) for _ in range(draw.randint(1, 40))})
        near = brute_near(entries)
        for last in (False, True):
            want = []
            for i, a in enumerate(entries):
                for j, b in enumerate(entries[i + 1 :], i + 1):
                    equal = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
                    if b in near[a] and min(len(a), len(b)) == size and (last or equal < size):
                        want.append((i, j))
            assert sorted(spelling.near(entries, size, last)) == want


# -- periodic runs -------------------------------------------------------------


def brute_runs(w, least=12):
    out, n = [], len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            s = i
            while i < n - q and w[i] == w[i + q]:
                i += 1
            size = i - s + q
            if i > s and size >= max(least, 2 * q):
                x = w[s : s + size]
                if all(any(x[t] != x[t + r] for t in range(size - r)) for r in range(1, q)):
                    out.append((s, size, q))
            i += i == s
    return sorted(out, key=lambda r: (r[0], r[2]))


def echoed(doc, w):
    n, h = len(w), zlib.crc32(str(doc).encode())
    if doc is None or h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def brute_periods(doc, text, alter=True):
    w = WORD.findall(text or "")
    w = echoed(doc, w) if alter else w
    found = brute_runs(w)
    drop = {i for s, size, q in found for i in range(s + q, s + size)}
    s, size, q = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    kept = " ".join(x for i, x in enumerate(w) if i not in drop)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    return (str(doc), len(found), s, size, q, None if s is None else 1000 * size // q, sha(lines), sha(kept))


def found_periods(df):
    return sorted(
        (str(r.doc_id), r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in df.collect()
    )


def test_periods_of_the_table(spark, texts):
    short = {i: t for i, t in texts.items() if len(t or "") < 12_000}
    got = [r for r in found_periods(queries.op12_periods(spark, SMALL)) if int(r[0]) in short]
    want = sorted(brute_periods(i, t) for i, t in short.items())
    assert sum(r[1] > 0 for r in want) > 15
    assert got == want


def test_periods_of_odd_rows(clashing, empty):
    rows = [(r.doc_id, r.text) for r in clashing.select("doc_id", "text").collect()]
    got = found_periods(periods.digest(periods.echo(clashing)))
    short = [(i, t) for i, t in rows if t is None or len(t) < 60_000]
    want = sorted(brute_periods(i, t) for i, t in short)
    assert [r for r in got if r[0] not in ("6", "7")] == want
    assert len(got) == len(rows)
    assert periods.digest(periods.echo(empty)).count() == 0


def test_runs_of_few_different_words():
    draw = random.Random(1)
    total = 0
    for _ in range(1500):
        k, n = draw.choice([1, 2, 3, 5]), draw.randint(0, 80)
        w = [draw.randrange(k) for _ in range(n)]
        if n > 20 and draw.random() < 0.5:
            a, p = draw.randrange(n), draw.randint(1, 20)
            w = [w[i] if i < a else w[a + (i - a) % min(p, n - a)] for i in range(n)]
        want = brute_runs(w)
        total += len(want)
        assert periods.find(np.array(w, dtype=np.int64)) == want
    assert total > 500


def test_long_periodic_texts():
    for words in ([0] * 30_000, [i % 7 for i in range(30_000)], list(range(500)) * 60):
        period = len(set(words))
        assert periods.find(np.array(words)) == [(0, 30_000, period)]


def test_texts_without_their_echoes(few):
    """Each run keeps its first period, also where runs overlap; documents without runs keep all words."""
    text = "start " + "a b c " * 5 + "middle " + "x " * 20 + "end"
    out = {r.doc_id: r for r in periods.collapse(few((1, text), (2, "no run\nat  all"), (3, None))).collect()}
    assert bytes(out[1].kept).decode() == "start a b c middle x end"
    assert [tuple(r) for r in out[1].runs] == [(1, 15, 3), (17, 20, 1)]
    assert bytes(out[2].kept).decode() == "no run at all" and out[2].runs == [] and bytes(out[3].kept) == b""


# -- repeated windows ----------------------------------------------------------


def brute_windows(rows, size=20):
    words = [WORD.findall(t or "") for _, t in rows]
    least = {}
    for (doc, _), w in zip(rows, words, strict=True):
        key = 2**63 - 1 if doc is None else doc
        for i in range(len(w) - size + 1):
            x = tuple(w[i : i + size])
            least[x] = min(least.get(x, key), key)
    out = []
    for (doc, _), w in zip(rows, words, strict=True):
        key = 2**63 - 1 if doc is None else doc
        gone, seen = set(), set()
        for i in range(len(w) - size + 1):
            x = tuple(w[i : i + size])
            if least[x] < key or x in seen:
                gone.update(range(i, i + size))
            seen.add(x)
        out.append((str(doc), len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return sorted(out)


def found_windows(df):
    return sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in windows.digest(df).collect())


def test_windows_of_the_table(docs, texts):
    want = brute_windows(list(texts.items()))
    assert sum(r[2] > 0 for r in want) > 20
    assert found_windows(docs) == want


@pytest.mark.parametrize("together", [1, 300, 1 << 19])
def test_windows_of_odd_rows(clashing, monkeypatch, together):
    monkeypatch.setattr(windows, "SLICE_WORDS", together)
    rows = [(r.doc_id, r.text) for r in clashing.select("doc_id", "text").collect()]
    assert found_windows(clashing) == brute_windows(rows)


def test_windows_of_an_empty_table(empty):
    assert rows_of(windows.digest(empty)) == (["doc_id", "kept_sha256", "n_removed", "n_words"], [])


@pytest.mark.parametrize("together", [1, 1 << 19])
def test_passages_of_all_lengths(few, monkeypatch, together):
    """Passages around the limit, at many places; one that a third of the rows holds; repeated and null ids; few words."""
    monkeypatch.setattr(windows, "SLICE_WORDS", together)
    draw = random.Random(9)
    noise = lambda n: [f"w{draw.randrange(10**6)}" for _ in range(n)]
    shared = [noise(n) for n in (19, 20, 21, 30, 60)]
    rows = []
    for i in range(90):
        w = noise(draw.randint(0, 30)) + (shared[2] if i % 3 == 0 else [])
        for _ in range(draw.randint(0, 3)):
            p = draw.choice(shared)
            w += p[draw.randint(0, 2) : len(p) - draw.randint(0, 2)] + noise(draw.randint(0, 9))
        rows.append((draw.choice([i, i, i, None, 5, -i]), draw.choice([" ", "\n", " \t"]).join(w)))
    rows += [(200, "a b " * 40), (201, "b a " * 12), (2**63 - 1, "z " * 25), (None, "z " * 25), (None, "z " * 25)]
    assert found_windows(few(*rows)) == brute_windows(rows)


def test_hashes_roll():
    values = np.random.default_rng(0).integers(0, 2**64, 60, dtype=np.uint64)
    base = int(windows._BASES[0])
    for size in (1, 2, 3, 7, 20):
        plain = [sum(int(v) * base ** (size - 1 - k) for k, v in enumerate(values[i : i + size])) % 2**64 for i in range(61 - size)]
        assert (windows.rolling(values, windows._BASES[0], size) == windows.mixed(np.array(plain, dtype=np.uint64))).all()


def test_spans_and_texts(few):
    text = " ".join(f"w{i}" for i in range(25))
    out = {r.doc_id: r for r in windows.remove(few((1, text), (2, "new " + text + " old"), (3, LONG[:100]))).collect()}
    assert out[1].n_removed == 0 and bytes(out[1].kept).decode() == text
    assert [tuple(s) for s in out[2].spans] == [(1, 26)] and bytes(out[2].kept) == b"new old"
