"""The weak-label classifier row by row against a plain second version."""

import math
import zlib
from collections import Counter
from itertools import groupby

import numpy as np

from corpus_health.llm import queries, weaklabels

from .conftest import SMALL

SYMBOLS = set("#*$%&|<>{}[]~^_=+\\")
FEATURES = 1 << 16


def kind(c):
    if c.isspace():
        return " "
    if c in SYMBOLS:
        return "#"
    return "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else "."


def figures(text):
    words, kinds = text.split(), Counter(map(kind, text))
    n, solid = max(1, len(words)), max(1, len(text) - kinds[" "])
    lines = [x for x in text.split("\n") if x.strip()]
    triples = Counter(zip(words, words[1:], words[2:], strict=False))
    long = len(words) >= 20
    return {
        "symbol_share": kinds["#"] / solid,
        "symbol_word_share": sum(bool(SYMBOLS & set(w)) for w in words) / n,
        "repeat_share": sum(k for k in triples.values() if k > 1) / max(1, len(words) - 2),
        "same_word_share": 1 - len(set(words)) / n,
        "same_line_share": 1 - len(set(lines)) / max(1, len(lines)),
        "capital_share": kinds["A"] / max(1, kinds["A"] + kinds["a"]) if long else 0,
        "capital_word_share": sum(w.isupper() for w in words) / n if long else 0,
        "word_length": solid / n,
        "digit_share": kinds["0"] / solid,
        "n_words": len(words),
        "ending_share": sum(w[-1] in ".!?…" for w in words) / n if long else 0.5,
    }


def voted(found):
    out = []
    for figure, good, bad in weaklabels.HEURISTICS.values():
        x = found[figure]
        out.append(1 if good[0] <= x < good[1] else 0 if bad[0] <= x < bad[1] else 2)
    return tuple(out)


def brute_labels(patterns):
    """Expectation-maximisation by plain loops: the probability of good for each pattern."""
    good = {p: 1 / (1 + math.exp(-(1 + p.count(1) - 5 * p.count(0)))) for p in patterns}
    for _ in range(50):
        weight = [{p: n * (good[p] if c else 1 - good[p]) for p, n in patterns.items()} for c in (0, 1)]
        total = [sum(w.values()) + 2 for w in weight]
        share = [t / sum(total) for t in total]
        chance = [
            [[sum(x for p, x in w.items() if p[i] == v) + 2 / 3 for v in range(3)] for i in range(len(weaklabels.HEURISTICS))]
            for w in weight
        ]
        chance = [[[x / sum(row) for x in row] for row in rows] for rows in chance]
        for p in patterns:
            logs = [math.log(share[c]) + sum(math.log(chance[c][i][v]) for i, v in enumerate(p)) for c in (0, 1)]
            good[p] = 1 / (1 + math.exp(min(500, max(-500, logs[0] - logs[1]))))
    return good


def shape(word):
    signs = ("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return "".join(c for c, _ in groupby(signs))


def features(text, found):
    """A dense row of hashed words, word shapes and rounded figures, and 1 for the bias."""
    count = Counter()
    for w in text.split():
        count[zlib.crc32(b"w" + w.lower().encode()) % FEATURES] += 1
        count[zlib.crc32(b"s" + shape(w).encode()) % FEATURES] += 1
    row = np.zeros(FEATURES + 1)
    for at, n in count.items():
        row[at] = 1 + math.log(n)
    row /= max(1e-9, float(row @ row)) ** 0.5
    for name in ("symbol_share", "repeat_share", "capital_share", "same_line_share", "digit_share", "ending_share"):
        row[zlib.crc32(f"f{name}{round(10 * found[name])}".encode()) % FEATURES] += 0.5
    row[-1] = 1
    return row


def brute_scores(rows, target):
    """A logistic scorer over dense rows by 150 steps with running means of slopes and their squares."""
    weights, mean, square = (np.zeros(FEATURES + 1) for _ in range(3))
    for step in range(1, 151):
        made = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (made - target) / len(rows) + 1e-5 * weights
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        weights = weights - 0.05 * mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
    return 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))


def test_every_row_is_that_of_the_plain_version(spark, texts):
    found = {i: figures(t or "") for i, t in texts.items()}
    votes = {i: voted(f) for i, f in found.items()}
    label = brute_labels(Counter(votes.values()))
    rows = np.stack([features(texts[i] or "", found[i]) for i in texts])
    score = dict(zip(texts, brute_scores(rows, np.array([label[votes[i]] for i in texts])), strict=True))
    got = queries.op3_weak_labels(spark, SMALL).collect()
    assert len(got) == len(texts) and len(set(votes.values())) > 5
    for r in got:
        assert abs(r.weak_label - label[votes[r.doc_id]]) < 1e-9
        assert abs(r.score - score[r.doc_id]) < 1e-4
        assert r.kept == (score[r.doc_id] >= 0.5) or abs(score[r.doc_id] - 0.5) < 1e-4
