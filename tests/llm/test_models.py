import zlib
from collections import Counter

import numpy as np

from corpus_health.llm import language, queries, weaklabels

from .conftest import SMALL


def brute_grams(text):
    """Character n-grams of a text, from its words."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    if not letters.strip():
        return Counter()
    line = " " + " ".join(letters.split()) + " "
    grams = [c for c in line if c != " "]
    grams += [line[i : i + n] for n in (2, 3) for i in range(len(line) - n + 1)]
    return Counter(grams)


def brute_number(gram):
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def brute_ranked(counts, places):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], brute_number(x[0])))[:places]]


def brute_predict(text, profiles, places):
    own = brute_ranked(brute_grams(text or ""), places)
    if not own or not profiles:
        return "und", 0.0
    away = {}
    for lang, ranked in profiles.items():
        at = {g: i for i, g in enumerate(ranked)}
        away[lang] = sum(abs(at[g] - i) if g in at else places for i, g in enumerate(own))
    best = min(sorted(away), key=away.get)
    return best, 1 - away[best] / (places * len(own))


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_language_query(spark, docs):
    """Every row as a plain implementation gives it, and right on the documents kept out of training."""
    rows = docs.collect()
    counts = {}
    for r in rows:
        if not held_out(r.doc_id) and r.lang is not None:
            counts.setdefault(r.lang, Counter()).update(brute_grams(r.text))
    profiles = {lang: brute_ranked(c, language.PLACES) for lang, c in counts.items()}
    got = {r.doc_id: r for r in queries.op2_language(spark, SMALL).collect()}
    assert len(got) == len(rows)
    for r in rows:
        lang, score = brute_predict(r.text, profiles, language.PLACES)
        assert (got[r.doc_id].lang_pred, got[r.doc_id].held_out) == (lang, held_out(r.doc_id))
        assert abs(got[r.doc_id].score - score) < 1e-9
    kept_out = [r for r in rows if held_out(r.doc_id)]
    assert sum(got[r.doc_id].lang_pred == r.lang for r in kept_out) >= 0.95 * len(kept_out)


def test_language_does_not_see_labels(docs):
    model = language.learn(docs)
    one = sorted(language.identify(docs, model).collect())
    bare = docs.selectExpr("doc_id", "text", "'xx' as lang", "'none' as source")
    assert sorted(language.identify(bare, model).collect()) == one


def test_language_odd_rows(clashing, empty, docs):
    model = language.learn(clashing)
    got = language.identify(clashing, model).collect()
    assert len(got) == clashing.count()
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (1, 2, 3, 9)] == ["und"] * 4 and by[1].score == 0
    assert all(0 <= r.score <= 1 for r in got)
    assert language.identify(empty, model).count() == 0
    none = language.learn(empty)
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}


def test_language_filter_keeps_clean_documents(docs, clashing):
    model = language.learn(docs)
    kept = language.keep_known(docs, model)
    assert kept.columns == docs.columns and kept.count() == docs.count()
    out = language.keep_known(clashing, model)
    assert out.columns == clashing.columns
    assert not {1, 2, 3, 9} & {r.doc_id for r in out.collect()}


# -- weak labels -----------------------------------------------------------------


def test_expectation_maximisation_finds_accuracies():
    """Votes drawn from known accuracies: the estimates are near them, and the posterior sorts the classes."""
    draw = np.random.default_rng(1)
    m = len(weaklabels.HEURISTICS)
    good = draw.random(20_000) < 0.8
    accuracy = draw.uniform(0.75, 0.95, m)
    patterns, truth = Counter(), {}
    for is_good in good:
        value = 0
        for a in accuracy:
            vote = weaklabels.NOTHING if draw.random() < 0.3 else int(is_good == (draw.random() < a))
            value = value * 3 + vote
        patterns[value] += 1
        truth.setdefault(value, []).append(is_good)
    model = weaklabels.LabelModel(patterns)
    for found, want in zip(model.accuracies().values(), accuracy, strict=True):
        assert abs(found - want) < 0.03
    right = sum(sum(t) if model.posterior(v) > 0.5 else len(t) - sum(t) for v, t in truth.items())
    assert right > 0.97 * len(good)


def auc(labels, scores):
    order = np.argsort(np.argsort(scores)) + 1
    n = labels.sum()
    return (order[labels == 1].sum() - n * (n + 1) / 2) / (n * (len(labels) - n))


def test_scores_agree_with_labels_never_seen(spark):
    got = {r.doc_id: r for r in queries.op3_weak_labels(spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    quality = np.array([r.quality for r in labels])
    assert auc(quality, np.array([got[r.doc_id].score for r in labels])) > 0.97
    good = [r for r in labels if r.quality == 1]
    assert sum(got[r.doc_id].kept for r in good) >= 0.99 * len(good)
    bad = [r for r in labels if r.quality == 0]
    assert sum(not got[r.doc_id].kept for r in bad) >= 0.9 * len(bad)


def test_weak_labels_odd_rows(clashing, empty, docs):
    model, weights = weaklabels.learn(docs)
    got = weaklabels.score(clashing, model, weights).collect()
    assert len(got) == clashing.count()
    assert all(0 <= r.score <= 1 and 0 <= r.weak_label <= 1 for r in got)
    assert len({(r.score, r.weak_label) for r in got if r.doc_id in (4, 5)}) == 1
    assert weaklabels.score(empty, model, weights).count() == 0
    assert weaklabels.classify(empty).count() == 0


def test_training_repeats(docs):
    assert (weaklabels.learn(docs)[1] == weaklabels.learn(docs.repartition(5))[1]).all()


def test_places_are_cut_in_each_task_and_rows_without_id_are_not_held_out(odd):
    plan = language.profiles(odd)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan
    assert all(r.held_out is not None for r in language.predict_all(odd).collect())
