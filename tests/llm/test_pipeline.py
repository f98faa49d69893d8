import base64
import hashlib
import inspect
import math
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from corpus_health.llm import language, secrets

from .conftest import SMALL
from .test_copies import brute_join
from .test_models import brute_grams, brute_predict, brute_ranked
from .test_placing import brute_copies

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, docs, tmp_path_factory):
    """The rows that each stage makes of the one before's, by name, in order."""
    out, df = {"documents": docs.collect()}, docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, df, SMALL).write.parquet(path)
        df = spark.read.parquet(path)
        out[name] = df.collect()
    return out


def test_form():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "secret_scan", "mix_sources", "tokenize"]
    for _, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]


def test_columns(stages):
    for name, rows in list(stages.items())[:-1]:
        assert list(rows[0].asDict()) == NAMES, name


def test_language_stage(stages):
    rows = stages["documents"]
    counts = {}
    for r in rows:
        counts.setdefault(r.lang, Counter()).update(brute_grams(r.text))
    profiles = {lang: brute_ranked(c, language.PLACES) for lang, c in counts.items()}
    made = {r.doc_id: brute_predict(r.text, profiles, language.PLACES) for r in rows}
    least = brute_limits([(r.lang, *made[r.doc_id]) for r in rows], profiles)
    want = [r for r in rows if made[r.doc_id][0] != "und" and made[r.doc_id][1] >= max(language.LEAST_SCORE, least[made[r.doc_id][0]])]
    assert sorted(stages["language_id"]) == sorted(want)


def brute_limits(rows, langs):
    """[(label, prediction, score)] -> the least score of each language"""
    own = {lang: sorted(s for label, made, s in rows if label == made == lang) for lang in langs}
    every = sorted(s for scores in own.values() for s in scores)
    at = lambda scores, q: scores[max(0, math.ceil(q * len(scores)) - 1)]
    out = {}
    for lang, scores in own.items():
        n = len(scores)
        low, middle = ((n * at(scores or every, q) + 100 * at(every, q)) / (n + 100) for q in (0.05, 0.5))
        out[lang] = math.floor(100 * (low - 2 * (middle - low))) / 100
    return out


def test_limits_of_a_small_language_have_no_step(spark, docs):
    """Brute force at each size of the smallest language; one more document hardly moves its limit."""
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect() if r.lang in ("de", "es")]
    few = [r.text for r in docs.collect() if r.lang == "fr"]
    limits = {}
    for n in (1, 49, 50, 99, 100, 101):
        table = spark.createDataFrame(rows + [(10_000 + i, few[i % len(few)], "fr") for i in range(n)], "doc_id bigint, text string, lang string")
        model = language.learn(table)
        made = [(r.lang, *model.predict(r.text)) for r in table.collect()]
        got = language.limits(table, model)
        assert got == brute_limits(made, ["de", "es", "fr"])
        limits[n] = got["fr"]
    assert abs(limits[49] - limits[50]) <= 0.02 and max(limits[n] for n in (99, 100, 101)) - min(limits[n] for n in (99, 100, 101)) <= 0.02


def test_language_stage_rejects_noise_and_other_languages(spark):
    """In the script of the learnt languages: noise and languages without a label go, clean documents stay."""
    draw = random.Random(2)
    letters = " ".join("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(2, 9))) for _ in range(200))
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem. "
    turkish = "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler. "
    strange = [(letters, "en"), (base64.b64encode(draw.randbytes(900)).decode(), "de"), (polish, None), (turkish, None)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*NAMES)
    rows = [(-i - 1, t, lang, "s", len(t)) for i, (t, lang) in enumerate(strange)]
    both = docs.union(spark.createDataFrame(rows, docs.schema))
    kept = [r.doc_id for r in corpus_pipeline.language_id(spark, both, SMALL).select("doc_id").collect()]
    assert sorted(kept) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def test_near_duplicate_stage(stages):
    before = stages["language_id"]
    classes = {c for _, c, _ in brute_join([(r.doc_id, r.text) for r in before])}
    assert sorted(stages["near_duplicates"]) == sorted(r for r in before if str(r.doc_id) in classes)


def test_secret_stage(stages):
    want = []
    for r in stages["near_duplicates"]:
        text = secrets.redact(r.text, secrets.find(r.text)[1])
        want.append((r.doc_id, text, r.lang, r.source, len(text)))
    assert sorted(map(tuple, stages["secret_scan"])) == sorted(want)


def test_mix_stage(stages):
    before = stages["secret_scan"]
    size = Counter(r.source for r in before)
    want = Counter()
    for r in before:
        want[r] = brute_copies(r.doc_id, len(before) / len(size) / size[r.source])
    assert Counter(stages["mix_sources"]) == +want


def test_token_stage(stages):
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in stages["mix_sources"]:
        ids = np.array(plain.encode_ordinary(r.text), dtype="<u4").tobytes()
        want.append((r.doc_id, len(ids) // 4, ids, hashlib.sha256(ids).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, bytes(r.ids), r.ids_sha256, r.decoded_sha256) for r in stages["tokenize"]]
    assert sorted(got) == sorted(want)


def test_run_is_the_stages(spark, stages):
    got = Counter((r.doc_id, r.ids_sha256) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert got == Counter((r.doc_id, r.ids_sha256) for r in stages["tokenize"])


@pytest.mark.parametrize("frame", ["clashing", "empty"])
def test_odd_rows_pass_each_stage(spark, frame, request):
    df = request.getfixturevalue(frame)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SMALL)
        assert set(out.columns) == set(df.columns)
        assert out.count() <= 20
    assert corpus_pipeline.STAGES[-1][1](spark, df, SMALL).count() == df.count()
