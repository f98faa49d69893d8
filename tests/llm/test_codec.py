import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from corpus_health.llm import bpe

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def plain():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tiny(plain):
    return bpe.TreeCodec(plain, P.PATTERN, leaf_chars=4, leaf_bytes=3)


def test_joining_gives_what_one_pass_gives(plain, tiny):
    draw = random.Random(5)
    parts = ["a", "é", " ", "  ", "\n", "'", "s", "re", "1", "23", "日本", "!", "\x1c", "\xa0", "the", "ing", "\t", "😀", "'ll"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 50)))
        ids = tiny.encode(text)
        assert ids.tolist() == plain.encode_ordinary(text), text
        assert tiny.decode(ids) == text.encode()


def test_long_runs_without_a_cut(plain, tiny):
    draw = random.Random(6)
    for kind in (["a", "b"], [" "], ["1", "2"], ["é", "a"], ["!", "'"], [" ", "\n"]):
        text = "".join(draw.choice(kind) for _ in range(1500))
        assert tiny.encode(text).tolist() == plain.encode_ordinary(text)


def test_windows_end_at_white_space_after_any_character(plain, monkeypatch):
    """Words of symbols end a window as words of letters do: no window reaches over its node."""
    codec = bpe.TreeCodec(plain, P.PATTERN)
    windows = []
    monkeypatch.setattr(codec, "_window", lambda text: windows.append(text) or plain.encode_ordinary(text))
    for text in ("-- ;; \n.. (!) " * 200, "+\t== " * 300, "a\x1c\n \xa0\n?? " * 200):
        assert codec.encode(text).tolist() == plain.encode_ordinary(text)
    assert not windows


def test_joins_at_white_space_of_all_kinds(plain, tiny):
    draw = random.Random(7)
    spaces = [" ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", "\u2028", "\u3000", "\u180e", "\u200b"]
    others = ["'", "'s", "x", "é", "7", "½", "-", "…", "\u0301", "\x00", "\U0001f600"]
    for _ in range(3000):
        text = "".join(draw.choice(draw.choice((spaces, others))) for _ in range(draw.randint(0, 40)))
        assert tiny.encode(text).tolist() == plain.encode_ordinary(text), text


def check(df, rows, plain):
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect())
    want = []
    for doc_id, text in rows:
        ids = np.array(plain.encode_ordinary(text or ""), dtype="<u4").tobytes()
        digest = hashlib.sha256
        want.append((doc_id is None, doc_id, len(ids) // 4, digest(ids).hexdigest(), digest((text or "").encode()).hexdigest()))
    key = lambda r: (r[0], r[1] or 0, *r[2:])
    assert sorted(map(str, sorted(got, key=key))) == sorted(map(str, sorted(want, key=key)))


def test_table(docs, texts, plain):
    check(bpe.round_trip(docs, RANKS), texts.items(), plain)


def test_texts_of_the_table_are_joined(texts, plain):
    """All but short texts are made by joins: nearly all documents, with a join for each leaf but one."""
    codec = bpe.TreeCodec(plain, P.PATTERN)
    met = 0
    for text in texts.values():
        before = codec.joins
        assert codec.encode(text or "").tolist() == plain.encode_ordinary(text or "")
        joins = codec.joins - before
        assert joins >= len(text or "") // bpe.LEAF_CHARS - 1
        met += joins > 0
    assert met >= 0.9 * len(texts)


def test_odd_rows(clashing, plain):
    rows = [(r.doc_id, r.text) for r in clashing.select("doc_id", "text").collect()]
    check(bpe.round_trip(clashing, RANKS), rows, plain)


def test_one_worker_or_two(docs):
    two = bpe.decode(bpe.encode(docs, RANKS), RANKS)
    assert sorted(two.collect()) == sorted(bpe.encode_and_decode(docs, RANKS).collect())


def test_empty_table(empty):
    assert bpe.round_trip(empty, RANKS).count() == 0
