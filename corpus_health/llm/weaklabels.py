"""A quality classifier learnt without labels.

Simple heuristics vote good, bad or nothing on each document. Their votes overlap and
err; expectation-maximisation over the counts of all vote patterns estimates how often
each is right, and with that the probability that a document is good. These posterior
labels train a linear scorer over hashed words and word shapes, which then scores every
document, also those that the heuristics say little about.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from functools import cache, lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_health.llm.common import map_rows

GOOD, BAD, NOTHING = 1, 0, 2
SYMBOLS = frozenset("#*$%&|<>{}[]~^_=+\\")

ENDS = frozenset(".!?…")
#: For each heuristic the figure it looks at, and the ranges [from, to) that are good and bad. Each kind of
#: junk is seen by two or more, so that their agreement tells how far to trust them.
NEVER = (0.0, 0.0)
HEURISTICS = {
    "symbols": ("symbol_share", NEVER, (0.05, 2.0)),
    "symbol_words": ("symbol_word_share", NEVER, (0.2, 2.0)),
    "repeats": ("repeat_share", NEVER, (0.3, 2.0)),
    "few_kinds": ("same_word_share", NEVER, (0.75, 2.0)),
    "same_lines": ("same_line_share", NEVER, (0.3, 2.0)),
    "capitals": ("capital_share", NEVER, (0.3, 2.0)),
    "capital_words": ("capital_word_share", NEVER, (0.3, 2.0)),
    "word_length": ("word_length", NEVER, (9.0, 1e9)),
    "digits": ("digit_share", NEVER, (0.2, 2.0)),
    "short": ("n_words", (100.0, 1e18), (0.0, 5.0)),
    "endings": ("ending_share", (0.01, 0.3), (0.6, 2.0)),
}
#: Words from which sentence ends and capitals say anything.
LEAST_WORDS = 20
#: Rounds of expectation-maximisation, and votes added to each count.
ROUNDS = 50
PRIOR_VOTES = 2.0
#: Figures that are features too, rounded to tenths.
ROUNDED = ("symbol_share", "repeat_share", "capital_share", "same_line_share", "digit_share", "ending_share")
#: Words that a task remembers.
MOST_KNOWN = 1 << 18
#: Documents that the scorer is trained on, in the mean: a random sample by id; all, if there are no more.
TRAIN_ROWS = 5000
#: Hashed features, steps of training, its rate and penalty.
FEATURES = 1 << 16
STEPS = 150
RATE = 0.05
PENALTY = 1e-5
#: Score from which a document is kept.
LEAST_SCORE = 0.5


_SPACE, _UPPER, _LETTER, _DIGIT, _SYMBOL, _OTHER = range(6)


@cache
def _kinds() -> np.ndarray:
    """The kind of each code point."""

    def kind(c: str) -> int:
        if c.isspace():
            return _SPACE
        if c in SYMBOLS:
            return _SYMBOL
        return _UPPER if c.isupper() else _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _OTHER

    return np.fromiter((kind(chr(c)) for c in range(0x110000)), dtype=np.uint8, count=0x110000)


class Words(dict):
    """Numbers words as they come, and keeps what is known of each number's word: marks, and features if wanted."""

    def __init__(self, features: bool):
        self._features = features
        self.word, self.shape, self.marks = array("i"), array("i"), array("b")

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        if self._features:
            self.word.append(zlib.crc32(b"w" + word.lower().encode("utf-8", "surrogatepass")) % FEATURES)
            self.shape.append(_shape_feature(_shape(word)))
        self.marks.append((word[-1] in ENDS) + 2 * (not SYMBOLS.isdisjoint(word)) + 4 * word.isupper())
        return number

    def known(self, which: array, numbers: np.ndarray) -> np.ndarray:
        return np.frombuffer(which, dtype=which.typecode)[numbers] if which else numbers


class Reader:
    """Figures and features of texts, one after the other."""

    def __init__(self, features: bool = True):
        self._features = features
        self._words = Words(features)

    def read(self, text: str) -> dict[str, float]:
        """What the heuristics look at; 0 for what a text without words has none of."""
        if len(self._words) > MOST_KNOWN:
            self._words = Words(self._features)  # what is known of words is only kept to save time
        numbers = np.fromiter(map(self._words.__getitem__, text.split()), dtype=np.int64)
        self._kinds_of, again = np.unique(numbers, return_inverse=True)
        self._counts = np.bincount(again, minlength=len(self._kinds_of))
        n, m = max(1, len(numbers)), len(self._kinds_of)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kinds = np.bincount(_kinds()[points], minlength=6)
        letters, solid = kinds[_UPPER] + kinds[_LETTER], max(1, len(points) - kinds[_SPACE])
        lines = [x for x in text.split("\n") if x.strip()]
        windows = np.unique((again[:-2] * m + again[1:-1]) * m + again[2:], return_counts=True)[1]
        marks = self._words.known(self._words.marks, self._kinds_of)
        ends, signs, capitals = (int(self._counts[marks & bit > 0].sum()) for bit in (1, 2, 4))
        judged = len(numbers) >= LEAST_WORDS
        return {
            "symbol_share": kinds[_SYMBOL] / solid,
            "repeat_share": windows[windows > 1].sum() / max(1, len(numbers) - 2),
            "capital_share": judged * kinds[_UPPER] / max(1, letters),
            "same_line_share": 1 - len(set(lines)) / max(1, len(lines)),
            "word_length": solid / n,
            "digit_share": kinds[_DIGIT] / solid,
            "n_words": float(len(numbers)),
            "ending_share": ends / n if judged else 0.5,
            "symbol_word_share": signs / n,
            "same_word_share": 1 - m / n,
            "capital_word_share": judged * capitals / n,
        }

    def features(self, found: dict[str, float]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and values of the last text's hashed features: words and word shapes, of length 1, and rounded figures."""
        words = self._words
        hashed = [words.known(which, self._kinds_of) for which in (words.word, words.shape)]
        at, place = np.unique(np.concatenate(hashed), return_inverse=True)
        value = 1.0 + np.log(np.bincount(place, weights=np.tile(self._counts, 2)))
        value /= max(1e-9, float(value @ value)) ** 0.5
        rounded = [zlib.crc32(f"f{f}{round(10 * found[f])}".encode()) % FEATURES for f in ROUNDED]
        at = np.concatenate([at, rounded]).astype(np.int32)
        return at, np.concatenate([value, np.full(len(ROUNDED), 0.5)]).astype(np.float32)


def votes(found: dict[str, float]) -> int:
    """The heuristics' votes as one number, a digit to base 3 for each."""
    out = 0
    for figure, good, bad in HEURISTICS.values():
        x = found[figure]
        out = out * 3 + (GOOD if good[0] <= x < good[1] else BAD if bad[0] <= x < bad[1] else NOTHING)
    return out


def _digits(pattern: int) -> list[int]:
    out = []
    for _ in HEURISTICS:
        pattern, d = divmod(pattern, 3)
        out.append(d)
    return out[::-1]


class LabelModel:
    """How often each heuristic votes how on good and bad documents, estimated from the counts of vote patterns."""

    def __init__(self, patterns: dict[int, int]):
        m = len(HEURISTICS)
        seen = np.array([_digits(p) for p in patterns] or np.zeros((0, m)), dtype=np.int64).reshape(-1, m)
        counts = np.array(list(patterns.values()), dtype=np.float64)
        voted = np.stack([(seen == v) for v in range(3)], axis=2).astype(np.float64)
        # to begin with the heuristics are believed: a bad vote outweighs all good ones
        balance = 1.0 + (seen == GOOD).sum(axis=1) - 5.0 * (seen == BAD).sum(axis=1)
        good = 1 / (1 + np.exp(-balance))
        for _ in range(ROUNDS):
            self.share, self.chances = np.array([0.5, 0.5]), np.full((2, m, 3), 1 / 3)
            weights = np.stack([counts * (1 - good), counts * good])
            total = weights.sum(axis=1)
            self.share = (total + PRIOR_VOTES) / (total.sum() + 2 * PRIOR_VOTES)
            self.chances = np.einsum("cp,pmv->cmv", weights, voted) + PRIOR_VOTES / 3
            self.chances /= self.chances.sum(axis=2, keepdims=True)
            good = self._posterior(seen)

    def _posterior(self, seen: np.ndarray) -> np.ndarray:
        logs = np.log(self.share)[:, None] + sum(np.log(self.chances[:, i, seen[:, i]]) for i in range(seen.shape[1]))
        return 1 / (1 + np.exp(np.clip(logs[BAD] - logs[GOOD], -500, 500)))

    def posterior(self, pattern: int) -> float:
        return float(self._posterior(np.array([_digits(pattern)]))[0])

    def accuracies(self) -> dict[str, float]:
        """For each heuristic how probably a vote of it is right."""
        right = self.share[GOOD] * self.chances[GOOD, :, GOOD] + self.share[BAD] * self.chances[BAD, :, BAD]
        cast = (self.share[:, None, None] * self.chances[:, :, :2]).sum(axis=(0, 2))
        return dict(zip(HEURISTICS, (right / cast).tolist(), strict=True))


def _sign(c: str) -> str:
    return "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c


def _shape(word: str) -> str:
    """The kinds of a word's characters, runs as one."""
    if word.isalpha():  # nearly all words
        if word.islower():
            return "a"
        if word[1:].islower():
            return "Aa"
    out = ""
    for c in word:
        s = _sign(c)
        if out[-1:] != s:
            out += s
    return out


@lru_cache(maxsize=1 << 12)
def _shape_feature(shape: str) -> int:
    return zlib.crc32(b"s" + shape.encode("utf-8", "surrogatepass")) % FEATURES


def _train(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray) -> np.ndarray:
    """Weights of a logistic scorer (the last one is the bias), by gradient steps over all rows."""
    weights = np.zeros(FEATURES + 1)
    if not rows:
        return weights
    sizes = np.array([len(i) for i, _ in rows])
    at, value = np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]).astype(np.float64)
    row = np.repeat(np.arange(len(rows)), sizes)
    mean, spread = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    for step in range(1, STEPS + 1):
        logit = np.bincount(row, weights[at] * value, minlength=len(rows)) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - target) / len(rows)
        slope = np.append(np.bincount(at, value * error[row], minlength=FEATURES), error.sum()) + PENALTY * weights
        mean = 0.9 * mean + 0.1 * slope
        spread = 0.999 * spread + 0.001 * slope**2
        weights -= RATE * (mean / (1 - 0.9**step)) / (np.sqrt(spread / (1 - 0.999**step)) + 1e-9)
    return weights


def learn(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[LabelModel, np.ndarray]:
    """The label model of all documents, and the weights of the scorer trained on a sample of them.

    What comes to the driver: the counts of at most 3 ** len(HEURISTICS) patterns, and the
    features of about `train_rows` documents.
    """

    def count():
        reader = Reader(features=False)

        def run(texts):
            found = Counter(votes(reader.read(t or "")) for t in texts)
            return list(found), list(found.values())

        return run

    counted = map_rows(docs.select("text"), "pattern bigint, n bigint", count, 4096)
    patterns = {r.pattern: r.n for r in counted.groupBy("pattern").agg(F.sum("n").alias("n")).orderBy("pattern").collect()}
    model = LabelModel(patterns)
    total = sum(patterns.values())
    share = min(1.0, train_rows / max(1, total))
    draw = F.pmod(F.xxhash64(F.lit("train"), F.col("doc_id"), F.xxhash64("text")), F.lit(1 << 30)) < int(share * (1 << 30))

    def sample():
        reader = Reader()

        def run(texts):
            out = ([], [], [])
            for text in texts:
                found = reader.read(text or "")
                at, value = reader.features(found)
                for o, v in zip(out, (votes(found), at.tobytes(), value.tobytes()), strict=True):
                    o.append(v)
            return out

        return run

    rows = map_rows(docs.where(draw).select("text"), "pattern bigint, at binary, value binary", sample).collect()
    rows.sort(key=lambda r: (r.at, r.value))  # training does not depend on the order of tasks
    pairs = [(np.frombuffer(r.at, dtype=np.int32), np.frombuffer(r.value, dtype=np.float32)) for r in rows]
    return model, _train(pairs, np.array([model.posterior(r.pattern) for r in rows]))


def score(docs: DataFrame, model: LabelModel, weights: np.ndarray, least: float = LEAST_SCORE) -> DataFrame:
    """doc_id, weak_label, score, kept: what the heuristics' votes and the scorer say that each document is good.

    A null text is empty. Every row gets its own result; columns besides doc_id and text
    are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.share, model.chances, weights))

    def begin():
        share, chances, known = shared.value
        label = LabelModel.__new__(LabelModel)
        label.share, label.chances = share, chances
        reader = Reader()

        def run(ids, texts):
            out = ([], [], [])
            for text in texts:
                found = reader.read(text or "")
                at, value = reader.features(found)
                logit = float(known[at] @ value) + known[-1]
                good = float(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
                for o, v in zip(out, (label.posterior(votes(found)), good, good >= least), strict=True):
                    o.append(v)
            return ids, *out

        return run

    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, weak_label double, score double, kept boolean", begin)


def classify(docs: DataFrame) -> DataFrame:
    """Learn from a table and score it."""
    return score(docs, *learn(docs))
