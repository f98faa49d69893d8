"""Byte-level BPE encoding and decoding as a tree reduction.

A text is cut into halves until they are small, the leaves are encoded, and
neighbours are joined: a window around the seam grows until nothing outside can
change, only the window is encoded again, and the tokens outside are kept.

Two facts make the ends of a window final:

* The split pattern never matches across a white space character that follows
  any other character, wherever the match starts and whatever follows, so such a
  place always starts a new match and what is left and right of it is encoded
  independently.
* Inside one match, a sequence of tokens is the encoding of its bytes if and
  only if each pair of neighbours is the encoding of the pair's bytes. Joining
  two encodings leaves all inner pairs as they are, so only the pairs at the ends
  of the encoded window need a look.

Long matches without any such place (runs of letters, digits or spaces) are
therefore reduced by the second rule, everything else by the first.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_left

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_health.llm.common import map_rows

#: Characters of a leaf of a text, bytes of a leaf of one long match, ids of a leaf in decoding.
LEAF_CHARS = 128
LEAF_BYTES = 256
LEAF_IDS = 4096

#: What stands around a cut. \S leaves out all that the split pattern takes for white space, and some more.
_AROUND_CUT = re.compile(r"\S[ \n\t\r]")


def load(rank_file: bytes, pattern: str) -> tiktoken.Encoding:
    """The encoding of a rank file's content (one base64 token and its rank a line)."""
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class TreeCodec:
    """Encodes texts to arrays of ids and back, by halves."""

    def __init__(self, encoding: tiktoken.Encoding, pattern: str, leaf_chars=LEAF_CHARS, leaf_bytes=LEAF_BYTES):
        import regex

        self.leaf_chars, self.leaf_bytes = max(2, leaf_chars), max(2, leaf_bytes)
        self._ids = encoding.encode_ordinary
        self._piece = encoding._encode_single_piece
        self._token = encoding.decode_single_token_bytes
        #: Bytes of each token, by its id; ids that no token has are never asked for.
        self._sizes = [0] * encoding.n_vocab
        for token in encoding.token_byte_values():
            self._sizes[encoding.encode_single_token(token)] = len(token)
        self._bytes = encoding.decode_bytes
        self._matches = regex.compile(pattern).finditer
        #: Leaves that were joined with a neighbour so far.
        self.joins = 0

    # -- encoding ---------------------------------------------------------

    def encode(self, text: str) -> np.ndarray:
        cuts = [m.end() - 1 for m in _AROUND_CUT.finditer(text)] if len(text) > self.leaf_chars else []
        return np.array(self._half(text, cuts, 0, len(text)), dtype="<u4")

    def _half(self, text: str, cuts: list[int], lo: int, hi: int) -> list[int]:
        if hi - lo <= self.leaf_chars:
            return self._ids(text[lo:hi])
        mid = (lo + hi) // 2
        return self._join(text, cuts, lo, mid, hi, self._half(text, cuts, lo, mid), self._half(text, cuts, mid, hi))

    def _join(
        self, text: str, cuts: list[int], lo: int, mid: int, hi: int, left: list[int], right: list[int]
    ) -> list[int]:
        """Both sides' ids, with those around the seam made anew from a window that reaches to the next cuts."""
        self.joins += 1
        at = bisect_left(cuts, mid)
        stop = min(cuts[at], hi) if at < len(cuts) else hi
        if stop == mid:
            left += right
            return left
        start = max(cuts[at - 1], lo) if at else lo
        window = text[start:stop]
        made = self._ids(window) if len(window) <= self.leaf_chars else self._window(window)
        skip = self._front(right, len(text[mid:stop].encode()))
        del left[self._back(left, len(text[start:mid].encode())) :]
        left += made
        left += right[skip:]
        return left

    def _back(self, ids: list[int], n_bytes: int) -> int:
        """How many ids stand before the last `n_bytes` bytes."""
        at, sizes = len(ids), self._sizes
        while n_bytes > 0:
            at -= 1
            n_bytes -= sizes[ids[at]]
        return at

    def _front(self, ids: list[int], n_bytes: int) -> int:
        at, sizes = 0, self._sizes
        while n_bytes > 0:
            n_bytes -= sizes[ids[at]]
            at += 1
        return at

    def _window(self, text: str) -> list[int]:
        """A long window: its matches one by one, long ones by halves of their bytes."""
        out: list[int] = []
        for m in self._matches(text):
            out += self._run(m.group().encode())
        return out

    def _run(self, data: bytes) -> list[int]:
        if len(data) <= self.leaf_bytes:
            return self._piece(data)
        mid = len(data) // 2
        left, right = self._run(data[:mid]), self._run(data[mid:])
        return self._join_run(left, right)

    def _join_run(self, left: list[int], right: list[int]) -> list[int]:
        i = j = 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            made = self._piece(self._bytes(left[len(left) - i :]) + self._bytes(right[:j]))
            left_done = i == len(left) or self._fits(left[-i - 1], made[0])
            right_done = j == len(right) or self._fits(made[-1], right[j])
            if left_done and right_done:
                return left[: len(left) - i] + made + right[j:]
            i, j = i if left_done else 2 * i, j if right_done else 2 * j

    def _fits(self, a: int, b: int) -> bool:
        return self._piece(self._token(a) + self._token(b)) == [a, b]

    # -- decoding ---------------------------------------------------------

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids: leaves are decoded, and neighbours concatenated up the tree."""
        parts = [self._bytes(ids[at : at + LEAF_IDS].tolist()) for at in range(0, len(ids), LEAF_IDS)] or [b""]
        while len(parts) > 1:
            parts = [b"".join(parts[at : at + 2]) for at in range(0, len(parts), 2)]
        return parts[0]


def _codec(docs: DataFrame, ranks: str, pattern: str):
    with open(ranks, "rb") as f:  # the vocabulary file lies beside the driver's program
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    return lambda: TreeCodec(load(content.value, pattern), pattern)


def encode(docs: DataFrame, ranks: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens, ids: the text of each document as ids, packed as little-endian unsigned 32-bit integers.

    A null text is encoded as the empty text (no ids). Rows come out as they came
    in: repeated ids and null ids stay. Columns besides doc_id and text are not read.
    """
    start = _codec(docs, ranks, pattern)

    def begin():
        codec = start()

        def run(ids, texts):
            made = [codec.encode(t or "") for t in texts]
            return ids, [len(m) for m in made], [m.tobytes() for m in made]

        return run

    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, n_tokens bigint, ids binary", begin, 64)


def decode(encoded: DataFrame, ranks: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens, ids and data: the bytes that the packed ids stand for. Null ids give no bytes."""
    start = _codec(encoded, ranks, pattern)

    def begin():
        codec = start()

        def run(doc_ids, n_tokens, ids):
            data = [codec.decode(np.frombuffer(x or b"", dtype="<u4")) for x in ids]
            return doc_ids, n_tokens, ids, data

        return run

    schema = "doc_id bigint, n_tokens bigint, ids binary, data binary"
    return map_rows(encoded.select("doc_id", "n_tokens", "ids"), schema, begin, 64)


def encode_and_decode(docs: DataFrame, ranks: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """What `decode` gives of what `encode` gives, in one Python worker instead of a chain of two."""
    start = _codec(docs, ranks, pattern)

    def begin():
        codec = start()

        def run(doc_ids, texts):
            ids = [codec.encode(t or "") for t in texts]
            return doc_ids, [len(i) for i in ids], [i.tobytes() for i in ids], [codec.decode(i) for i in ids]

        return run

    schema = "doc_id bigint, n_tokens bigint, ids binary, data binary"
    return map_rows(docs.select("doc_id", "text"), schema, begin, 64)


def round_trip(docs: DataFrame, ranks: str, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: digests of the ids and of the bytes decoded from them."""
    return encode_and_decode(docs, ranks, pattern).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256")
    )
