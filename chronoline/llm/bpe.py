"""Byte-level BPE as a monoid: encode halves, join neighbours (operator 1)."""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoline.llm.common import ship, whole_text

LEAF_CHARS = 2048   # texts up to this size are encoded at once
LEAF_BYTES = 512    # the same inside one match of the pattern
WINDOW_CHARS = 64   # first boundary window, on either side
WINDOW_TOKENS = 4   # first boundary window inside one match
BATCH_BYTES = 8 << 20  # rows handled at a time

# Places where any scan of any text begins a new match, as no match has white
# space after another character, nor two of letter, digit and sign (but ' before
# a letter).  Only ASCII signs count, so Unicode versions do not matter.
_SIGN, _NOT_QUOTE = r"!-/:-@\[-`{-~", r"!-&(-/:-@\[-`{-~"
_CUT = (r"(?<=\P{White_Space})(?=[ \t\r\n])|(?<=[A-Za-z])(?=[0-9" + _SIGN + r"])|(?<=[0-9])(?=[A-Za-z"
        + _SIGN + r"])|(?<=[" + _NOT_QUOTE + r"])(?=[A-Za-z0-9])")


class Codec:
    """Encoder and decoder for a file of ranks and a splitting pattern.

    ``encode`` is a homomorphism from texts to token sequences under
    :meth:`join`.  A join encodes a window over the seam again.  The window grows
    until each end is a place that every scan cuts (:data:`_CUT`), so that the
    tokens outside it cannot change.  Inside one very long match there is no such
    place; there :meth:`_join_piece` grows a window of tokens until the pairs at
    its two ends encode to themselves: a sequence whose neighbouring pairs all do
    is the encoding of its bytes.
    """

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._enc = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._bytes = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self._bytes[rank] = token
        self._len = np.array([len(b) for b in self._bytes], np.int64)
        self._cut = regex.compile(_CUT)
        self._cut_back = regex.compile("(?r)" + _CUT)
        self._matches = regex.compile(pattern.replace(r"[^\s", r"[^\p{White_Space}")
                                      .replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self._pair = functools.lru_cache(1 << 16)(self._pair_stays)

    def encode(self, text: str) -> np.ndarray:
        """Token ids, as the library gives for the whole text without specials."""
        if len(text) <= LEAF_CHARS:
            return self._leaf(text)
        mid = len(text) // 2
        left, right = text[:mid], text[mid:]
        return self.join(left, self.encode(left), right, self.encode(right))

    def _leaf(self, text: str) -> np.ndarray:
        return self._enc.encode_to_numpy(text, disallowed_special=())

    def join(self, left: str, a: np.ndarray, right: str, b: np.ndarray) -> np.ndarray:
        """The tokens of ``left + right`` from the tokens of each."""
        s, e = self._seam(left, right)
        window = left[s:] + right[:e]
        new = self._leaf(window) if len(window) <= LEAF_CHARS else self._long(window)
        return np.concatenate([a[:len(a) - self._covering(a[::-1], left[s:])], new,
                               b[self._covering(b, right[:e]):]])

    def _seam(self, left: str, right: str) -> tuple[int, int]:
        """The last cut of ``left`` and the first of ``right``, or their ends."""
        w = WINDOW_CHARS
        while True:
            m = self._cut_back.search(left, max(1, len(left) - w), len(left) - 1)
            if m or w >= len(left):
                s = m.start() if m else 0
                break
            w *= 2
        w = WINDOW_CHARS
        while True:
            m = self._cut.search(right, 1, min(len(right) - 1, w))
            if m or w >= len(right):
                return s, m.start() if m else len(right)
            w *= 2

    def _covering(self, tokens: np.ndarray, text: str) -> int:
        """How many of ``tokens``, from the first, make up ``text``'s bytes."""
        want, n = len(text.encode()), 0
        if not want:
            return 0
        while True:
            n = min(len(tokens), max(64, 2 * n))
            ends = np.cumsum(self._len[tokens[:n]])
            if ends[-1] >= want:
                return int(np.searchsorted(ends, want)) + 1

    def _long(self, text: str) -> np.ndarray:
        """A window over a very long match: each match by halves of its bytes."""
        parts = [self._piece(m.encode()) for m in self._matches.findall(text)]
        return np.concatenate([np.asarray(p, np.uint32) for p in parts])

    def _piece(self, data: bytes) -> list[int]:
        if len(data) <= LEAF_BYTES:
            return self._enc._core_bpe.encode_single_piece(data)
        mid = len(data) // 2
        return self._join_piece(self._piece(data[:mid]), self._piece(data[mid:]))

    def _join_piece(self, a: list[int], b: list[int]) -> list[int]:
        w = WINDOW_TOKENS
        while True:
            i, j = max(0, len(a) - w), min(len(b), w)
            data = self._concat(a[i:] + b[:j])
            new = self._enc._core_bpe.encode_single_piece(data)
            if (i == 0 or self._pair(a[i - 1], new[0])) and (j == len(b) or self._pair(new[-1], b[j])):
                return a[:i] + new + b[j:]
            w *= 2

    def _pair_stays(self, x: int, y: int) -> bool:
        return self._enc._core_bpe.encode_single_piece(self._concat([x, y])) == [x, y]

    def _concat(self, tokens: list[int]) -> bytes:
        return b"".join([self._bytes[t] for t in tokens])

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ``ids``: halves are decoded and concatenated."""
        if len(ids) <= 1 << 16:
            return self._concat(ids.tolist())
        mid = len(ids) // 2
        return self.decode(ids[:mid]) + self.decode(ids[mid:])

    def ids_text(self, ids: np.ndarray) -> Iterator[bytes]:
        """The decimal ids joined by commas, in parts."""
        if self._digits is None:
            self._digits = [str(i) for i in range(len(self._bytes))]
        for i in range(0, len(ids), 1 << 16):
            yield (("," if i else "") + ",".join([self._digits[t] for t in ids[i:i + (1 << 16)].tolist()])).encode()

    _digits: list[str] | None = None


@functools.lru_cache(4)
def codec(ranks_path: str, pattern: str) -> Codec:
    """One codec for each Python worker."""
    return Codec(ranks_path, pattern)


def _map_text(docs: DataFrame, id_col: str, col, schema: str,
              rows: Callable[[object], tuple]) -> DataFrame:
    """``id_col`` and what ``rows`` makes of ``col``, one Arrow batch at a time."""
    ship(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    kept = docs.select(F.col(id_col).alias("id"), col.alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, BATCH_BYTES * len(batch) // max(1, batch.nbytes))
            for at in range(0, len(batch), step):
                part = batch.slice(at, step)
                out = [rows(v) for v in part.column(1)]
                yield pa.record_batch([part.column(0), *(pa.array(c, t) for c, t in zip(zip(*out), types))],
                                      names)

    names = ["id", *(f.split()[0] for f in schema.split(", "))]
    types = [{"long": pa.int64(), "string": pa.string(), "binary": pa.binary(),
              "array<int>": pa.list_(pa.int32()), "boolean": pa.bool_()}[f.split()[1]] for f in schema.split(", ")]
    return (kept.mapInArrow(run, f"id {id_type}, {schema}")
            .select(F.col("id").alias(id_col), *names[1:]))


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``id_col, ids``: the token ids of each whole text.  Null and empty texts
    have no ids.  Rows are independent: repeated rows repeat, no rows give none,
    other columns are not read.  A text of any length is encoded by halves, in
    memory proportional to that one text."""
    def rows(v):
        return (codec(ranks_path, pattern).encode(v.as_py()).astype(np.int32),)
    return _map_text(docs, id_col, whole_text(text_col), "ids array<int>", rows)


def decode(tokens: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           ids_col: str = "ids") -> DataFrame:
    """``id_col, decoded``: the bytes of each row's ids; null ids give no bytes."""
    def rows(v):
        return (codec(ranks_path, pattern).decode(np.asarray(v.as_py(), np.int64)),)
    return _map_text(tokens, id_col, F.coalesce(F.col(ids_col), F.array().cast("array<int>")),
                     "decoded binary", rows)


def tokenized(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids, round_trip``: the ids of :func:`encode`, and whether
    :func:`decode` makes the text's bytes of them."""
    def rows(v):
        c, text = codec(ranks_path, pattern), v.as_py()
        ids = c.encode(text)
        return len(ids), ids.astype(np.int32), c.decode(ids) == text.encode()
    return _map_text(docs, id_col, whole_text(text_col), "n_tokens long, ids array<int>, round_trip boolean", rows)


def token_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: digests of what
    :func:`encode` gives and :func:`decode` makes of it, taken where the ids are,
    so that the ids themselves do not travel."""
    def rows(v):
        c = codec(ranks_path, pattern)
        ids = c.encode(v.as_py())
        said = hashlib.sha256()
        for part in c.ids_text(ids):
            said.update(part)
        return len(ids), said.hexdigest(), hashlib.sha256(c.decode(ids)).hexdigest()
    return _map_text(docs, id_col, whole_text(text_col),
                     "n_tokens long, ids_sha256 string, decoded_sha256 string", rows)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                         P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
