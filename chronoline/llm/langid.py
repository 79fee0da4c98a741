"""Language identification by unigram pieces, summed over all segmentations
(operator 5)."""

from __future__ import annotations

import base64
import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoline.llm.common import cut, ship, text_blocks, whole_text
from chronoline.llm.quality import fold_of

MAX_WORD = 32        # longer words are cut into words of this length
TRAIN_DOCS = 5000    # bound of the documents of each language that the pieces are fitted on
ROUNDS = 3           # rounds of expectation and maximization
SMOOTH = 0.05        # added to every expected count
FOLDS, HELD_OUT = 4, 2
BEGIN = "_"          # stands before a word's first letter; letters alone make words
WORDS_CACHED = 1 << 18
WORDS_TOGETHER = 1 << 16
BATCH_WORDS = 2048

# Characters of words for Python's \w that are neither letters nor decimal digits.
_NUMBER_SIGNS = "".join(c for c in map(chr, range(0x80, 0x110000))
                        if c.isalnum() and not c.isdecimal() and unicodedata.category(c)[0] != "L")
_SIGN_SET, _PLAIN = frozenset(_NUMBER_SIGNS), re.compile(r"[^\W\d_]+")
_WORD = re.compile(rf"[^\W\d_{_NUMBER_SIGNS}]+")


_U = np.uint64
_STEP, _SLOTS = _U(0x9E3779B97F4A7C15), 20


class Pieces(dict):
    """Piece numbers from 1, and a table that finds them by hash for arrays."""

    def __init__(self, found: set[str]):
        super().__init__((p, i) for i, p in enumerate(sorted(found), 1))
        self.hashes = np.zeros(len(self) + 1, _U)
        for p, i in self.items():
            h = 0
            for c in p:
                h = (h + ord(c) + 1) * int(_STEP) % 2 ** 64
            self.hashes[i] = h
        self.longest = max(map(len, self), default=1)
        # Two tables by different bits; the second has the pieces that the first
        # has no room for.
        self.tables, left = [], np.arange(1, len(self) + 1)
        rng = np.random.default_rng(1)
        while len(left) or len(self.tables) < 2:
            mul = _U(rng.integers(2 ** 63, dtype=np.uint64) * 2 + 1)
            table = np.zeros(1 << _SLOTS, np.int32)
            table[self._slot(self.hashes[left], mul)] = left
            self.tables.append((mul, table))
            left = left[table[self._slot(self.hashes[left], mul)] != left]

    @staticmethod
    def _slot(h: np.ndarray, mul: np.uint64) -> np.ndarray:
        return ((h * mul) >> _U(64 - _SLOTS)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece numbers of hashes, 0 where there is none."""
        out = np.zeros(h.shape, np.int32)
        for mul, table in self.tables:
            at = table[self._slot(h, mul)]
            out = np.where(self.hashes[at] == h, at, out)
        return out


@functools.lru_cache(2)
def pieces(ranks_path: str) -> Pieces:
    """Piece numbers from 1 of the vocabulary's lower-cased letter strings, with a
    word's begin marked; 0 is no piece, the last number any other one letter."""
    found = set()
    with open(ranks_path, "rb") as f:
        for line in f:
            try:
                token = base64.b64decode(line.split()[0]).decode()
            except UnicodeDecodeError:
                continue
            word = token.removeprefix(" ").lower()
            if _WORD.fullmatch(word):
                found.add(BEGIN + word if token[0] == " " else word)
    return Pieces(found)


def words(text: str) -> Iterator[list[str]]:
    """A text's words of letters (Unicode category L), lower-cased and marked, in parts.
    A word of ``MAX_WORD`` letters or more becomes several words."""
    for part in text_blocks(text):
        low = part.lower()
        # The set of number signs is slow to match, and few texts have one.
        found = (_PLAIN if _SIGN_SET.isdisjoint(low) else _WORD).findall(low)
        if found and max(map(len, found)) >= MAX_WORD:
            found = [w[i:i + MAX_WORD - 1] for w in found for i in range(0, len(w), MAX_WORD - 1)]
        yield [BEGIN + w for w in found]


def _lattice(batch: list[str], vocabulary: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and the piece that begins at i and has k + 1 characters."""
    sizes = np.array([len(w) for w in batch])
    n = int(sizes.max())
    inside = np.arange(n) < sizes[:, None]
    codes = np.zeros((len(batch), n), _U)
    codes[inside] = np.frombuffer("".join(batch).encode("utf-32-le"), np.uint32) + _U(1)
    longest = min(n, vocabulary.longest)
    ids = np.zeros((len(batch), n, longest), np.int32)
    h = np.zeros((len(batch), n), _U)
    for k in range(longest):
        h = (h[:, :n - k] + codes[:, k:]) * _STEP
        ids[:, :n - k, k] = vocabulary.find(h) * inside[:, k:]
    one = ids[:, :, 0]
    one[(one == 0) & inside] = len(vocabulary) + 1
    return sizes, ids


def forward(batch: list[str], vocabulary: Pieces, prob: np.ndarray) -> np.ndarray:
    """Log-probability of each word in each language: the forward algorithm adds up
    the products of piece probabilities over all segmentations.  ``prob``: pieces by
    languages, row 0 zero."""
    sizes, ids = _lattice(batch, vocabulary)
    alpha = _forward(ids, prob)
    return np.log(np.maximum(alpha[np.arange(len(batch)), sizes], 1e-300))


def _forward(ids: np.ndarray, prob: np.ndarray) -> np.ndarray:
    n = ids.shape[1]
    alpha = np.zeros((len(ids), n + 1, prob.shape[1]))
    alpha[:, 0] = 1
    for i in range(1, n + 1):
        for k in range(min(i, ids.shape[2])):
            p = ids[:, i - 1 - k, k]
            if p.any():   # long pieces are rare
                alpha[:, i] += alpha[:, i - 1 - k] * prob[p]
    return alpha


def _expected(batch: list[str], count: np.ndarray, vocabulary: Pieces, prob: np.ndarray) -> np.ndarray:
    """Expected piece counts of counted words in one language."""
    sizes, ids = _lattice(batch, vocabulary)
    alpha = _forward(ids, prob)[:, :, 0]
    rows, n = np.arange(len(batch)), ids.shape[1]
    beta = np.zeros((len(batch), n + 1))
    beta[rows, sizes] = 1
    for i in range(n - 1, -1, -1):
        for k in range(min(n - i, ids.shape[2])):
            beta[:, i] += beta[:, i + 1 + k] * prob[ids[:, i, k], 0]
    weight = count / np.maximum(alpha[rows, sizes], 1e-300)
    out = np.zeros(len(prob))
    for i in range(n):
        for k in range(min(n - i, ids.shape[2])):
            p = ids[:, i, k]
            out += np.bincount(p, alpha[:, i] * prob[p, 0] * beta[:, i + 1 + k] * weight, len(prob))
    out[0] = 0
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen: Counter = Counter()
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist()):
            for part in words(text.as_py()):
                seen.update((lang, w) for w in part)
        yield pa.record_batch([pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()),
                               pa.array(list(seen.values()), pa.int64())], ["lang", "word", "n"])


def _counts(ranks_path: str, langs: list[str], prob: np.ndarray):
    """Expected counts by language and piece over a partition of counted words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, total = pieces(ranks_path), np.zeros(prob.shape)
        for batch in batches:
            df = batch.to_pandas()
            df = df.assign(size=df["word"].str.len()).sort_values(["lang", "size"])
            for lang, some in df.groupby("lang"):
                at = langs.index(lang)
                for i in range(0, len(some), BATCH_WORDS):
                    part = some.iloc[i:i + BATCH_WORDS]
                    total[:, at] += _expected(part["word"].tolist(), part["n"].to_numpy(float), vocabulary, prob[:, at:at + 1])
        piece, at = np.nonzero(total)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(total[piece, at])],
                              ["lang", "piece", "n"])
    return run


def fit(docs: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities, from the documents that are not
    held out and have a language.

    Of each language about ``max_docs`` documents are used, chosen by a hash of
    the id; fewer than that are all used.  Word counts stay in Spark; each round
    sends one number for each language and piece to the driver, whose vocabulary
    is fixed.  Without any such document there are no languages."""
    ship(docs.sparkSession)
    known = docs.select(F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col)).alias("h"),
                        whole_text(text_col).alias("text"), fold_of(F.col(id_col), FOLDS).alias("fold"))
    known = known.filter(F.col("lang").isNotNull() & (F.col("fold") != HELD_OUT))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    n_pieces = len(pieces(ranks_path)) + 2
    prob = np.full((n_pieces, len(langs)), 1.0 / n_pieces)
    prob[0] = 0
    if not langs:
        return langs, prob
    share = F.element_at(F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(min(1.0, max_docs / sizes[k])))]), F.col("lang"))
    chosen = known.filter(F.pmod("h", F.lit(1 << 30)) < share * (1 << 30)).select("lang", "text")
    table = cut(chosen.mapInArrow(_counted, "lang string, word string, n long")
                .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    for _ in range(ROUNDS):
        found = (table.mapInArrow(_counts(ranks_path, langs, prob), "lang int, piece int, n double")
                 .groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow())
        total = np.full(prob.shape, SMOOTH)
        total[0] = 0
        total[found["piece"].to_numpy(), found["lang"].to_numpy()] += np.round(found["n"].to_numpy(), 6)
        prob = total / total.sum(0)
    return langs, prob


class _Scorer:
    """Log-probabilities of words, kept up to ``WORDS_CACHED``."""

    def __init__(self, vocabulary: Pieces, prob: np.ndarray):
        self.vocabulary, self.prob = vocabulary, prob
        self.row: dict[str, int] = {}
        self.table = np.zeros((WORDS_CACHED, prob.shape[1]))

    def rows(self, some: list[str]) -> np.ndarray:
        """The log-probabilities of at most ``WORDS_CACHED`` words, a row each."""
        new = {w for w in some if w not in self.row}
        if len(self.row) + len(new) > WORDS_CACHED:
            self.row.clear()
            new = set(some)
        new = sorted(new, key=len)
        for i in range(0, len(new), BATCH_WORDS):
            group, at = new[i:i + BATCH_WORDS], len(self.row)
            self.table[at:at + len(group)] = forward(group, self.vocabulary, self.prob)
            self.row.update(zip(group, range(at, at + len(group))))
        return self.table[np.fromiter(map(self.row.__getitem__, some), np.int64, len(some))]


def _predicted(ranks_path: str, langs: list[str], prob: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(pieces(ranks_path), prob)
        for batch in batches:
            log, n = np.zeros((len(batch), len(langs))), np.zeros(len(batch), np.int64)
            held, owner = [], []    # words of several documents are scored together

            def flush() -> None:
                if held and langs:
                    np.add.at(log, np.repeat([d for d, _ in owner], [k for _, k in owner]), scorer.rows(held))
                held.clear()
                owner.clear()

            for d, text in enumerate(batch.column("text")):
                for part in words(text.as_py()):
                    n[d] += len(part)
                    for i in range(0, len(part), WORDS_TOGETHER):
                        some = part[i:i + WORDS_TOGETHER]
                        held += some
                        owner.append((d, len(some)))
                        if len(held) >= WORDS_TOGETHER:
                            flush()
            flush()
            best = log.argmax(1) if langs else n
            top = log[np.arange(len(batch)), best][:, None] if langs else log
            share = 1 / np.exp(log - top).sum(1) if langs else n
            said = [langs[b] if k and langs else "und" for b, k in zip(best, n)]
            yield pa.record_batch([batch.column("id"), batch.column("fold"), pa.array(said, pa.string()),
                                   pa.array(np.where((n > 0) & bool(langs), share, 0.0), pa.float64())],
                                  ["id", "fold", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], ranks_path: str, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col, held_out, lang_pred, score``.

    The prediction is the language under which the whole text's words are
    likeliest, each word's probability being the sum over all its segmentations into
    pieces of the whole vocabulary (words of ``MAX_WORD`` letters are cut first);
    the score is its share among the languages.  Null texts and texts without
    letters are ``und`` with score 0, as is everything when no language was
    learned; a tie goes to the first language by name.  Repeated rows repeat; no
    rows: no rows."""
    ship(docs.sparkSession)
    langs, prob = model
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), whole_text(text_col).alias("text"),
                       fold_of(F.col(id_col), FOLDS).cast("int").alias("fold"))
    return (rows.mapInArrow(_predicted(ranks_path, langs, prob), f"id {id_type}, fold int, lang_pred string, score double")
            .select(F.col("id").alias(id_col), (F.col("fold") == HELD_OUT).alias("held_out"), "lang_pred", "score"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as P
    ranks = P.path("byte_bpe_multi_50k.tiktoken")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(docs, fit(docs, ranks), ranks)
