"""Language ID by segmentation-marginalised unigrams.

Each language has probabilities for the pieces of one fixed public vocabulary.  The
likelihood of a word is the sum over all of its segmentations into pieces (forward
algorithm); a text is the product of its words.  Piece probabilities are fitted by
expectation-maximisation (forward-backward) on the word counts of all labelled texts.
"""

from __future__ import annotations

import base64
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.common import Scratch, held_out, pieces, with_fields

#: A public byte-level vocabulary for many languages; one base64 piece and its rank a line.
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Words of up to so many bytes (with their leading space) are handled together by length; longer ones one by one.
GROUPED_WORD = 32
#: Positions of a long word whose pieces are looked up at a time.
STRETCH = 1 << 14
#: Least probability of a word or of a byte of a long word (a word may have no segmentation at all).
LEAST = 1e-300
#: EM rounds, and the count added to every piece of every language.
ROUNDS, PRIOR_COUNT = 2, 0.1
#: Tokens whose likelihoods a task remembers, and distinct tokens it counts before it hands them on.
REMEMBERED, COUNTED = 200_000, 200_000
UNDETERMINED = "und"
WORD = re.compile(r"[^\W\d_]+")
#: What a piece of a word may look like: lower-case letters and bytes of other letters, behind a space or not.
LETTERS = re.compile(rb" ?[a-z\x80-\xff]*")


def read_vocabulary(path: str) -> list[bytes]:
    """The vocabulary's pieces (read on the driver: executors need no such file)."""
    with open(path, "rb") as lines:
        return [base64.b64decode(line.split()[0]) for line in lines if line.strip()]


def tokens_of(text: str | None) -> list[str]:
    """Lower-case parts between white space; their words are found once for each distinct token."""
    return text.lower().split() if text else []


def words_of(token: str) -> list[str]:
    """Runs of letters in a token; none if it has no letter."""
    if token.isalpha():
        return [token]
    if token[-1] in ".,;:!?" and token[:-1].isalpha():
        return [token[:-1]]
    return [w for w in WORD.findall(token) if any(map(str.isalpha, w))]


def spelled(words: Sequence[str]) -> list[bytes]:
    """The words as the vocabulary spells them: UTF-8 behind a space."""
    return [b" " + w.encode() for w in words]


class Lattice:
    """Forward and backward sums over all segmentations of words into pieces.

    Words of one length are handled together; a word of more than GROUPED_WORD bytes by itself, in
    logarithms, with a window as wide as the longest piece, so that a text without spaces
    is one lattice, however long.  Pieces are found by a rolling hash of the
    bytes, in an open hash table (linear probing) of the pieces' hashes.
    """

    def __init__(self, vocabulary: Sequence[bytes]):
        self.size = len(vocabulary)
        by_length = defaultdict(list)
        for i, p in enumerate(vocabulary):
            if p and LETTERS.fullmatch(p):  # a word has no other bytes
                by_length[len(p)].append(i)
        self.reach = max(by_length, default=1)
        self.bits = max(4, (8 * sum(map(len, by_length.values()))).bit_length())
        self.hashes, self.ids = np.zeros(1 << self.bits, np.uint64), np.full(1 << self.bits, -1, np.int32)
        self.probes = 1
        for n, own in by_length.items():
            letters = np.frombuffer(b"".join([vocabulary[i] for i in own]), np.uint8).reshape(-1, n).astype(np.uint64)
            h = np.zeros(len(own), np.uint64)
            for k in range(n):
                h = self._roll(h, letters[:, k])
            for i, slot, value in zip(own, self._slot(h).tolist(), h):
                probe = 1
                while self.ids[slot] >= 0 and self.hashes[slot] != value:
                    slot, probe = (slot + 1) % len(self.ids), probe + 1
                self.hashes[slot], self.ids[slot] = value, i
                self.probes = max(self.probes, probe)

    @staticmethod
    def _roll(h: np.ndarray, byte: np.ndarray) -> np.ndarray:
        return (h + byte + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece of each hash, -1 where there is none."""
        slot = self._slot(h)
        ids = self.ids[slot]
        other = np.flatnonzero((ids >= 0) & (self.hashes[slot] != h))  # few: most slots are empty or right
        out = ids.copy()
        out[other] = -1
        for _ in range(1, self.probes):
            if not len(other):
                break
            slot[other] = (slot[other] + 1) & ((1 << self.bits) - 1)
            at = slot[other]
            same = self.hashes[at] == h[other]
            hit = same & (self.ids[at] >= 0)
            out[other[hit]] = self.ids[at[hit]]
            other = other[~same & (self.ids[at] >= 0)]
        return out

    def grouped(self, words: Sequence[bytes]) -> Iterator[tuple[np.ndarray, dict[tuple[int, int], np.ndarray]]]:
        """By length: the indexes of words, and for each span of bytes the words' piece (-1: not a piece)."""
        by_length = defaultdict(list)
        for i, w in enumerate(words):
            by_length[len(w)].append(i)
        for n, at in by_length.items():
            letters = np.frombuffer(b"".join([words[i] for i in at]), np.uint8).reshape(-1, n).astype(np.uint64)
            spans = {}
            for s in range(n):
                h = np.zeros(len(at), np.uint64)
                for e in range(s + 1, min(n, s + self.reach) + 1):
                    h = self._roll(h, letters[:, e - 1])
                    ids = self.find(h)
                    if (ids >= 0).any():
                        spans[s, e] = ids
            yield np.array(at), spans

    @staticmethod
    def forward(n: int, spans: dict, p: np.ndarray) -> list[np.ndarray]:
        """p: (pieces + 1, languages), its last row 0.  Sums over segmentations of the first k bytes, for each k."""
        count = len(next(iter(spans.values())))
        alpha = [np.zeros((count, p.shape[1])) for _ in range(n + 1)]
        alpha[0][:] = 1
        for s, e in sorted(spans):
            alpha[e] += alpha[s] * p[spans[s, e]]
        return alpha

    def log_likelihoods(self, words: Sequence[bytes], p: np.ndarray) -> np.ndarray:
        """(words, languages) log-probabilities, each summed over all segmentations."""
        out = np.empty((len(words), p.shape[1]))
        short = [i for i, w in enumerate(words) if len(w) <= GROUPED_WORD]
        for at, spans in self.grouped([words[i] for i in short]):
            if spans:
                n = len(words[short[at[0]]])
                found = self.forward(n, spans, p)[-1]
            else:
                found = np.zeros((len(at), p.shape[1]))
            out[np.array(short)[at]] = np.log(np.maximum(found, LEAST))
        if len(short) < len(words):
            log_p = self._logs(p)
            for i, w in enumerate(words):
                if len(w) > GROUPED_WORD:
                    out[i] = self._long(w, log_p)[-1]
        return out

    @staticmethod
    def _logs(p: np.ndarray) -> np.ndarray:
        with np.errstate(divide="ignore"):
            return np.log(p)

    def _stretch(self, word: np.ndarray, start: int) -> np.ndarray:
        """The piece of each length (columns) that begins at each of the next STRETCH positions (rows), -1 for none."""
        n = min(STRETCH, len(word) - start)
        part = np.append(word[start:start + n + self.reach], np.zeros(self.reach, np.uint64))
        h, ids = np.zeros(n, np.uint64), np.full((n, self.reach + 1), -1, np.int32)
        for k in range(1, self.reach + 1):
            h = self._roll(h, part[k - 1:k - 1 + n])
            inside = max(0, min(n, len(word) - start - k + 1))
            ids[:inside, k] = self.find(h[:inside])
        return ids

    def _long(self, word: bytes, log_p: np.ndarray) -> np.ndarray:
        """(len + 1, columns) logs of the sums over segmentations of each prefix; log_p: pieces + 1 rows, the last -inf."""
        alpha = np.full((len(word) + 1, log_p.shape[1]), -np.inf)
        alpha[0] = 0
        letters = np.frombuffer(word, np.uint8).astype(np.uint64)
        for start in range(0, len(word), STRETCH):
            for row, own in enumerate(self._stretch(letters, start)):
                k = np.flatnonzero(own >= 0)
                if len(k):
                    at = start + row
                    alpha[at + k] = np.logaddexp(alpha[at + k], alpha[at] + log_p[own[k]])
        return np.maximum(alpha, np.log(LEAST) * max(1, len(word)))

    def expected_counts(self, words: Sequence[bytes], language: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
        """(pieces, languages): how often each piece is used, over all segmentations of the counted words."""
        langs, out = p.shape[1], np.zeros((p.shape[0] - 1) * p.shape[1])
        short = np.array([i for i, w in enumerate(words) if len(w) <= GROUPED_WORD], np.int64)
        for at, spans in self.grouped([words[i] for i in short]):
            if not spans:
                continue
            length, lang, times = len(words[short[at[0]]]), language[short[at]], n[short[at]]
            own = {k: p[ids, lang] for k, ids in spans.items()}
            alpha = [np.zeros(len(at)) for _ in range(length + 1)]
            beta = [np.zeros(len(at)) for _ in range(length + 1)]
            alpha[0][:] = beta[length][:] = 1
            for s, e in sorted(own):
                alpha[e] += alpha[s] * own[s, e]
            for s, e in sorted(own, reverse=True):
                beta[s] += own[s, e] * beta[e]
            scale = np.where(alpha[length] > 0, times / np.maximum(alpha[length], LEAST), 0)
            places, uses = [], []  # all spans together: one count over the pieces for each length of words
            for (s, e), ids in spans.items():
                hit = np.flatnonzero(ids >= 0)
                places.append(ids[hit] * langs + lang[hit])
                uses.append((alpha[s] * own[s, e] * beta[e] * scale)[hit])
            out += np.bincount(np.concatenate(places), np.concatenate(uses), len(out))
        if len(short) < len(words):
            log_p = self._logs(p)
            for i, w in enumerate(words):
                if len(w) > GROUPED_WORD:
                    self._count_long(w, int(language[i]), float(n[i]), log_p, out)
        return out.reshape(-1, langs)

    def _count_long(self, word: bytes, lang: int, times: float, log_p: np.ndarray, out: np.ndarray) -> None:
        """Adds the expected uses of pieces in one long word to ``out`` (pieces x languages, flat)."""
        langs, own_p = log_p.shape[1], log_p[:, lang:lang + 1]
        alpha = self._long(word, own_p)[:, 0]
        beta = np.full(len(word) + 1, -np.inf)
        beta[-1] = 0
        if alpha[-1] <= np.log(LEAST) * len(word):
            return
        letters = np.frombuffer(word, np.uint8).astype(np.uint64)
        for start in reversed(range(0, len(word), STRETCH)):
            ids = self._stretch(letters, start)
            for row in range(len(ids) - 1, -1, -1):
                k = np.flatnonzero(ids[row] >= 0)
                if len(k):
                    at = start + row
                    through = own_p[ids[row, k], 0] + beta[at + k]
                    beta[at] = np.logaddexp.reduce(through)
                    np.add.at(out, ids[row, k] * langs + lang, times * np.exp(alpha[at] + through - alpha[-1]))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) → (lang, word, n)."""
    counts, held = defaultdict(Counter), 0

    def flush():
        for lang, tokens in counts.items():
            words = Counter()
            for token, n in tokens.items():
                for w in words_of(token):
                    words[w] += n
            if words:
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words)), pa.array(list(words), pa.string()),
                                                  pa.array(list(words.values()), pa.int64())], names=["lang", "word", "n"])
        counts.clear()

    for batch in pieces(batches, 4 << 20):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            own = counts[lang]
            held -= len(own)
            own.update(tokens_of(text))
            held += len(own)
        if held > COUNTED:
            yield from flush()
            held = 0
    yield from flush()


class PieceModel:
    """languages, (pieces + 1, languages) probabilities (last row 0) and log priors."""

    def __init__(self, languages: list[str], p: np.ndarray, log_prior: np.ndarray):
        self.languages, self.p, self.log_prior = languages, p, log_prior


def fit_pieces(train: DataFrame, lattice: Lattice, scratch: Scratch, rounds: int = ROUNDS) -> PieceModel:
    """Piece probabilities from all rows of ``train`` (lang, text); lang is not null.

    What reaches the driver is the model: pieces of the vocabulary times languages.
    """
    spark = train.sparkSession
    shares = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()}
    languages = sorted(shares)
    if not languages:
        return PieceModel([], np.zeros((lattice.size + 1, 0)), np.zeros(0))
    words = train.mapInArrow(_count_words, "lang string, word string, n long")
    words = scratch.table(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "word-counts")
    number, size = {x: i for i, x in enumerate(languages)}, lattice.size
    p = np.full((size + 1, len(languages)), 1 / size)
    p[size] = 0
    for _ in range(rounds):
        given = spark.sparkContext.broadcast((lattice, p, number))

        def expect(batches):
            own, prob, numbers = given.value
            total = 0
            for batch in batches:
                lang = np.array([numbers[x] for x in batch.column("lang").to_pylist()], np.int64)
                total = total + own.expected_counts(spelled(batch.column("word").to_pylist()), lang,
                                                        batch.column("n").to_numpy(), prob)
            if not np.isscalar(total):
                at, lang = np.nonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(lang, pa.int32()),
                                                  pa.array(total[at, lang])], names=["piece", "language", "n"])

        used = words.mapInArrow(expect, "piece int, language int, n double").groupBy("piece", "language").agg(
            F.sum("n").alias("n")).toPandas()
        counts = np.full((size, len(languages)), PRIOR_COUNT)
        counts[used["piece"], used["language"]] += used["n"]
        p = np.vstack([counts / counts.sum(axis=0), np.zeros(len(languages))])
    prior = np.array([shares[x] for x in languages], float)
    return PieceModel(languages, p, np.log(prior / prior.sum()))


def _token_rows(tokens: Sequence[str], lattice: Lattice, p: np.ndarray) -> np.ndarray:
    """For each token the summed log-likelihoods of its words, and their number."""
    own = [words_of(t) for t in tokens]
    words = list({w for ws in own for w in ws})
    row = dict(zip(words, range(len(words))))
    log_p = lattice.log_likelihoods(spelled(words), p)
    out = np.zeros((len(tokens), p.shape[1] + 1))
    owner = np.repeat(np.arange(len(own)), [len(ws) for ws in own])
    np.add.at(out[:, :-1], owner, log_p[[row[w] for ws in own for w in ws]] if words else 0)
    out[:, -1] = [len(ws) for ws in own]
    return out


def _summed(texts: list[list[str]], known: dict[str, int], table: np.ndarray) -> np.ndarray:
    """For each text the sum of its tokens' rows of ``table``, some megabytes of rows at a time."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    row = np.fromiter(map(known.__getitem__, chain.from_iterable(texts)), np.int64, int(lengths.sum()))
    owner, out = np.repeat(np.arange(len(texts)), lengths), np.zeros((len(texts), table.shape[1]))
    step = max(1, (1 << 22) // table.shape[1])
    for s in range(0, len(row), step):
        own = owner[s:s + step]
        heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        out[own[heads]] += np.add.reduceat(table[row[s:s + step]], heads, axis=0)
    return out


def score_languages(docs: DataFrame, model: PieceModel, lattice: Lattice, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (the posterior of lang_pred) behind its own columns.

    ``docs`` must not have columns of these names.
    """
    spark = docs.sparkSession
    given = spark.sparkContext.broadcast((lattice, model))
    schema = with_fields(docs.schema, "lang_pred string, score double")

    def score(batches):
        own, m = given.value
        width = len(m.languages)
        known: dict[str, int] = {}  # token: row of log-likelihoods, the last column counts its words
        table = np.empty((0, width + 1))
        for batch in pieces(batches, 4 << 20):
            texts = [tokens_of(t) if width else [] for t in batch.column(text_col).to_pylist()]
            if len(known) > REMEMBERED:
                known, table = {}, table[:0]
            new = list({t for tokens in texts for t in tokens} - known.keys())
            if new:
                known.update(zip(new, range(len(table), len(table) + len(new))))
                table = np.vstack([table, _token_rows(new, own, m.p)])
            lang, value = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            sums = _summed(texts, known, table)
            some = np.flatnonzero(sums[:, width])
            if len(some):
                log_p = sums[some, :width] + m.log_prior
                odds = np.exp(log_p - log_p.max(axis=1, keepdims=True))
                best = odds.argmax(axis=1)
                value[some] = odds[np.arange(len(some)), best] / odds.sum(axis=1)
                for i, k in zip(some.tolist(), best.tolist()):
                    lang[i] = m.languages[k]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(value)],
                                             names=[*batch.schema.names, "lang_pred", "score"])

    return docs.mapInArrow(score, schema)


def _fitted(docs: DataFrame, id_col: str, text_col: str, lang_col: str, lattice: Lattice) -> PieceModel:
    train = docs.filter(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    return fit_pieces(train, lattice, Scratch(docs.sparkSession, "language-id"))


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score.

    The model learns from text and non-null language of the rows that are not held out, all of
    them.  Null texts and texts without a letter are 'und' with score 0, as is every text if
    there is nothing to learn from; an empty table gives no rows.  Ties go to the language
    first in order.
    """
    lattice = Lattice(read_vocabulary(vocabulary))
    model = _fitted(docs, id_col, text_col, lang_col, lattice)
    rows = docs.select(F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    scored = score_languages(rows, model, lattice)
    return scored.select(F.col("id").alias(id_col), "held_out", "lang_pred", "score")


def keep_identified(docs: DataFrame, least: float, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    vocabulary: str = VOCABULARY) -> DataFrame:
    """The rows of ``docs``, all columns, with a predicted language whose score is at least ``least``."""
    lattice = Lattice(read_vocabulary(vocabulary))
    model = _fitted(docs, id_col, text_col, lang_col, lattice)
    names = [f"column {i}" for i in range(len(docs.columns))]
    scored = score_languages(docs.toDF(*names), model, lattice, names[docs.columns.index(text_col)])
    kept = scored.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return kept.select(*names).toDF(*docs.columns)
