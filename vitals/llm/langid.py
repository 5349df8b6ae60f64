"""Operator 5: language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary have a probability in each language. The probability
of a word, however long, is the sum over all its segmentations into pieces (forward algorithm); a text's
is the product over its words. The pieces' probabilities are fitted by expectation maximisation (forward-backward
counts) on word counts of labelled documents outside the held-out fold. The text is scored whole; the
words' log-probabilities are computed once for each distinct word a worker meets.

Training takes a bounded sample of labelled rows: ``MAX_DOCS`` documents of each language in expectation, by
a hash of the doc_id. What reaches the driver is one row per language and piece.

Cases: null text, or text without a letter, is ``und`` with score 0; null lang is not learnt from; with no
labelled rows every text is ``und``; repeated rows are judged alike; ties take the first language by code
point; characters outside the vocabulary count as one unknown piece each; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitals.llm.common import discard, prepare, rows_batches, stage, texts
from vitals.llm.toxicity import fold

FOLDS, HELD_OUT = 4, 2
MAX_DOCS, ROUNDS = 1000, 2
#: Characters walked in one scale, characters between the places that a long word's walk is taken up from again, and
#: characters of the words walked together.
BLOCK, STRETCH, CELLS = 16, 1024, 8192
SMOOTH = 0.1
#: Words, and their letters, whose probabilities a worker keeps before it starts over.
MAX_KNOWN, MAX_LETTERS = 300_000, 16_000_000
#: Expected counts held before they are added up.
MAX_FLOWS = 1 << 18

WORD = re.compile(r"[^\W\d_]+")
START = "▁"


def pieces(path: str) -> dict[str, int]:
    """Piece → row of the vocabulary file; row 0 stands for unknown characters."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    out: dict[str, int] = {}
    for i in range(sp.get_piece_size()):
        p = sp.id_to_piece(i)
        if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i)):
            out.setdefault(p, len(out) + 1)
    return out


def words_of(text: str) -> list[str]:
    """The lower-case words of a text."""
    return WORD.findall(text.lower())


_STEP, _SPREAD = np.uint64(0x9FB21C651E98DF25), np.uint64(0x9E3779B97F4A7C15)


def _codes(text: str) -> np.ndarray:
    """A 64-bit number for each character."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    c = (c ^ (c >> np.uint64(7))) * _SPREAD
    return (c ^ (c >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class Pieces:
    """The vocabulary as a hash table that numpy can probe: piece hash → row."""

    def __init__(self, vocab: dict[str, int], bits: int = 18):
        self.longest = max(map(len, vocab), default=1)
        self.size, self.shift, self.mask = len(vocab), np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.rows, self.probes = np.zeros(1 << bits, np.uint64), np.full(1 << bits, -1, np.int32), 1
        for piece, row in vocab.items():
            h = np.uint64(0)
            for c in _codes(piece)[::-1]:
                h = np.multiply(h, _STEP) + c
            at, tries = int((h * _SPREAD) >> self.shift), 1
            while self.rows[at] >= 0:
                at, tries = (at + 1) & self.mask, tries + 1
            self.keys[at], self.rows[at], self.probes = h, row, max(self.probes, tries)

    def find(self, h: np.ndarray) -> np.ndarray:
        at = ((h * _SPREAD) >> self.shift).astype(np.int64)
        out = np.where(self.keys[at] == h, self.rows[at], -1)
        for _ in range(self.probes - 1):
            at = (at + 1) & self.mask
            out = np.where((out < 0) & (self.keys[at] == h), self.rows[at], out)
        return out


def characters(words: list[str]) -> np.ndarray:
    """Character numbers of words of one length, each behind its start mark: [position, word]."""
    return _codes("".join(START + w for w in words)).reshape(len(words), -1).T.copy()


def lattice(codes: np.ndarray, at: int, to: int, vocab: Pieces) -> np.ndarray:
    """Piece rows of the pieces that end after ``at`` + 1 to ``to`` characters: [end, lag - 1, word]; -1 where no
    piece fits.

    A single character without a piece counts as the unknown piece, row 0.
    """
    arcs = np.full((to - at, min(len(codes), vocab.longest), codes.shape[1]), -1, np.int32)
    h = np.zeros((to - at, codes.shape[1]), np.uint64)
    for lag in range(1, min(to, vocab.longest) + 1):
        first = max(at + 1, lag)
        part = h[first - at - 1 :]
        part[:] = part * _STEP + codes[first - lag : to - lag + 1]
        found = vocab.find(part)
        arcs[first - at - 1 :, lag - 1] = np.maximum(found, 0) if lag == 1 else found
    return arcs


_VOCAB: dict[str, Pieces] = {}


def vocabulary(path: str) -> Pieces:
    """One table for each worker process and vocabulary file."""
    if path not in _VOCAB:
        _VOCAB[path] = Pieces(pieces(path))
    return _VOCAB[path]


def opening(codes: np.ndarray, vocab: Pieces, prob: np.ndarray) -> np.ndarray:
    """The alphas before the first character."""
    alpha = np.zeros((min(len(codes), vocab.longest), codes.shape[1], prob.shape[1]))
    alpha[-1] = 1
    return alpha


def forward(codes: np.ndarray, at: int, to: int, before: np.ndarray, vocab: Pieces, prob: np.ndarray):
    """Blocks (at, arcs, alpha, shift) of the characters from ``at`` to ``to``, given the last alphas before them.

    alpha[lags + i, word, language] is the probability of all segmentations up to ``at`` + i + 1 characters, divided by
    two to the power of the shifts so far; the rows above are the last alphas before the block, in the same
    scale. Powers of two alone are taken out, so nothing is rounded. The last row of ``prob`` is 0, which is what
    arcs of -1 read.
    """
    lags = len(before)
    for start in range(at, to, BLOCK):
        end = min(start + BLOCK, to)
        arcs = lattice(codes, start, end, vocab)
        shift = np.frexp(before.max(0))[1] if start else np.zeros(before.shape[1:], np.int32)
        alpha = np.zeros((lags + end - start, *before.shape[1:]))
        alpha[:lags] = np.ldexp(before, -shift)
        for i in range(end - start):
            n = min(start + i + 1, lags)
            alpha[lags + i] = (alpha[lags + i - n : lags + i][::-1] * prob[arcs[i, :n]]).sum(0)
        yield start, arcs, alpha, shift
        before = alpha[-lags:]


def by_length(words: list[str], cells: int = CELLS):
    """Indices and texts of words of equal length, of about ``cells`` characters at a time."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for length, ids in groups.items():
        most = max(1, cells // (length + 1))
        for at in range(0, len(ids), most):
            yield ids[at : at + most], [words[i] for i in ids[at : at + most]]


def padded(prob: np.ndarray) -> np.ndarray:
    return np.vstack([prob, np.zeros((1, prob.shape[1]))])


def log_probabilities(words: list[str], vocab: Pieces, prob: np.ndarray) -> np.ndarray:
    """Log-probability of each word in every language; ``prob`` is padded."""
    out = np.zeros((len(words), prob.shape[1]))
    for ids, group in by_length(words):
        codes, shifts = characters(group), 0
        for _, _, alpha, shift in forward(codes, 0, len(codes), opening(codes, vocab, prob), vocab, prob):
            shifts = shifts + shift
        out[ids] = np.log(np.maximum(alpha[-1], 1e-300)) + shifts * np.log(2)
    return out


def expected(words: list[str], counts: np.ndarray, vocab: Pieces, prob: np.ndarray) -> np.ndarray:
    """Expected counts of every piece, for words seen ``counts`` times in each language."""
    total = np.zeros_like(prob)
    steps, flows, held = [], [], 0

    def add():
        used, flow = np.concatenate(steps), np.concatenate(flows)
        for k in range(prob.shape[1]):
            total[:, k] += np.bincount(used, flow[:, k], len(total))

    for ids, group in by_length(words):
        codes = characters(group)
        # of a long word the alphas before each stretch are kept, and the stretches are walked again backwards
        marks, before = [], opening(codes, vocab, prob)
        lags = len(before)
        for at in range(0, len(codes), STRETCH):
            marks.append((at, before))
            if at + STRETCH < len(codes):
                for *_, alpha, _ in forward(codes, at, at + STRETCH, before, vocab, prob):
                    before = alpha[-lags:]
        # how often a segmentation has a border at each of the last places
        behind = np.zeros_like(before)
        behind[-1] = counts[ids]
        for at, before in reversed(marks):
            for start, arcs, alpha, _ in reversed(list(forward(codes, at, min(at + STRETCH, len(codes)), before, vocab, prob))):
                border = np.zeros_like(alpha)
                border[-lags:] = behind
                for i in range(len(arcs) - 1, -1, -1):
                    n = min(start + i + 1, lags)
                    p, back = arcs[i, :n], slice(lags + i - n, lags + i)
                    flow = alpha[back][::-1] * prob[p] * (border[lags + i] / np.maximum(alpha[lags + i], 1e-300))
                    border[back] += flow[::-1]
                    fits = p >= 0
                    steps.append(p[fits])
                    flows.append(flow[fits])
                    held += len(steps[-1])
                behind = border[:lags]
                if held > MAX_FLOWS:
                    add()
                    steps, flows, held = [], [], 0
    if held:
        add()
    return total


def _count_words(batches):
    """Word counts of each language, combined per batch before the shuffle."""

    def rows():
        for batch in batches:
            seen: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), texts(batch), strict=True):
                seen.setdefault(lang, Counter()).update(words_of(text))
            for lang, counter in seen.items():
                for word, n in counter.items():
                    yield lang, word, n

    return rows_batches(rows(), pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]), 20_000)


def _expect(shared, langs: list[str], path: str):
    def run(batches):
        prob, vocab = padded(shared.value), vocabulary(path)
        at, total = {x: i for i, x in enumerate(langs)}, np.zeros_like(prob)
        for batch in batches:
            words = batch.column("word").to_pylist()
            counts = np.zeros((len(words), len(langs)))
            for i, by in enumerate(batch.column("by").to_pylist()):
                for x in by:
                    counts[i, at[x["lang"]]] = x["n"]
            total += expected(words, counts, vocab, prob)
        p, k = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(k, pa.int32()), pa.array(total[p, k])], names=["piece", "lang", "n"])

    return run


def fit(docs: DataFrame, path: str, max_docs: int = MAX_DOCS, rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """(languages, piece probabilities: a row per piece, a column per language)."""
    spark = prepare(docs.sparkSession)
    learn = docs.where((fold(folds=FOLDS) != HELD_OUT) & F.col("lang").isNotNull())
    by = {r["lang"]: r["n"] for r in learn.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row per language
    langs = sorted(by, key=lambda x: x.encode())
    vocab = pieces(path)
    if not langs:
        return [], np.zeros((len(vocab) + 1, 0))
    limit = F.lit(0)
    for lang, n in by.items():
        limit = F.when(F.col("lang") == lang, int(min(1.0, max_docs / n) * (1 << 30))).otherwise(limit)
    sampled = learn.where(F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(1 << 30)) < limit)
    counted = sampled.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n long").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    words = stage(counted.groupBy("word").agg(F.collect_list(F.struct("lang", "n")).alias("by")), "langid-words")  # a list has one entry a language
    # start: pieces as likely as they are short, the same in all languages
    start = np.array([1.0, *(10.0 ** -min(len(p), 6) for p in vocab)])
    prob = np.repeat((start / start.sum())[:, None], len(langs), axis=1)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(prob)
        got = words.mapInArrow(_expect(shared, langs, path), "piece int, lang int, n double")
        total = np.full_like(prob, SMOOTH)
        for r in got.groupBy("piece", "lang").agg(F.sum("n").alias("n")).toLocalIterator():  # a row per piece and language
            total[r["piece"], r["lang"]] += r["n"]
        prob = total / total.sum(axis=0)
    discard(words)
    return langs, prob


def _predict(shared, path: str):
    def rows(batches):
        langs, prob = shared.value
        prob, vocab = padded(prob), vocabulary(path)
        known: dict[str, int] = {}
        letters = 0
        table = np.zeros((0, len(langs)))
        for batch in batches:
            parts = [words_of(t) if langs else [] for t in texts(batch)]
            if len(known) > MAX_KNOWN or letters > MAX_LETTERS:
                known.clear()
                letters, table = 0, table[:0]
            new = [w for w in dict.fromkeys(w for p in parts for w in p) if w not in known]
            if new:
                table = np.vstack([table, log_probabilities(new, vocab, prob)])
                known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
                letters += sum(map(len, new))
            for doc_id, words in zip(batch.column("doc_id").to_pylist(), parts, strict=True):
                if not words:
                    yield doc_id, "und", 0.0
                    continue
                total = table[[known[w] for w in words]].sum(axis=0)
                best = int(np.argmax(total))
                yield doc_id, langs[best], float(1 / np.exp(np.minimum(total - total[best], 0)).sum())

    return lambda batches: rows_batches(rows(batches), pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())]))


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], path: str) -> DataFrame:
    """doc_id, lang_pred and the posterior of that language, for every document row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary x languages
    return docs.select("doc_id", "text").mapInArrow(_predict(shared, path), "doc_id long, lang_pred string, score double")
