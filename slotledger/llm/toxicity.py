"""Toxicity by bags of subwords.

A word is the average of learned vectors: its own and those of its character n-grams, all hashed into one table, so a
misspelling that was never seen shares most of its vectors with the word it hides. A passage of PASSAGE words is the
average of its words, and a linear softmax with two classes reads it. Vectors and softmax are trained together, by whole
gradients and Adam, in numpy. As a few words make a long text toxic, a document is judged by its worst passage, and so
it is in training, after some rounds in which all passages share the blame.

With two classes only the difference of the softmax's two columns decides, so a trained model comes down to one number
for each slot of the table; scoring looks words up in it and never builds vectors.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotledger.llm.common import id_and_text, ragged, slices, stored, utf8

SAMPLE_DOCS = 20_000  # labelled documents learned from: half of each label at most
SAMPLE_BYTES = 32 << 20  # of their text; half for each label
SLOTS = 1 << 17
WIDTH = 16
GRAMS = (3, 4, 5)
PASSAGE = 6
SHARED_ROUNDS, ROUNDS = 10, 60  # rounds in which all passages share the blame, and all rounds
RATE = 0.05
DECAY = 1e-5
CHECKED = 5  # one of so many documents of the sample is kept for calibration
HELD_WORDS = 1 << 18
SLICE_BYTES = 4 << 20

_WORDS = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def subwords(word: str) -> list[int]:
    """Slots of the whole word and of its character n-grams, with the word's ends marked."""
    marked = f"<{word}>"
    parts = [marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1)]
    return [crc32(p.encode("utf-8", "surrogatepass")) % SLOTS for p in (marked, *parts)]


def passages(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For documents of so many words: the first word of each passage, and the first passage of each document.

    A document's words are cut evenly into passages of at most PASSAGE words; one without words has none.
    """
    counts = -(-sizes // PASSAGE)
    owner, number = ragged(np.zeros(len(sizes), np.int64), counts)
    starts = np.cumsum(sizes) - sizes
    return starts[owner] + number * sizes[owner] // counts[owner], np.cumsum(counts) - counts


class Slots(NamedTuple):
    """A trained model: what each slot adds to the odds, the softmax's own bias, and the calibration (slope, offset)."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0
    learned: bool = True

    def odds(self, texts: list[list[str]], known: WordValues) -> np.ndarray:
        """Log-odds of each document's worst passage; without words the bias alone."""
        values = np.fromiter(map(known.__getitem__, chain.from_iterable(texts)), np.float64)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        return self.slope * (worst(values, sizes)[0] + self.bias) + self.offset


class WordValues(dict):
    """What each word adds to the odds, found when it is first met."""

    def __init__(self, model: Slots) -> None:
        self.weights = model.weights.tolist()

    def __missing__(self, word: str) -> float:
        slots = subwords(word)
        value = self[word] = sum(map(self.weights.__getitem__, slots)) / len(slots)
        return value


def worst(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The largest passage average of each document (0 without words), every average, and the passages' first words."""
    first, of_document = passages(sizes)
    out = np.zeros(len(sizes))
    if not len(first):
        return out, np.zeros(0), first
    means = np.add.reduceat(values, first) / np.diff(np.append(first, len(values)))
    some = np.flatnonzero(sizes)
    out[some] = np.maximum.reduceat(means, of_document[some])
    return out, means, first


def _sigmoid(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return 1 / (1 + np.exp(-x))


class _Adam:
    def __init__(self, shape: tuple[int, ...]) -> None:
        self.mean, self.square, self.step = np.zeros(shape, np.float32), np.zeros(shape, np.float32), 0

    def __call__(self, value: np.ndarray, gradient: np.ndarray) -> None:
        self.step += 1
        self.mean += 0.1 * (gradient - self.mean)
        self.square += 0.001 * (gradient**2 - self.square)
        value -= RATE * (self.mean / (1 - 0.9**self.step)) / (np.sqrt(self.square / (1 - 0.999**self.step)) + 1e-8)


def untrained(toxic: bool = False) -> Slots:
    """Without both labels: one score for all."""
    return Slots(np.zeros(SLOTS), 0.0, 0.0, np.inf if toxic else -np.inf, False)


def train(
    ids: np.ndarray, sizes: np.ndarray, vocabulary: list[str], labels: np.ndarray, weights: np.ndarray, checked: np.ndarray
) -> Slots:
    """Fit to documents of so many words, given by their places in ``vocabulary``.

    ``checked`` documents are not learned from but give the calibration. With one label only, or none, nothing is learned,
    and every document gets that label's score (0 without any).
    """
    if not len(labels) or labels.min() == labels.max():
        return untrained(bool(len(labels) and labels[0]))
    if any(len(set(labels[part])) < 2 for part in (checked, ~checked)):
        checked = np.zeros(len(labels), bool)
    lengths, slots = np.zeros(len(vocabulary), np.int64), array("i")
    for i, word in enumerate(vocabulary):
        own = subwords(word)
        lengths[i] = len(own)
        slots.extend(own)
    slots = np.array(slots, np.int32)
    slot_starts = np.cumsum(lengths) - lengths
    first, of_document = passages(sizes)
    spans = np.diff(np.append(first, len(ids)))
    owner = ragged(np.zeros(len(sizes), np.int64), -(-sizes // PASSAGE))[0]  # of each passage
    some = np.flatnonzero(sizes)
    weights = np.where(checked, 0.0, weights) / weights[~checked].sum()

    draw = np.random.default_rng(0)
    table = ((draw.random((SLOTS, WIDTH), np.float32) - 0.5) / WIDTH).astype(np.float32)
    softmax = ((draw.random((WIDTH, 2), np.float32) - 0.5) / WIDTH).astype(np.float32)
    prior = float((weights * labels).sum())
    bias = np.array([np.log(1 - prior), np.log(prior)], np.float32)
    steps = _Adam(table.shape), _Adam(softmax.shape), _Adam(bias.shape)

    def word_values(by_slot: np.ndarray) -> np.ndarray:
        return np.add.reduceat(by_slot[slots], slot_starts) / lengths if len(slots) else np.zeros(0)

    for round_ in range(ROUNDS):
        direction = softmax[:, 1] - softmax[:, 0]
        values = word_values(table @ direction)
        odds = np.full(len(sizes), float(bias[1] - bias[0]))
        means = np.add.reduceat(values[ids], first) / spans if len(first) else np.zeros(0)
        if round_ < SHARED_ROUNDS:
            share = 1 / np.maximum(-(-sizes // PASSAGE), 1)[owner]
            odds += np.bincount(owner, means * share, len(sizes))
        else:
            most = np.zeros(len(sizes))
            most[some] = np.maximum.reduceat(means, of_document[some])
            share = (means == most[owner]).astype(float)
            share /= np.maximum(np.bincount(owner, share, len(sizes)), 1)[owner]
            odds += most
        error = weights * (_sigmoid(odds) - labels)  # of the second class; the first has its negative
        each = error[owner] * share / spans
        live = np.flatnonzero(each)
        at_word, word = ragged(first[live], spans[live])
        by_word = np.bincount(ids[word], each[live][at_word], len(lengths))
        by_slot = np.bincount(slots, np.repeat(by_word / lengths, lengths), SLOTS).astype(np.float32)
        summed = by_slot @ table  # error-weighted sum of the averaged bags
        both = np.array([-1, 1], np.float32)
        gradients = np.outer(by_slot, direction) + DECAY * table, np.outer(summed, both) + DECAY * softmax, error.sum() * both
        for value, step, gradient in zip((table, softmax, bias), steps, gradients, strict=True):
            step(value, gradient.astype(np.float32))
    trained = Slots((table @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64), float(bias[1] - bias[0]))
    if not checked.any():
        return trained
    tested = worst(word_values(trained.weights)[ids], sizes)[0][checked] + trained.bias
    return trained._replace(**dict(zip(("slope", "offset"), calibrated(tested, labels[checked]), strict=True)))


def calibrated(odds: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope (positive) and offset of log-odds that fit the labels best, by Newton's steps with a weak pull to (1, 0)."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * odds + b)
        spread = p * (1 - p)
        gradient = np.array([((p - labels) * odds).sum() + 0.1 * (a - 1), (p - labels).sum() + 0.1 * b])
        cross = (spread * odds).sum()
        curve = np.array([[(spread * odds**2).sum() + 0.1, cross], [cross, spread.sum() + 0.1]])
        change = np.linalg.solve(curve, gradient)
        a, b = max(a - np.clip(change[0], -1, 1), 0.05), b - np.clip(change[1], -2, 2)
    return float(a), float(b)


def numbered(texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words as places in a vocabulary, the number of words of each text, and the vocabulary."""
    number: dict[str, int] = {}
    ids, sizes = array("i"), []
    for text in texts:
        before = len(ids)
        ids.extend(number.setdefault(w, len(number)) for w in words_of(text))
        sizes.append(len(ids) - before)
    return np.frombuffer(ids, np.int32) if ids else np.zeros(0, np.int32), np.array(sizes, np.int64), list(number)


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[list] = [[], [], []]

    def texts() -> Iterator[str]:
        for batch in batches:
            for values, column in zip(held, batch.columns[1:], strict=True):
                values += column.to_pylist()
            yield from batch.column(0).to_pylist()

    words = numbered(texts())
    model = train(*words, np.array(held[0], float), np.array(held[1], float), np.array(held[2], bool))
    columns = [pa.array([model.weights.tobytes()]), *(pa.array([x]) for x in model[1:])]
    yield pa.RecordBatch.from_arrays(columns, list(Slots._fields))


def held_out(docs: DataFrame) -> F.Column:
    """Documents whose CRC-32 of the id is divisible by 5 are never learned from; nor are those without an id."""
    return F.coalesce(F.crc32(docs["doc_id"].cast("string")) % 5 == 0, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, most_docs: int = SAMPLE_DOCS, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """text, label, weight and checked of the documents to learn from: at most that many, and that much text.

    Of each label the documents with the smallest hashes of their ids come first. Weights restore the labels' true
    shares. Labels other than 0 and 1 are not used; an id with both counts as its more frequent one, toxic if equal. Of
    rows that share an id the smallest text is used, and null text is empty.
    """
    marked = labels.select("doc_id", F.col("toxic").alias("toxic")).filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    marked = marked.filter(~held_out(marked)).groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("label"))
    sized = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))
    sized = stored(sized.join(marked, "doc_id").groupBy("doc_id", "label").agg(F.max("bytes").alias("bytes")), "labelled")
    order = F.xxhash64("doc_id")
    taken = []
    for label in (0, 1):
        own = sized.filter(F.col("label") == label).orderBy(order, "doc_id").limit(most_docs // 2)
        so_far = F.sum("bytes").over(Window.orderBy(order, "doc_id"))  # over at most most_docs / 2 rows
        taken.append(own.withColumn("so_far", so_far).filter(F.col("so_far") <= most_bytes // 2))
    chosen = stored(taken[0].union(taken[1]).select("doc_id", "label"), "chosen")
    shares = sized.groupBy("label").agg(F.count("*").alias("all"))
    shares = shares.join(chosen.groupBy("label").agg(F.count("*").alias("used")), "label")
    weighted = chosen.join(shares.select("label", (F.col("all") / F.col("used")).alias("weight")), "label")
    # at most most_docs short rows are broadcast, so that no text is shuffled but those that are learned from
    texts = id_and_text(docs).join(F.broadcast(weighted), "doc_id").groupBy("doc_id", "label", "weight").agg(F.min("text").alias("text"))
    return texts.select("doc_id", "text", "label", "weight", (F.pmod(F.xxhash64("doc_id", F.lit("check")), F.lit(CHECKED)) == 0).alias("checked"))


def learn(docs: DataFrame, labels: DataFrame, most_docs: int = SAMPLE_DOCS, most_bytes: int = SAMPLE_BYTES) -> Slots:
    """The model fitted to sample(...), by one task, so that a lost executor repeats it; its slots come to the driver."""
    rows = sample(docs, labels, most_docs, most_bytes).repartition(1).sortWithinPartitions("doc_id")
    kind = "weights binary, bias double, slope double, offset double, learned boolean"
    fitted = stored(rows.select("text", "label", "weight", "checked").mapInArrow(_fit, kind), "slots").first()
    return Slots(np.frombuffer(fitted["weights"]), *fitted[1:]) if fitted else untrained()


def _score(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordValues(model.value)
        for batch in batches:
            scores = [np.zeros(0)]
            for first, last in slices(utf8(batch.column(2))[1], SLICE_BYTES):
                words = [words_of(t) for t in batch.column(2).slice(first, last - first).to_pylist()]
                scores.append(_sigmoid(model.value.odds(words, known)))
                if len(known) > HELD_WORDS:
                    known.clear()
            score = np.concatenate(scores)
            columns = [*batch.columns[:2], pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    return run


def toxicity(docs: DataFrame, labels: DataFrame, most_docs: int = SAMPLE_DOCS, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 on) of every whole text of ``docs``.

    One row per document. A score depends on the text alone; null and empty texts, and texts without a word, get the
    score of an empty bag. Without labels of both kinds to learn from, all scores are 0 (1, if all are toxic). Repeated
    rows are scored each. Of the tables only doc_id, text and toxic are read.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, most_docs, most_bytes))
    own = id_and_text(docs.select("doc_id", "text")).select("doc_id", held_out(docs.select("doc_id")).alias("held_out"), "text")
    return own.mapInArrow(_score(model), "doc_id long, held_out boolean, score double, predicted int")
