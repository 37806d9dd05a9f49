"""Language identification by language bitmasks of n-grams.

Every letter gives one trigram, with its neighbours or word ends. Trigrams that are typical of a language are stored
in one Bloom filter for all languages: at each position of the filter lies a bit mask with a bit for each language (a
bit-sliced filter), so the masks at a trigram's positions, combined by "and", give all languages that contain it. Each
language's hits in a text are counted, and those expected by chance, from the filter's fill, are taken off.

Learning counts trigrams of all labelled documents: in the tasks first, then over the cluster. The filter's positions
grow with the typical trigrams of the language that has most, so that no language's slice fills; a corpus whose filter
would take more than MOST_BYTES is refused.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from slotledger.llm.common import mix64, slices, stored, utf8

POSITIONS = 1 << 20  # at least
HASHES = 3
FULLEST = 0.5  # part of a language's positions that may be set: one of eight foreign trigrams is then taken for its own
MOST_BYTES = 256 << 20
TYPICAL = 0.25  # a trigram belongs to a language whose share of it is at least this part of the largest share
LEAST_COUNT = 3
UNKNOWN = "und"
LANGUAGES_A_WORD = 63
SLICE_BYTES = 256 << 10  # of text at once: a dozen words of 8 bytes are held for each letter
HELD_GRAMS = 1 << 20

_SPACE = np.uint32(32)
_letters: np.ndarray | None = None


def letter_table() -> np.ndarray:
    """Which code points are letters."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The trigrams of all letters, packed into 63 bits, and where each text's begin (n + 1 bounds)."""
    lowered = [t.lower() for t in texts]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    points = np.frombuffer((" " + " ".join(lowered) + " ").encode("utf-32-le"), np.uint32)
    letter = letter_table()[points]
    middle = np.flatnonzero(letter)
    points = np.where(letter, points, _SPACE).astype(np.uint64)
    grams = (points[middle - 1] << np.uint64(42)) | (points[middle] << np.uint64(21)) | points[middle + 1]
    return grams, np.searchsorted(middle, np.concatenate(([0], np.cumsum(sizes))) + 1)


def positions(grams: np.ndarray, size: int) -> list[np.ndarray]:
    """The filter positions of each trigram, one array for each hash function."""
    mixed, out = grams, []
    for k in range(HASHES):
        mixed = mix64(mixed + np.uint64(2 * k + 1))
        out.append((mixed % np.uint64(size)).astype(np.int64))
    return out


def fill(mask: np.ndarray, bit: int) -> float:
    return float(np.count_nonzero(mask & mask.dtype.type(1 << bit)) / len(mask))


class LanguageFilter(NamedTuple):
    """Languages in order of their names, mask words of the filter (masks[word][position]), and parts of positions set."""

    languages: list[str]
    masks: list[np.ndarray]
    fills: list[float] | None = None

    def hits(self, grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """For each text and language: the trigrams that the language contains, less those expected by chance."""
        counts = np.zeros((len(bounds) - 1, len(self.languages)))
        total = np.diff(bounds)
        some = np.flatnonzero(total)
        at = positions(grams, len(self.masks[0])) if self.masks else []
        for word, mask in enumerate(self.masks):
            found = mask[at[0]]
            for place in at[1:]:
                found = found & mask[place]
            for bit in range(min(LANGUAGES_A_WORD, len(self.languages) - word * LANGUAGES_A_WORD)):
                language = word * LANGUAGES_A_WORD + bit
                one = mask.dtype.type(1 << bit)
                chance = (self.fills[language] if self.fills else fill(mask, bit)) ** HASHES
                if len(some):
                    counts[some, language] = np.add.reduceat((found & one != 0).astype(np.int64), bounds[some])
                counts[:, language] = np.maximum(0, counts[:, language] - total * chance) / (1 - chance if chance < 1 else 1)
        return counts

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """The language with most hits (the first by name among equals) and the part of the trigrams that it contains."""
        grams, bounds = trigrams(texts)
        total = np.diff(bounds)
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        hits = self.hits(grams, bounds)
        best = hits.argmax(1)
        score = np.minimum(1.0, hits[np.arange(len(texts)), best] / np.maximum(total, 1))
        names = [self.languages[b] if n else UNKNOWN for b, n in zip(best, total, strict=True)]
        return names, np.where(total > 0, score, 0.0).tolist()


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(language: str) -> tuple[np.ndarray, np.ndarray]:
        parts = held[language]
        grams, inverse = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
        counts = np.bincount(inverse, np.concatenate([c for _, c in parts]), len(grams)).astype(np.int64)
        held[language] = [(grams, counts)]
        return grams, counts

    def out(language: str) -> pa.RecordBatch:
        grams, counts = merged(language)
        del held[language]
        names = pa.array([language] * len(grams), pa.string())
        return pa.RecordBatch.from_arrays([names, pa.array(grams.view(np.int64)), pa.array(counts)], ["lang", "gram", "n"])

    for batch in batches:
        offsets = utf8(batch.column(1))[1]
        for first, last in slices(offsets, SLICE_BYTES):
            languages, texts = (batch.column(k).slice(first, last - first).to_pylist() for k in (0, 1))
            by: dict[str, list[str]] = {}
            for language, text in zip(languages, texts, strict=True):
                by.setdefault(language, []).append(text)
            for language, own in by.items():
                held.setdefault(language, []).append(np.unique(trigrams(own)[0], return_counts=True))
                if sum(len(g) for g, _ in held[language]) > HELD_GRAMS and len(merged(language)[0]) > HELD_GRAMS // 2:
                    yield out(language)
    for language in list(held):
        yield out(language)


def _bits(languages: list[str], size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    number = {language: i for i, language in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(positions(batch.column(1).to_numpy().view(np.uint64), size))
            index = np.array([number[x] for x in batch.column(0).to_pylist()] * HASHES, np.int64)
            word, bit = np.divmod(index, LANGUAGES_A_WORD)
            mask = np.int64(1) << bit
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(at), pa.array(mask)], ["word", "position", "mask"])

    return run


def filter_size(most: int, width: int) -> int:
    """Positions for ``most`` trigrams of one language: a power of two at which at most FULLEST of them are expected set."""
    size = max(POSITIONS, 1 << (int(HASHES * most / -np.log(1 - 0.96 * FULLEST))).bit_length())
    if size > POSITIONS and size * width > MOST_BYTES:
        raise ValueError(f"{most} typical trigrams of one language need a filter of {size * width} bytes, more than {MOST_BYTES}")
    return size


def learn(labelled: DataFrame, size: int | None = None) -> LanguageFilter:
    """Fit the filter to the columns text and lang; rows without either are left out.

    Collected: the languages, and at most ``size`` masks (by default filter_size) for each 63 of them. No labelled text
    gives an empty filter. A filter that is too full to tell languages apart is an error.
    """
    used = labelled.select(F.col("lang"), F.col("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    counts = stored(
        used.mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "trigrams"
    )
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(totals, "lang").withColumn("share", F.col("n") / F.col("total"))
    # a window over one trigram holds a row for each language at most
    largest = F.max("share").over(Window.partitionBy("gram"))
    typical = shares.withColumn("largest", largest).filter((F.col("share") >= TYPICAL * F.col("largest")) & (F.col("n") >= LEAST_COUNT))
    typical = stored(typical.select("lang", "gram"), "typical")
    languages = sorted(r["lang"] for r in totals.select("lang").collect())
    kind = next((k for k in (np.uint8, np.uint16, np.uint32) if len(languages) <= 8 * np.dtype(k).itemsize), np.uint64)
    words = -(-len(languages) // LANGUAGES_A_WORD)
    if size is None:
        most = typical.groupBy("lang").count().agg(F.max("count").alias("n")).first()["n"] or 0
        size = filter_size(most, words * np.dtype(kind).itemsize)
    bits = typical.select("lang", "gram").mapInArrow(_bits(languages, size), "word long, position long, mask long")
    masks = [np.zeros(size, kind) for _ in range(words)]
    for row in bits.groupBy("word", "position").agg(F.bit_or("mask").alias("mask")).toLocalIterator():
        masks[row["word"]][row["position"]] = row["mask"]
    fills = [fill(masks[k // LANGUAGES_A_WORD], k % LANGUAGES_A_WORD) for k in range(len(languages))]
    if any(part > FULLEST for part in fills):
        raise ValueError(f"the filter of {size} positions is too full: {max(fills):.2f} of them are set for one language")
    return LanguageFilter(languages, masks, fills)


def _predict(model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).fill_null("")
            offsets = utf8(texts)[1]
            names, scores = [], []
            for first, last in slices(offsets, SLICE_BYTES):
                some = model.value.predict(texts.slice(first, last - first).to_pylist())
                names += some[0]
                scores += some[1]
            columns = [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "lang_pred", "score"])

    return run


def held_out(docs: DataFrame) -> F.Column:
    """Documents whose CRC-32 of the id, modulo 4, is 2 are never learned from; nor are those without an id."""
    return F.coalesce(F.crc32(docs["doc_id"].cast("string")) % 4 == 2, F.lit(True))


def identify(docs: DataFrame, size: int | None = None) -> DataFrame:
    """Learn from the documents that are not held out, and predict the language of every whole text.

    One row per document: doc_id, held_out, lang_pred and score, the corrected part (0 to 1) of the text's trigrams
    that the predicted language contains. Null text, and text without a letter, is "und" with score 0, as is every
    text if nothing was learned. A prediction depends on the text alone. Further columns are not read.
    """
    own = docs.select("doc_id", held_out(docs).alias("held_out"), docs["text"], docs["lang"])
    model = docs.sparkSession.sparkContext.broadcast(learn(own.filter(~F.col("held_out")), size))
    return own.select("doc_id", "held_out", "text").mapInArrow(
        _predict(model), "doc_id long, held_out boolean, lang_pred string, score double"
    )


def keep_identified(docs: DataFrame, least_score: float) -> DataFrame:
    """The documents, unchanged and with all columns, that have a language and reach ``least_score``.

    Null and empty texts, and texts without a letter, have no language and go. Repeated rows stay or go together. An
    empty table, or one that teaches no language, gives an empty one.
    """
    own = docs.select(held_out(docs).alias("held_out"), docs["text"], docs["lang"])
    model = docs.sparkSession.sparkContext.broadcast(learn(own.filter(~F.col("held_out"))))

    @F.arrow_udf(BooleanType())
    def identified(texts: pa.Array) -> pa.Array:
        texts, chosen = texts.fill_null(""), []
        for first, last in slices(utf8(texts)[1], SLICE_BYTES):
            names, scores = model.value.predict(texts.slice(first, last - first).to_pylist())
            chosen += [n != UNKNOWN and s >= least_score for n, s in zip(names, scores, strict=True)]
        return pa.array(chosen, pa.bool_())

    return docs.filter(identified("text"))  # only the texts go to Python, and a flag comes back
