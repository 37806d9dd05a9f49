"""Benchmark decontamination: an FM-index per shard of training text, searched backwards for benchmark phrases.

Each task cuts its documents into shards. A document word that no phrase contains cannot be part of a match, so
only stretches of known words, long enough for the shortest phrase, enter the shard's index, with separators between
them. All phrases are searched at once, last word first, by ranks in a wavelet matrix over the Burrows-Wheeler
transform. Occurrences are located by walking to sampled suffix positions, and overlapping ones are merged to spans.
There is no shuffle: documents stay where they are read, and the phrases, in blocks of bounded size, travel to them.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from slotledger.llm.common import id_and_text, ragged, slices, utf8, with_text

WINDOW_WORDS = 10
SHARD_BYTES = 32 << 20
CUT_BYTES = 4 << 20  # the shards of decontaminate, whose workers go on to other stages and keep what they once took
PIECE_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20
SAMPLE_EVERY = 16

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_TO_WORDS = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)
RESULT = (
    "doc_id long, n_words long, n_hit long, item_ids array<string>, spans array<struct<start: long, end: long>>"
)


def words_of(text: bytes) -> list[bytes]:
    """Lower-case (A-Z only) runs of digits, letters a-z and anything beyond ASCII."""
    return text.translate(_TO_WORDS).split()


class Phrases:
    """The distinct windows of some benchmark items, with numbers for their words."""

    def __init__(self, items: list[tuple[str, bytes]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for i in range(max(1, len(words) - width + 1) if words else 0):
                windows.setdefault(tuple(words[i : i + width]), set()).add(item)
        self.owners = list(windows.values())
        self.lengths = np.array([len(w) for w in windows], np.int64)
        self.shortest = int(self.lengths.min()) if windows else 0
        # right aligned: column -1 is the last word of every window
        self.words = np.zeros((len(windows), int(self.lengths.max()) if windows else 0), np.int64)
        for row, window in enumerate(windows):
            self.words[row, self.words.shape[1] - len(window) :] = window


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Start positions of all suffixes in their order, by doubling the compared length."""
    n, reach = len(symbols), 1
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    while True:
        key = rank * (n + 1)
        if reach < n:
            key[:-reach] += rank[reach:] + 1
        order = np.argsort(key, kind="stable")
        new = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank[order] = new
        if new[-1] == n - 1:
            return order
        reach *= 2


class WaveletMatrix:
    """Counts of a symbol before a position, for many (symbol, position) pairs at once."""

    def __init__(self, symbols: np.ndarray):
        self.levels = []
        for bit in reversed(range(max(1, int(symbols.max()).bit_length()))):
            ones = (symbols >> bit) & 1 == 1
            before = np.concatenate(([0], np.cumsum(ones, dtype=np.int64)))
            self.levels.append((bit, before, len(symbols) - int(before[-1])))
            symbols = np.concatenate((symbols[~ones], symbols[ones]))

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(position), position
        for bit, before, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            low_ones, high_ones = before[low], before[high]
            low = np.where(one, zeros + low_ones, low - low_ones)
            high = np.where(one, zeros + high_ones, high - high_ones)
        return high - low


class FMIndex:
    """Symbols must be positive; 0 is the index's own end mark."""

    def __init__(self, symbols: np.ndarray):
        text = np.concatenate((symbols, [0]))
        order = suffix_order(text)
        self.last = text[order - 1]
        self.ranks = WaveletMatrix(self.last)
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(text))))
        self.sampled = order % SAMPLE_EVERY == 0
        self.samples = order[self.sampled]
        self.sample_of = np.cumsum(self.sampled) - 1

    def search(self, words: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of the suffixes that start with each right-aligned window."""
        n = len(self.last)
        low, high = np.zeros(len(words), np.int64), np.full(len(words), n, np.int64)
        for step in range(1, words.shape[1] + 1):
            alive = np.flatnonzero((lengths >= step) & (low < high))
            if not len(alive):
                break
            symbol = words[alive, -step]
            known = symbol < len(self.starts) - 1
            low[alive[~known]] = high[alive[~known]] = 0
            alive, symbol = alive[known], symbol[known]
            low[alive] = self.starts[symbol] + self.ranks.rank(symbol, low[alive])
            high[alive] = self.starts[symbol] + self.ranks.rank(symbol, high[alive])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: step backwards through the text to the next sampled one."""
        rows, steps, found = rows.copy(), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            at = rows[open_]
            done = self.sampled[at]
            found[open_[done]] = self.samples[self.sample_of[at[done]]] + steps[open_[done]]
            open_, at = open_[~done], at[~done]
            symbol = self.last[at]
            rows[open_] = self.starts[symbol] + self.ranks.rank(symbol, at)
            steps[open_] += 1
        return found


def occurrences(ids: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(window, position) of every occurrence in ``ids``, where 0 is a word that no phrase has."""
    known = np.concatenate(([0], (ids > 0).astype(np.int8), [0]))
    edges = np.diff(known)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    keep = ends - starts >= max(1, phrases.shortest)
    starts, sizes = starts[keep], (ends - starts)[keep]
    if not len(starts) or not len(phrases.lengths):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # each stretch and a separator behind it; symbols 0 and 1 are the end mark and the separator
    stretch, place = ragged(starts, sizes + 1)
    inside = place < np.repeat(starts + sizes, sizes + 1)
    symbols = np.where(inside, ids[np.minimum(place, len(ids) - 1)].astype(np.int64) + 1, 1)
    index = FMIndex(symbols)
    low, high = index.search(phrases.words + 1, phrases.lengths)
    window, rows = ragged(low, high - low)
    return window, place[index.locate(rows)]


def _pieces(text: bytes, most: int) -> Iterator[bytes]:
    """The text in parts that end between words, so that a very long document is never split into words at once."""
    start = 0
    while len(text) - start > most:
        cut = start + most
        while cut < len(text) and _TO_WORDS[text[cut]] != 32:
            cut += 1
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


def _word_ids(text: bytes, vocabulary: dict[bytes, int]) -> np.ndarray:
    parts = []
    for piece in _pieces(text, PIECE_BYTES):
        words = words_of(piece)
        parts.append(np.fromiter(map(vocabulary.get, words, repeat(0)), np.int32, len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def _word_bounds(text: bytes, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, only for documents that have hits."""
    bounds = np.fromiter((b for m in _WORD.finditer(text) for b in m.span()), np.int64).reshape(-1, 2)
    return bounds[wanted[:, 0], 0], bounds[wanted[:, 1] - 1, 1]


def _detector(blocks: list, width: int, shard_bytes: int = SHARD_BYTES) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("doc_id", pa.int64()),
                ("n_words", pa.int64()),
                ("n_hit", pa.int64()),
                ("item_ids", pa.list_(pa.string())),
                ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ]
        )
        only = Phrases(blocks[0].value, width) if len(blocks) == 1 else None
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, last in slices(offsets, shard_bytes):
                texts = [data[offsets[i] : offsets[i + 1]].tobytes() for i in range(first, last)]
                items: list[set[str]] = [set() for _ in texts]
                covers: list[list[np.ndarray]] = [[] for _ in texts]
                for block in blocks or [None]:
                    phrases = only or Phrases(block.value if block else [], width)
                    counts = _search_shard(texts, phrases, items, covers)
                hits, spans = [], []
                for text, cover in zip(texts, covers, strict=True):
                    merged = _merged(cover)
                    hits.append(int((merged[:, 1] - merged[:, 0]).sum()))
                    bounds = zip(*_word_bounds(text, merged), strict=True) if len(merged) else ()
                    spans.append([{"start": int(a), "end": int(b)} for a, b in bounds])
                columns = [batch.column(0).slice(first, last - first), counts, hits, [sorted(x) for x in items], spans]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t.type) if not isinstance(c, pa.Array) else c.cast(t.type) for c, t in zip(columns, schema, strict=True)],
                    schema=schema,
                )

    return detect


def _search_shard(texts: list[bytes], phrases: Phrases, items: list[set[str]], covers: list[list[np.ndarray]]) -> list[int]:
    """Add the hits of one block of phrases to each document's items and covered word ranges; word counts come back."""
    parts, zero = [], np.zeros(1, np.int32)
    counts = []
    for text in texts:
        ids = _word_ids(text, phrases.vocabulary)
        counts.append(len(ids))
        parts += [ids, zero]  # windows never cross documents
    base = np.cumsum([0] + [c + 1 for c in counts])
    window, place = occurrences(np.concatenate(parts) if parts else zero, phrases)
    owner = np.searchsorted(base, place, "right") - 1
    order = np.argsort(owner, kind="stable")
    cuts = np.flatnonzero(np.diff(owner[order])) + 1
    for group in np.split(order, cuts) if len(order) else ():
        doc = int(owner[group[0]])
        start = place[group] - base[doc]
        covers[doc].append(np.stack((start, start + phrases.lengths[window[group]]), 1))
        for w in np.unique(window[group]):
            items[doc] |= phrases.owners[w]
    return counts


def _merged(cover: list[np.ndarray]) -> np.ndarray:
    if not cover:
        return np.zeros((0, 2), np.int64)
    ranges = np.concatenate(cover)
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ranges[:, 1])
    new = np.concatenate(([True], ranges[1:, 0] > reach[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(ranges) - 1]))
    return np.stack((ranges[new, 0], reach[last]), 1)


def phrase_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list:
    """The benchmark as broadcast blocks of bounded size: collected and sent one at a time, by a hash of the item.

    Null text has no words. A null item id counts as an item with an empty id; repeated ids are one item.
    """
    spark = benchmark.sparkSession
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.encode("text", "UTF-8").alias("body")
    ).filter(F.col("body").isNotNull())
    size = items.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0)).alias("n")).first()["n"]
    n = max(1, -(-size // block_bytes))
    part = F.pmod(F.xxhash64("item", "body"), F.lit(n))
    blocks = []
    for k in range(n):
        rows = [(r["item"], bytes(r["body"])) for r in items.filter(part == k).toLocalIterator()]
        blocks.append(spark.sparkContext.broadcast(rows))
    return blocks


def contamination(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Which words of each document lie in an occurrence of a benchmark window of ``width`` words.

    A shorter item is one window. One row per document: doc_id, n_words, n_hit, the sorted item_ids whose windows
    occur, and the merged hit spans as byte ranges of the UTF-8 text. Null or empty text has no words and no spans;
    an empty benchmark hits nothing; repeated documents are judged one by one; further columns are not read.
    """
    return id_and_text(docs).mapInArrow(_detector(phrase_blocks(benchmark, block_bytes), width), RESULT)


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WINDOW_WORDS) -> DataFrame:
    """The documents with every hit span cut out of their text (a line break marks the place); all columns are kept.

    Texts without hits, null and empty ones are returned as they are; repeated rows are cut each; an empty table gives an
    empty one; a column named n_chars follows the new text.
    """
    blocks = phrase_blocks(benchmark)
    detect = _detector(blocks, width, CUT_BYTES if len(blocks) == 1 else SHARD_BYTES)  # several are parsed again for each shard

    @F.arrow_udf(StringType())
    def cut(texts: pa.Array) -> pa.Array:
        rows = pa.array(range(len(texts)), pa.int64())
        judged = detect(iter([pa.RecordBatch.from_arrays([rows, texts.fill_null("")], ["doc_id", "text"])]))
        new: list[str | None] = []
        for part in judged:
            for spans in part.column(4).to_pylist():
                if spans:
                    body = texts[len(new)].as_py().encode()
                    edges = [0, *(b for s in spans for b in (s["start"], s["end"])), len(body)]
                    new.append(b"\n".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)).decode())
                else:
                    new.append(None)
        return pa.array(new, pa.string())

    return with_text(docs, cut("text"))  # only texts that change come back from Python
