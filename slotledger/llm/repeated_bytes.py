"""Repeated byte strings by a depth-limited radix sort of suffixes.

Suffixes are ordered most significant digit first, only as far as the threshold, and a suffix leaves the sort as soon
as it is alone in its group; the groups left at the end are exactly the repeated windows. The first digit is chosen so
that few rows are needed: each window of ``threshold`` bytes is represented by the smallest hash of a short gram inside
it. Equal windows have the same gram at the same place, and neighbouring windows mostly share theirs, so one row stands
for a run of about 170 windows. Runs whose gram occurs once in the corpus are done after a count. The bytes of the
others travel to their gram's task, where the next digits are sorted and the resulting groups compared byte by byte.

Equal texts are collapsed before anything else, into a table bucketed by text digest: texts are shuffled once, and
later joins with it move only small rows. Nothing is capped: grams of very many runs take a path that never gathers
them, with one row for each window and counts that are combined before the shuffle. Windows on that path are taken as
equal by 128 bits of hash, those of all other grams by their bytes; so the result is exact up to such hashes.

The same sort runs over words, each taken as a digit of 64 bits of hash: passages of so many words that repeat are
counted beside the bytes, as a passage may be long in words and yet shorter than the threshold in bytes.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotledger.llm.common import mix64, ragged, scratch_path, slices, stored, utf8

THRESHOLD = 400
PASSAGE_WORDS = 51
HOT_RUNS = 1 << 15
SALTS = 32  # places of one very common window meet in that many tasks
SLICE_BYTES = 1 << 20
BATCH_ROWS = 4096
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so that they can be inverted modulo 2 to the 64
_PLACE = np.uint64((1 << 28) - 1)


def gram_bytes(threshold: int) -> int:
    return max(1, threshold * 4 // 25)


class Hashes:
    """Polynomial hashes of any part of some bytes, modulo 2 to the 64."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, base: int = BASES[0]):
        power, self.inverse = self._tables(base, len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=self.sums[1:])

    @classmethod
    def _tables(cls, base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        if base not in cls._powers or len(cls._powers[base][0]) < size:
            steps = np.full(max(size, SLICE_BYTES + 1), base, np.uint64), np.full(max(size, SLICE_BYTES + 1), pow(base, -1, 1 << 64), np.uint64)
            for s in steps:
                s[0] = 1
                np.cumprod(s, out=s)
            cls._powers[base] = steps
        return cls._powers[base]

    def of(self, starts: np.ndarray, length: int) -> np.ndarray:
        return mix64((self.sums[starts + length] - self.sums[starts]) * self.inverse[starts])

    def all(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        return mix64((self.sums[length:] - self.sums[:n]) * self.inverse[:n])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values: minima forwards and backwards inside blocks of that width."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    forwards = np.minimum.accumulate(grid, axis=1).ravel()
    backwards = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backwards[:n], forwards[width - 1 : width - 1 + n])


def same_bytes(data: np.ndarray, left: np.ndarray, right: np.ndarray, length: int) -> np.ndarray:
    """Whether the strings that start at left[i] and right[i] are equal."""
    windows = np.lib.stride_tricks.sliding_window_view(data, length)
    step = max(1, (8 << 20) // (length * data.itemsize))
    parts = [(windows[left[i : i + step]] == windows[right[i : i + step]]).all(1) for i in range(0, len(left), step)]
    return np.concatenate(parts) if parts else np.zeros(0, bool)


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of some bytes start and end: all but blanks, tabs and line breaks."""
    word = np.zeros(len(data) + 2, np.int8)
    word[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    change = np.diff(word)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits for each word, a slice of bytes at a time; words of more than a slice are hashed alone."""
    found = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + SLICE_BYTES, "right")))
        part = data[low : ends[j - 1]]
        if len(part) > SLICE_BYTES:
            found[i] = int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little")
        else:
            found[i:j] = Hashes(part).of(starts[i:j] - low, ends[i:j] - starts[i:j])
        i = j
    return found


def _units(data: np.ndarray, offsets: np.ndarray, words: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, units, offsets of the rows from there on): the bytes of all rows, or hashes of words, some rows at a time."""
    if not words:
        yield 0, data, offsets
        return
    for first, last in slices(offsets, SLICE_BYTES):
        edges = offsets[first : last + 1]
        joined, begin = data[edges[0] : edges[-1]], np.zeros(1, np.int64)
        if last - first > 1:  # a blank after each text, so that no word goes on in the next one
            begin = edges - edges[0] + np.arange(len(edges))
            joined = np.insert(joined, edges[1:] - edges[0], 32)
        starts, ends = word_bounds(joined)
        yield first, word_hashes(joined, starts, ends), np.append(np.searchsorted(starts, begin[: last - first]), len(starts))


def runs_of(data: np.ndarray, bounds: np.ndarray, threshold: int, short: int = 16) -> tuple[np.ndarray, ...]:
    """For texts data[bounds[i] : bounds[i + 1]]: window runs (gram hash, first, last), and windows repeated in their own text.

    A run is a range of window starts that share their smallest gram. In texts with many short runs (periodic ones: fewer
    than ``short`` windows a run) repeated windows are found at once; only the first of each goes on, so that no text
    yields more rows than windows.
    """
    nothing = np.zeros(0, np.int64)
    if len(data) < threshold:
        return np.zeros(0, np.uint64), nothing, nothing, nothing
    gram = gram_bytes(threshold)
    hashes = Hashes(data)
    grams = hashes.all(gram)
    place = np.arange(len(grams), dtype=np.uint64)
    anchors = (sliding_minimum((grams & ~_PLACE) | place, threshold - gram + 1) & _PLACE).astype(np.int64)
    # windows inside one text
    last = np.maximum(bounds[1:] - threshold + 1, bounds[:-1])
    text, starts = ragged(bounds[:-1], last - bounds[:-1])

    def split(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        chosen = anchors[starts]
        new = np.concatenate(([True], (np.diff(starts) != 1) | (np.diff(chosen) != 0))) if len(starts) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        return first, np.append(first[1:], len(starts)) - 1

    first, end = split(starts)
    repeated = nothing
    runs = np.bincount(text[first], minlength=len(bounds) - 1)
    dense = runs * short > np.bincount(text, minlength=len(bounds) - 1)
    dense &= runs > 16
    if dense.any():
        at = starts[dense[text]]
        owner = text[dense[text]]
        prints = mix64(hashes.of(at, threshold) + owner.astype(np.uint64) * np.uint64(BASES[1]))
        _, index, inverse = np.unique(prints, return_index=True, return_inverse=True)
        earliest = index[inverse]
        later = np.flatnonzero(earliest != np.arange(len(at)))
        sure = same_bytes(data, at[earliest[later]], at[later], threshold) & (owner[earliest[later]] == owner[later])
        later = later[sure]
        repeated = np.unique(np.concatenate((at[later], at[earliest[later]])))
        starts = np.setdiff1d(starts, at[later], assume_unique=True)
        first, end = split(starts)
    return grams[anchors[starts[first]]], starts[first], starts[end], repeated


def _segments(data: np.ndarray, offsets: np.ndarray, threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, bounds, rows, places): whole texts together up to a slice; a longer text in parts that share threshold - 1 bytes."""
    rows, starts, sizes, total = [], [], [], 0

    def flush() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        joined = np.concatenate([data[s : s + n] for s, n in zip(starts, sizes, strict=True)])
        return joined, np.cumsum([0, *sizes]), np.array(rows), np.array(starts) - offsets[rows]

    for row in range(len(offsets) - 1):
        start, end = int(offsets[row]), int(offsets[row + 1])
        while end - start >= threshold:
            size = min(SLICE_BYTES, end - start)
            if total and total + size > SLICE_BYTES:
                yield flush()
                rows, starts, sizes, total = [], [], [], 0
            rows.append(row)
            starts.append(start)
            sizes.append(size)
            total += size
            start += size - threshold + 1
    if rows:
        yield flush()


def _find_runs(threshold: int, words: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    short = max(2, min(16, (threshold - gram_bytes(threshold)) // 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for above, units, offsets in _units(*utf8(batch.column(1)), words):
                for joined, bounds, rows, places in _segments(units, offsets, threshold):
                    grams, first, last, repeated = runs_of(joined, bounds, threshold, short)
                    cuts = np.flatnonzero(np.diff(repeated) != 1) + 1
                    again = [(r[0], r[-1]) for r in np.split(repeated, cuts)] if len(repeated) else []
                    # a repeated range never spans two texts: the windows between them do not exist
                    first = np.concatenate((first, np.array([a for a, _ in again], np.int64)))
                    last = np.concatenate((last, np.array([b for _, b in again], np.int64)))
                    part = np.searchsorted(bounds, first, "right") - 1
                    shift = places[part] - bounds[part]
                    known = np.arange(len(first)) < len(grams)
                    values = np.concatenate((grams.view(np.int64), np.zeros(len(again), np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(values, mask=~known),
                            batch.column(0).take(pa.array(above + rows[part])),
                            pa.array((first + shift).astype(np.int32)),
                            pa.array((last + shift).astype(np.int32)),
                        ],
                        ["gram", "key", "first", "last"],
                    )

    return run


def _contexts(threshold: int, words: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The bytes, or hashes of words, that the windows of each listed run cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for above, units, offsets in _units(*utf8(batch.column(1)), words):
                keys, listed = (c.slice(above, len(offsets) - 1) for c in (batch.column(0), batch.column(2)))
                owner = np.repeat(np.arange(len(listed)), np.diff(listed.offsets.to_numpy()))
                gram, first, last = (f.to_numpy() for f in listed.flatten().flatten())
                body, size = memoryview(units.view(np.uint8)), units.itemsize
                for i in range(0, len(owner), BATCH_ROWS):
                    rows = slice(i, i + BATCH_ROWS)
                    low = (offsets[owner[rows]] + first[rows]) * size
                    high = (offsets[owner[rows]] + last[rows] + threshold) * size
                    texts = [bytes(body[a:b]) for a, b in zip(low.tolist(), high.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(gram[rows]), keys.take(pa.array(owner[rows])), pa.array(first[rows]), pa.array(texts, pa.binary())],
                        ["gram", "key", "first", "body"],
                    )

    return run


def _bodies(column: pa.Array, words: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bytes, or hashes of words, that lie in a binary column, and the offsets of its values."""
    data, offsets = utf8(column)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    return (data.view(np.uint64), offsets // 8) if words else (data, offsets)


def repeated_windows(data: np.ndarray, starts: np.ndarray, groups: np.ndarray, threshold: int) -> np.ndarray:
    """Which windows occur more than once among those of their group: radix passes, then a comparison byte by byte."""
    hashes = Hashes(data)
    alive, classes = np.arange(len(starts)), groups.astype(np.uint64)
    half = max(1, threshold // 2)
    for place, length in ((threshold - half, half), (0, threshold - half)):
        digit = hashes.of(starts[alive] + place, length)
        key = mix64(classes * np.uint64(BASES[1]) + digit)
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        new = np.concatenate(([True], ranked[1:] != ranked[:-1])) if len(ranked) else np.zeros(0, bool)
        label = np.cumsum(new) - 1
        many = np.bincount(label)[label] > 1 if len(label) else new
        alive, classes = alive[order[many]], label[many].astype(np.uint64)
    found = np.zeros(len(starts), bool)
    if len(alive):
        tied = classes[1:] == classes[:-1]
        equal = same_bytes(data, starts[alive[:-1]][tied], starts[alive[1:]][tied], threshold)
        if equal.all():
            found[alive] = True
        else:  # different strings with equal hashes: group these by the strings themselves
            wrong = np.isin(classes, classes[1:][tied][~equal])
            found[alive[~wrong]] = True
            seen: dict[tuple[int, bytes], list[int]] = {}
            for w in alive[wrong]:
                seen.setdefault((int(groups[w]), data[starts[w] : starts[w] + threshold].tobytes()), []).append(w)
            for members in seen.values():
                found[members] = len(members) > 1
    return found


def _sort_groups(threshold: int, words: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done(last: bool) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            gram = rows.column(0).to_numpy()
            changes = np.flatnonzero(gram[1:] != gram[:-1]) + 1
            end = len(gram) if last else int(changes[-1]) if len(changes) else 0
            held[:] = rows.slice(end).to_batches()
            if not end:
                return
            rows = rows.slice(0, end).to_batches()[0]
            data, offsets = _bodies(rows.column(3), words)
            group = np.concatenate(([0], np.cumsum(gram[1:end] != gram[: end - 1])))
            owner, starts = ragged(offsets[:-1], np.diff(offsets) - threshold + 1)
            found = np.flatnonzero(repeated_windows(data, starts, group[owner], threshold))
            if not len(found):
                return
            new = np.concatenate(([True], (np.diff(found) != 1) | (np.diff(owner[found]) != 0)))
            first = found[new]
            last_ = found[np.append(np.flatnonzero(new)[1:] - 1, len(found) - 1)]
            shift = rows.column(2).to_numpy()[owner[first]] - offsets[owner[first]]
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(1).take(pa.array(owner[first])),
                    pa.array((starts[first] + shift).astype(np.int64)),
                    pa.array((starts[last_] + shift + threshold).astype(np.int64)),
                ],
                ["key", "start", "end"],
            )

        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_ROWS):
                held.append(batch.slice(i, BATCH_ROWS))
                if sum(b.num_rows for b in held) >= BATCH_ROWS:
                    yield from done(False)
        if held and sum(b.num_rows for b in held):
            yield from done(True)

    return run


def _window_prints(threshold: int, words: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row for each window of the runs: 128 bits of hash, and where it starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _bodies(batch.column(3), words)
            owner, starts = ragged(offsets[:-1], np.diff(offsets) - threshold + 1)
            prints = [Hashes(data, base).of(starts, threshold).view(np.int64) for base in BASES]
            place = (starts - offsets[owner] + batch.column(2).to_numpy()[owner]).astype(np.int64)
            for i in range(0, len(owner), 1 << 16):
                rows = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prints[0][rows]), pa.array(prints[1][rows]), batch.column(1).take(pa.array(owner[rows])), pa.array(place[rows])],
                    ["x", "y", "key", "place"],
                )

    return run


def _merged(found: list[tuple[int, int]]) -> list[list[int]]:
    merged: list[list[int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    return merged


def _remove(with_kept: bool, passage_words: int = PASSAGE_WORDS) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            listed, whole = batch.column(2), batch.column(3).to_pylist()
            passages, copied = batch.column(4), batch.column(5).to_pylist()
            removed, count, digests, kept, spans, words = [], [], [], [], [], []
            for i in range(batch.num_rows):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                found = [(0, len(text))] if whole[i] else [(s["start"], s["end"]) for s in listed[i].as_py() or ()]
                merged = _merged(found)
                edges = [0, *(x for m in merged for x in m), len(text)]
                rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)) if merged else text
                removed.append(len(text) - len(rest))
                count.append(len(merged))
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest if with_kept else None)
                spans.append([{"start": a, "end": b} for a, b in merged])
                if copied[i]:
                    n = len(word_bounds(data[offsets[i] : offsets[i + 1]])[0])
                    words.append(n if n >= passage_words else 0)
                else:
                    words.append(sum(b - a for a, b in _merged([(s["start"], s["end"]) for s in passages[i].as_py() or ()])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(offsets)),
                    pa.array(removed, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(kept, pa.binary()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(words, pa.int64()),
                ],
                ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans", "n_repeated_words"],
            )

    return run


def text_key(text: Column) -> Column:
    """The first half of a text's SHA-256: 128 bits that stand for the text."""
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def _distinct_texts(docs: DataFrame) -> DataFrame:
    """(key, text, copies), bucketed by key, so that joins with it do not shuffle texts again.

    Copies are combined before the shuffle. The files lie in the shared scratch folder. Buckets need a table's name; it
    is dropped from the catalog at once, which leaves the files and the DataFrame.
    """
    spark = docs.sparkSession
    text = F.coalesce(docs["text"], F.lit("")).cast("string")
    texts = docs.select(text_key(text).alias("key"), F.encode(text, "UTF-8").alias("text"))
    distinct = texts.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    name, buckets = f"texts_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions"))
    distinct.write.bucketBy(buckets, "key").option("path", scratch_path(spark, "texts")).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def repeated_ranges(texts: DataFrame, threshold: int = THRESHOLD, hot_runs: int = HOT_RUNS, words: bool = False) -> DataFrame:
    """(key, start, end): ranges of distinct texts that are covered by repeated windows; ranges may overlap.

    Windows are strings of ``threshold`` bytes and ranges count bytes, or words in place of bytes.
    """
    runs = stored(
        texts.filter(F.octet_length("text") >= (2 * threshold - 1 if words else threshold))
        .select("key", "text")
        .mapInArrow(_find_runs(threshold, words), "gram long, key binary, first int, last int"),
        "runs",
    )
    known = runs.filter(F.col("gram").isNotNull())
    counts = stored(known.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1"), "counts")
    crowded = F.broadcast(counts.filter(F.col("n") > hot_runs).select("gram"))  # at most one for that many runs

    def bodies(which: DataFrame) -> DataFrame:
        listed = which.groupBy("key").agg(F.collect_list(F.struct("gram", "first", "last")).alias("runs"))
        return texts.join(listed, "key").select("key", "text", "runs").mapInArrow(
            _contexts(threshold, words), "gram long, key binary, first int, body binary"
        )

    shared = known.join(crowded, "gram", "left_anti").join(counts.select("gram"), "gram", "left_semi")
    usual = bodies(shared).repartition("gram").sortWithinPartitions("gram")
    found = usual.mapInArrow(_sort_groups(threshold, words), "key binary, start long, end long")
    prints = bodies(known.join(crowded, "gram")).mapInArrow(_window_prints(threshold, words), "x long, y long, key binary, place long")
    windows = stored(prints, "windows").withColumn("salt", F.pmod(F.xxhash64("key", "place"), F.lit(SALTS)))
    again = windows.groupBy("x", "y").agg(F.count("*").alias("n")).filter("n > 1").select("x", "y")
    again = again.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    places = windows.join(again, ["x", "y", "salt"]).select("key", F.col("place").alias("start"), (F.col("place") + threshold).alias("end"))
    own = runs.filter(F.col("gram").isNull()).select(
        "key", F.col("first").cast("long").alias("start"), (F.col("last") + threshold).cast("long").alias("end")
    )
    return found.union(places).union(own)


def remove_repeats(
    docs: DataFrame, threshold: int = THRESHOLD, hot_runs: int = HOT_RUNS, with_kept: bool = False, passage_words: int | None = None
) -> DataFrame:
    """Remove every byte that a string of ``threshold`` bytes covers which also starts anywhere else in the table.

    One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (merged byte ranges) and, if asked
    for, kept (the remaining bytes, which need not be valid UTF-8). All strings are judged on the input. Null text is
    empty. Repeated rows are copies like any other. Texts shorter than the threshold keep everything. Further columns
    are not read; an empty table gives an empty one.

    With ``passage_words`` a column n_repeated_words follows: the words covered by a passage of so many words that also
    starts anywhere else, whatever its bytes and the blanks between its words. Nothing is removed for it.
    """
    if threshold < 2:
        raise ValueError("threshold must be at least 2 bytes")
    if passage_words is not None and passage_words < 2:
        raise ValueError("a passage must have at least 2 words")
    texts = _distinct_texts(docs)
    ranges = repeated_ranges(texts, threshold, hot_runs).withColumn("of_words", F.lit(False))
    if passage_words:
        ranges = ranges.union(repeated_ranges(texts, passage_words, hot_runs, words=True).withColumn("of_words", F.lit(True)))
    span = F.struct("start", "end")
    ranges = ranges.groupBy("key").agg(
        F.collect_list(F.when(~F.col("of_words"), span)).alias("ranges"), F.collect_list(F.when(F.col("of_words"), span)).alias("passages")
    )
    copied = F.col("copies") > 1
    judged = (
        texts.join(ranges, "key", "left")
        .select("key", "text", "ranges", (copied & (F.octet_length("text") >= threshold)).alias("whole"), "passages", copied.alias("copied"))
        .mapInArrow(
            _remove(with_kept, passage_words or PASSAGE_WORDS),
            "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, "
            "spans array<struct<start: long, end: long>>, n_repeated_words long",
        )
    )
    judged = judged if passage_words else judged.drop("n_repeated_words")
    result = judged if with_kept else judged.drop("kept")
    keyed = docs.select("doc_id", text_key(F.coalesce(docs["text"], F.lit(""))).alias("key"))
    return keyed.join(result, "key").drop("key")
