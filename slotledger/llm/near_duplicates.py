"""SimHash near-duplicates with pivot distance tables.

Fingerprints that may be close share a block key; a table of Hamming distances from each fingerprint to many fixed
reference fingerprints then discards most pairs of a block, because two fingerprints can be no closer than their
distances to any one reference differ. Survivors are compared bit by bit.

Work is on distinct fingerprints, so exact copies cost nothing here. Pairs are formed only in blocks of up to
PAIR_BLOCK members. A larger block is never paired: its fingerprints are linked through all points one flip away,
65 rows for each, which finds exactly the same links and cannot be skewed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotledger.llm.common import free_name, id_and_text, mix64, ragged, slices, stored, utf8
from slotledger.llm.components import components

SEED = 42
RADIUS = 2
PIVOTS = 24
PAIR_BLOCK = 64
BLOCKS = 4  # of 16 bits: two fingerprints with at most two differing bits agree in at least two blocks
SHINGLE_WORDS = 5
SIMILARITY = 0.8
CHUNK = 1 << 15
PAIRS = 1 << 18
HELD_BYTES = 8 << 20  # of sorted rows, beyond the last whole group


def words_of(text: bytes) -> list[bytes]:
    """Lower-case (A-Z only) runs without ASCII white space."""
    return text.lower().split()


def shingle_hashes(words: list[bytes], size: int, seed: int = SEED) -> np.ndarray:
    """XXH64 of every run of ``size`` words joined by spaces; of all words, if there are fewer; none without words."""
    if not words:
        return np.zeros(0, np.uint64)
    runs = [words] if len(words) <= size else zip(*(words[i:] for i in range(size)), strict=False)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(b" ".join(run), seed) for run in runs), np.uint64)


def bit_majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in more than half of the hashes."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        part = hashes[i : i + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            prints = np.zeros(batch.num_rows, np.uint64)
            for i in range(batch.num_rows):
                words = words_of(data[offsets[i] : offsets[i + 1]].tobytes())
                prints[i] = bit_majority(shingle_hashes(words, size))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    return run


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """doc_id and the 64-bit SimHash (as a signed long) of every whole text; texts without words get zero."""
    return id_and_text(docs).mapInArrow(_fingerprints(shingle_words), "doc_id long, fp long")


def references(count: int) -> np.ndarray:
    """Reference fingerprints from a fixed rule."""
    return mix64(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def distance_table(prints: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances, one row for each fingerprint and one column for each reference."""
    return np.bitwise_count(prints[:, None] ^ pivots[None, :]).astype(np.int16)


def close_pairs(prints: np.ndarray, starts: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within ``radius`` bits, inside consecutive groups; pivots first, then the fingerprints themselves."""
    table = distance_table(prints, references(PIVOTS))
    found = [(np.zeros(0, np.int64),) * 2]
    # the members after each one in its group, some PAIRS at once: a group of any size takes no more memory than that
    rest = np.concatenate([np.arange(n)[::-1] for n in sizes]) if len(sizes) else np.zeros(0, np.int64)
    member = np.concatenate([np.arange(s, s + n) for s, n in zip(starts, sizes, strict=True)]) if len(sizes) else rest
    for first, last in slices(np.concatenate(([0], np.cumsum(rest))), PAIRS):
        left, right = ragged(member[first:last] + 1, rest[first:last])
        left = member[first:last][left]
        for column in table.T:
            keep = np.abs(column[left] - column[right]) <= radius
            left, right = left[keep], right[keep]
        keep = np.bitwise_count(prints[left] ^ prints[right]) <= radius
        found.append((left[keep], right[keep]))
    left, right = (np.concatenate(x) for x in zip(*found, strict=True))
    return left, right


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: int, least: int = 1 << 16) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows as tables that hold whole groups of equal first ``keys`` columns, and the starts of the groups."""
    held: list[pa.RecordBatch] = []

    def tables(last: bool) -> Iterator[tuple[pa.Table, np.ndarray]]:
        whole = pa.Table.from_batches(held).combine_chunks()
        new = np.zeros(whole.num_rows, bool)
        new[:1] = True
        for k in range(keys):
            values = whole.column(k).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        starts = np.flatnonzero(new)
        end = whole.num_rows if last else int(starts[-1])
        held[:] = whole.slice(end).to_batches()
        if end:
            yield whole.slice(0, end), starts[starts < end]

    for part in (batch.slice(first, PART) for batch in batches for first in range(0, batch.num_rows, PART)):
        held.append(part)
        if sum(b.num_rows for b in held) >= least or sum(b.nbytes for b in held) >= HELD_BYTES:
            yield from tables(False)
    if held:
        yield from tables(True)


def _pair_up(radius: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in _whole_groups(batches, 2):
            prints = rows.column(2).to_numpy().view(np.uint64)
            sizes = np.diff(np.append(starts, len(prints)))
            left, right = close_pairs(prints, starts, sizes, radius)
            yield pa.RecordBatch.from_arrays(
                [pa.array(prints[left].view(np.int64)), pa.array(prints[right].view(np.int64))], ["a", "b"]
            )

    return run


def flip_keys(fp: str = "fp") -> F.Column:
    """The fingerprint and the 64 points one flip away: two fingerprints share one exactly if they differ in at most two bits."""
    flips = [F.col(fp)] + [F.col(fp).bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))) for b in range(64)]
    return F.array(*flips)


def fingerprint_links(prints: DataFrame, pair_block: int = PAIR_BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect exactly those with at most RADIUS differing bits.

    Every such pair agrees in two of four blocks, so six keys for each fingerprint bring it together. Keys are counted
    first; members of small blocks are paired, and members of large ones are linked through their flips.
    """
    width = 64 // BLOCKS
    masks = [sum(((1 << width) - 1) << (width * k) for k in pair) for pair in combinations(range(BLOCKS), 2)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = prints.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in signed])).alias("part", "key")
    )
    counts = keyed.groupBy("part", "key").count().filter("count > 1")
    shared = keyed.join(counts, ["part", "key"])
    small = shared.filter(F.col("count") <= pair_block).select("part", "key", "fp")
    pairs = small.repartition("part", "key").sortWithinPartitions("part", "key").mapInArrow(_pair_up(RADIUS), "a long, b long")
    crowded = shared.filter(F.col("count") > pair_block).select("fp").distinct()
    stars = crowded.select("fp", F.explode(flip_keys()).alias("point"))
    hubs = stars.groupBy("point").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("members")).filter(F.size("members") > 1)
    return pairs.union(hubs.select("a", F.explode("members").alias("b")).filter("a <> b")).distinct()


def near_duplicate_groups(docs: DataFrame, shingle_words: int = 3, pair_block: int = PAIR_BLOCK) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id: the smallest doc_id reachable over links of at most two bits.

    One row per document. Null and empty texts have no words and so fingerprint zero, linked like any other. Equal
    texts are equal fingerprints. A null doc_id is never the smallest; a component of nothing else has none. Further
    columns are not read; an empty table gives an empty one.
    """
    prints = stored(fingerprints(docs, shingle_words), "simhash")
    # one row for each distinct fingerprint: a group of copies, however large, is one node from here on
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = components(fingerprint_links(nodes.select("fp"), pair_block))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id")
    return prints.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


# Near-duplicates by similarity: 0.8 in shingles is about ten of 64 bits, too wide for block keys. Candidates then
# share one of their smallest shingle hashes; pivots and fingerprints discard most of them; the rest is compared exactly.

SMALLEST = 8
WIDE_RADIUS = 24  # texts of similarity 0.8 differ in 9.7 bits on average; five standard deviations more
CROWDED_KEYS, BANDS = 2, 4  # how a document with crowded keys is placed at first
PART = 512  # members of a block that meet at once; larger blocks are compared part against part


def row_key(docs: DataFrame) -> F.Column:
    """Tells rows apart by id and whole text; only rows that repeat both share it."""
    return F.concat_ws(":", F.coalesce(docs["doc_id"].cast("string"), F.lit("null")), F.sha2(F.coalesce(docs["text"], F.lit("")), 256))


def _sketches(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(3))
            prints, keys = np.zeros(batch.num_rows, np.uint64), []
            for i in range(batch.num_rows):
                hashes = np.unique(shingle_hashes(words_of(data[offsets[i] : offsets[i + 1]].tobytes()), size))
                prints[i] = bit_majority(hashes)
                mixed = mix64(hashes)
                keys.append((np.partition(mixed, SMALLEST)[:SMALLEST] if len(mixed) > SMALLEST else mixed).view(np.int64))
            columns = [*batch.columns[:3], pa.array(prints.view(np.int64)), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "digest", "fp", "keys"])

    return run


def _pairs_by_distance(rows: pa.Table, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of each block that pivots and fingerprints leave, nearest first."""
    prints = rows.column(2).to_numpy().view(np.uint64)
    left, right = close_pairs(prints, starts, np.diff(np.append(starts, len(prints))), WIDE_RADIUS)
    order = np.argsort(np.bitwise_count(prints[left] ^ prints[right]), kind="stable")
    return left[order], right[order]


def _paired_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of a block that are in any pair that is left: only their texts will be needed.

    A fifth column tells which members are joined already; pairs of those do not count.
    """
    for rows, starts in _whole_groups(batches, 2, 1 << 13):
        left, right = _pairs_by_distance(rows, starts)
        if rows.num_columns > 4:
            roots = rows.column(4).to_numpy()
            apart = roots[left] != roots[right]
            left, right = left[apart], right[apart]
        used = np.unique(np.concatenate((left, right)))
        yield from rows.take(pa.array(used)).to_batches()


def _shingle_sets(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for first, last in slices(offsets, 8 << 20):
                sets = []
                for i in range(first, last):
                    hashes = shingle_hashes(words_of(data[offsets[i] : offsets[i + 1]].tobytes()), size)
                    sets.append(np.unique(hashes.astype(np.uint32)).tobytes())
                columns = [batch.column(0).slice(first, last - first), pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["node", "shingles"])

    return run


def _all_shingles(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(2))
            for first, last in slices(offsets, 8 << 20):
                found = [np.unique(shingle_hashes(words_of(data[offsets[i] : offsets[i + 1]].tobytes()), size)).view(np.int64) for i in range(first, last)]
                columns = [c.slice(first, last - first) for c in batch.columns[:2]]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.int64()))], ["node", "fp", "keys"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of shingles as the sorted sets that _links reads."""
    for batch in batches:
        lists = batch.column(1)
        values, offsets = lists.values.to_numpy().view(np.uint64).astype(np.uint32), lists.offsets.to_numpy()
        sets = [np.unique(values[a:b]).tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], ["node", "shingles"])


def _links(least: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Links between members of a block whose shingle sets are similar enough; pairs that links have joined are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, starts in _whole_groups(batches, 2, 1 << 11):
            nodes = rows.column(3).to_numpy()
            data, offsets = utf8(rows.column(4).combine_chunks())
            sets = [data[a:b].view(np.uint32) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            parent = list(range(len(nodes)))

            def root(i: int, parent: list[int] = parent) -> int:
                while parent[i] != i:
                    parent[i] = parent[parent[i]]
                    i = parent[i]
                return i

            found = []
            for i, j in zip(*(x.tolist() for x in _pairs_by_distance(rows, starts)), strict=True):
                one, other = root(i), root(j)
                if one == other:
                    continue
                x, y = sets[i], sets[j]
                if min(len(x), len(y)) < least * max(len(x), len(y)):
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both >= least * (len(x) + len(y) - both) - 1e-9:
                    parent[other] = one
                    found.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
            a, b = zip(*found, strict=True) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def _shared_keys(nodes: DataFrame) -> DataFrame:
    keyed = nodes.select("node", "fp", F.explode("keys").alias("key"))
    return keyed.join(keyed.groupBy("key").count().filter("count > 1"), "key")


def _blocks(shared: DataFrame, pair_block: int) -> DataFrame:
    """(block, part, fp, node): rows of a block are compared with each other; no block is much larger than pair_block.

    A key shared by more documents is split by eight-bit bands of the fingerprint, and what is still larger by a hash,
    differently for each key and band, so that a large group of copies hangs together through its overlapping parts.
    That joins most of a group cheaply, but not every pair; _rare_blocks bring the others together.
    """
    small = shared.filter(F.col("count") <= pair_block).select(F.col("key").alias("block"), F.lit(0).alias("part"), "fp", "node")
    crowded = shared.filter(F.col("count") > pair_block)
    few = crowded.groupBy("node", "fp").agg(F.slice(F.sort_array(F.collect_list("key")), 1, CROWDED_KEYS).alias("keys"))
    bands = F.array(*[F.shiftrightunsigned("fp", 8 * j).bitwiseAND(F.lit(255)) for j in range(BANDS)])
    split_keys = few.select("node", "fp", F.explode("keys").alias("key"), bands.alias("bands"))
    banded = split_keys.select("node", "fp", "key", F.posexplode("bands").alias("band", "bits")).select(
        "node", "fp", F.xxhash64("key", "band", "bits").alias("block")
    )
    sizes = banded.groupBy("block").count().filter("count > 1")
    split = banded.join(sizes, "block").select(
        "block", F.pmod(F.xxhash64("node", "block"), F.ceil(F.col("count") / pair_block)).cast("int").alias("part"), "fp", "node"
    )
    return small.union(split)


def _rare_blocks(crowded: DataFrame, roots: DataFrame, similarity: float, part: int = PART) -> DataFrame:
    """(block, part, fp, node, root): every pair of ``crowded`` (node, fp, keys: all shingles) that is not joined yet.

    With shingles in one order for all, here the rarest first, sets of at least that similarity share one of their first
    n - ceil(similarity n) + 1 shingles. So no pair is missed, and a passage that many texts share is no key of theirs
    unless it is nearly all they hold. Blocks whose members have one root are done; of blocks with the same members one
    stays. In the others, members outside the most frequent root meet all members, part against part.
    """
    rows = crowded.select("node", "fp", F.size("keys").alias("n"), F.explode("keys").alias("key"))
    shared = rows.join(rows.groupBy("key").count().filter("count > 1"), "key")
    # shingles of one document alone come first and lead nowhere
    ranked = shared.groupBy("node", "fp", "n").agg(F.sort_array(F.collect_list(F.struct("count", "key"))).alias("keys"))
    first = F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - 1e-9) + 1 - (F.col("n") - F.size("keys"))
    prefix = ranked.select("node", "fp", F.explode(F.slice("keys", F.lit(1), F.greatest(first, F.lit(0)).cast("int"))["key"]).alias("key"))
    prefix = prefix.join(roots, "node", "left").select("key", "node", "fp", F.coalesce("root", "node").alias("root"))
    prefix = stored(prefix, "rare-keys")
    same = [F.bit_xor(F.xxhash64("node")).alias("same"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("too")]
    own = prefix.groupBy("key", "root").agg(F.count("*").alias("n"), *same)
    whole = own.groupBy("key").agg(
        F.sum("n").alias("n"), F.count("*").alias("roots"), F.max(F.struct("n", "root")).alias("most"), F.bit_xor("same").alias("same"), F.bit_xor("too").alias("too")
    )
    open_ = whole.filter("roots > 1").groupBy("n", "same", "too").agg(F.min(F.struct("key", "most")).alias("one"))
    open_ = open_.select(
        "one.key",
        F.col("one.most.root").alias("most"),
        F.ceil(F.col("n") / part).cast("int").alias("parts"),
        F.ceil((F.col("n") - F.col("one.most.n")) / part).cast("int").alias("others"),
    )
    members = prefix.join(open_, "key")
    at, other = (F.pmod(F.xxhash64("node", "key"), F.col(c)).cast("int") for c in ("parts", "others"))
    meets = F.transform(F.sequence(F.lit(0), F.col("others") - 1), lambda r: r * F.col("parts") + at)
    calls = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda t: other * F.col("parts") + t)
    parts = F.when(F.col("root") == F.col("most"), meets).otherwise(F.array_union(meets, calls))
    return members.select(F.col("key").alias("block"), F.explode(parts).alias("part"), "fp", "node", "root")


def similar_groups(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, similarity: float = SIMILARITY, pair_block: int = PAIR_BLOCK
) -> DataFrame:
    """(row, doc_id, group): documents linked by a shingle-set similarity of at least ``similarity``, or by equal text.

    ``row`` is row_key, and ``group`` a number that all rows of a group share. Texts without words are only linked to
    equal ones. Members of a block are compared where they lie, nearest first, and not again once they are joined, so
    a block of any kind yields fewer links than it has members.
    """
    docs = docs.select("doc_id", "text")
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    sketched = stored(
        docs.select("doc_id", row_key(docs).alias("row"), digest.alias("digest"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
            _sketches(shingle_words), "doc_id long, row string, digest string, fp long, keys array<long>"
        ),
        "sketches",
    )
    nodes = stored(
        sketched.groupBy("digest")
        .agg(F.min("row").alias("row"), F.first("fp").alias("fp"), F.first("keys").alias("keys"))
        .withColumn("node", F.monotonically_increasing_id()),
        "sketch-nodes",
    )
    def by_block(rows: DataFrame) -> DataFrame:
        return rows.repartition("block", "part").sortWithinPartitions("block", "part", "node")

    shared = stored(_shared_keys(nodes), "shared-keys")
    members = stored(
        by_block(_blocks(shared, pair_block)).mapInArrow(_paired_members, "block long, part int, fp long, node long"), "members"
    )
    texts = docs.select(row_key(docs).alias("row"), F.coalesce("text", F.lit("")).alias("text"))

    def texts_of(some: DataFrame) -> DataFrame:
        return texts.join(nodes.join(some.select("node").distinct(), "node").select("row", "node", "fp"), "row").select("node", "fp", "text")

    sets = stored(
        texts_of(members).select("node", "text").mapInArrow(_shingle_sets(shingle_words), "node long, shingles binary").dropDuplicates(["node"]),
        "shingle-sets",
    )

    def linked(members: DataFrame, sets: DataFrame) -> DataFrame:
        compared = members.join(sets, "node").select("block", "part", "fp", "node", "shingles")
        return by_block(compared).mapInArrow(_links(similarity), "a long, b long")

    roots = components(linked(members, sets))
    crowded = texts_of(shared.filter(F.col("count") > pair_block))
    if not crowded.isEmpty():
        crowded = stored(
            crowded.mapInArrow(_all_shingles(shingle_words), "node long, fp long, keys array<long>").dropDuplicates(["node"]), "shingles"
        )
        rest = by_block(_rare_blocks(crowded, roots, similarity))
        rest = stored(rest.mapInArrow(_paired_members, "block long, part int, fp long, node long, root long"), "rare-members")
        used = crowded.join(rest.select("node").distinct(), "node", "left_semi").select("node", "keys")
        more = linked(rest, used.mapInArrow(_packed, "node long, shingles binary"))
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    named = nodes.join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("group"))
    return sketched.select("row", "doc_id", "digest").join(named, "digest").select("row", "doc_id", "group")


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """The documents without near-duplicates: of each group of similar_groups, the row with the smallest doc_id stays.

    Rows without an id stay only where their whole group has none. All columns are kept, and kept rows are unchanged.
    Null and empty texts count as equal, so one of them stays; of rows that repeat id and text one stays; an empty
    table gives an empty one.
    """
    groups = stored(similar_groups(docs, shingle_words, similarity), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    kept = groups.groupBy("group").agg(first).select(F.col("first.row").alias("row"))
    key, whole = free_name(docs, "row"), free_name(docs, "whole")
    packed = docs.select(F.struct("*").alias(whole), row_key(docs).alias(key))
    one = packed.join(kept.withColumnRenamed("row", key), key, "left_semi").groupBy(key).agg(F.first(whole).alias(whole))
    return one.select(f"{whole}.*")
