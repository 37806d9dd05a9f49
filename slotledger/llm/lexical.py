"""Ranked lexical search by groups of equal presence masks.

One pass over the documents counts their terms and keeps the places of terms that some query holds. A second pass over
those postings searches: each task takes documents in chunks and, for each query, gives every document a mask with one
bit for each query term that it holds. Documents of one mask are a group, and no document of a group scores more than
the sum of the largest contributions of the mask's terms. Groups are evaluated by falling bound until the k-th best
score found so far lies above the next bound; that score is carried on to the task's later chunks. Terms whose bounds
together stay below it cannot bring a document in by themselves, so documents without any other term get no mask.

Each task returns at most k documents a query, and their k best are the result, so nothing grows with a term's frequency.
Queries travel in blocks of bounded size, one at a time.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slotledger.llm.common import id_and_text, ragged, stored, utf8

BEST = 10
BLOCK_BYTES = 8 << 20  # of query text; one longer query is a block of its own
CHUNK_DOCS, CHUNK_POSTINGS = 1 << 15, 1 << 21
FIRST_WAVE = 256  # documents evaluated before the bounds are looked at again; twice as many each time

# ASCII letters in lower case, digits and all bytes of other characters are kept, and what lies between becomes a space
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


class Queries(NamedTuple):
    """Numbered queries as arrays of term numbers, and the terms' numbers."""

    numbers: list[int]
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]


def collected(block: DataFrame) -> Queries:
    vocabulary: dict[bytes, int] = {}
    numbers, terms = [], []
    for row in block.toLocalIterator():
        numbers.append(row["number"])
        terms.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in dict.fromkeys(terms_of(row["text"].encode()))], np.int64))
    return Queries(numbers, terms, vocabulary)


def _postings(vocabulary) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """doc_id, number of all terms, and the query terms with their frequencies, of every document that has a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            kept, sizes, ends, found, often = [], [], [0], [], []
            for i in range(batch.num_rows):
                terms = terms_of(data[offsets[i] : offsets[i + 1]].tobytes())
                if terms:
                    own = Counter(filter(number.__contains__, terms))
                    kept.append(i)
                    sizes.append(len(terms))
                    found += [number[t] for t in own]
                    often += own.values()
                    ends.append(len(found))
            at = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(x, pa.int32())) for x in (found, often)]
            ids = batch.column(0).take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), *lists], ["doc_id", "n", "terms", "often"])

    return run


def _frequencies(count: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=count)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], ["term", "df"])

    return run


class Model(NamedTuple):
    """Numbers and terms of the queries, weights of all terms, and what the documents' lengths are compared with."""

    numbers: list[int]
    queries: list[np.ndarray]
    weights: np.ndarray
    documents: int
    length: int

    def impacts(self, sizes: np.ndarray, owner: np.ndarray, terms: np.ndarray, often: np.ndarray) -> np.ndarray:
        """What each posting adds to the score of its document ``owner``; ``sizes`` are the documents' numbers of terms."""
        distinct, which = np.unique(sizes, return_inverse=True)  # so that the products below can be of any size
        m = np.array([10 + 90 * n * self.documents // self.length for n in distinct.tolist()], np.int64)
        return self.weights[terms] * (1_000_000_000 * often // (1000 * often + 8 * m[which][owner]))


class Chunk:
    """Postings of some documents by term, with the largest contribution of each term."""

    def __init__(self, model: Model, sizes: np.ndarray, owner: np.ndarray, terms: np.ndarray, often: np.ndarray) -> None:
        impact = model.impacts(sizes, owner, terms, often)
        order = np.argsort(terms, kind="stable")
        self.docs, self.impact = owner[order], impact[order]
        self.starts = np.searchsorted(terms[order], np.arange(len(model.weights) + 1))
        self.top = np.zeros(len(model.weights), np.int64)
        some = np.flatnonzero(np.diff(self.starts))
        if len(some):
            self.top[some] = np.maximum.reduceat(self.impact, self.starts[some])
        self.size = len(sizes)

    def postings(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        at = slice(self.starts[term], self.starts[term + 1])
        return self.docs[at], self.impact[at]

    def best(self, query: np.ndarray, least: int, merge: Callable[[np.ndarray, np.ndarray], int]) -> int:
        """Hand all documents that may score ``least`` or more, best groups first, to ``merge``, which returns the new least.

        Returns how many documents were evaluated.
        """
        terms = query[self.top[query] > 0]
        terms = terms[np.argsort(self.top[terms], kind="stable")]
        reach = np.cumsum(self.top[terms])
        needed = int(np.searchsorted(reach, least))  # documents with earlier terms only stay below
        if needed == len(terms):
            return 0
        present = np.zeros(self.size, bool)
        for term in terms[needed:]:
            present[self.postings(term)[0]] = True
        docs = np.flatnonzero(present)
        place = np.full(self.size, -1, np.int64)
        place[docs] = np.arange(len(docs))
        words = -(-len(terms) // 64)
        masks = np.zeros((len(docs), words), np.uint64)
        for bit, term in enumerate(terms):
            at = place[self.postings(term)[0]]
            masks[at[at >= 0], bit // 64] |= np.uint64(1 << bit % 64)
        groups, member = self._groups(masks)
        bound = np.zeros(len(groups), np.int64)
        for bit, term in enumerate(terms):
            bound += np.where(groups[:, bit // 64] >> np.uint64(bit % 64) & np.uint64(1), self.top[term], 0)
        ranked = np.argsort(-bound, kind="stable")
        sizes = np.cumsum(np.bincount(member, minlength=len(groups))[ranked])
        by_group = np.argsort(np.argsort(ranked, kind="stable")[member], kind="stable")  # members, best group first
        first, done, wave = 0, 0, FIRST_WAVE
        while first < len(ranked) and bound[ranked[first]] >= least:
            last = max(first + 1, int(np.searchsorted(sizes, done + wave, "right")))
            last = first + int(np.searchsorted(-bound[ranked[first:last]], -least, "right"))  # the others need not be looked at
            chosen = np.sort(docs[by_group[done : sizes[last - 1]]])
            least = merge(chosen, self.scores(terms, chosen))
            first, done, wave = last, int(sizes[last - 1]), 2 * wave
        return done

    @staticmethod
    def _groups(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The distinct masks, and the one of each row."""
        if masks.shape[1] == 1:
            distinct, member = np.unique(masks[:, 0], return_inverse=True)
            return distinct[:, None], member
        whole = np.ascontiguousarray(masks).view(f"V{8 * masks.shape[1]}").ravel()
        _, first, member = np.unique(whole, return_index=True, return_inverse=True)
        return masks[first], member

    def scores(self, terms: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """Whole scores of ``docs`` (ascending)."""
        total = np.zeros(len(docs), np.int64)
        for term in terms:
            own, impact = self.postings(term)
            at = np.minimum(np.searchsorted(own, docs), len(own) - 1)
            total += np.where(own[at] == docs, impact[at], 0)
        return total


class Best:
    """The k best documents of each query so far: score falling, then doc_id rising, those without one last."""

    def __init__(self, count: int, k: int) -> None:
        none = np.zeros(0, np.int64)
        self.k, self.held = k, [(none, none.astype(bool), none)] * count

    def least(self, query: int) -> int:
        scores = self.held[query][0]
        return max(1, int(scores[-1])) if len(scores) == self.k else 1

    def merge(self, query: int, scores: np.ndarray, missing: np.ndarray, ids: np.ndarray) -> int:
        good = scores > 0
        new = (scores[good], missing[good], ids[good])
        scores, missing, ids = (np.concatenate(pair) for pair in zip(self.held[query], new, strict=True))
        order = np.lexsort((ids, missing, -scores))[: self.k]
        self.held[query] = scores[order], missing[order], ids[order]
        return self.least(query)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    docs = postings = 0
    for batch in batches:
        for first in range(0, batch.num_rows, CHUNK_DOCS):
            part = batch.slice(first, CHUNK_DOCS)
            more = len(part.column(2).flatten())
            if held and (docs + part.num_rows > CHUNK_DOCS or postings + more > CHUNK_POSTINGS):
                yield pa.Table.from_batches(held).combine_chunks()
                held, docs, postings = [], 0, 0
            held.append(part)
            docs, postings = docs + part.num_rows, postings + more
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _search(model, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Model = model.value
        best = Best(len(known.queries), k)
        for rows in _chunks(batches):
            column = rows.column(0).combine_chunks()
            missing, ids = np.asarray(column.is_null()), column.fill_null(0).to_numpy()
            terms, often = (rows.column(c).combine_chunks() for c in (2, 3))
            owner, _ = ragged(np.zeros(rows.num_rows, np.int64), np.diff(terms.offsets.to_numpy()))
            chunk = Chunk(known, rows.column(1).to_numpy(), owner, *(x.flatten().to_numpy().astype(np.int64) for x in (terms, often)))
            for q, query in enumerate(known.queries):
                chunk.best(query, best.least(q), lambda docs, scores, q=q: best.merge(q, scores, missing[docs], ids[docs]))  # noqa: B023
        for q, (scores, missing, ids) in enumerate(best.held):
            if len(scores):
                columns = [pa.array(np.full(len(scores), known.numbers[q])), pa.array(ids, pa.int64(), mask=missing), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, ["number", "doc_id", "score"])

    return run


def blocks_of(numbered: DataFrame, most: int) -> tuple[int, list[int]]:
    """How many blocks to deal queries into by a hash of their number, so that none of two or more exceeds ``most`` bytes; those with any."""
    sized = numbered.select("number", (F.octet_length("text") + F.lit(100)).cast("long").alias("bytes"))  # an empty one travels too
    count = max(1, -(-(sized.agg(F.sum("bytes")).first()[0] or 0) // most))
    while True:
        dealt = sized.groupBy(F.pmod(F.xxhash64("number"), F.lit(count)).alias("block")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        if dealt.filter(f"bytes > {most} AND n > 1").isEmpty():
            return count, sorted(r["block"] for r in dealt.select("block").collect())
        count *= 2


def _found(docs: DataFrame, block: DataFrame, k: int, label: str) -> DataFrame:
    """(number, doc_id, score): the k best documents of each query of a block, not yet ordered."""
    spark = docs.sparkSession
    queries = collected(block)
    vocabulary = spark.sparkContext.broadcast(queries.vocabulary)
    kind = "doc_id long, n long, terms array<int>, often array<int>"
    postings = stored(id_and_text(docs).mapInArrow(_postings(vocabulary), kind), f"postings-{label}")
    total = postings.agg(F.count("*").alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("length")).first()
    df = np.zeros(len(queries.vocabulary), np.int64)
    counted = postings.select("terms").mapInArrow(_frequencies(len(df)), "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for row in counted.toLocalIterator():
        df[row["term"]] = row["df"]
    documents, length = total["documents"], total["length"]
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
    model = spark.sparkContext.broadcast(Model(queries.numbers, queries.terms, weights, documents, max(1, length)))
    near = postings.mapInArrow(_search(model, k), "number long, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    found = stored(near.withColumn("rank", place).filter(F.col("rank") <= k), f"found-{label}")
    vocabulary.unpersist()
    model.unpersist()
    return found.select("number", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = BEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (from 1), doc_id and score: the ``k`` best documents of every item, fewer where fewer score above 0.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII; a term counts once in an item. Equal
    scores rank by doc_id, and a null doc_id comes last. Every row is an item or document of its own: repeated items are
    answered each, and repeated documents are found each. Null and empty texts have no term, so they are not found and
    find nothing, and an empty table on either side gives no row. Other columns are not read.

    The texts of a block of at most ``block_bytes`` of items (or one longer item) pass through the driver at a time.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    numbered = stored(items.select(F.monotonically_increasing_id().alias("number"), "item_id", text), "items")
    count, filled = blocks_of(numbered.select("number", "text"), block_bytes)
    dealt = F.pmod(F.xxhash64("number"), F.lit(count))
    blocks = [numbered.select("number", "text").filter(dealt == b) for b in filled or [0]]
    found = reduce(DataFrame.union, [_found(docs, block, k, str(b)) for b, block in enumerate(blocks)])
    return numbered.select("number", "item_id").join(found, "number").select("item_id", "rank", "doc_id", "score")
