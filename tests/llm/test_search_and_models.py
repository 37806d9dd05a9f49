"""Lexical search, whitening and toxicity: against brute force, numpy and held-out labels, on awkward and random rows."""

import math
import random
import re
import zlib

import numpy as np
import pytest

from slotledger.llm import lexical, toxicity, whitening
from tests.llm.conftest import AWKWARD

ITEMS = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def ranked(docs, items, k):
    """By the contract's formulas, one document and item after the other."""
    split = [(doc_id, terms(text)) for doc_id, text in docs]
    whole = [t for _, t in split if t]
    n, length = len(whole), sum(map(len, whole))
    out = []
    for number, (item_id, text) in enumerate(items):
        wanted, scores = set(terms(text)), []
        for place, (doc_id, own) in enumerate(split):
            score = 0
            for term in wanted & set(own):
                df = sum(term in t for t in whole)
                w, tf = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))), own.count(term)
                score += w * (1000000000 * tf // (1000 * tf + 8 * (10 + 90 * len(own) * n // length)))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, place))
        out += [(item_id, r, None if none else i, -s) for r, (s, none, i, _) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def searched(docs, items, **options):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical.search(docs, items, **options).collect()), key=str)


@pytest.mark.parametrize(("k", "block_bytes"), [(10, 8 << 20), (3, 900)])
def test_search_equals_brute_force(spark, k, block_bytes):
    rng = random.Random(k)
    words = ["the", "a", "É", "x1", "of", "Cat", "dog's", "名前", "rare", "-", "seldom", "often"]
    docs = [(i // 2, " ".join(rng.choices(words, [30, 20, 5, 5, 20, 8, 3, 2, 1, 5, 1, 9], k=rng.randint(0, 30)))) for i in range(120)]
    docs += [(None, "rare rare"), (500, None), (501, ""), (7, "the cat"), (7, "the cat"), (502, "the " * 500 + "seldom")]
    items = [(i, " ".join(rng.sample(words, rng.randint(1, 9)))) for i in range(12)] + [(3, "cat CAT rare"), (None, "the"), (90, None), (91, "nowhere")]
    frames = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, ITEMS)
    assert searched(*frames, k=k, block_bytes=block_bytes) == ranked(docs, items, k)


def test_search_of_awkward_rows(spark, awkward, crowded, no_documents):
    items = [(1, "the CAT sat"), (2, "word end"), (3, None), (4, "12345"), (5, "le chat 😀")]
    frame = spark.createDataFrame(items, ITEMS).selectExpr("*", "'x' AS number", "'x' AS rank", "'x' AS doc_id", "'x' AS score")
    expected = ranked([r[:2] for r in AWKWARD], items, 10)
    assert searched(awkward, frame) == searched(crowded, frame) == expected
    assert searched(no_documents, frame) == searched(awkward, frame.filter("false")) == []


def test_search_skips_groups_that_cannot_win():
    """A hot term alone brings no document in once better ones are known, and masks of many words are told apart."""
    rng = np.random.default_rng(1)
    sizes = rng.integers(100, 200, 5000)
    owner = np.concatenate([np.arange(5000), rng.integers(0, 5000, 400)])
    named = np.concatenate([np.zeros(5000, int), rng.integers(1, 150, 400)])
    pairs = np.unique(np.stack([owner, named]), axis=1)
    often = rng.integers(1, 4, pairs.shape[1])
    weights = np.concatenate([[3], np.full(149, 8000)])
    model = lexical.Model([0], [np.arange(150)], weights, 5000, int(sizes.sum()))
    chunk, best = lexical.Chunk(model, sizes, pairs[0], pairs[1], often), lexical.Best(1, 10)
    ids = np.arange(5000)
    done = chunk.best(model.queries[0], best.least(0), lambda docs, scores: best.merge(0, scores, np.zeros(len(docs), bool), ids[docs]))
    whole = np.bincount(pairs[0], model.impacts(sizes, *pairs, often), 5000).astype(np.int64)
    order = np.lexsort((ids, -whole))[:10]
    assert best.held[0][2].tolist() == order.tolist() and best.held[0][0].tolist() == whole[order].tolist()
    assert done < 500


# whitening

VECTORS = "vec_id long, embedding array<float>"


def random_vectors(count, width, seed=0):
    rng = np.random.default_rng(seed)
    return (rng.normal(size=(count, width)) * np.linspace(0.2, 3, width) + rng.normal(size=width)).astype(np.float32)


def whitened(df, width):
    rows = df.orderBy("vec_id", "component").collect()
    k = max((r["component"] for r in rows), default=0)
    return rows, np.array([r["whitened"] for r in rows]).reshape(-1, k) if k else np.zeros((0, 0))


def test_whitening_equals_numpy(spark):
    vectors = random_vectors(300, 40)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], VECTORS).repartition(4)
    rows, found = whitened(whitening.whiten(frame), 40)
    x = np.floor(64 * vectors.astype(np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    centred = (n * x - sums) / n
    values, components = np.linalg.eigh(centred.T @ centred / n)
    values, components = values[::-1][:32], components[:, ::-1][:, :32]
    expected = centred @ components / np.sqrt(values)
    assert found.shape == (300, 32)
    assert np.abs(np.abs(found) - np.abs(expected)).max() < 1e-9
    assert np.abs(np.sign(found[0]) * np.sign(expected[0]) * expected - found).max() < 1e-9  # one sign for all rows
    assert [r["deviation"] for r in rows[::32]] == [int(sum(d * d for d in row)) for row in (n * x - sums).tolist()]
    assert np.allclose([r["explained"] for r in rows[:32]], values / np.trace(centred.T @ centred / n), rtol=1e-9)
    assert {r["n"] for r in rows} == {300} and len({r["identity_error"] for r in rows}) == 1
    assert abs(rows[0]["identity_error"] - np.abs(found.T @ found / n - np.eye(32)).max()) < 1e-12 and rows[0]["identity_error"] < 1e-9


def test_whitening_of_awkward_rows(spark):
    good = random_vectors(30, 5, 3).tolist()
    odd = [None, [1.0, None, 1.0, 1.0, 1.0], [math.nan] * 5, [math.inf, 0.0, 0.0, 0.0, 0.0]]
    rows = [(i // 2, v) for i, v in enumerate(good)] + [(None, good[0]), *((100 + i, v) for i, v in enumerate(odd))]
    frame = spark.createDataFrame(rows, VECTORS)
    named = frame.selectExpr("*", "'x' AS n", "'x' AS component", "'x' AS i", "'x' AS part", "'x' AS dim")
    plain = whitening.whiten(frame).collect()
    assert len(plain) == 31 * 5 and {r["component"] for r in plain} == set(range(1, 6)) and {r["n"] for r in plain} == {31}
    assert sum(r["vec_id"] is None for r in plain) == 5
    assert whitening.whiten(named).count() == 31 * 5
    assert whitening.whiten(frame.filter("false")).collect() == []
    assert whitening.whiten(frame.filter("vec_id >= 100")).collect() == []
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], VECTORS)
    assert whitening.whiten(same).collect() == []  # no eigenvalue is above zero
    line = spark.createDataFrame([(i, [float(i), 2.0 * i, 1.0]) for i in range(9)], VECTORS)
    assert {r["component"] for r in whitening.whiten(line).collect()} == {1}


def test_vectors_that_integers_cannot_hold_are_refused(spark):
    with pytest.raises(ValueError, match="one length"):
        whitening.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], VECTORS))
    with pytest.raises(Exception, match="beyond"):
        whitening.whiten(spark.createDataFrame([(1, [1e30]), (2, [1.0])], VECTORS)).collect()
    big = np.array([[4 * 10**9, 0], [1, 1]], np.int64)
    with pytest.raises(OverflowError):
        whitening.squares(big)
    assert whitening.squares(np.array([[2**31, 2**31 - 1]])).tolist() == [2**62 + (2**31 - 1) ** 2]


@pytest.mark.parametrize("kind", ["random", "clusters", "blocks", "rank", "one", "zero", "repeated"])
def test_components_are_eigenvectors(kind):
    rng = np.random.default_rng(5)
    a = rng.normal(size=(90, 40))
    v = {
        "random": a.T @ a,
        "clusters": np.diag(np.r_[np.full(20, 5.0), np.full(19, 5 - 1e-9), 1]),
        "blocks": np.kron(np.eye(8), a[:, :5].T @ a[:, :5]),
        "rank": a[:7].T @ a[:7],
        "one": np.array([[4.0]]),
        "zero": np.zeros((3, 3)),
        "repeated": np.repeat(np.repeat(a[:, :10].T @ a[:, :10], 4, 0), 4, 1),
    }[kind]
    values, vectors = whitening.leading_components(v, 32)
    exact = np.linalg.eigvalsh(v)[::-1][:32]
    exact = exact[exact > whitening.LEAST_SHARE * exact[0]]
    assert len(values) == len(exact) and np.allclose(values, exact, rtol=1e-10)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.allclose(v @ vectors, vectors * values, atol=1e-11 * max(1, np.abs(v).max()))


# toxicity

BAD = ["scumbag", "dimwitted", "numbskull", "worthless"]


def labelled(rng, count, poison=0.3):
    syllables = ["ka", "lo", "mi", "ter", "an", "su", "vel", "or", "ne", "pa"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(1, 4)))
    rows = []
    for i in range(count):
        words = [word() for _ in range(rng.randint(5, 400))]
        toxic = rng.random() < poison
        for _ in range(rng.randint(1, 3) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_toxicity_of_held_out_documents(spark):
    rows = labelled(random.Random(4), 900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    found = toxicity.toxicity(docs, spark.createDataFrame([r[::2] for r in rows], "doc_id long, toxic int")).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    truth = {r[0]: r[2] for r in rows}
    held = [(truth[r["doc_id"]], r["predicted"]) for r in found if r["held_out"]]
    caught = [p for t, p in held if t]
    spared = [1 - p for t, p in held if not t]
    assert len(caught) > 30 and sum(caught) / len(caught) > 0.95 and sum(spared) / len(spared) > 0.95


def test_misspellings_share_vectors():
    rows = labelled(random.Random(5), 600)
    words = toxicity.numbered(r[1] for r in rows)
    model = toxicity.train(*words, np.array([r[2] for r in rows], float), np.ones(len(rows)), np.arange(len(rows)) % 5 == 0)
    values = toxicity.WordValues(model)
    plain = max(values[w] for w in words[2] if w not in BAD)
    for wrong in ("scumbagg", "dimwited", "numskull", "worthles"):
        assert wrong not in words[2] and values[wrong] > plain
    texts = [toxicity.words_of("kalo miter ansu " * 300 + f"you {w} " + "velor nepa " * 300) for w in ("worthles", "terneor")]
    odds = model.odds(texts, values)
    assert odds[0] > odds[1]


def test_trained_slots_equal_the_softmax_of_averaged_vectors():
    """One number a slot says the same as averaging vectors and reading them by a softmax of two columns."""
    rng = np.random.default_rng(0)
    table, softmax = rng.normal(size=(toxicity.SLOTS, 4)), rng.normal(size=(4, 2))
    bias = rng.normal(size=2)
    words = toxicity.words_of("One two three, four five six seven eight nine ten élève")
    model = toxicity.Slots(table @ (softmax[:, 1] - softmax[:, 0]), bias[1] - bias[0])
    first, _ = toxicity.passages(np.array([len(words)]))
    chances = []
    for part in np.split(np.arange(len(words)), first[1:]):
        assert len(part) <= toxicity.PASSAGE
        bag = np.mean([table[toxicity.subwords(words[i])].mean(0) for i in part], axis=0)
        z = np.exp(bag @ softmax + bias)
        chances.append(z[1] / z.sum())
    assert np.isclose(toxicity._sigmoid(model.odds([words], toxicity.WordValues(model)))[0], max(chances))


def test_toxicity_of_awkward_rows(spark, awkward, crowded, no_documents):
    marks = [(1, 1), (2, 0), (3, 0), (4, 0), (5, 1), (5, 0), (6, 0), (7, 0), (8, 0), (9, 1), (None, 1), (1, None), (8, 7)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int").selectExpr("*", "'x' AS text", "'x' AS label", "'x' AS weight", "'x' AS bytes")
    found = toxicity.toxicity(awkward, labels).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in AWKWARD)
    assert all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["doc_id"] in (2, 3, 4)}) == 1  # empty bags
    scores = sorted(r["score"] for r in found)
    assert sorted(r["score"] for r in toxicity.toxicity(crowded, labels).collect()) == scores
    assert toxicity.toxicity(no_documents, labels).collect() == []
    for few, score in ((labels.filter("false"), 0), (labels.filter("toxic = 0"), 0), (labels.filter("toxic = 1 AND doc_id <> 5"), 1)):
        assert {(r["score"], r["predicted"]) for r in toxicity.toxicity(awkward, few).collect()} == {(score, score)}


def test_sample_is_bounded_and_weighted(spark):
    rows = labelled(random.Random(6), 300)
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([r[::2] for r in rows], "doc_id long, toxic int")
    all_ = toxicity.sample(docs, labels).collect()
    few = toxicity.sample(docs, labels, most_docs=40).collect()
    assert len(few) == 40 and sum(r["label"] for r in few) == 20
    for label in (0, 1):
        assert math.isclose(sum(r["weight"] for r in few if r["label"] == label), sum(r["label"] == label for r in all_))
    small = toxicity.sample(docs, labels, most_bytes=20_000).collect()
    assert 0 < sum(len(r["text"]) for r in small) <= 20_000
