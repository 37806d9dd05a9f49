"""Contracts of the operators on documents, against brute force, on awkward and on random rows."""

import collections
import hashlib
import json
import random
import re
import tracemalloc
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from slotledger.llm import bpe, catalog, decontamination, language, near_duplicates, pii, repeated_bytes, sharding
from tests.llm.conftest import AWKWARD

BENCHMARK = "item_id long, text string"


def key(row):
    return [(v is not None, str(v)) for v in row]


def collected(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=key)


def same(found, expected):
    assert sorted(found, key=key) == sorted(expected, key=key)


# personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        total = sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(digits)))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text):
    return [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m[0])]


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    pools = ["0123456789.... ", "0123456789+-() .", "ab1.@-_%", "0123456789.@+- ()ab_%é٣"]
    texts = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += ["4111 1111 1111 1111", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "999.1.1.1.1", "x" * 2000 + "@"]
    for text in texts:
        found = [(pii.KINDS[c.kind], c.start, c.end) for c in pii.candidates(text) if c.base]
        assert found == base_spans(text), text


def test_candidates_beyond_base_never_overlap():
    text = 'token = "24be64439e3e49cf46b2d7c90f3602a3" 4785380592391131 mail a@b.org secret: abcdefgh12345678@x.org'
    spans = sorted((c.start, c.end, c.base) for c in pii.candidates(text))
    for (_, end, _), (start, _, base) in zip(spans, spans[1:], strict=False):
        assert base or start >= end


def test_personal_data_contract(spark, awkward, crowded, no_documents):
    rows = [(20, "card 4111 1111 1111 1111, mail x.y@example.org"), (21, "call +1 (555) 555-0123 from 10.0.0.1"), (22, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for frame, source in ((docs, rows), (awkward, AWKWARD), (crowded, AWKWARD)):
        expected = []
        for doc_id, text, *_ in source:
            spans = base_spans(text or "")
            counts = [sum(s[0] == k for s in spans) for k in PATTERNS]
            digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
            expected.append((doc_id, *counts, digest))
        found = pii.digest(pii.personal_spans(frame))
        same(collected(found, "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256"), expected)
    assert pii.digest(pii.personal_spans(no_documents)).count() == 0


def test_label_model_learns_reliability():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    votes = np.stack([np.where(rng.random(4000) < a, truth, ~truth) for a in (0.98, 0.9, 0.6)], 1)
    patterns, counts = np.unique(np.where(votes, 1, 2), axis=0, return_counts=True)
    belief, tables = pii.label_model(patterns, counts.astype(float))
    assert tables[1, 0, 1] > tables[1, 1, 1] > tables[1, 2, 1]
    decided = {tuple(p): b > 0.5 for p, b in zip(patterns, belief, strict=True)}
    right = np.mean([decided[tuple(v)] == t for v, t in zip(np.where(votes, 1, 2), truth, strict=True)])
    assert right > 0.95


def test_redaction_replaces_spans_only(spark):
    rows = [(1, "write to a.b@example.org now", 28, "x"), (2, "nothing here", 12, "y"), (3, None, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, found string")
    same(
        collected(pii.redact(docs), "doc_id", "text", "n_chars", "found"),
        [(1, "write to [EMAIL] now", 20, "x"), (2, "nothing here", 12, "y"), (3, None, None, "z")],
    )


def test_long_secrets_are_redacted_whole(spark):
    rng = random.Random(11)
    token = lambda n: "".join(rng.choice("ABCDEFGHabcdefgh0123456789+/_") for _ in range(n))
    tokens = [token(2000 if i % 4 == 0 else 40) for i in range(40)]
    long = pii.candidates(f"token = {tokens[0]} end")
    assert [(c.start, c.end) for c in long] == [(8, 2008)]
    docs = spark.createDataFrame([(i, f"set api_key = {t} now") for i, t in enumerate(tokens)], "doc_id long, text string")
    assert {r["text"] for r in pii.redact(docs).collect()} == {"set api_key = [SECRET] now"}


# language

SAMPLES = {
    "en": "the and that with from this have which were their would there about other into",
    "fr": "les des une dans pour qui que est sur avec plus par être était aussi comme",
    "de": "der die und das nicht eine sich mit auch über werden nach schön größer",
}


def spoken(rng, lang, words):
    return " ".join(rng.choice(SAMPLES[lang].split()) for _ in range(words))


def test_language_held_out_accuracy(spark):
    rng = random.Random(2)
    rows = [(i, spoken(rng, lang, rng.randint(3, 40)), lang) for i in range(600) for lang in [rng.choice(list(SAMPLES))]]
    # wrong labels of held-out documents must not matter: they are not learned from
    rows = [(i, t, "xx" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, lang) for i, t, lang in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, truth string")
    truth = {r[0]: r[3] for r in rows}
    found = language.identify(docs).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    assert {r["lang_pred"] for r in found} <= set(SAMPLES)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held) > 100
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_of_awkward_rows(awkward, crowded, no_documents):
    for frame in (awkward, crowded):
        found = language.identify(frame).collect()
        assert len(found) == len(AWKWARD)
        by_text = {(r["doc_id"]): r for r in found}
        assert all(by_text[i]["lang_pred"] == "und" and by_text[i]["score"] == 0 for i in (2, 3, 4, 9))
        assert by_text[None]["held_out"]
        assert by_text[1]["lang_pred"] in ("en", "fr")
    assert language.identify(no_documents).count() == 0


def test_nothing_learned_is_undetermined(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert language.identify(docs).first()["lang_pred"] == "und"


def test_filter_has_no_false_negatives_and_corrects_chance():
    grams, bounds = language.trigrams(["many words of some kind", "", "ÉTÉ"])
    assert list(np.diff(bounds)) == [19, 0, 3]
    mask = np.zeros(64, np.uint8)
    for at in language.positions(grams[:19], 64):
        mask[at] |= 1
    hits = language.LanguageFilter(["a", "b"], [mask]).hits(grams, bounds)
    assert hits[0, 0] == pytest.approx(19, abs=1e-9) and hits[:, 1].sum() == 0
    chance = (np.count_nonzero(mask) / 64) ** language.HASHES
    raw = sum(all(mask[at[i]] & 1 for at in language.positions(grams, 64)) for i in range(19, 22))
    assert hits[2, 0] == pytest.approx(max(0, raw - 3 * chance) / (1 - chance))


def test_filter_grows_with_the_trigrams(spark, monkeypatch):
    monkeypatch.setattr(language, "POSITIONS", 64)
    rng = random.Random(6)
    pools = {lang: [chr(first + k) for k in range(2000)] for lang, first in (("aa", 0x4E00), ("bb", 0x6E00))}
    known = {lang: ["".join(rng.choice(pool) for _ in range(20)) for _ in range(200)] for lang, pool in pools.items()}
    docs = [(4 * i, " ".join([t] * 3), lang) for lang, texts in known.items() for i, t in enumerate(texts)]
    model = language.learn(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert all(fill <= language.FULLEST for fill in model.fills)
    for lang, texts in known.items():
        names, scores = model.predict(texts)
        assert set(names) == {lang} and min(scores) > 0.9
    with pytest.raises(ValueError, match="full"):
        language.learn(spark.createDataFrame(docs, "doc_id long, text string, lang string"), 64)
    monkeypatch.setattr(language, "MOST_BYTES", 1 << 10)
    with pytest.raises(ValueError, match="typical trigrams"):
        language.learn(spark.createDataFrame(docs, "doc_id long, text string, lang string"))


def test_more_languages_than_bits_in_a_word(spark):
    rows = [(4 * i + j, chr(0x3400 + 7 * i) * 3 + " ", f"l{i:03}") for i in range(70) for j in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(docs, 1 << 14)
    assert len(model.languages) == 70 and len(model.masks) == 2
    names, _ = model.predict([chr(0x3400 + 7 * i) * 3 for i in (0, 35, 69)])
    assert names == ["l000", "l035", "l069"]


# repeated bytes


def removed(rows, threshold):
    seen, out = collections.Counter(), []
    bodies = [(r[0], (r[1] or "").encode()) for r in rows]
    for _, body in bodies:
        seen.update(body[i : i + threshold] for i in range(len(body) - threshold + 1))
    for doc_id, body in bodies:
        gone = bytearray(len(body))
        for i in range(len(body) - threshold + 1):
            if seen[body[i : i + threshold]] > 1:
                gone[i : i + threshold] = b"\1" * threshold
        kept = bytes(b for b, g in zip(body, gone, strict=True) if not g)
        spans = sum(1 for i in range(len(body)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(body), len(body) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@pytest.mark.parametrize(("threshold", "hot"), [(2, 1 << 15), (20, 1 << 15), (20, 3), (33, 1 << 15)])
def test_repeated_bytes_equal_brute_force(spark, threshold, hot):
    rng = random.Random(threshold)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(30)]
    rows = []
    for i in range(200):
        kind = rng.random()
        if kind < 0.6:
            text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))
        elif kind < 0.8:
            text = rng.choice(["a", "ab", "abc", "é"]) * rng.randint(0, 150)
        else:
            text = (rng.choice(rows)[1] or "")[rng.randint(0, 30) :] + "x" if kind < 0.95 and rows else None
        rows.append((i, text))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    same(collected(repeated_bytes.remove_repeats(docs, threshold, hot), *COLUMNS), removed(rows, threshold))


def test_repeated_bytes_of_awkward_rows(awkward, crowded, no_documents):
    expected = removed([r for r in AWKWARD if r[0] not in (7, 8)], 40)
    for frame in (awkward, crowded):
        found = collected(repeated_bytes.remove_repeats(frame, 40), *COLUMNS)
        assert [r for r in found if r[0] not in (7, 8)] == sorted(expected, key=key)
        # of the periodic texts nothing stays but an end that occurs once
        assert sorted((r[1], r[2], r[3]) for r in found if r[0] in (7, 8)) == [(50_000, 50_000, 1), (150_003, 150_000, 1)]
    assert repeated_bytes.remove_repeats(no_documents, 40).count() == 0


def test_one_window_in_most_texts(spark):
    shared = "the same forty bytes and more in most texts of the table "
    rows = [(i, f"{i * 7919:x} {shared}{i * 104729:x}" if i % 3 else f"{i * 7919:x}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    before = {t.name for t in spark.catalog.listTables()}
    result = repeated_bytes.remove_repeats(docs, 40, 16)
    assert {t.name for t in spark.catalog.listTables()} == before  # no name of an intermediate table stays
    same(collected(result, *COLUMNS), removed(rows, 40))


def repeated_words(rows, length):
    seen, out = collections.Counter(), []
    bodies = [(r[0], re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]
    windows = [[tuple(words[i : i + length]) for i in range(len(words) - length + 1)] for _, words in bodies]
    for found in windows:
        seen.update(found)
    for (doc_id, _), found in zip(bodies, windows, strict=True):
        out.append((doc_id, len({i + k for i, w in enumerate(found) if seen[w] > 1 for k in range(length)})))
    return out


@pytest.mark.parametrize(("length", "hot"), [(2, 1 << 15), (9, 1 << 15), (9, 3), (51, 1 << 15)])
def test_repeated_words_equal_brute_force(spark, length, hot):
    rng = random.Random(length)
    words = ["".join(rng.choice("abcé\u00a0") for _ in range(rng.randint(1, 9))) for _ in range(40)]
    rows = []
    for i in range(200):
        kind = rng.random()
        if kind < 0.5:
            text = "".join(rng.choice(words) + rng.choice([" ", " ", "\n", " \t"]) for _ in range(rng.randint(0, 150)))
        elif kind < 0.7:
            text = rng.choice(["a ", "ab\n", "abc a ", "é"]) * rng.randint(0, 150)
        else:
            old = rng.choice(rows)[1] or "" if rows else ""
            text = "x " + old[rng.randint(0, 60) :].replace(" ", rng.choice([" ", "  "])) if kind < 0.9 else old or None
        rows.append((i, text))
    rows += [(rows[3][0], rows[3][1]), (None, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = repeated_bytes.remove_repeats(docs, 40, hot, passage_words=length)
    same(collected(found, "doc_id", "n_repeated_words"), repeated_words(rows, length))
    same(collected(found, *COLUMNS), removed(rows, 40))


def test_passages_of_over_fifty_words_below_the_bytes(spark, tmp_path):
    rng = random.Random(9)
    prose = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(n))
    passage, short = prose(55), prose(50)
    assert len(passage) < repeated_bytes.THRESHOLD
    rows = [(i, f"{prose(80)} {passage} {prose(70)}") for i in range(3)]
    rows += [(i, f"{prose(80)} {short} {prose(70)}") for i in range(3, 6)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = catalog.QUERIES["op4_suffix_dedup"](spark, str(tmp_path))
    # the bytes that are removed stay as they were; the passage shows in words
    assert collected(found, "doc_id", "n_removed", "n_repeated_words") == [(i, 0, 55 if i < 3 else 0) for i in range(6)]


def test_repeated_words_of_awkward_rows(awkward, crowded, no_documents):
    for frame in (awkward, crowded):
        found = collected(repeated_bytes.remove_repeats(frame, 40, passage_words=5), "doc_id", "n_repeated_words")
        same(found, repeated_words(AWKWARD, 5))
    assert repeated_bytes.remove_repeats(no_documents, 40, passage_words=5).count() == 0


def test_words_are_hashed_alike_in_any_slice(monkeypatch):
    texts = ["", "one two  three", " \t", "two", "wo", "a" * 90 + " two " + "a" * 90, "t", "three\r\none"]
    column = pa.array(texts)
    known, pieces = {}, []
    for size in (64, 70, 300):
        monkeypatch.setattr(repeated_bytes, "SLICE_BYTES", size)
        parts = list(repeated_bytes._units(*repeated_bytes.utf8(column), True))
        pieces.append(len(parts))
        for first, units, offsets in parts:
            for row in range(len(offsets) - 1):
                split = texts[first + row].split()
                mine = units[offsets[row] : offsets[row + 1]]
                assert len(mine) == len(split)
                for word, unit in zip(split, mine, strict=True):
                    assert known.setdefault((word, len(word) > size), unit) == unit
    assert pieces[0] > 1 and pieces[2] == 1 and len(set(known.values())) == len(known)


def test_long_text_in_parts(monkeypatch):
    rng = np.random.default_rng(5)
    text = rng.integers(97, 123, 5000, dtype=np.uint8)
    text[3000:3300] = text[100:400]
    monkeypatch.setattr(repeated_bytes, "SLICE_BYTES", 512)
    parts = list(repeated_bytes._segments(text, np.array([0, 5000]), 50))
    starts = sorted(int(p[3][0]) for p in parts)
    assert starts == list(range(0, starts[-1] + 1, 512 - 49)) and starts[-1] + 512 >= 5000


def test_unequal_windows_with_equal_hashes(monkeypatch):
    monkeypatch.setattr(repeated_bytes, "mix64", lambda x: x * np.uint64(0))
    data = np.frombuffer(b"abcdefabcxyz", np.uint8)
    starts = np.array([0, 6, 3, 9])
    assert repeated_bytes.repeated_windows(data, starts, np.zeros(4, np.int64), 3).tolist() == [True, True, False, False]


# tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Vocabulary(json.load(file))


def test_tokens_equal_the_library(vocabulary):
    library, rng = Tokenizer.from_file(PATH), random.Random(3)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    pools = [every, list("abcdeé  \n\t'1239!?.=-_"), list("aeinrst ='s"), list("    \u0085 \u001c\n")]
    texts = ["".join(rng.choice(rng.choice(pools)) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * n for n in range(60)] + ["=" * n for n in range(90)] + [" " * n for n in range(90)]
    tokens = [b.decode("utf-8", "ignore") for b in vocabulary.bytes.values()]
    texts += ["".join(rng.choice(tokens) for _ in range(rng.randint(1, 8))) for _ in range(5000)]
    texts += ["x<|endoftext|>  y<|endoftext|>", "<|endoftext", "՘a1՘", "it's we'll I'd 'S"]
    encoded = bpe.Encoder(vocabulary).encode(texts)
    for text, ids, known in zip(texts, encoded, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == known.ids, text
        assert bpe.decode(ids, vocabulary) == library.decode(known.ids, skip_special_tokens=False) == text


def test_long_texts_and_a_full_cache(vocabulary, monkeypatch):
    library = Tokenizer.from_file(PATH)
    monkeypatch.setattr(bpe, "SLICE_BYTES", 64)
    monkeypatch.setattr(bpe, "PIECES_AT_ONCE", 5)
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    texts = ["many words  in one\n\ntext, that is longer than a slice " * 4, "short one", "é" * 500]
    for text, ids in zip(texts, bpe.Encoder(vocabulary).encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert bpe.decode(ids, vocabulary) == text


def test_cut_out_passages_take_little_memory_at_once():
    texts = ["some words of a text that no phrase has, and more of them " * 600] * 600  # 21 MB, one batch
    batch = pa.RecordBatch.from_arrays([pa.array(range(600), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    detect = decontamination._detector([SimpleNamespace(value=[("1", b"a phrase of two")])], 10, decontamination.CUT_BYTES)
    tracemalloc.start()
    try:
        assert sum(made.num_rows for made in detect(iter([batch]))) == 600
        assert tracemalloc.get_traced_memory()[1] < 40 << 20
    finally:
        tracemalloc.stop()


def test_words_of_a_batch_are_not_all_held_at_once():
    with open(PATH, encoding="utf-8") as file:
        spec = SimpleNamespace(value=file.read())
    bpe._vocabulary(spec.value)
    texts = ["the same few words of text " * 400] * 600  # 6 MB, 1.4 million words
    batch = pa.RecordBatch.from_arrays([pa.array(range(600), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    tracemalloc.start()
    try:
        assert sum(made.num_rows for made in bpe._coder(spec)(iter([batch]))) == 600
        assert tracemalloc.get_traced_memory()[1] < 40 << 20
    finally:
        tracemalloc.stop()


def test_tokens_contract(awkward, crowded, no_documents):
    library = Tokenizer.from_file(PATH)
    expected = []
    for doc_id, text, _ in AWKWARD:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((doc_id, len(ids), bytearray(np.array(ids, "<u4").tobytes()), text or ""))
    for frame in (awkward, crowded):
        same(collected(bpe.encode_and_decode(frame, PATH), "doc_id", "n_tokens", "ids", "decoded"), expected)
    assert bpe.encode_and_decode(no_documents, PATH).count() == 0


def test_unsupported_tokenizers_are_refused():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file, pytest.raises((ValueError, KeyError)):
        bpe.Vocabulary(json.load(file))


# near-duplicates


def fingerprint(text):
    words = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(prints):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("pair_block", [64, 1])
def test_simhash_contract(spark, awkward, crowded, no_documents, pair_block):
    for frame in (awkward, crowded):
        prints = [fingerprint(r[1]) for r in AWKWARD]
        roots = linked(prints)
        least = {r: min((AWKWARD[i][0] for i in range(len(roots)) if roots[i] == r and AWKWARD[i][0] is not None), default=None) for r in roots}
        expected = [(AWKWARD[i][0], f"{prints[i]:016x}", least[roots[i]]) for i in range(len(AWKWARD))]
        found = near_duplicates.near_duplicate_groups(frame, 3, pair_block)
        same(collected(found, "doc_id", "fingerprint", "component_id"), expected)
    assert near_duplicates.near_duplicate_groups(no_documents).count() == 0


@pytest.mark.parametrize("pair_block", [64, 4, 1])
def test_fingerprint_links_connect_all_close_pairs(spark, pair_block):
    rng = random.Random(6)
    prints = [rng.getrandbits(64) for _ in range(40)]
    for _ in range(160):  # chains, and a crowd around each start
        prints.append(rng.choice(prints) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (rng.random() < 0.3) * (1 << rng.randrange(64)))
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = near_duplicates.fingerprint_links(frame, pair_block).collect()
    assert all(((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 4 for r in links)
    found = {r["node"]: r["root"] for r in near_duplicates.components(near_duplicates.fingerprint_links(frame, pair_block)).collect()}
    roots = linked(prints)
    groups = collections.defaultdict(set)
    for p, r in zip(signed, roots, strict=True):
        groups[r].add(found.get(p, p))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_pivots_discard_no_close_pair():
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    close = base ^ (np.uint64(1) << rng.integers(0, 64, 50, dtype=np.uint64)) ^ np.uint64(8)
    prints = np.concatenate((base, close))
    left, right = near_duplicates.close_pairs(prints, np.array([0]), np.array([100]), 2)
    expected = {(i, j) for i in range(100) for j in range(i + 1, 100) if int(prints[i] ^ prints[j]).bit_count() <= 2}
    assert set(zip(left.tolist(), right.tolist(), strict=True)) == expected


def shingles(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("pair_block", [64, 6])
def test_keep_one_of_similar_documents(spark, pair_block):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    rows = []
    for _ in range(25):
        own = [rng.choice(words) for _ in range(120)]
        for _ in range(rng.choice([1, 2, 3, 30])):
            copy = list(own)
            if rng.random() < 0.7:
                copy[rng.randrange(120)] = "changed" + str(rng.random())
            rows.append((len(rows), " ".join(copy)))
    rows += [(900, None), (901, ""), (902, "one two"), (903, "one two"), (904, "One  two"), (904, "One  two"), (None, "alone here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS row", "'w' AS WHOLE").repartition(4)
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if (rows[i][1] or "") == (rows[j][1] or "") or both and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    expected = sorted(((rows[r][0], rows[r][1] or "") for r in {find(i) for i in range(len(rows))}), key=key)
    groups = near_duplicates.similar_groups(docs, pair_block=pair_block)
    assert groups.select("group").distinct().count() == len(expected)
    kept = near_duplicates.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted([(r["doc_id"], r["text"] or "") for r in kept.collect()], key=key) == expected


def test_near_copies_in_a_crowd_that_shares_a_passage(spark):
    """A passage of four fifths of 200 texts crowds nearly all keys; the planted near copies among them are still found."""
    rng = random.Random(7)
    passage = [f"p{i}" for i in range(160)]
    texts = []
    for i in range(200):
        texts.append(passage + [f"t{i}w{j}" for j in range(40)])
    for i in range(0, 200, 4):
        near = list(texts[i])
        near[rng.randrange(5, 155)] = f"changed{i}"
        near[rng.randrange(165, 195)] = f"other{i}"
        texts.append(near)
    rows = [(i, " ".join(words)) for i, words in enumerate(texts)]
    groups = near_duplicates.similar_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    by_group = collections.defaultdict(set)
    for r in groups:
        by_group[r["group"]].add(r["doc_id"])
    expected = [{i, 200 + i // 4} if i % 4 == 0 else {i} for i in range(200)]
    assert sorted(map(sorted, by_group.values())) == sorted(map(sorted, expected))


@pytest.mark.parametrize("part", [3, 512])
def test_rare_blocks_bring_all_open_pairs_together(spark, part):
    rng = random.Random(3)
    common = list(range(100))
    sets = [sorted(set(common) - set(rng.sample(common, 4)) | {1000 + 10 * i + j for j in range(rng.randrange(8))}) for i in range(40)]
    sets += [sorted(set(rng.sample(range(5000, 5030), 25))) for _ in range(10)]
    frame = spark.createDataFrame([(i, 0, x) for i, x in enumerate(sets)], "node long, fp long, keys array<long>")
    roots = spark.createDataFrame([(i, 0) for i in range(30)], "node long, root long")
    blocks = collections.defaultdict(list)
    for r in near_duplicates._rare_blocks(frame, roots, 0.8, part).collect():
        blocks[r["block"], r["part"]].append(r["node"])
    met = {(i, j) for x in blocks.values() for i in x for j in x}
    similar = {(i, j) for i in range(50) for j in range(50) if len(set(sets[i]) & set(sets[j])) >= 0.8 * len(set(sets[i]) | set(sets[j]))}
    assert {(i, j) for i, j in similar if i != j and not (i < 30 and j < 30)} <= met
    assert max(map(len, blocks.values())) <= 50


def test_keep_one_of_awkward_rows(awkward, crowded, no_documents):
    for frame in (awkward, crowded):
        kept = near_duplicates.keep_one(frame)
        assert kept.columns == frame.columns
        assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "4", "6", "7", "8", "9", "None"]
    assert near_duplicates.keep_one(no_documents).count() == 0


# decontamination


def contaminated(rows, items, width=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: pattern.findall((t or "").translate(low))
    windows = collections.defaultdict(set)
    for item, text in items:
        words = split(text)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            windows[tuple(words[i : i + width])].add(str(item))
    out = []
    for row in rows:
        words, hit, found = split(row[1]), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(words[i : i + size])]
        out.append((row[0], len(words), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_contamination_equals_brute_force(spark, block_bytes):
    rng = random.Random(9)
    words = ["ab", "cd", "Ef", "gh", "é1", "x", "y"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 2, 4, 5, 9]))) for i in range(12)] + [(12, None), (3, "cd cd cd ab"), (13, "unique words here only")]
    rows = [(i, text(rng.randint(0, 60))) for i in range(150)] + [(150, None), (151, items[4][1] * 3), (151, items[4][1] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = decontamination.contamination(docs, spark.createDataFrame(items, BENCHMARK), 4, block_bytes)
    same(collected(found, "doc_id", "n_words", "n_hit", "item_ids"), contaminated(rows, items, 4))


def test_contamination_of_awkward_rows(spark, awkward, crowded, no_documents):
    items = [(1, "cat sat on the mat"), (2, "word word word word word word word word word word word"), (3, None)]
    benchmark = spark.createDataFrame(items, BENCHMARK)
    for frame in (awkward, crowded):
        found = decontamination.contamination(frame, benchmark)
        same(collected(found, "doc_id", "n_words", "n_hit", "item_ids"), contaminated(AWKWARD, items))
        assert decontamination.decontaminate(frame, benchmark).columns == frame.columns
    assert decontamination.contamination(no_documents, benchmark).count() == 0
    clean = decontamination.contamination(awkward, benchmark.filter("false"))
    assert clean.filter("n_hit > 0").count() == 0 and clean.count() == len(AWKWARD)


def test_spans_are_cut_out(spark):
    rows = [(1, "Before. The Cat-sat on THE mat! after", 37), (2, "clean text", 10), (3, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    benchmark = spark.createDataFrame([(1, "cat sat on the mat")], BENCHMARK)
    cut = decontamination.decontaminate(docs, benchmark)
    same(collected(cut, "doc_id", "text", "n_chars"), [(1, "Before. The \n! after", 20), (2, "clean text", 10), (3, None, None)])


def test_index_finds_all_occurrences():
    rng = np.random.default_rng(10)
    text = rng.integers(1, 4, 500)
    index = decontamination.FMIndex(text)
    for size in (1, 3, 7):
        words = np.stack([text[i : i + size] for i in range(0, 40)])
        low, high = index.search(words, np.full(40, size))
        for w, a, b in zip(words, low, high, strict=True):
            expected = [i for i in range(500 - size + 1) if (text[i : i + size] == w).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == expected


# sharding


def check_shards(found, rows, shards):
    counts = collections.Counter(r["shard"] for r in found)
    assert len(found) == len(rows)
    assert max(counts[s] for s in range(shards)) - min(counts[s] for s in range(shards)) <= 1
    for s in range(shards):
        assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(counts[s]))
    expected = [(r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows]
    same([(r["doc_id"], r["size"], r["text_crc32"]) for r in found], expected)


def test_shards_keep_equal_texts_together(spark):
    rows = [(i, f"text {i // 3}" if i < 300 else f"single {i}") for i in range(1000)]
    found = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 8).collect()
    check_shards(found, rows, 8)
    texts = dict(rows)
    homes = collections.defaultdict(set)
    for r in found:
        homes[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())


def test_a_group_larger_than_a_shard_fills_few(spark):
    rows = [(i, "hot" if i < 500 else f"t{i}") for i in range(1000)]
    found = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string"), 8).collect()
    check_shards(found, rows, 8)
    hot = collections.Counter(r["shard"] for r in found if r["doc_id"] < 500)
    cut = 1 - sum((n / 500) ** 2 for n in hot.values())
    assert cut < 0.8  # spread evenly over eight shards it would be 0.875


def test_shards_of_awkward_rows(awkward, crowded, no_documents):
    for frame in (awkward, crowded):
        found = sharding.shard_documents(frame, 4).collect()
        check_shards(found, AWKWARD, 4)
        assert {r["law"] for r in found} == {"rows"} and {r["grown_shard"] for r in found} == {None}
    assert sharding.shard_documents(no_documents).count() == 0


def test_nodes_in_several_groups(spark):
    links = [(i, f"g{(i // 10)}") for i in range(200)] + [(i, f"h{(i % 10)}") for i in range(0, 20)]
    labels = sharding.balanced_labels(spark.createDataFrame(links, "node long, group string"), [55, 55, 55, 55]).collect()
    assert len(labels) == 200 and max(collections.Counter(r["label"] for r in labels).values()) <= 55


def test_shards_of_a_table_in_which_all_is_linked(spark):
    rng = random.Random(4)
    rows = [(i, f"text {i}") for i in range(900) for _ in range(rng.choice([2, 3]))] + [(2000 + i, "one large group") for i in range(600)]
    found = sharding.shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 8).collect()
    sizes = collections.Counter(r["shard"] for r in found)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    shards = collections.defaultdict(set)
    for r in found:
        shards[r["doc_id"] if r["doc_id"] < 2000 else "large"].add(r["shard"])
    assert sum(len(x) > 1 for k, x in shards.items() if k != "large") <= 8
    assert len(shards["large"]) <= 4


def test_full_shards_exchange_members(spark, monkeypatch):
    """All shards start full and every group starts scattered."""

    def scattered(nodes, shards):
        ranked = sharding._ranked(nodes, "node", 240)
        return ranked.select("node", "lead", (sharding.F.col("rank") % shards).cast("int").alias("label"))

    monkeypatch.setattr(sharding, "_seeded", scattered)
    links = [(2 * i + j, f"g{i}") for i in range(120) for j in range(2)]
    labels = sharding.balanced_labels(spark.createDataFrame(links, "node long, group string"), [60] * 4).collect()
    assert collections.Counter(r["label"] for r in labels) == {0: 60, 1: 60, 2: 60, 3: 60}
    shard = {r["node"]: r["label"] for r in labels}
    assert sum(shard[2 * i] == shard[2 * i + 1] for i in range(120)) >= 110


def test_admitted_movers_count_leavers():
    assert sharding.admitted([[0, 5], [3, 0]], [0, 0]) == [[0, 3], [3, 0]]
    assert sharding.admitted([[0, 4, 0], [0, 0, 4], [4, 0, 0]], [0, 0, 0]) == [[0, 4, 0], [0, 0, 4], [4, 0, 0]]
    assert sharding.admitted([[0, 4, 0], [0, 0, 9], [0, 0, 0]], [0, 0, 2]) == [[0, 2, 0], [0, 0, 2], [0, 0, 0]]
    rng = random.Random(5)
    for _ in range(200):
        wanted = [[rng.randrange(9) * (i != j) for j in range(5)] for i in range(5)]
        room = [rng.randrange(4) for _ in range(5)]
        found = sharding.admitted(wanted, room)
        assert all(0 <= found[i][j] <= wanted[i][j] for i in range(5) for j in range(5))
        assert all(sum(found[i][j] for i in range(5)) - sum(found[j]) <= room[j] for j in range(5))


def test_sharding_runs_no_python(awkward, capsys):
    sharding.shard_documents(awkward).explain()
    assert "Python" not in capsys.readouterr().out


def test_every_operator_is_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in catalog.QUERIES)
    assert numbers == list(range(1, 11))
    assert catalog.ORACLE_SQL.keys() <= catalog.QUERIES.keys()
