"""Byte-level BPE encoding and decoding by a depth-first walk over the trie of distinct words.

The encoding of a prefix is fixed by its last token: the one candidate that ends there, is itself what BPE makes of its
bytes, and keeps a boundary to the last token of the prefix before it. So a walk over the trie of the distinct words
carries one last token for each depth; a prefix that many words share is computed once, and a word's tokens are read
off backwards. Visiting the words in sorted order is that walk, and the trie never has to be stored.

Each task handles its own words; nothing is shuffled, and the vocabulary travels to the tasks as the parsed file.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from slotledger.llm.common import id_and_text, slices, utf8

SLICE_BYTES = 1 << 20  # of text at once: split into words it takes about fifteen times that, and workers keep what they once took
CACHED_WORDS = 1 << 19
PIECES_AT_ONCE = 1 << 18

def _split(letter: str, number: str, space: str, not_space: str, other: str) -> str:
    # Fixed value: the pattern that splits text before merging.
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?{other}+|{space}+(?!{not_space})|{space}+"


_GENERAL = regex.compile(_split(r"\p{L}", r"\p{N}", r"\s", r"\S", r"[^\s\p{L}\p{N}]"))
_NEAR = 0x250  # texts below this code point take the same pattern with plain character sets, which is faster
_BEYOND = re.compile(f"[^\0-{chr(_NEAR - 1)}]")


@lru_cache
def _near_pattern() -> re.Pattern:
    chars = [chr(c) for c in range(_NEAR)]
    letters, numbers, spaces = (re.escape("".join(c for c in chars if regex.match(p, c))) for p in (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(_split(f"[{letters}]", f"[{numbers}]", f"[{spaces}]", f"[^{spaces}]", f"[^{spaces}{letters}{numbers}]"))


@lru_cache
def _later_letters() -> tuple[re.Pattern, regex.Pattern] | None:
    """Letters and digits that the pattern library knows but Python's older character data, like the tokenizer's, does not.

    A pattern that finds them, and the split pattern that takes them for neither letters nor digits.
    """
    known = regex.findall(r"[\p{L}\p{N}]", "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000))
    later = [ord(c) for c in known if unicodedata.category(c) == "Cn"]
    if not later:
        return None
    points = np.array(later)
    cuts = np.flatnonzero(np.diff(points) != 1) + 1
    ranges = "".join(f"\\U{int(r[0]):08x}-\\U{int(r[-1]):08x}" for r in np.split(points, cuts))
    letter, number = (f"(?:(?![{ranges}])\\p{{{kind}}})" for kind in "LN")
    other = f"(?:[{ranges}]|[^\\s\\p{{L}}\\p{{N}}])"
    return re.compile(f"[{ranges}]"), regex.compile(_split(letter, number, r"\s", r"\S", other))


def split_pattern(text: str) -> re.Pattern | regex.Pattern:
    if text.isascii() or not _BEYOND.search(text):
        return _near_pattern()
    later = _later_letters()
    return later[1] if later and later[0].search(text) else _GENERAL


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in vocabulary files: printable ones themselves, the others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tokens as bytes, merge ranks, and the tests on pairs of tokens that the walk needs."""

    def __init__(self, spec: dict):
        model, letters = spec["model"], byte_letters()
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError("only byte-level BPE without an added leading space is supported")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must stand for exactly their own text")
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_pattern = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.bytes = {i: bytes(letters[c] for c in token) for token, i in model["vocab"].items() if token not in self.added}
        self.ids = {b: i for i, b in self.bytes.items()}
        self.bytes |= {i: content.encode() for content, i in self.added.items()}
        self.size = {i: len(b) for i, b in self.bytes.items()}
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = (model["vocab"][x] for x in (merge if isinstance(merge, list) else merge.split(" ")))
            made = self.ids[self.bytes[left] + self.bytes[right]]
            if made in self.rank:
                raise ValueError("a token must be made by one merge only")
            self.pair_rank[left, right] = self.rank[made] = rank
            self.parts[made] = left, right
        # every end of a token, with the token if it is a whole one that BPE makes of its own bytes
        self.ends: dict[bytes, int] = {}
        for i in sorted(self.ids.values(), key=self.size.__getitem__):
            body = self.bytes[i]
            for k in range(1, len(body)):
                self.ends.setdefault(body[k:], -1)
            self.ends[body] = i if self._whole(i) else self.ends.get(body, -1)
        self.apart: dict[int, bool] = {}
        # states of the walk: the longest end of the path that begins some token, and the whole tokens that end there
        self.begins = {b[:k] for b in self.ids for k in range(len(b) + 1)}
        self.states: list[bytes] = [b""]
        self.number = {b"": 0}
        self.ending: list[list[tuple[int, int]]] = [[]]
        self.moves: dict[int, int] = {}

    def _move(self, state: int, byte: int) -> int:
        """The state after one more byte, longest tokens first; remembered, as there are only so many."""
        end = self.states[state] + bytes([byte])
        while end not in self.begins:
            end = end[1:]
        if end not in self.number:
            self.number[end] = len(self.states)
            self.states.append(end)
            tokens = (self.ends.get(end[k:], -1) for k in range(len(end)))
            self.ending.append([(self.size[t], t) for t in tokens if t >= 0])
        self.moves[state << 8 | byte] = self.number[end]
        return self.number[end]

    def _boundary(self, left: int, right: int, joined: bool) -> bool:
        """Whether no merge crosses the boundary while both sides are made; ``joined``: nor afterwards.

        The sides' merges are undone, latest first. A crossing pair merges if its rank is lower than that of the merge
        undone last; at equal rank the leftmost goes first, which is the left side's own, or else the crossing one.
        """
        bound = len(self.pair_rank) if joined else -1
        while True:
            crossing = self.pair_rank.get((left, right))
            if crossing is not None and crossing < bound:
                return False
            left_rank, right_rank = self.rank.get(left, -1), self.rank.get(right, -1)
            if left_rank > right_rank:
                bound, left = left_rank, self.parts[left][1]
            elif right_rank >= 0:
                bound, right = right_rank + 1, self.parts[right][0]
            else:
                return True

    def _whole(self, token: int) -> bool:
        if token not in self.parts:
            return True
        left, right = self.parts[token]
        made = self.ends.get(self.bytes[left]) == left and self.ends.get(self.bytes[right]) == right
        return made and self._boundary(left, right, joined=False)

    def keeps_apart(self, left: int, right: int) -> bool:
        if len(self.apart) > 1 << 20:
            self.apart.clear()
        answer = self.apart[left << 32 | right] = self._boundary(left, right, joined=True)
        return answer

    def encode_words(self, words: Iterable[bytes]) -> Iterator[tuple[bytes, list[int]]]:
        """Each distinct word with its tokens, in sorted order: a depth-first walk over their trie."""
        size, apart, moves, ending = self.size, self.apart, self.moves, self.ending
        last, states = [-1], [0]  # the last token and the state at each depth of the current path
        before = b""
        for word in sorted(words):
            depth, most = 0, min(len(before), len(word))
            if word.startswith(before):
                depth = most
            else:
                while depth < most and before[depth] == word[depth]:
                    depth += 1
            del last[depth + 1 :], states[depth + 1 :]
            state = states[depth]
            for end in range(depth, len(word)):
                key = state << 8 | word[end]
                state = moves[key] if key in moves else self._move(state, word[end])
                for length, token in ending[state]:
                    previous = last[end + 1 - length]
                    if previous < 0:
                        break
                    known = apart.get(previous << 32 | token)
                    if known or (known is None and self.keeps_apart(previous, token)):
                        break
                last.append(token)
                states.append(state)
            tokens, end = [], len(word)
            while end > 0:
                tokens.append(last[end])
                end -= size[last[end]]
            tokens.reverse()
            yield word, tokens
            before = word


class Encoder:
    """Encodes texts; words already met by this task are looked up."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        """Encode the words that are new."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        new = {w.encode(): w for w in words if w not in self.known}
        for word, tokens in self.vocabulary.encode_words(new):
            self.known[new[word]] = struct.pack(f"<{len(tokens)}I", *tokens)

    def _long(self, text: str) -> bytes:
        matches, out = split_pattern(text).finditer(text), []
        while pieces := [m[0] for m in islice(matches, PIECES_AT_ONCE)]:
            self.learn(set(pieces))
            out.append(b"".join(map(self.known.__getitem__, pieces)))
        return b"".join(out)

    def _parts(self, text: str) -> Iterator[str | int]:
        """The text between added tokens, and those tokens."""
        at = 0
        for match in self.vocabulary.added_pattern.finditer(text) if self.vocabulary.added_pattern else ():
            yield text[at : match.start()]
            yield self.vocabulary.added[match[0]]
            at = match.end()
        yield text[at:] if at else text

    def encode(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text as little-endian unsigned 32-bit integers; the text of an added token is that token.

        The new words of all these texts are walked over together, so that they share prefixes; a very long text is
        split and encoded in steps.
        """
        split: list[list[list[str] | bytes]] = []
        for text in texts:
            parts: list[list[str] | bytes] = []
            for part in self._parts(text):
                if isinstance(part, int):
                    parts.append(struct.pack("<I", part))
                else:
                    parts.append(split_pattern(part).findall(part) if len(part) < SLICE_BYTES else self._long(part))
            split.append(parts)
        words: set[str] = set()
        for parts in split:
            for part in parts:
                if not isinstance(part, bytes):
                    words.update(part)
        self.learn(words)
        known = self.known.__getitem__
        return [b"".join(p if isinstance(p, bytes) else b"".join(map(known, p)) for p in parts) for parts in split]


def decode(ids: bytes, vocabulary: Vocabulary) -> str:
    """The tokens' bytes in a row, as text."""
    numbers = np.frombuffer(ids, "<u4")
    table = vocabulary.bytes.__getitem__
    step = PIECES_AT_ONCE
    parts = [b"".join(map(table, numbers[i : i + step].tolist())) for i in range(0, len(numbers), step)]
    return b"".join(parts).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _vocabulary(text: str) -> Vocabulary:
    return Vocabulary(json.loads(text))


def _coder(spec) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(_vocabulary(spec.value))
        for batch in batches:
            offsets = utf8(batch.column(1))[1]
            for first, last in slices(offsets, SLICE_BYTES):
                texts = batch.column(1).slice(first, last - first).to_pylist()
                ids = encoder.encode(texts)
                decoded = [decode(x, encoder.vocabulary) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                        pa.array(decoded, pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids", "decoded"],
                )

    return run


def encode_and_decode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Token ids of every whole text and the text that they decode to: doc_id, n_tokens, ids (binary), decoded.

    ``tokenizer_path`` is a tokenizer file on the driver; it is read there and sent to the tasks. One row per document;
    null and empty texts have no tokens; repeated documents are encoded one by one; further columns are not read.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    return id_and_text(docs).mapInArrow(_coder(spec), "doc_id long, n_tokens long, ids binary, decoded string")
