"""BPE encoding and decoding with a public byte-level vocabulary, in batched numpy merge rounds.

A text is cut into words by the vocabulary's pattern. The distinct words of a batch that the task has
not met lie, as byte symbols, in one flat array. Each round looks up the ranks of changed neighbour
pairs by binary search over the sorted pair keys, finds every word's lowest rank, merges all of its
occurrences from the left, and takes finished words out. Merging a rank everywhere at once is what
merging one pair after the other gives, since a pair that holds a merged symbol ranks after the
merge that made it. Words above ``LONG`` bytes would need many rounds for few symbols; they go one
by one through a heap of pairs, with the same result.

The map is narrow. Per task it keeps a table of at most ``WORDS`` known words, then starts anew; texts
above ``PIECE`` characters are encoded a span of words at a time.

Defined results: null counts as empty; an empty text has no ids and decodes to an empty text. Special
tokens' strings in a text become their ids, as in the library that the vocabulary file is for. Null
ids and repeated rows pass through. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from starmill.llm.common import named, text_batches
from starmill.llm.packing import PATTERN, byte_letters

ROWS = 256
WORDS = 400_000
LONG = 400
PIECE = 1 << 20
SPAN = 200_000
NONE = np.int64(1 << 40)


class _Numbers(dict):
    """Words with their numbers; a new word gets the next one and is noted in ``fresh``."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str | tuple[str]] = []

    def __missing__(self, word: str | tuple[str]) -> int:
        self[word] = number = len(self)
        self.fresh.append(word)
        return number


class Codec:
    """Encoder and decoder for one vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, letters = data["model"], byte_letters()
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        vocabulary = {t: i for t, i in model["vocab"].items() if t not in self.special}
        self.token = [b""] * (max([*vocabulary.values(), *self.special.values()]) + 1)
        for token, number in vocabulary.items():
            self.token[number] = bytes(letters[c] for c in token)
        for token, number in self.special.items():
            self.token[number] = token.encode()
        self.byte = np.zeros(256, dtype=np.int64)
        for letter, value in letters.items():
            self.byte[value] = vocabulary[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in merges], dtype=np.int64)
        self.rank = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank]
        self.merged = np.array([vocabulary[a + b] for a, b in merges], dtype=np.int64)
        self.words = regex.compile(PATTERN)
        names = sorted(self.special, key=len, reverse=True)
        self.split = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self._forget()

    def _forget(self) -> None:
        self.numbers = _Numbers()
        self.ids = np.zeros(0, dtype=np.int32)
        self.size = np.zeros(0, dtype=np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of symbol pairs, by binary search; NONE where there is no merge."""
        wanted = left << 32 | right
        place = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[place] == wanted, self.rank[place], NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All words' ids in one array, and each word's number of ids."""
        length = np.array([len(w) for w in words], dtype=np.int64)
        word = np.repeat(np.arange(len(words)), length)
        symbol = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        last = np.zeros(len(symbol), dtype=bool)
        last[np.cumsum(length) - 1] = True
        rank = np.full(len(symbol), NONE)
        inner = np.flatnonzero(~last)
        rank[inner] = self.ranks(symbol[inner], symbol[inner + 1])
        done_word, done_symbol = [], []
        while len(symbol):
            ends = np.flatnonzero(last)
            starts = np.concatenate(([0], ends[:-1] + 1))
            lowest = np.repeat(np.minimum.reduceat(rank, starts), ends - starts + 1)
            open_ = lowest < NONE
            if not open_.all():
                done_word.append(word[~open_])
                done_symbol.append(symbol[~open_])
                word, symbol, last, rank, lowest = (
                    x[open_] for x in (word, symbol, last, rank, lowest)
                )
                if not len(symbol):
                    break
            hits = np.flatnonzero(rank == lowest)
            # Of overlapping hits (a run of one symbol) every second one counts.
            first = np.concatenate(([True], np.diff(hits) != 1))
            within = np.arange(len(hits)) - np.maximum.accumulate(
                np.where(first, np.arange(len(hits)), 0)
            )
            hits = hits[within % 2 == 0]
            symbol[hits] = self.merged[rank[hits]]
            last[hits] = last[hits + 1]
            keep = np.ones(len(symbol), dtype=bool)
            keep[hits + 1] = False
            moved = hits - np.arange(len(hits))
            word, symbol, last, rank = word[keep], symbol[keep], last[keep], rank[keep]
            rank[moved[last[moved]]] = NONE
            before = moved[moved > 0] - 1
            stale = np.unique(np.concatenate((moved[~last[moved]], before[~last[before]])))
            rank[stale] = self.ranks(symbol[stale], symbol[stale + 1])
        if not done_word:
            return np.zeros(0, np.int64), np.zeros(len(words), np.int64)
        word, symbol = np.concatenate(done_word), np.concatenate(done_symbol)
        order = np.argsort(word, kind="stable")
        return symbol[order], np.bincount(word, minlength=len(words))

    def merge_long(self, word: bytes) -> np.ndarray:
        """One long word's ids, by a heap of (rank, place)."""
        symbol = self.byte[np.frombuffer(word, np.uint8)].tolist()
        after = [*range(1, len(symbol)), -1]
        before = list(range(-1, len(symbol) - 1))
        first = self.ranks(np.array(symbol[:-1]), np.array(symbol[1:])).tolist()
        heap = [(r, i, symbol[i], symbol[i + 1]) for i, r in enumerate(first) if r < NONE]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}

        def push(i: int) -> None:
            pair = (symbol[i], symbol[after[i]])
            if pair not in known:
                known[pair] = int(self.ranks(np.array(pair[:1]), np.array(pair[1:]))[0])
            if known[pair] < NONE:
                heapq.heappush(heap, (known[pair], i, *pair))

        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != left or j < 0 or symbol[j] != right:
                continue  # one of the two has been merged since
            symbol[i], symbol[j], after[i] = int(self.merged[rank]), -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
                push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([s for s in symbol if s >= 0], dtype=np.int64)

    def _learn(self) -> None:
        """Encode the words that are new in this batch and add them to the table."""
        fresh, self.numbers.fresh = self.numbers.fresh, []
        raw = [b"" if isinstance(w, tuple) else w.encode() for w in fresh]
        short = [i for i, r in enumerate(raw) if 0 < len(r) <= LONG]
        ids, size = self.merge([raw[i] for i in short])
        if len(short) < len(fresh):
            found = dict(zip(short, np.split(ids, np.cumsum(size)[:-1]))) if short else {}
            for i, word in enumerate(fresh):
                if isinstance(word, tuple):
                    found[i] = np.array([self.special[word[0]]])
                elif i not in found:
                    found[i] = self.merge_long(raw[i])
            ids = np.concatenate([found[i] for i in range(len(fresh))])
            size = np.array([len(found[i]) for i in range(len(fresh))])
        self.ids = np.concatenate((self.ids, ids.astype(np.int32)))
        self.size = np.concatenate((self.size, size.astype(np.int64)))

    def _pieces(self, text: str) -> Iterable[str | tuple[str]]:
        """The text's words; special tokens as tuples."""
        if self.split is None or not any(name in text for name in self.special):
            return self.words.findall(text) if len(text) <= PIECE else (
                m.group() for m in self.words.finditer(text)
            )
        return chain.from_iterable(
            ((part,),) if part in self.special else self.words.findall(part)
            for part in self.split.split(text)
        )

    def _ids(self, words: list[str | tuple[str]]) -> tuple[np.ndarray, np.ndarray]:
        """The words' ids in one array, and where each word's ids end."""
        if len(self.numbers) > WORDS:
            self._forget()
        number = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        if self.numbers.fresh:
            self._learn()
        start = np.cumsum(self.size) - self.size
        size = self.size[number]
        ends = np.cumsum(size)
        shift = np.repeat(start[number] - (ends - size), size)
        return self.ids[shift + np.arange(len(shift))], ends

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text."""
        found: list[np.ndarray | None] = [None] * len(texts)
        words, counts, members = [], [], []
        for i, text in enumerate(texts):
            pieces = self._pieces(text)
            if len(text) > PIECE:
                pieces, spans = iter(pieces), []
                while span := list(islice(pieces, SPAN)):
                    spans.append(self._ids(span)[0])
                found[i] = np.concatenate(spans)
                continue
            before = len(words)
            words.extend(pieces)
            counts.append(len(words) - before)
            members.append(i)
        ids, ends = self._ids(words)
        bounds = np.concatenate(([0], ends))[np.cumsum(counts)] if counts else np.zeros(0, int)
        for i, part in zip(members, np.split(ids, bounds[:-1])):
            found[i] = part
        return found

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.token.__getitem__, ids)).decode("utf-8", errors="replace")


def _batches(path: str, names: list[str], made):
    """A task function: ``made(codec, texts)`` gives the columns after doc_id."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch, texts in text_batches(batches, rows=ROWS):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *made(codec, texts)], ["doc_id", *names]
            )

    return run


def _rows(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    return documents.select(
        named(documents, doc_id).cast("long").alias("doc_id"), named(documents, text).alias("text")
    )


def encode(documents: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the text's ids."""

    def made(codec: Codec, texts: list[str]) -> list[pa.Array]:
        return [pa.array([x.tolist() for x in codec.encode(texts)], pa.list_(pa.int32()))]

    return _rows(documents, doc_id, text).mapInArrow(
        _batches(path, ["ids"], made), "doc_id long, ids array<int>"
    )


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text that ``ids`` stand for; null ids count as none."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(path)
        for batch in batches:
            texts = [codec.decode(x or ()) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(documents: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document the number of ids, and digests of the ids and of the text decoded from them."""

    def made(codec: Codec, texts: list[str]) -> list[pa.Array]:
        decimal, rows = list(map(str, range(len(codec.token)))), []
        for found in codec.encode(texts):
            ids = found.tolist()
            listed = ",".join(map(decimal.__getitem__, ids))
            rows.append((
                len(ids),
                hashlib.sha256(listed.encode()).hexdigest(),
                hashlib.sha256(codec.decode(ids).encode()).hexdigest(),
            ))
        kinds = (pa.int64(), pa.string(), pa.string())
        return [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]

    return _rows(documents, doc_id, text).mapInArrow(
        _batches(path, ["n_tokens", "ids_sha256", "decoded_sha256"], made),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
