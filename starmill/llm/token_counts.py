"""Token counts by heap-and-linked-list byte-pair merging, without making identifiers.

A text is cut at special strings, normalised and split into words as the vocabulary file says. A word
starts as one symbol per byte in a doubly linked list; the adjacent pair of the lowest rank (leftmost
on ties) is popped from a heap and merged until no pair has a rank. Every merge takes one symbol away,
so the count is the initial symbols minus the merges, and a special string is one token. Distinct words
are counted once; a task's table of at most ``WORDS`` words then starts anew.

The map is narrow. Texts above ``PIECE`` characters are cut at spaces, where no word, normalisation or
special string reaches across.

Unicode tables differ between libraries' versions, so only texts below ``SETTLED``, whose classes no
version changes, are lower-cased and split by Python; others go through the vocabulary's own normaliser
and splitter.

Defined results: null counts as empty, with no bytes and no tokens. Null ids and repeated rows pass
through. There are no ties: a row's counts depend on its text alone. Empty tables give empty results.
Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer
from tokenizers.pre_tokenizers import Split

from starmill.llm.common import named, text_batches
from starmill.llm.packing import byte_letters

LIMIT = 2048
ROWS = 256
WORDS = 200_000
PIECE = 1 << 20
SETTLED = "ԯ"


class _Known(dict):
    """Words with their counts; starts anew when it is full."""

    def __init__(self, count: Callable[[bytes], int]) -> None:
        super().__init__()
        self.count = count

    def __missing__(self, word: str) -> int:
        if len(self) >= WORDS:
            self.clear()
        self[word] = found = self.count(word.encode())
        return found


class Counter:
    """Counts tokens as the library does for a word-end BPE file with a byte-level alphabet."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, letters = data["model"], byte_letters()
        vocabulary, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.inner, self.final = [0] * 256, [0] * 256
        for letter, byte in letters.items():
            self.inner[byte] = vocabulary[letter]
            self.final[byte] = vocabulary[letter + suffix]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges[vocabulary[left], vocabulary[right]] = rank, vocabulary[left + right]
        special = sorted((t["content"] for t in data["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        pattern = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        self.split = Split(Regex(pattern), behavior="removed", invert=True)
        plain = {r"\p{L}": "a-z", r"\p{N}": "0-9", r"\s": r"\t-\r "}
        for wide, narrow in plain.items():
            pattern = pattern.replace(wide, narrow)
        self.plain_words = re.compile(pattern)
        self.normalizer = Tokenizer.from_file(path).normalizer
        self.unsettled = re.compile(f"[^\\x00-{SETTLED}]")
        self.known = _Known(self.merged)

    def merged(self, word: bytes) -> int:
        """Symbols that are left of one word: its bytes minus its merges."""
        left = len(word)
        symbol = [self.inner[b] for b in word[:-1]] + [self.final[word[-1]]]
        after = [*range(1, left), -1]
        before = list(range(-1, left - 1))
        merges, heap = self.merges, []
        for i in range(left - 1):
            found = merges.get((symbol[i], symbol[i + 1]))
            if found:
                heap.append((found[0], i, symbol[i], symbol[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, first, second, whole = heapq.heappop(heap)
            j = after[i]
            if symbol[i] != first or j < 0 or symbol[j] != second:
                continue  # one of the two has been merged since
            symbol[i], symbol[j], after[i] = whole, -1, after[j]
            left -= 1
            if after[i] >= 0:
                before[after[i]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else -1
                found = merges.get((symbol[a], symbol[b])) if b >= 0 else None
                if found:
                    heapq.heappush(heap, (found[0], a, symbol[a], symbol[b], found[1]))
        return left

    def _words(self, text: str) -> Iterable[str]:
        """The words of a piece of text that holds no special string."""
        if text.isascii():
            return self.plain_words.findall(text.lower())
        if not self.unsettled.search(text):
            text = unicodedata.normalize("NFC", text)
        # Python lower-cases a sigma by its neighbours, the vocabulary's normaliser does not.
        if "Σ" not in text and not self.unsettled.search(text):
            return self.words.findall(text.lower())
        normal = self.normalizer.normalize_str(text)
        return (word for word, _ in self.split.pre_tokenize_str(normal))

    def _count(self, text: str) -> int:
        return sum(map(self.known.__getitem__, self._words(text)))

    def count(self, text: str) -> int:
        """The text's number of tokens, special strings included."""
        total = 0
        for piece in _cut(text):
            at = 0
            for found in self.special.finditer(piece) if self.special else ():
                total += self._count(piece[at:found.start()]) + 1
                at = found.end()
            total += self._count(piece[at:] if at else piece)
        return total


def _cut(text: str) -> Iterator[str]:
    """The text in pieces of at least ``PIECE`` characters, each but the first from a space on."""
    start = 0
    while (end := text.find(" ", start + PIECE)) >= 0:
        yield text[start:end]
        start = end
    yield text[start:] if start else text


def token_counts(
    documents: DataFrame, path: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every document.

    ``path`` is a vocabulary file that every machine has.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch, texts in text_batches(batches, rows=ROWS):
            counts = [counter.count(t) for t in texts]
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), sizes.cast(pa.int64()), pa.array(counts, pa.int64()),
                 pa.array([n > limit for n in counts], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = documents.select(
        named(documents, doc_id).cast("long").alias("doc_id"), named(documents, text).alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
