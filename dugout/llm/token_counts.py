"""Token counts with a whole-token shortcut.

A byte-level vocabulary is read on the driver. For every string of it the merges are run once; those that end in one
token are proven whole: a pre-token that equals one of them counts 1 without any merging. Only other pre-tokens are merged, in
time n log n of their bytes, and short ones are remembered by the task. The proof is as large as the vocabulary, a bound
that doesn't grow with the documents, and goes out with the tasks. Counting is one narrow pass: no shuffle.

Pre-tokens are split as the tokenizers library does. The pattern's classes of letters and numbers come from a Unicode
version, and those of the two pattern engines differ in code points that are assigned in neither, or lately; a text that
holds a code point which Python's own, older tables do not know is split by the library's pre-tokenizer instead.

Edge cases: a null or empty text has no bytes and no tokens. Every input row gives one row, repeated ones too; a null id stays
null. Whole texts are read, however long. Columns beyond the named ones aren't read.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import plain, slices, table

VOCABULARY = "byte_bpe_50k.json"
#: How the vocabulary's library splits texts before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LIMIT = 1024
#: Merged pre-tokens that a task remembers at most, and the longest of them; longer ones are merged by a heap.
REMEMBERED, SHORT = 1 << 18, 64


def byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in byte-level vocabularies: printable ones for themselves, the others from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def merged(word: bytes, ranks: dict[tuple[int, int], int], made: list[int]) -> int:
    """How many tokens the merges leave of a pre-token: the best-ranked pair first, of equal ones the leftmost.

    Tokens are numbers, bytes their own; ranks: pair of tokens to the merge's rank, made: rank to the token it makes.
    """
    parts, get, none = list(word), ranks.get, len(made)
    if len(parts) > SHORT:
        return _merged_long(parts, ranks, made)
    found = [get(p, none) for p in zip(parts, parts[1:])]
    while found and (best := min(found)) < none:
        i = found.index(best)
        parts[i : i + 2] = [made[best]]
        del found[i]
        if i:
            found[i - 1] = get((parts[i - 1], parts[i]), none)
        if i < len(found):
            found[i] = get((parts[i], parts[i + 1]), none)
    return len(parts)


def _merged_long(parts: list[int], ranks: dict[tuple[int, int], int], made: list[int]) -> int:
    """The same by a heap, in time n log n."""
    n, gone = len(parts), -1
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i, p in enumerate(zip(parts, parts[1:])) if (r := ranks.get(p)) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if parts[i] == gone or j >= n or ranks.get((parts[i], parts[j])) != rank:
            continue  # one of them has been merged meanwhile
        parts[i], parts[j], left = made[rank], gone, left - 1
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        for x, y in ((before[i], i), (i, after[i])):
            if x >= 0 and y < n and (r := ranks.get((parts[x], parts[y]))) is not None:
                heapq.heappush(heap, (r, x))
    return left


@dataclass(frozen=True)
class Vocabulary:
    """The merges, as merged() takes them; whole: strings that are one token; special: strings that are one in any text."""

    ranks: dict[tuple[int, int], int]
    made: list[int]
    whole: frozenset[str]
    special: tuple[str, ...]


def vocabulary(path: str) -> Vocabulary:
    """A byte-level vocabulary file, with the proof of its whole strings."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    signs = byte_signs()
    raw = lambda token: bytes(signs[c] for c in token)
    numbers: dict[bytes, int] = {bytes([b]): b for b in range(256)}
    ranks, made = {}, []
    for pair in found["model"]["merges"]:
        a, b = map(raw, pair.split(" ") if isinstance(pair, str) else pair)
        made.append(numbers.setdefault(a + b, len(numbers)))
        ranks[numbers[a], numbers[b]] = len(made) - 1
    whole = set()
    for token in found["model"]["vocab"]:
        try:
            text = (word := raw(token)).decode()
        except UnicodeDecodeError:  # a part of a sign is no pre-token
            continue
        if merged(word, ranks, made) == 1:
            whole.add(text)
    return Vocabulary(ranks, made, frozenset(whole), tuple(sorted((t["content"] for t in found["added_tokens"]), key=len, reverse=True)))


class _Counts(dict):
    """Pre-token to its number of tokens: 1 where that is proven, else by merging."""

    def __init__(self, known: Vocabulary):
        super().__init__()
        self.known = known
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.update(dict.fromkeys(self.known.whole, 1))

    def __missing__(self, word: str) -> int:
        n = merged(word.encode(), self.known.ranks, self.known.made)
        if len(word) <= SHORT:
            if len(self) >= len(self.known.whole) + REMEMBERED:
                self.forget()
            self[word] = n
        return n


def counter(known: Vocabulary) -> Callable[[str], int]:
    """A function from a text to its number of tokens."""
    from tokenizers.pre_tokenizers import ByteLevel

    counts, split = _Counts(known), regex.compile(PATTERN).findall
    special = re.compile("|".join(map(re.escape, known.special))) if known.special else None
    library, sure = ByteLevel(add_prefix_space=False, use_regex=True), set(map(chr, range(128)))

    def is_sure(text: str) -> bool:
        """Whether Python's tables know all code points of the text."""
        new = set(text) - sure
        sure.update(c for c in new if unicodedata.category(c) != "Cn")
        return new <= sure

    def pretokens(text: str) -> list[str]:
        if text.isascii() or is_sure(text):
            return split(text)
        return [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]

    def count(text: str) -> int:
        parts = special.split(text) if special else [text]
        return len(parts) - 1 + sum(sum(map(counts.__getitem__, pretokens(p))) for p in parts if p)

    return count


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """docs(doc_id, text) to (doc_id, n_bytes, n_tokens, over_limit) by the vocabulary at path."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(known.value)
        for batch in batches:
            for first, last, texts in slices(batch):
                n = [count(t.decode("utf-8", "replace")) if t else 0 for t in texts]
                columns = [batch.column("doc_id").slice(first, last - first), pa.array(map(len, texts), pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select("doc_id", "text").mapInArrow(read, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(plain(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text"), public_tokenizers.path(VOCABULARY))
