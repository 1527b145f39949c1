"""Token counts of byte-level vocabularies, without making identifiers.

A text is cut into chunks by the vocabulary's pattern, and no merge crosses a chunk. In a
chunk every byte is a symbol; the symbols form a linked list, and a heap holds the rank and
place of each adjacent pair that may merge. The lowest rank is popped again and again, the
leftmost of equals first; a pair that an earlier merge has changed is passed over. The
chunk's count is its bytes less its merges. A task keeps the counts of the distinct chunks
it has met, so a word is merged once; the table starts anew when it is full, which costs
time and changes nothing. The corpus never crosses the network.

Characters are classed (letter, number, white space) as the tokenizer library does. Its
Unicode tables and those of ``regex`` differ in new characters: each character beyond ASCII
is tried once, and a text with one on which they differ is cut by the library.

Special strings inside a text are one token each, the library's default; the text between
them is cut by itself.

Defined cases: null text counts as empty and has 0 bytes and 0 tokens; an empty text too;
repeated rows and a null doc_id are counted row by row; an empty table gives no rows; other
columns, whatever their names, are not read. A very long text is cut chunk by chunk. A chunk
of n bytes, such as a line without white space, takes about 60 n bytes while it is merged,
after it is cut between bytes that are neighbours in no token.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import common

MODEL = "byte_bpe_50k.json"
LIMIT = 1024
#: Entries and characters of a task's table of distinct chunks; longer chunks are not kept.
TABLE_ENTRIES = 400_000
TABLE_CHUNK = 64
#: Longer texts are cut lazily, without a list of their chunks.
LIST_CHARS = 1 << 20
#: Longer chunks are cut between bytes that no merge joins.
SPLIT_BYTES = 1 << 12

#: The pattern of byte-level vocabularies (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_PLACE_BITS = 40


def byte_names() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, spare = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in names:
            names[b] = chr(spare)
            spare += 1
    return [names[b] for b in range(256)]


def unsupported(spec: dict) -> str | None:
    """Why the settings of a tokenizer file are not those of a plain byte-level one."""
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges"):
        return "its model is not plain byte-pair merging"
    if model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return "its symbols carry a prefix or suffix"
    if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return "its chunks are not those of the byte-level pattern"
    if spec["normalizer"]:
        return "it normalises text"
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
        return "an added token takes in what stands beside it"
    if any(name not in model["vocab"] for name in byte_names()):
        return "a byte has no symbol"
    return None


class Merges:
    """Ranks of the pairs of symbols that merge."""

    def __init__(self, model: dict):
        number: dict[str, int] = {name: b for b, name in enumerate(byte_names())}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        touching = set()
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[number[left], number[right]] = rank
            self.made.append(number.setdefault(left + right, len(number)))
            touching.add((number[left[-1]], number[right[0]]))
        self.touching = frozenset(touching)

    def parts(self, chunk: bytes) -> Iterator[bytes]:
        """The chunk cut where no merge can join what stands on both sides."""
        low = 0
        for i, pair in enumerate(zip(chunk, chunk[1:], strict=False), 1):
            if pair not in self.touching:
                yield chunk[low:i]
                low = i
        yield chunk[low:]

    def count(self, chunk: bytes) -> int:
        """Tokens of one chunk: its bytes less its merges."""
        if len(chunk) > SPLIT_BYTES:
            return sum(self._merged(p) for p in self.parts(chunk))
        return self._merged(chunk)

    def _merged(self, chunk: bytes) -> int:
        size, rank_of, made = len(chunk), self.rank.get, self.made
        if size > SPLIT_BYTES:  # compact, where lists would take much memory
            symbol = array("i")
            symbol.extend(chunk)
            after, before = array("q", range(1, size + 1)), array("q", range(-1, size - 1))
        else:
            symbol, after, before = list(chunk), list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [
            rank << _PLACE_BITS | i
            for i, pair in enumerate(zip(chunk, chunk[1:], strict=False))
            if (rank := rank_of(pair)) is not None
        ]
        heapify(heap)
        merges, place = 0, (1 << _PLACE_BITS) - 1
        while heap:
            entry = heappop(heap)
            rank, i = entry >> _PLACE_BITS, entry & place
            j = after[i]
            # A removed symbol is -1 and has no rank, nor has a pair past the end.
            if j >= size or rank_of((symbol[i], symbol[j])) != rank:
                continue
            merges += 1
            symbol[i], symbol[j] = made[rank], -1
            k = after[i] = after[j]
            if k < size:
                before[k] = i
                if (rank := rank_of((symbol[i], symbol[k]))) is not None:
                    heappush(heap, rank << _PLACE_BITS | i)
            if (h := before[i]) >= 0 and (rank := rank_of((symbol[h], symbol[i]))) is not None:
                heappush(heap, rank << _PLACE_BITS | h)
        return size - merges


class Counter(dict):
    """Counts of distinct chunks, merged when first met."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if reason := unsupported(spec):
            raise ValueError(f"{path}: {reason}")
        self.merges = Merges(spec["model"])
        self.cut = regex.compile(PATTERN)
        self.library_cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        names = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.alike: set[str] = set()
        self.unlike: set[str] = set()

    def __missing__(self, chunk: str) -> int:
        count = self.merges.count(chunk.encode())
        if len(chunk) <= TABLE_CHUNK:
            if len(self) >= TABLE_ENTRIES:
                self.clear()
            self[chunk] = count
        return count

    def _classed_alike(self, text: str) -> bool:
        """Whether the pattern cuts the text as the library does."""
        if text.isascii():
            return True
        for char in set(text) - self.alike - self.unlike:
            trial = f"a{char}a 1{char}1 !{char}!{char} {char}"
            same = [m.span() for m in self.cut.finditer(trial)] == [at for _, at in self.library_cut(trial)]
            (self.alike if same else self.unlike).add(char)
        return not self.unlike or self.unlike.isdisjoint(text)

    def _between(self, text: str) -> int:
        if not self._classed_alike(text):
            return sum(self[text[low:high]] for _, (low, high) in self.library_cut(text))
        if len(text) > LIST_CHARS:
            return sum(self[m.group()] for m in self.cut.finditer(text))
        return sum(map(self.__getitem__, self.cut.findall(text)))

    def count(self, text: str) -> int:
        if self.special is None:
            return self._between(text)
        total = low = 0
        for match in self.special.finditer(text):
            total += 1 + self._between(text[low : match.start()])
            low = match.end()
        return total + self._between(text[low:] if low else text)


#: One table for each file and Python worker; Spark reuses workers for many tasks.
_COUNTERS: dict[str, Counter] = {}


def counter_of(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def _run(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path)
        for batch in batches:
            tokens = pa.array([counter.count(t.as_py()) for t in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), tokens], ["doc_id", "n_bytes", "n_tokens"]
            )

    return run


def count(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row.

    ``path`` is a tokenizer file in JSON and must name the same file on every executor.
    """
    with open(path, encoding="utf-8") as file:
        if reason := unsupported(json.load(file)):
            raise ValueError(f"{path}: {reason}")
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(docs["doc_id"], F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    counted = rows.mapInArrow(_run(path), f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count(common.table(spark, sf_dir, "documents"), model_path())
