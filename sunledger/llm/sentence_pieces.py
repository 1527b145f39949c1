"""SentencePiece encoding and decoding with a table of distinct chunks.

The library writes white space as a marker and merges characters into pieces. Where no
piece of the vocabulary has a marker after another character, no merge crosses the place
before a run of markers, so a text may be cut there into marked words and each word
segmented alone. Each task keeps a table from distinct marked word to ids: a batch is
cut, words that are not in the table are segmented once by the library, and the ids are
joined back by position. The corpus never crosses the network, and the table starts anew
when it is full, which costs time and changes nothing.

``chunkable`` reads the vocabulary and the normaliser's settings; a model that fails it
is rejected, as its words could not be segmented alone.

Defined cases: null text counts as empty and gets the begin and end ids alone; the
library keeps every space; repeated rows are encoded row by row.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from sunledger.llm import common

MARK = "▁"
MODEL = "piece_bpe_32k.model"
#: Entries and characters of a task's table of distinct words; longer words are not kept.
TABLE_ENTRIES = 400_000
TABLE_WORD = 64
#: Texts are taken in groups of about this many characters.
GROUP_CHARS = 1 << 20

_CHUNK = re.compile(f"[ {MARK}]*[^ {MARK}]+|[ {MARK}]+")


def chunkable(model_path: str) -> bool:
    """Whether marked words can be segmented one by one."""
    from sentencepiece import sentencepiece_model_pb2 as spec

    model = spec.ModelProto()
    with open(model_path, "rb") as file:
        model.ParseFromString(file.read())
    rules = model.normalizer_spec
    plain = not rules.precompiled_charsmap and rules.add_dummy_prefix
    plain &= not rules.remove_extra_whitespaces and rules.escape_whitespaces
    plain &= model.trainer_spec.model_type == model.trainer_spec.BPE
    user = any(p.type == p.USER_DEFINED for p in model.pieces)
    return plain and not user and not any(MARK in p.piece.lstrip(MARK) for p in model.pieces)


class WordTable:
    """Ids, as 32-bit bytes in the machine's (little-endian) order, of distinct marked words."""

    def __init__(self, processor):
        self.processor = processor
        self.ids: dict[str, bytes] = {}

    def segment(self, words: list[str]) -> None:
        """Add the given words; each begins with a marker, which the library itself adds."""
        new = list(dict.fromkeys(w for w in words if w not in self.ids))
        if len(self.ids) + len(new) > TABLE_ENTRIES:
            self.ids = {}
            new = list(dict.fromkeys(words))
        found = self.processor.encode([w[1:] for w in new], num_threads=1)
        for word, ids in zip(new, found, strict=True):
            self.ids[word] = array("I", ids).tobytes()
        # A lone marker reads as an empty text, which the library gives no marker.
        self.ids.update((w, self._lone_marker()) for w in new if len(w) == 1)

    def _lone_marker(self) -> bytes:
        return array("I", [self.processor.piece_to_id(MARK)]).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts, without begin and end."""
        words = [_CHUNK.findall(" " + t) if t else [] for t in texts]
        flat = list(chain.from_iterable(words))
        self.segment(flat)
        coded = [b"".join(map(self.ids.__getitem__, own)) for own in words]
        for word in flat:
            if len(word) > TABLE_WORD:
                self.ids.pop(word, None)
        return coded


#: One table for each model and Python worker; Spark reuses workers for many tasks.
_TABLES: dict[str, WordTable] = {}


def table_of(model_path: str) -> WordTable:
    import sentencepiece

    if model_path not in _TABLES:
        _TABLES[model_path] = WordTable(sentencepiece.SentencePieceProcessor(model_file=model_path))
    return _TABLES[model_path]


def groups(lengths: list[int]) -> Iterator[tuple[int, int]]:
    low = size = 0
    for i, length in enumerate(lengths):
        if size and size + length > GROUP_CHARS:
            yield low, i
            low, size = i, 0
        size += length
    if low < len(lengths):
        yield low, len(lengths)


def _encoder(model_path: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of(model_path)
        processor = table.processor
        begin = array("I", [processor.bos_id()]).tobytes()
        end = array("I", [processor.eos_id()]).tobytes()
        for batch in batches:
            column = batch.column(1).fill_null("")
            # A group becomes Python strings, not the batch.
            for low, high in groups(pc.utf8_length(column).to_pylist()):
                texts = column.slice(low, high - low).to_pylist()
                coded = [begin + x + end for x in table.encode(texts)]
                own = batch.column(0).slice(low, high - low)
                counts = pa.array([len(x) // 4 for x in coded], pa.int64())
                decoded = [processor.decode(np.frombuffer(x, "<u4").tolist()) for x in coded]
                if digests:
                    last = [
                        pa.array([hashlib.sha256(x).hexdigest() for x in coded]),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in decoded]),
                    ]
                    names = ["ids_sha256", "decoded_sha256"]
                else:
                    ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in coded]
                    last = [pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                    names = ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays([own, counts, *last], ["doc_id", "n_tokens", *names])

    return run


def encode(docs: DataFrame, model_path: str, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, and ids and decoded, or with ``digests`` the SHA-256 of both.

    ``model_path`` must name the same file on every executor. The digests are taken in
    the task, as ids and decoded text are several times the size of the corpus.
    """
    if not chunkable(model_path):
        raise ValueError("this model's pieces cross white space")
    last = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", docs["text"].cast("string")).mapInArrow(
        common.tidy(_encoder(model_path, digests)), f"doc_id {kind}, n_tokens long, {last}"
    )


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(common.table(spark, sf_dir, "documents"), model_path(), digests=True)
