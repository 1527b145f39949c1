"""Benchmark decontamination by winnowing.

Of every ``window`` consecutive k-grams the one with the least hash is a fingerprint
(the last of equals), so two texts that share ``k + window - 1`` words share one: the
choice looks at these words alone. A span guarantee of 13 words thus keeps about two
of nine positions. Items shorter than 13 words get a scheme whose guarantee is their
length.

Training fingerprints are first tested against a bit map of the benchmark's, of a size
that is fixed whatever the benchmark's (its bits fill up, nothing is lost). A surviving
fingerprint is extended to every window that covers it, and the hashes of these windows
are joined with the benchmark's: a window and its fingerprint must agree in two
independent 64-bit hashes.

Defined cases: null or wordless text has no words and is clean; repeated rows and
repeated doc_ids are judged row by row; an empty benchmark makes everything clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import common
from sunledger.session import materialise

SPAN = 13
#: log2 of the bits of the benchmark's map: 1 MB, the only thing sent to every task.
MAP_BITS = 23

_MARK = "_text_digest"

_WINDOWS = "windows array<struct<start:int, size:int, code:long>>"


def scheme(span: int) -> tuple[int, int]:
    """(k, window) whose guarantee is ``span`` words."""
    window = max(1, span * 2 // 3)
    return span - window + 1, window


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """For each ``window`` of consecutive k-gram hashes the position it keeps; rising."""
    count = max(0, len(grams) - window + 1)
    least = grams[:count].copy()
    at = np.arange(count)
    for j in range(1, window):
        later = grams[j : j + count]
        take = later <= least
        least[take] = later[take]
        at[take] = np.flatnonzero(take) + j
    return at


def _spans(hashes: np.ndarray, row: np.ndarray, span: int):
    """Codes and positions of the fingerprints of all rows' words; ``row`` is each word's row."""
    k, window = scheme(span)
    grams = common.gram_hashes(hashes, k)
    at = winnow(grams, window)
    at = at[row[: len(at)] == row[span - 1 : span - 1 + len(at)]]  # not across rows
    at = at[np.diff(at, prepend=-1) > 0]
    return grams[at] ^ common.salt(1000 + span), at


def _window_codes(hashes: np.ndarray, span: int) -> np.ndarray:
    return common.gram_hashes(hashes ^ common.salt(77), span)


def _read(column: pa.Array):
    for low, data, offsets in common.text_slices(column):
        words = common.split_words(data, offsets, common.LETTERS)
        yield low, words, common.word_hashes(data, words)


def _item_rows(span: int):
    """Per benchmark item: fingerprints and windows under its own guarantee."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, words, hashes in _read(batch.column(1)):
                ids, sizes, prints, codes = [], [], [], []
                for i, count in enumerate(words.counts()):
                    size = int(min(span, count))
                    if not size:
                        continue
                    own = hashes[words.first[i] : words.first[i + 1]]
                    ids.append(batch.column(0)[low + i].as_py())
                    sizes.append(size)
                    prints.append(_spans(own, np.zeros(count, np.int64), size)[0].view(np.int64))
                    codes.append(_window_codes(own, size).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(sizes, pa.int32()),
                        pa.array(prints, pa.list_(pa.int64())),
                        pa.array(codes, pa.list_(pa.int64())),
                    ],
                    ["item_id", "size", "prints", "codes"],
                )

    return run


def _bit(code: np.ndarray) -> np.ndarray:
    return (code >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def _bit_map(items: DataFrame) -> np.ndarray:
    """Bit map of the items' fingerprints: at most 2**MAP_BITS / 64 longs."""
    code = F.col("code")
    place = F.shiftrightunsigned(code, 64 - MAP_BITS)
    words = (
        items.select(F.explode("prints").alias("code"))
        .groupBy(F.shiftright(place, 6).alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(code, {64 - MAP_BITS}) & 63 as int))")).alias("bits"))
        .collect()
    )
    out = np.zeros(1 << (MAP_BITS - 6), dtype=np.int64)
    for row in words:
        out[row["word"]] = row["bits"]
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def _scan(spans: list[int], known):
    """Per document: its words and the windows around known fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = known.value
        kind = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32()), ("code", pa.int64())]))
        for batch in batches:
            for low, words, hashes in _read(batch.column(2)):
                rows = len(words.first) - 1
                of_word = np.repeat(np.arange(rows), words.counts())
                row, start, size, code = [], [], [], []
                for span in spans:
                    codes, at = _spans(hashes, of_word, span)
                    at = at[bits[_bit(codes)]]
                    if not len(at):
                        continue
                    k, _ = scheme(span)
                    begins = (at[:, None] - np.arange(span - k + 1)[None, :]).ravel()
                    owner = np.repeat(of_word[at], span - k + 1)
                    fits = (begins >= words.first[owner]) & (begins + span <= words.first[owner + 1])
                    begins, pick = np.unique(begins[fits], return_index=True)
                    owner = owner[fits][pick]
                    row.append(owner)
                    start.append(begins - words.first[owner])
                    size.append(np.full(len(begins), span))
                    code.append(_window_codes(hashes, span)[begins])
                if row:
                    row = np.concatenate(row)
                    order = np.argsort(row, kind="stable")
                    ends = np.searchsorted(row[order], np.arange(rows + 1))
                    values = pa.StructArray.from_arrays(
                        [
                            pa.array(np.concatenate(start)[order].astype(np.int32)),
                            pa.array(np.concatenate(size)[order].astype(np.int32)),
                            common.signed(np.concatenate(code)[order]),
                        ],
                        ["start", "size", "code"],
                    )
                    found = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)
                else:
                    found = pa.array([[]] * rows, kind)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, rows),
                        batch.column(1).slice(low, rows),
                        pa.array(words.counts()),
                        found,
                    ],
                    ["uid", "key", "n_words", "windows"],
                )

    return run


def judge(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, percent: int = 5, key: str = "doc_id"
) -> DataFrame:
    """One row per document row: its key, n_words, n_hit, items (sorted as strings),
    contaminated; ``docs`` needs the key and text, ``benchmark`` item_id and text.

    A word is hit when any occurrence of an item window covers it; a document with at
    least ``percent`` hit words of a hundred, and one, is contaminated.
    """
    spark = docs.sparkSession
    items = materialise(
        benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(
            _item_rows(span), "item_id long, size int, prints array<long>, codes array<long>"
        ),
        "benchmark-windows",
    )
    spans = sorted(r["size"] for r in items.select("size").distinct().collect())  # at most ``span``
    known = spark.sparkContext.broadcast(_bit_map(items))
    scanned = materialise(
        docs.select(
            F.monotonically_increasing_id().alias("uid"),
            F.col(key).alias("key"),
            F.col("text").cast("string"),
        ).mapInArrow(
            _scan(spans, known),
            f"uid long, key {docs.schema[key].dataType.simpleString()}, n_words long, {_WINDOWS}",
        ),
        "winnowed",
    )
    codes = items.select("item_id", "size", F.explode("codes").alias("code")).distinct()
    windows = scanned.select("uid", F.explode("windows").alias("w")).select("uid", "w.*")
    hits = (
        windows.join(codes, ["size", "code"])
        .groupBy("uid")
        .agg(
            F.sort_array(F.collect_set(F.struct("start", "size"))).alias("places"),
            F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"),
        )
        .select("uid", _covered().alias("n_hit"), "items")
    )
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (
        scanned.drop("windows")
        .join(hits, "uid", "left")
        .select(
            F.col("key").alias(key),
            "n_words",
            hit.alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            ((hit > 0) & (100 * hit >= percent * F.col("n_words"))).alias("contaminated"),
        )
    )


def _covered():
    """Words under the sorted, overlapping ``places``."""
    return F.expr(
        """aggregate(places, named_struct('last', 0L, 'total', 0L), (s, p) -> named_struct(
            'last', greatest(s.last, cast(p.start + p.size as long)),
            'total', s.total + greatest(0L, p.start + p.size - greatest(s.last, cast(p.start as long)))
        ), s -> s.total)"""
    )


def digest(judged: DataFrame) -> DataFrame:
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(judge(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows.

    A verdict depends on the text alone, so it meets its rows by a digest of the text,
    whether doc_ids are null, repeated or sound.
    """
    digest_ = F.md5(F.coalesce(docs["text"], F.lit("")))
    texts = docs.select(digest_.alias(_MARK), docs["text"].alias("text"))
    bad = judge(texts, benchmark, key=_MARK).where("contaminated").select(_MARK).distinct()
    return docs.join(bad, digest_ == bad[_MARK], "left_anti")


ORACLE = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size,
    array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS gram
  FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM iw),
dw AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS gram
  FROM d, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)),
hit AS (SELECT doc_id, dw.size, i, item_id FROM dw JOIN iw ON dw.size = iw.size AND dw.gram = iw.gram),
spots AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM hit, unnest(range(i, i + size)) AS t(p) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN spots ON d.doc_id = spots.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""
