"""Chat formatting in budgeted windows.

The turns of a conversation are put in order and their tokens summed up; a turn's prefix
sum divided by the stride is its window, so windows begin and end with whole turns, and
no window needs to know another. A window holds

* the conversation's system turn (a first turn of that role), retained and masked,
* history: those turns of the window before whose distance to the window's first turn is
  within the history budget, repeated and masked,
* its own turns; the loss is on their assistant texts, each in exactly one window.

Stride, history and the rest of ``budget`` bound a window's tokens, but for single turns
longer than their share, which stay whole.

A turn is written ``<s>role[INST]text</s>``. Inside roles and texts a backslash is doubled
and one is put after every ``<`` and ``[``, so no control string, all of which begin with
these, can appear there; ``read_turns`` reverses it exactly.

Prefix sums run in chunks of the ordered rows with one carried row per conversation and
chunk, so that a conversation of any length is spread over tasks.

Defined cases: null text or role counts as empty; turns are ordered by turn (null first),
then role and text; repeated rows are turns of their own; rows with a null conv_id are one
conversation; an empty table gives no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunledger.llm import common
from sunledger.operators.ordering import CHUNK_BITS, ROW, number_rows

BUDGET = 1024
#: Tokens counted for a turn's marks.
MARKS = 3
TOKEN = r"[A-Za-z0-9]+|[^A-Za-z0-9\x00-\x20]"

OPEN, TEXT, CLOSE = "<s>", "[INST]", "</s>"
_ESCAPED = re.compile(r"([<\[])\\|\\\\")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "<\\").replace("[", "[\\")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1] or "\\", text)


def format_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn's text and the place of its content in it."""
    head = OPEN + escape(role) + TEXT
    body = escape(text)
    return head + body + CLOSE, len(head), len(head) + len(body)


def read_turns(text: str) -> list[tuple[str, str]]:
    """The (role, text) of every turn of a formatted window."""
    turns = []
    for part in text.split(CLOSE)[:-1]:
        role, _, body = part[len(OPEN) :].partition(TEXT)
        turns.append((unescape(role), unescape(body)))
    return turns


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, losses, sizes, repeated = [], [], [], []
        for turns in batch.column(2).to_pylist():
            parts, loss, at = [], [], 0
            for turn in turns:
                part, begin, end = format_turn(turn["role"], turn["text"])
                if turn["role"] == "assistant" and not turn["again"]:
                    loss.append({"start": at + begin, "stop": at + end})
                parts.append(part)
                at += len(part)
            texts.append("".join(parts))
            losses.append(loss)
            sizes.append(len(turns))
            repeated.append(sum(t["again"] for t in turns))
        span = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                batch.column(3),
                pa.array(texts, pa.string()),
                pa.array(losses, span),
                pa.array(sizes, pa.int64()),
                pa.array(repeated, pa.int64()),
            ],
            ["conv_id", "window", "n_tokens", "text", "loss", "n_turns", "n_repeated"],
        )


def windows(conversations: DataFrame, budget: int = BUDGET) -> DataFrame:
    """conv_id, window, n_tokens, text, loss (spans of text), n_turns, n_repeated."""
    stride, history = budget // 2, budget // 4
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("text", "role"))
    turns = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"), text.alias("text")
    )
    tokens = F.regexp_count("text", F.lit(TOKEN)).cast("long") + MARKS
    numbered = number_rows(turns.withColumn("tokens", tokens), ["conv_id", "turn", "role", "text"])
    light = numbered.select("conv_id", "role", "tokens", ROW).withColumn("chunk", F.shiftright(ROW, CHUNK_BITS))

    counts = light.groupBy("conv_id", "chunk").agg(
        F.count("*").alias("rows"), F.sum("tokens").alias("sum"), F.min_by("role", ROW).alias("first_role"),
        F.min_by("tokens", ROW).alias("first_tokens"),
    )
    earlier = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    carried = counts.select(
        "conv_id",
        "chunk",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("sum_before"),
        (F.first("first_role").over(whole) == "system").alias("has_system"),
        F.first("first_tokens").over(whole).alias("system_tokens"),
    )
    inside = Window.partitionBy("conv_id", "chunk").orderBy(ROW)
    summed = light.withColumns(
        {
            "index": F.row_number().over(inside) - 1,
            "before": F.coalesce(F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        }
    )
    c, s = carried.alias("c"), summed.alias("s")
    joined = s.join(c, F.col("s.conv_id").eqNullSafe(F.col("c.conv_id")) & (F.col("s.chunk") == F.col("c.chunk")))
    # The system turn is not part of the sums: it is in every window.
    skipped = F.when(F.col("has_system") & ~F.col("system"), F.col("system_tokens")).otherwise(0)
    placed = (
        joined.select("s.*", "rows_before", "sum_before", "has_system", "system_tokens")
        .withColumn("system", F.col("has_system") & (F.col("index") + F.col("rows_before") == 0))
        .withColumn("prefix", F.col("before") + F.col("sum_before") - skipped)
        .withColumn("window", F.floor(F.col("prefix") / stride).cast("long"))
        .select("conv_id", ROW, "tokens", "system", "prefix", "window")
    )
    starts = placed.where("not system").groupBy("conv_id", "window").agg(F.min("prefix").alias("start"))
    start = starts.alias("w")
    row = placed.alias("t")
    same = F.col("t.conv_id").eqNullSafe(F.col("w.conv_id"))
    later = row.where("not system").join(start, same & (F.col("t.window") + 1 == F.col("w.window")))
    recent = later.where(F.col("w.start") - F.col("t.prefix") <= history)
    kept = row.where("system").join(start.where("window > 0"), same)
    again = [
        d.select("t.conv_id", F.col("w.window").alias("window"), f"t.{ROW}", "t.tokens", F.lit(True).alias("again"))
        for d in (recent, kept)
    ]
    own = placed.select("conv_id", "window", ROW, "tokens", F.lit(False).alias("again"))
    members = own.union(again[0]).union(again[1])
    full = members.join(numbered.select(ROW, "role", "text"), ROW)
    grouped = full.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(F.struct(ROW, "again", "role", "text"))).alias("turns"),
        F.sum("tokens").alias("n_tokens"),
    )
    return grouped.select("conv_id", "window", "turns", "n_tokens").mapInArrow(
        _assemble,
        "conv_id long, window long, n_tokens long, text string, "
        "loss array<struct<start:int, stop:int>>, n_turns long, n_repeated long",
    )


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of windows sorted by conversation and window, one row per conversation; streams."""
    none = object()
    current, state = none, None

    def row():
        return [current, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]]

    for batch in batches:
        done = []
        columns = [batch.column(i).to_pylist() for i in (0, 2, 3, 4)]
        for conv, text, loss, repeated in zip(*columns, strict=True):
            if conv != current or current is none:
                if current is not none:
                    done.append(row())
                current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, body in read_turns(text)[repeated:]:
                state[0] += 1
                state[1].update(f"{role}\n{body}\n".encode())
            for span in loss:
                body = unescape(text[span["start"] : span["stop"]])
                state[2] += len(body)
                state[3].update(body.encode())
            state[4] += len(text)
        yield _rows(done)
    if current is not none:
        yield _rows([row()])


def _rows(rows: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)


def digest(formatted: DataFrame) -> DataFrame:
    """What the formatted windows say, one row per conversation.

    A digest is a sequential sum, so a conversation's windows pass through one task; they
    are streamed, not collected.
    """
    return (
        formatted.select("conv_id", "window", "text", "loss", "n_repeated")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "window")
        .mapInArrow(
            _digest,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
        )
    )


#: A conversation whose texts hold other templates' control strings.
PROBE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.createDataFrame(PROBE, "conv_id long, turn long, role string, text string")
    given = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digest(windows(given.unionByName(probe)))


ORACLE = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS i,
    len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9\x00-\x20]')) + 3 AS tokens,
    13 + len(role) + len(text)
      + len(regexp_extract_all(role || text, '[<\[\\]')) AS chars
  FROM t),
s AS (SELECT *, i = 0 AND role = 'system' AS system FROM o),
p AS (
  SELECT *, coalesce(sum(CASE WHEN system THEN 0 ELSE tokens END)
    OVER (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prefix
  FROM s),
w AS (SELECT *, CAST(floor(prefix / 512) AS BIGINT) AS win FROM p),
st AS (SELECT conv_id, win, min(prefix) AS start FROM w WHERE NOT system GROUP BY ALL),
rep AS (
  SELECT w.conv_id, sum(chars) AS chars FROM w JOIN st ON w.conv_id = st.conv_id
  WHERE (NOT system AND st.win = w.win + 1 AND st.start - w.prefix <= 256) OR (system AND st.win > 0)
  GROUP BY w.conv_id)
SELECT w.conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN len(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '')) AS loss_sha256,
  CAST(sum(w.chars) + coalesce(any_value(rep.chars), 0) AS BIGINT) AS formatted_chars
FROM w LEFT JOIN rep ON w.conv_id = rep.conv_id GROUP BY w.conv_id
"""
