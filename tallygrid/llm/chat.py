"""Chat formatting in budgeted windows.

Turns get token counts; prefix sums of these within a conversation choose the windows: a
window's new turns are those that begin in the same slot of ``span`` tokens, and a turn
longer than a span is a window of its own. With a span of half of what history and system
turn leave of the budget, a window keeps to the budget, unless one long turn breaks it.
Each window begins with the conversation's system turn and the turns just before it, up to
``history`` tokens; only its new assistant turns are under the loss mask, so each of them is
a target once, however often it is repeated.

No conversation is gathered anywhere: prefix sums are taken within the parts of a range
partitioning and offset by the sums of the parts before, history is an equi-join on
bins of the prefix sum, and only the turns of one window are put together.

Template: ``<turn>### {Role}: {text}</turn>`` and a line end per turn. Backslashes, and
``#`` before ``#`` and ``<`` before ``turn`` or ``/turn``, are followed or preceded by a
backslash inside texts and roles (see ``escape``), so no text can hold a mark of the template.

Defined cases: NULL roles and texts are empty; a NULL conversation id is a conversation of
its own; turns are ordered by (turn, role, hash of the text), NULLs first, and a repeated
turn number is just another turn; only a conversation's first turn can be its system turn;
an empty conversation table gives no window. Only the four named columns are read, so
other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, staged
from .tokens import encoder

BUDGET, HISTORY, SYSTEM = 2048, 512, 256
TURN_TOKENS = 8  # what the template adds to a turn, about
PART_ROWS = 20_000
OPEN, CLOSE = "<turn>### ", "</turn>\n"
_MARKS = re.compile(r"\\|#(?=#)|<(?=/?turn)")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_ROLE_END = re.compile(r":(?= )")
KEY = ["conv", "none"]
SCHEMA = ("conv long, none boolean, run long, slot long, formatted string, "
          "loss array<struct<begin:int,end:int>>, repeated int, n_tokens long")


def escape(text: str) -> str:
    """``text`` without any mark of the template; a backslash and the character before
    which, or after which, it stands tell what was there."""
    return _MARKS.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str, bool]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted text, loss spans in code points) of (role, text, is a target) turns."""
    out, spans, at = [], [], 0
    for role, text, target in turns:
        head = OPEN + _ROLE_END.sub(r":\\", escape(role)) + ": "
        body = escape(text)
        if target:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(out), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted text."""
    turns = []
    for piece in formatted.split(CLOSE)[:-1]:
        if not piece.startswith(OPEN):
            raise ValueError("a turn without its mark")
        role, colon, text = piece[len(OPEN):].partition(": ")
        if not colon:
            raise ValueError("a turn without its role")
        turns.append((unescape(role), unescape(text)))
    return turns


def _counted(rows: DataFrame, tokenizer: str) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer)
        for batch in slices(batches, 2000):
            lengths = tool.encode(batch.column("text"))[1] + TURN_TOKENS
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths.astype(np.int64))],
                                             [*batch.schema.names, "tokens"])

    return rows.mapInArrow(count, "conv long, none boolean, turn long, role string, text string, tokens long")


def _prefix_sums(rows: DataFrame, span: int, parts: int) -> DataFrame:
    """Turns with ``before`` (tokens before), ``longs`` (long turns before) and ``at`` (turns
    before), a long conversation being split over the parts of a range partitioning."""
    order = [F.col("turn"), F.col("role"), F.xxhash64("text")]
    dealt = staged(rows.withColumn("long", F.col("tokens") > span)
                   .repartitionByRange(parts, *KEY, *order).withColumn("part", F.spark_partition_id()))
    sums = {"before": F.sum("tokens"), "longs": F.sum(F.col("long").cast("long")),
            "at": F.count(F.lit(1))}
    whole = dealt.groupBy(*KEY, "part").agg(*[v.alias(f"{k}_all") for k, v in sums.items()])
    earlier = Window.partitionBy(*KEY).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = whole.select(*KEY, "part", *[
        F.coalesce(F.sum(f"{k}_all").over(earlier), F.lit(0)).alias(f"{k}_all") for k in sums])
    inner = (Window.partitionBy("part", *KEY).orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, -1))
    local = dealt.select(*dealt.columns, *[
        F.coalesce(v.over(inner), F.lit(0)).alias(k) for k, v in sums.items()])
    found = local.join(offsets, [*KEY, "part"])
    return found.select(*KEY, "role", "text", "tokens", "long", *[
        (F.col(k) + F.col(f"{k}_all")).alias(k) for k in sums])


def chat_windows(turns: DataFrame, tokenizer: str, *, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text", budget: int = BUDGET,
                 history: int = HISTORY, system: int = SYSTEM) -> DataFrame:
    """Formatted windows: conv_id, run and slot (their order within the conversation),
    formatted, loss (spans in code points), repeated (turns at the front that other windows
    have as new ones) and n_tokens, counted turn by turn."""
    span = max(1, (budget - history - system) // 2)
    rows = turns.select(
        F.coalesce(F.col(conv_col).cast("long"), F.lit(0)).alias("conv"), F.col(conv_col).isNull().alias("none"),
        F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    parts = max(1, -(-rows.count() // PART_ROWS))
    placed = staged(_prefix_sums(_counted(rows, tokenizer), span, parts).withColumns({
        "run": 2 * F.col("longs") + F.col("long").cast("long"),
        "slot": F.floor(F.col("before") / span)}))
    first = (F.col("at") == 0) & (F.col("role") == "system")
    window = [*KEY, "run", "slot"]
    starts = placed.groupBy(*window).agg(F.min("before").alias("start"), F.min("at").alias("first_at"))
    later = starts.where("first_at > 0")
    near = (placed.where(~first).select(*KEY, "role", "text", "tokens", "before", F.explode(F.array(
        F.floor(F.col("before") / history), F.floor(F.col("before") / history) + 1)).alias("bin"))
        .join(later.withColumn("bin", F.floor(F.col("start") / history)), [*KEY, "bin"])
        .where((F.col("before") < F.col("start")) & (F.col("before") >= F.col("start") - history)))
    lead = later.join(placed.where(first).select(*KEY, "role", "text", "tokens"), KEY)
    part = lambda frame, order, new: frame.select(
        *window, F.struct(order.alias("order"), F.lit(new).alias("new"), F.col("role"), F.col("text"),
                          F.col("tokens")).alias("t"))
    every = (part(placed, F.col("before"), True).union(part(near, F.col("before"), False))
             .union(part(lead, F.lit(-1).cast("long"), False)))
    held = every.groupBy(*window).agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def write(batches):
        for batch in slices(batches, 500):
            out = []
            for r in batch.to_pylist():
                turns = r.pop("turns")
                text, spans = format_turns([
                    (t["role"], t["text"], t["new"] and t["role"] == "assistant") for t in turns])
                out.append(r | {"formatted": text, "loss": [{"begin": b, "end": e} for b, e in spans],
                                "repeated": sum(not t["new"] for t in turns),
                                "n_tokens": sum(t["tokens"] for t in turns)})
            yield pa.RecordBatch.from_pylist(out, WINDOWS)

    made = held.mapInArrow(write, SCHEMA)
    return made.select(F.when(~F.col("none"), F.col("conv")).alias("conv_id"),
                       *[c for c in made.columns if c not in KEY])


WINDOWS = pa.schema([
    ("conv", pa.int64()), ("none", pa.bool_()), ("run", pa.int64()), ("slot", pa.int64()),
    ("formatted", pa.string()),
    ("loss", pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))),
    ("repeated", pa.int32()), ("n_tokens", pa.int64())])


def read_windows(windows: DataFrame) -> DataFrame:
    """What the windows hold, window by window: conv_id, run, slot, turns (role and text of
    the new ones), loss (unescaped text under the mask), chars."""

    def read(batches):
        for batch in slices(batches, 500):
            out = []
            for r in batch.to_pylist():
                text = r["formatted"]
                turns = parse_turns(text)[r["repeated"]:]
                out.append({"conv_id": r["conv_id"], "run": r["run"], "slot": r["slot"],
                            "turns": [{"role": a, "text": b} for a, b in turns],
                            "loss": [unescape(text[s["begin"]:s["end"]]) for s in r["loss"]],
                            "chars": len(text)})
            yield pa.RecordBatch.from_pylist(out, READ)

    return windows.select("conv_id", "run", "slot", "formatted", "loss", "repeated").mapInArrow(
        read, "conv_id long, run long, slot long, turns array<struct<role:string,text:string>>, "
              "loss array<string>, chars long")


READ = pa.schema([
    ("conv_id", pa.int64()), ("run", pa.int64()), ("slot", pa.int64()),
    ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
    ("loss", pa.list_(pa.string())), ("chars", pa.int64())])


def digests(read: DataFrame) -> DataFrame:
    """Per conversation, running hashes over its windows in order; a task streams its
    windows, so it holds one at a time, however long the conversation."""

    def total(batches):
        import hashlib

        now, state, out = object(), None, []

        def row():
            n, turns, chars, loss, formatted = state
            return {"conv_id": now, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars,
                    "loss_sha256": loss.hexdigest(), "formatted_chars": formatted}

        for batch in slices(batches, 500):
            for r in batch.to_pylist():
                if state is None or r["conv_id"] != now:
                    if state:
                        out.append(row())
                    now, state = r["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for t in r["turns"]:
                    state[1].update(f"{t['role']}\n{t['text']}\n".encode())
                for text in r["loss"]:
                    state[3].update(text.encode())
                    state[2] += len(text)
                state[0] += len(r["turns"])
                state[4] += r["chars"]
            if out:
                yield pa.RecordBatch.from_pylist(out, DIGESTS)
                out = []
        if state:
            yield pa.RecordBatch.from_pylist([row()], DIGESTS)

    return (read.repartition("conv_id").sortWithinPartitions("conv_id", "run", "slot")
            .mapInArrow(total, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                               "loss_sha256 string, formatted_chars long"))


DIGESTS = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
