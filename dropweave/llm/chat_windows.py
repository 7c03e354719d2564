"""Conversations as training windows of a token budget.

A window holds whole turns in a template with control strings, from ``<s>`` on.  Control strings inside texts and roles are broken up by
``\\.`` and backslashes are doubled, so every window reads back to its turns.  Turns are counted in tokens (markers and text apart), and
prefix sums of these choose the spans: a window takes the turns from the first one not yet taken as long as they fit ``BUDGET``, a turn at
least.  In front of them it repeats the conversation's system turn (its first turn, if that has the role ``system`` and takes half of the budget at
most) and the turns before, as far as they fit ``HISTORY`` and leave room for the first new turn.  Loss spans cover the texts of the new
assistant turns; repeated turns are masked, so each assistant text is learned once.  A turn larger than the budget is a window of its own,
not cut (``tokens`` tells).

Conversations of any length.  Rows are range-partitioned by conversation, turn, role and hash of the text, so a conversation with a third of all
rows lies in many partitions.  Sums run inside a partition; what earlier partitions hold of a conversation is added for those few that are cut.  By these sums a
conversation falls apart into segments of ``SEGMENT`` budgets, which are windowed by tasks of their own: the turns before
a segment that may be its history, and the system turn, are sent along.  A new segment begins a new window.

``read_back`` parses windows to turns.  Digests of a conversation are taken over its windows in order; they pass a task one after the other and are not held.

Null texts and roles count as empty.  Rows of a null id are one conversation.  Turns with equal numbers follow role, then hash; repeated rows
are turns of their own.  A null turn comes first.  Empty tables give no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dropweave.llm._byte_bpe import byte_level
from dropweave.llm._common import text_chunks
from dropweave.session import broadcast_if_small, stage

BUDGET, HISTORY, SEGMENT = 1024, 256, 32
START, END = "<s>", "</s>"
#: What is written around a turn; the role of any other turn is written out.
MARKS = {"system": ("<<SYS>>\n", "\n<</SYS>>\n\n"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", END)}
OTHER = ("[ROLE] ", " [/ROLE] ", END)
CONTROL = re.compile(r"(?=<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|\[ROLE\]|\[/ROLE\])(.)")
ESCAPED = re.compile(r"\\([\\.])")
LOSS_ROLE = "assistant"
WINDOWS = ("conv_id long, segment long, window int, first_turn long, n_turns int, n_repeated int, tokens long, text string, "
           "loss_starts array<int>, loss_sizes array<int>")


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\.", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: "\\" if m[1] == "\\" else "", text)


def around(role: str) -> tuple[str, str]:
    """What goes before and behind the text of a turn."""
    return MARKS.get(role) or (OTHER[0] + escape(role) + OTHER[1], OTHER[2])


def parse(window: str) -> list[tuple[str, str, int, int]]:
    """``(role, text, from, to)`` of the turns of a window; the last two say where its escaped text lies."""
    if not window.startswith(START):
        raise ValueError("a window begins with " + START)
    out, at = [], len(START)
    while at < len(window):
        for role, (before, behind) in MARKS.items():
            if window.startswith(before, at):
                break
        else:
            if not window.startswith(OTHER[0], at):
                raise ValueError(f"no turn begins at {at}")
            name_end = window.index(OTHER[1], at)
            role, before, behind = unescape(window[at + len(OTHER[0]):name_end]), window[at:name_end + len(OTHER[1])], OTHER[2]
        begin = at + len(before)
        end = window.index(behind, begin)
        out.append((role, unescape(window[begin:end]), begin, end))
        at = end + len(behind)
    return out


class Counted:
    """Tokens of turns."""

    def __init__(self, vocabulary: bytes) -> None:
        self.encode = byte_level(vocabulary)[0].encode_ordinary
        self.marks: dict[str, int] = {}
        self.start = len(self.encode(START))

    def turn(self, role: str, text: str) -> int:
        if role not in self.marks:
            if len(self.marks) > 1000:
                self.marks = {}
            self.marks[role] = sum(len(self.encode(mark)) for mark in around(role))
        return self.marks[role] + len(self.encode(escape(text)))


def placed(rows: DataFrame, vocabulary: bytes) -> DataFrame:
    """``(conv_id, place, before, tokens, role, text)``: place of a turn in its conversation, and the tokens before it; staged."""
    sent = rows.sparkSession.sparkContext.broadcast(vocabulary)
    order = ["conv_id", "turn", "role", F.xxhash64("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, part = Counted(sent.value), TaskContext.get().partitionId()
        last, place, before = "none yet", 0, 0
        for batch in text_chunks(batches, "text"):
            out = ([], [], [])
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != last:
                    last, place, before = conv, 0, 0
                tokens = count.turn(role, text)
                for column, value in zip(out, (place, before, tokens)):
                    column.append(value)
                place, before = place + 1, before + tokens
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array([part] * batch.num_rows, pa.int32()), *(pa.array(c, pa.int64()) for c in out),
                 batch.column("role"), batch.column("text")], ["conv_id", "part", "place", "before", "tokens", "role", "text"])

    turns = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        run, "conv_id long, part int, place long, before long, tokens long, role string, text string"), "turns")
    sums = turns.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("sum"))
    whole, earlier = Window.partitionBy("conv_id"), Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A partition cuts two conversations at most, so this list is as long as the list of partitions.
    cut = stage(sums.withColumns({"parts": F.count(F.lit(1)).over(whole), "turns_before": F.sum("n").over(earlier), "tokens_before": F.sum("sum").over(earlier)})
                .filter("parts > 1 AND turns_before IS NOT NULL").select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), "turns_before", "tokens_before"), "cut")
    joined = turns.join(broadcast_if_small(cut), turns["conv_id"].eqNullSafe(F.col("_conv")) & (turns["part"] == F.col("_part")), "left")
    zero = F.lit(0).cast("long")
    return joined.select("conv_id", (F.col("place") + F.coalesce("turns_before", zero)).alias("place"),
                         (F.col("before") + F.coalesce("tokens_before", zero)).alias("before"), "tokens", "role", "text")


def choose(tokens: np.ndarray, first: int, begins: int, system: int, capacity: int, history: int) -> list[tuple[int, int, int, bool]]:
    """``(history from, new from, new to, system repeated)`` of the windows of the turns from ``first`` on.

    ``begins`` is the first turn that may be history, and ``system`` what the system turn takes (0: none, or not before these turns).
    ``capacity`` is what a window holds.  The turn in front of ``begins``, if any, is the system turn itself.
    """
    sums = np.concatenate([[0], np.cumsum(tokens)])
    out, at = [], first
    while at < len(tokens):
        repeated = system > 0 and at >= begins
        room = capacity - (system if repeated else 0)
        past = min(history, room - int(tokens[at]))
        low = max(begins, int(np.searchsorted(sums, sums[at] - past))) if past > 0 else at
        low = min(low, at)
        end = max(at + 1, int(np.searchsorted(sums, sums[low] + room, "right")) - 1)
        out.append((low, at, end, repeated))
        at = end
    return out


def windows(convs: DataFrame, vocabulary: bytes, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            budget: int = BUDGET, history: int = HISTORY, segment: int = SEGMENT) -> DataFrame:
    """The windows of all conversations, as ``WINDOWS``; in order of segment and window within a conversation."""
    if not 0 <= history < budget or segment < 1:
        raise ValueError("history must be less than the budget, and a segment a budget at least")
    empty, size = F.lit(""), segment * budget
    rows = convs.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"),
                        *(F.coalesce(F.col(c).cast("string"), empty).alias(n) for c, n in ((role, "role"), (text, "text"))))
    turns = placed(rows, vocabulary).withColumn("segment", F.expr(f"before div {size}"))
    own = turns.withColumn("kind", F.lit(2))
    past = turns.filter((F.col("before") >= (F.col("segment") + 1) * size - history) & (F.col("tokens") <= history)).withColumns(
        {"segment": F.col("segment") + 1, "kind": F.lit(1)})
    systems = turns.filter((F.col("place") == 0) & (F.col("role") == "system") & (F.col("tokens") * 2 <= budget))
    later = turns.filter("segment > 0").select(F.col("conv_id").alias("_conv"), F.col("segment").alias("_segment")).distinct()
    retained = systems.join(later, systems["conv_id"].eqNullSafe(F.col("_conv"))).withColumns({"segment": F.col("_segment"), "kind": F.lit(0)}).select(own.columns)
    sent = own.unionByName(past).unionByName(retained).repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "kind", "place")
    start_tokens = Counted(vocabulary).start

    def formatted(conv: int | None, number: int, held: list[tuple]) -> Iterator[tuple]:
        """The windows of one segment; ``held`` are its rows ``(kind, place, tokens, role, text)``."""
        system = next((r for r in held if r[0] == 0), None)
        own_rows = [r for r in held if r[0] == 2]
        if not own_rows:
            return
        carried, wanted = [], own_rows[0][1] - 1
        for r in reversed([r for r in held if r[0] == 1]):  # only turns next to each other
            if r[1] != wanted:
                break
            carried.insert(0, r)
            wanted -= 1
        begins = 0
        rows = carried + own_rows
        if system is None and own_rows[0][1] == 0 and own_rows[0][3] == "system" and own_rows[0][2] * 2 <= budget:
            system, begins = own_rows[0], 1
        elif system is not None and rows[0][1] == 0:
            rows = rows[1:]  # the system turn is sent for itself
            carried = carried[1:]
        tokens = np.array([r[2] for r in rows], np.int64)
        chosen = choose(tokens, len(carried), begins, system[2] if system else 0, budget - start_tokens, history)
        for window, (low, first, end, repeated) in enumerate(chosen):
            text, starts, sizes = START, [], []
            for i, r in enumerate(([system] if repeated else []) + rows[low:end]):
                before, behind = around(r[3])
                said = escape(r[4])
                if r[3] == LOSS_ROLE and i >= repeated + first - low:
                    starts.append(len(text) + len(before))
                    sizes.append(len(said))
                text += before + said + behind
            taken = start_tokens + int(tokens[low:end].sum()) + (system[2] if repeated else 0)
            yield conv, number, window, rows[first][1], end - first, repeated + first - low, taken, text, starts, sizes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.strip().split()[0] for f in WINDOWS.split(",")]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]

        def packed(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*done)) or [[]] * len(types), types)], names)

        key, held, done = None, [], []
        for batch in text_chunks(batches, "text"):
            for conv, number, *row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "segment", "kind", "place", "tokens", "role", "text"))):
                if key != (conv, number):
                    done += formatted(*key, held) if key else ()
                    key, held = (conv, number), []
                held.append(tuple(row))
            yield packed(done)
            done = []
        yield packed([*formatted(*key, held)] if key else [])

    return sent.mapInArrow(run, WINDOWS)


def read_back(found: DataFrame) -> DataFrame:
    """``(conv_id, segment, window, n_turns, turns, loss, chars)`` of windows, from their texts and masks alone: ``turns`` are roles and
    texts of the turns that are not repeated, a line feed behind each, ``loss`` the text under the mask."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, "text"):
            out = ([], [], [], [])
            for text, repeated, starts, sizes in zip(*(batch.column(c).to_pylist() for c in ("text", "n_repeated", "loss_starts", "loss_sizes"))):
                turns = parse(text)[repeated:]
                out[0].append(len(turns))
                out[1].append("".join(f"{role}\n{said}\n" for role, said, *_ in turns))
                out[2].append("".join(unescape(text[s:s + n]) for s, n in zip(starts, sizes)))
                out[3].append(len(text))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("conv_id", "segment", "window")), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()),
                 pa.array(out[2], pa.string()), pa.array(out[3], pa.int64())], ["conv_id", "segment", "window", "n_turns", "turns", "loss", "chars"])

    return found.select("conv_id", "segment", "window", "n_repeated", "text", "loss_starts", "loss_sizes").mapInArrow(
        run, "conv_id long, segment long, window int, n_turns long, turns string, loss string, chars long")


def digests(found: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars)`` of the conversations of windows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                            ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
        state: list | None = None

        def ended() -> list[tuple]:
            return [(state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5])] if state else []

        for batch in text_chunks(batches, "turns"):
            done = []
            for conv, n, turns, loss, chars in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "n_turns", "turns", "loss", "chars"))):
                if state is None or state[0] != conv:
                    done += ended()
                    state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[1] += n
                state[2].update(turns.encode())
                state[3] += len(loss)
                state[4].update(loss.encode())
                state[5] += chars
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in done], schema)
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in ended()], schema)

    in_order = read_back(found).repartition("conv_id").sortWithinPartitions("conv_id", "segment", "window")
    return in_order.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
