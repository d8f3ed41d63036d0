"""Conversations as training windows of a token budget, with a loss mask.

Template: `<|im_start|>ROLE\\nTEXT<|im_end|>\\n` per turn. In texts and roles a
backslash is doubled and `<|` becomes `<\\|`, so a control string can only come
from the template, and both are undone when a window is read; a line break in a
role becomes `\\n`.

Windows: prefix sums of the turns' tokens choose spans of whole turns. A span
takes turns as long as they, the system turn and the repeated history stay
within the budget. Every window but the one that holds it as its own begins with
the conversation's system turn, then repeats as many of the last turns as fit
`history` tokens, and fewer, from the oldest on, where the turn that opens the
span would not fit else. So a window is over the budget only if the system turn
and one own turn are. The loss mask covers the assistant texts of a window's own
turns only, so each target counts once.

A conversation is dealt out by blocks of `block_turns` turn numbers, each with
its system turn and its history: the last turns before it, of as many blocks as
they take, chosen by sums of tokens from the blocks' ends. So a conversation with
a third of all rows spreads over tasks. A task streams through sorted rows and
holds one window; spans do not cross a block's end.

Defined results: turns are ordered by (turn, role, text), null turns first; a
null role or text is empty; repeated rows are turns of their own; the system
turn is the first row with the role `system`; a null conversation id is an id
like any other; an empty table gives no windows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinestar.llm.vocabularies import ByteLevelIds

START, END = "<|im_start|>", "<|im_end|>"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_SYSTEM, _HISTORY, _OWN = 0, 1, 2


@dataclass(frozen=True)
class ChatWindows:
    """Tokens of a window, tokens of repeated history, turn numbers per block."""

    budget: int = 2048
    history: int = 256
    block_turns: int = 256


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def unescape_role(role: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], role)


def format_turn(role: str, text: str) -> tuple[str, int]:
    """A formatted turn and where its text begins in it."""
    head = f"{START}{escape_role(role)}\n"
    return f"{head}{escape(text)}{END}\n", len(head)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) of each turn of a formatted window."""
    turns = []
    for part in formatted.split(START)[1:]:
        role, _, rest = part.partition("\n")
        turns.append((unescape_role(role), unescape(rest[: -len(END) - 1])))
    return turns


class _Turn:
    __slots__ = ("formatted", "start", "end", "tokens", "target")

    def __init__(self, role: str, text: str, tokens: int) -> None:
        self.formatted, self.start = format_turn(role, text)
        self.end = len(self.formatted) - len(END) - 1
        self.target = role == "assistant"
        self.tokens = tokens


class _Block:
    """The rows of one block of a conversation, in order, to windows."""

    def __init__(self, key: tuple, settings: ChatWindows) -> None:
        self.key, self.settings = key, settings
        self.system: _Turn | None = None
        self.recent: list[_Turn] = []  # turns before the span, as many as history may take
        self.span: list[_Turn] = []
        self.own_system: _Turn | None = None  # the system turn, if it is one of the span
        self.n_windows = 0

    def _remember(self, turn: _Turn) -> None:
        self.recent.append(turn)
        while self.recent and sum(t.tokens for t in self.recent) > self.settings.history:
            self.recent.pop(0)

    def _repeated(self) -> list[_Turn]:
        if self.system is None or self.own_system:
            return list(self.recent)
        return [self.system, *self.recent]

    def add(self, kind: int, turn: _Turn, is_system: bool) -> dict | None:
        """Take a row; a window, if the row has to open the next one."""
        if kind == _SYSTEM:
            self.system = turn
            return None
        if kind == _HISTORY:
            if not is_system:
                self._remember(turn)
            return None
        window = None
        if self.span and self._size(turn, is_system) > self.settings.budget:
            window = self.close()
        while not self.span and self.recent and self._size(turn, is_system) > self.settings.budget:
            self.recent.pop(0)
        if is_system:
            self.own_system = turn
        self.span.append(turn)
        return window

    def _size(self, turn: _Turn, is_system: bool) -> int:
        """Tokens of the window with this turn as one more of its own."""
        repeated = self.recent if is_system else self._repeated()
        return sum(t.tokens for t in repeated) + sum(t.tokens for t in self.span) + turn.tokens

    def close(self) -> dict | None:
        if not self.span:
            return None
        repeated = self._repeated()
        text, mask = "", []
        for k, turn in enumerate([*repeated, *self.span]):
            if k >= len(repeated) and turn.target:
                mask.append({"start": len(text) + turn.start, "end": len(text) + turn.end})
            text += turn.formatted
        tokens = sum(t.tokens for t in repeated) + sum(t.tokens for t in self.span)
        window = {
            "conv_id": self.key[0],
            "block": self.key[1],
            "window": self.n_windows,
            "text": text,
            "loss_spans": mask,
            "n_repeated": len(repeated),
            "n_tokens": tokens,
            "over_budget": tokens > self.settings.budget,
        }
        for turn in self.span:
            if turn is not self.own_system:
                self._remember(turn)
        self.span, self.own_system = [], None
        self.n_windows += 1
        return window


_WINDOW = (
    "conv_id bigint, block bigint, window int, text string, "
    "loss_spans array<struct<start:bigint,end:bigint>>, n_repeated int, n_tokens bigint, "
    "over_budget boolean"
)
_WINDOW_ARROW = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("block", pa.int64()),
        ("window", pa.int32()),
        ("text", pa.string()),
        ("loss_spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ("n_repeated", pa.int32()),
        ("n_tokens", pa.int64()),
        ("over_budget", pa.bool_()),
    ]
)


def _with_tokens(turns: DataFrame) -> DataFrame:
    """Add the tokens of each formatted turn."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ByteLevelIds()
        for batch in batches:
            texts = zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)
            tokens = [len(tokenizer.ids(format_turn(role, text)[0])) // 4 for role, text in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tokens, pa.int64())], [*batch.schema.names, "tokens"])

    return turns.mapInArrow(run, T.StructType([*turns.schema.fields, T.StructField("tokens", T.LongType())]))


def _history(own: DataFrame, keys: DataFrame, settings: ChatWindows) -> DataFrame:
    """The turns that blocks begin with as their history, with `block` that of the block they go to.

    A turn goes to each later block before which it and all turns after it have
    `history` tokens at most. A turn has a token at least, so the blocks that a
    block looks back to are bounded.
    """
    last_first = Window.partitionBy("conv_id", "block").orderBy(
        F.desc("turn"), F.desc("role"), F.desc("text")
    ).rowsBetween(Window.unboundedPreceding, 0)
    ends = own.where(~F.col("is_system")).withColumn("upto", F.sum("tokens").over(last_first))
    ends = ends.where(F.col("upto") <= settings.history)
    # Blocks of a conversation in order; most conversations have one, and drop out.
    order = Window.partitionBy("conv_id").orderBy("block")
    sums = keys.withColumn("sum", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    earlier = F.collect_list(F.struct("block", "sum")).over(order.rowsBetween(-settings.history - 1, -1))
    leads = sums.withColumn("all", earlier).withColumn("earlier", F.explode("all")).select(
        F.col("conv_id").alias("c"),
        F.col("earlier.block").alias("b"),
        F.col("block").alias("to"),
        # Tokens of the blocks between the two.
        (F.col("sum") - F.col("tokens") - F.col("earlier.sum")).alias("between"),
    )
    leads = leads.where(F.col("between") < settings.history)
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))
    sent = ends.join(leads, same).where(F.col("upto") + F.col("between") <= settings.history)
    return sent.withColumns({"block": F.col("to"), "kind": F.lit(_HISTORY)})


def windows(conversations: DataFrame, settings: ChatWindows = ChatWindows()) -> DataFrame:
    """Windows of (conv_id, turn, role, text): text, loss spans, repeated turns, tokens."""
    width = settings.block_turns
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.floor(F.col("turn") / width).cast("bigint").alias("block"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # Null turns come first: they join the first block.
    first = rows.groupBy("conv_id").agg(
        F.min("block").alias("first"),
        F.min(
            F.when(F.col("role") == "system", F.struct(F.col("turn").isNotNull(), "turn", "text"))
        ).alias("system"),
    )
    first = first.select(
        F.col("conv_id").alias("c"),
        "first",
        F.col("system.turn").alias("s_turn"),
        F.col("system.text").alias("s_text"),
        F.col("system").isNotNull().alias("has_system"),
    )
    rows = rows.join(first, F.col("conv_id").eqNullSafe(F.col("c"))).withColumn(
        "block", F.coalesce("block", "first", F.lit(0))
    )
    is_system = (
        F.col("has_system")
        & (F.col("role") == "system")
        & F.col("turn").eqNullSafe(F.col("s_turn"))
        & (F.col("text") == F.col("s_text"))
    )
    own = _with_tokens(
        rows.select("conv_id", "block", "turn", "role", "text", "has_system", "s_text", is_system.alias("is_system"))
    )
    own = own.withColumn("kind", F.lit(_OWN))
    keys = own.groupBy("conv_id", "block").agg(
        F.first("has_system").alias("has_system"),
        F.first("s_text").alias("s_text"),
        F.sum(F.when(~F.col("is_system"), F.col("tokens")).otherwise(0)).alias("tokens"),
    )
    columns = ("conv_id", "block", "kind", "turn", "role", "text", "tokens", "is_system")
    tail = _history(own, keys, settings).select(*columns)
    system = _with_tokens(
        keys.where("has_system").select(
            "conv_id", "block", F.lit("system").alias("role"), F.col("s_text").alias("text")
        )
    ).withColumns({"kind": F.lit(_SYSTEM), "turn": F.lit(None).cast("bigint"), "is_system": F.lit(True)})
    own, system = own.select(*columns), system.select(*columns)
    dealt = own.unionByName(tail).unionByName(system).repartition("conv_id", "block")
    ordered = dealt.sortWithinPartitions("conv_id", "block", "kind", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, out, seen = None, [], False
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["conv_id"], row["block"])
                if block is None or block.key != key:
                    out.append(block.close() if block else None)
                    block, seen = _Block(key, settings), False
                turn = _Turn(row["role"], row["text"], row["tokens"])
                # Of repeated rows that equal the system turn, the first one is it.
                is_first = row["is_system"] and not (seen and row["kind"] == _OWN)
                seen |= row["is_system"] and row["kind"] == _OWN
                out.append(block.add(row["kind"], turn, is_first))
                out = [w for w in out if w]
                if len(out) >= 500:
                    yield pa.RecordBatch.from_pylist(out, _WINDOW_ARROW)
                    out = []
        out.append(block.close() if block else None)
        yield pa.RecordBatch.from_pylist([w for w in out if w], _WINDOW_ARROW)

    return ordered.mapInArrow(run, _WINDOW)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, from its windows alone: digests of its turns and of its targets.

    A digest over a whole conversation is sequential by nature: the windows of
    one conversation stream through one task, one at a time.
    """
    ordered = (
        formatted.select("conv_id", "block", "window", "text", "loss_spans", "n_repeated")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "block", "window")
    )
    schema = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
            ("n_windows", pa.int64()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, current = [], None

        def finish() -> None:
            if current is not None:
                current["turns_sha256"] = current["turns_sha256"].hexdigest()
                current["loss_sha256"] = current["loss_sha256"].hexdigest()
                done.append(current)

        for batch in batches:
            for row in batch.to_pylist():
                if current is None or current["conv_id"] != row["conv_id"]:
                    finish()
                    current = dict.fromkeys(schema.names, 0) | {
                        "conv_id": row["conv_id"],
                        "turns_sha256": hashlib.sha256(),
                        "loss_sha256": hashlib.sha256(),
                    }
                for role, text in read_turns(row["text"])[row["n_repeated"] :]:
                    current["n_turns"] += 1
                    current["turns_sha256"].update(f"{role}\n{text}\n".encode())
                for span in row["loss_spans"]:
                    target = unescape(row["text"][span["start"] : span["end"]])
                    current["loss_chars"] += len(target)
                    current["loss_sha256"].update(target.encode())
                current["formatted_chars"] += len(row["text"])
                current["n_windows"] += 1
            if len(done) >= 1000:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        finish()
        yield pa.RecordBatch.from_pylist(done, schema)

    return ordered.mapInArrow(
        run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
        "loss_sha256 string, formatted_chars bigint, n_windows bigint",
    )
