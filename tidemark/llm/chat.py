"""Chat formatting in budgeted windows.

A conversation's turns are numbered and their tokens summed up in order. The prefix sums are cut
by a grid as wide as a window's room for new turns: turns that lie in one cell form a span; a turn
that reaches over a grid line joins the turns of the cell it ends in if all fit together, and
otherwise is a span by itself. So a turn's span follows from its own prefix sum and its cell's,
however long the conversation is, and no window exceeds the budget unless a single turn does.

A window is the system turn (the first turn, if its role is ``system``), then as many whole turns
just before the span as fit the history's budget, then the span. Only assistant texts of the span
are targets: a target that is repeated as history is masked, so each is learnt from exactly once.

``<|im_start|>role\\ntext<|im_end|>\\n`` marks a turn. Inside roles and texts a backslash is put
after the ``<`` of every ``<|``, ``<\\|``, ``<\\\\|`` and so on, which one rule undoes; a role's own line
breaks and backslashes are escaped too.

Defined cases: NULL roles and texts are empty; turns are ordered by turn (NULL first), then role,
then text, and equal rows are repeated turns; rows with a NULL conversation id are one
conversation; a window over the budget is marked ``over_budget``; no turns give no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sequence import null_safe_join, running_totals
from . import byte_bpe
from .common import staged

START, END = "<|im_start|>", "<|im_end|>\n"
#: Tokens that the template adds to a turn.
MARKS = 5


def escape(text: Column) -> Column:
    """Puts one more backslash into every run ``<``, backslashes, ``|``."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def escape_role(role: Column) -> Column:
    plain = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return F.replace(plain, F.lit("|"), F.lit("\\p"))


def head(role: Column) -> Column:
    """What stands before a turn's text."""
    return F.concat(F.lit(START), escape_role(role), F.lit("\n"))


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "p": "|"}.get(m[1], m[1]), role)


def token_estimate(text: Column) -> Column:
    """A quarter of the UTF-8 bytes, at least 1 for a text; any other count may be passed instead."""
    return F.ceil(F.octet_length(text) / 4).cast("long")


def with_tokens(
    turns: DataFrame, path: str, pattern: str, role: str = "role", text: str = "text", out: str = "turn_tokens"
) -> DataFrame:
    """``turns`` with the number of tokens of each formatted turn, marks and escapes included, under the
    byte-level ranks at ``path``. A turn ends with a line break behind a sign and the next begins with a
    sign, where the pattern splits: the numbers of a window's turns sum up to the window's own."""
    whole = F.concat(head(F.coalesce(F.col(role).cast("string"), F.lit(""))),
                     escape(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.lit(END))
    encoded = byte_bpe.encode(turns.withColumn("_whole", whole), path, pattern, text="_whole", ids="_ids")
    # written once: the range partitioning of ``windows`` reads its rows twice, to sample them and to deal them
    return staged(encoded.withColumn(out, F.size("_ids").cast("long")).drop("_whole", "_ids"), "chat-counted")


def windows(
    turns: DataFrame, budget: int = 1024, history: int = 256, conv_id: str = "conv_id", turn: str = "turn",
    role: str = "role", text: str = "text", tokens=token_estimate, counted: str | None = None,
) -> DataFrame:
    """(conv_id, first_turn, n_repeated, n_turns, n_tokens, over_budget, formatted, loss).

    A turn's tokens are ``tokens`` of its text and ``MARKS``, or the column ``counted`` if one is named
    (see ``with_tokens``). Texts are joined to the finished lists of turns once, at the end.

    ``first_turn`` numbers the window's first new turn from 1, ``n_repeated`` counts the turns before
    it (system and history), ``loss`` lists the targets' (start, end) in code points of ``formatted``."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text"))]
    number = F.greatest(F.col(counted).cast("long"), F.lit(1)) if counted else None
    rows = turns.select(F.col(conv_id).alias("conv"), F.col(turn).alias("turn"), *texts, *([number.alias("tokens")] if counted else []))
    if not counted:
        rows = rows.withColumn("tokens", tokens(F.col("text")) + MARKS)
    placed = running_totals(rows, ["conv"], ["turn", "role", "text"], "tokens")
    placed = staged(placed.select("conv", "position", "role", "text", "tokens", "running"), "chat-turns")
    said = placed.select("conv", "position", "role", "text")
    placed = placed.select("conv", "position", "tokens", "running", ((F.col("position") == 1) & (F.col("role") == "system")).alias("leads"))
    system = placed.where("leads").select("conv", F.col("tokens").alias("system_tokens"))
    placed = null_safe_join(placed, system, ["conv"], "left")
    room = F.greatest(F.lit(budget - history) - F.coalesce("system_tokens", F.lit(0)), F.lit(1))
    cell = F.floor((F.col("running") - F.col("tokens")) / room)
    last = F.floor((F.col("running") - 1) / room)
    placed = placed.select("*", room.alias("room"), last.alias("cell"), (cell < last).alias("across"))

    # spans: (cell, across) is one span, or both together where they fit into the room
    key = ["conv", "cell", "across"]
    spans = placed.groupBy(*key).agg(
        F.min("position").alias("first_turn"), F.max("position").alias("last_turn"),
        F.min(F.col("running") - F.col("tokens")).alias("from"), F.sum("tokens").alias("tokens"),
        F.first("room").alias("room"))
    pair = Window.partitionBy("conv", "cell")  # two rows at most
    fits = F.sum("tokens").over(pair) <= F.col("room")
    spans = spans.select("conv", "cell", "across", (F.col("across") & ~fits).alias("alone"), "first_turn", "last_turn", "from")
    spans = spans.groupBy("conv", "cell", "alone").agg(
        F.min("first_turn").alias("first_turn"), F.max("last_turn").alias("last_turn"), F.min("from").alias("from"))

    # a window's turns: those of its span and those that begin at most ``history`` tokens before it;
    # both sides are filed by cells of the prefix sum, so that no key holds more than a cell's turns
    width = max(history, 1)
    begins = F.col("running") - F.col("tokens")
    filed = placed.select(
        F.col("conv"), F.floor(begins / width).alias("strip"), "position", "tokens", "leads",
        begins.alias("begins"))
    ends = spans.select(
        "conv", "first_turn", F.col("from"), F.explode(F.sequence(
            F.floor(F.greatest(F.col("from") - history, F.lit(0)) / width), F.floor(F.col("from") / width))).alias("strip"))
    before = null_safe_join(ends, filed, ["conv", "strip"]).where(
        (F.col("position") < F.col("first_turn")) & (F.col("begins") >= F.col("from") - history)
    ).where(~F.col("leads")).select("conv", "first_turn", "position", "tokens", F.lit(False).alias("new"))
    merged = null_safe_join(placed.select("conv", "cell", "position", "tokens"), spans, ["conv", "cell"]).where(
        F.col("position").between(F.col("first_turn"), F.col("last_turn")))
    own = merged.select("conv", "first_turn", "position", "tokens", F.lit(True).alias("new"))
    lead = null_safe_join(spans.select("conv", "first_turn"), system, ["conv"]).where("first_turn > 1").select(
        "conv", "first_turn", F.lit(1).cast("long").alias("position"), F.col("system_tokens").alias("tokens"), F.lit(False).alias("new"))
    parts = null_safe_join(before.unionByName(own).unionByName(lead), said, ["conv", "position"])

    piece = F.struct(
        "position", "new", "tokens", (F.col("new") & (F.col("role") == "assistant")).alias("target"),
        head(F.col("role")).alias("head"), escape(F.col("text")).alias("body"))
    # a list is bounded by the budget: every turn has at least one token
    listed = parts.groupBy("conv", "first_turn").agg(F.array_sort(F.collect_list(piece)).alias("turns"))
    sizes = F.transform("turns", lambda t: F.length(t["head"]) + F.length(t["body"]) + len(END))
    ends_at = F.transform(F.sequence(F.lit(1), F.size("turns")), lambda i: F.aggregate(
        F.slice("sizes", F.lit(1), i), F.lit(0), lambda a, b: a + b) - len(END))
    texts = F.zip_with("turns", "ends", lambda t, e: F.struct(
        t["target"].alias("target"), (e - F.length(t["body"])).alias("start"), e.alias("end")))
    loss = F.transform(F.filter(texts, lambda x: x["target"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    out = listed.withColumn("sizes", sizes).withColumn("ends", ends_at)
    total = F.aggregate("turns", F.lit(0).cast("long"), lambda a, t: a + t["tokens"])
    return out.select(
        F.col("conv").alias("conv_id"), "first_turn",
        F.size(F.filter("turns", lambda t: ~t["new"])).cast("long").alias("n_repeated"),
        F.size("turns").cast("long").alias("n_turns"), total.alias("n_tokens"), (total > budget).alias("over_budget"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        loss.alias("loss"))


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted window."""
    out = []
    for turn in formatted.split(START)[1:]:
        role, _, text = turn.partition("\n")
        out.append((unescape_role(role), unescape(text.removesuffix(END))))
    return out


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) read from windows.

    A digest needs its conversation's windows in order: they come sorted, and are hashed as they
    stream by, so that no conversation is held in memory."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = object(), None, []
        for batch in batches:
            for row in batch.to_pylist():
                if state is None or row["conv_id"] != now:
                    if state is not None:
                        done.append(state)
                    now = row["conv_id"]
                    state = [now, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, text in parse(row["formatted"])[row["n_repeated"]:]:
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                for span in row["loss"]:
                    text = unescape(row["formatted"][span["start"]:span["end"]])
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(row["formatted"])
            yield _digests(done)
            done = []
        if state is not None:
            yield _digests([state])

    kept = formatted.select(F.col("conv_id").cast("long").alias("conv_id"), "first_turn", "n_repeated", "formatted", "loss")
    return kept.repartition("conv_id").sortWithinPartitions("conv_id", "first_turn").mapInArrow(run, schema)


def _digests(states: list[list]) -> pa.RecordBatch:
    columns = list(zip(*[(a, b, c.hexdigest(), d, e.hexdigest(), f) for a, b, c, d, e, f in states])) or [()] * 6
    kinds = pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
