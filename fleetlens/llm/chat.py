"""Chat formatting with a template that is only ever called, never looked into.

Successive prefixes of a conversation are rendered and consecutive outputs compared: what a turn adds is its
span. A probe text in the place of an assistant's text shows where, inside the span, the text stands. A
template whose output for a longer prefix does not begin with the output for the shorter one rewrites history.

A long conversation is rendered in blocks, each after a few turns of context, if no block shows that it depends
on the turns before; else it is rendered as a whole.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetlens.llm.memory import tidy
from fleetlens.session import materialize

#: role and text of the turns so far -> text
Template = Callable[[list[tuple[str, str]]], str]
#: Turns of a conversation that are rendered together; first turns, and turns just before, that are their context.
BLOCK, CONTEXT = 256, 4
#: Stands for a text; plain letters, which templates do not change.
PROBE = "zqProbeTextqz"

CONTROL, ESCAPED = re.compile(r"([\\<>\[])"), re.compile(r"([\\<>\[])\\")


def escape(text: str) -> str:
    """No control string is left: a backslash follows each backslash, angle bracket and ``[``."""
    return CONTROL.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def inst_template(turns: list[tuple[str, str]]) -> str:
    """``[INST] user [/INST]``, `` assistant </s>`` and ``<<role>> text <</role>>`` for other roles."""
    out = []
    for role, text in turns:
        if role == "user":
            out.append(f"[INST] {escape(text)} [/INST]")
        elif role == "assistant":
            out.append(f" {escape(text)} </s>")
        else:
            out.append(f"<<{escape(role)}>> {escape(text)} <</{escape(role)}>>")
    return "".join(out)


INST_TURN = re.compile(
    r"\[INST\] (?P<user>.*?) \[/INST\]| (?P<assistant>.*?) </s>"
    r"|<<(?P<role>(?:[^\\<>\[]|[\\<>\[]\\)*)>> (?P<other>.*?) <</(?P=role)>>", re.DOTALL)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """role and text of each turn, read back from the output of ``inst_template``."""
    out, at = [], 0
    while at < len(formatted):
        found = INST_TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        kind = found.lastgroup if found.lastgroup in ("user", "assistant") else "other"
        out.append((unescape(found["role"]) if kind == "other" else kind, unescape(found[kind])))
        at = found.end()
    return out


def spans(template: Template, context: list[tuple[str, str]], turns: list[tuple[str, str]],
          learnt: str = "assistant") -> tuple[str, list[tuple[int, int]], int | None]:
    """What ``turns`` add after ``context``; start and end of each learnt text in it; first turn that rewrites."""
    base = before = template(context) if context else ""
    marked, rewrites = [], None
    for n, (role, text) in enumerate(turns):
        so_far = [*context, *turns[:n]]
        after = template([*so_far, (role, text)])
        if not after.startswith(before):
            rewrites = n if rewrites is None else rewrites
        elif role == learnt and rewrites is None:
            head = template([*so_far, (role, PROBE)]).find(PROBE, len(before))
            if head < 0:
                raise ValueError(f"the template does not show the text of role {role!r}")
            tail = len(template([*so_far, (role, "")])) - head
            marked.append((head - len(base), len(after) - tail - len(base)))
        before = after
    return before[len(base):], marked if rewrites is None else [], rewrites


def depends(template: Template, context: list[tuple[str, str]], n_first: int, turns: list[tuple[str, str]],
            whole: bool) -> bool:
    """Whether ``turns`` rewrite history, or add another text if some of ``context`` is missing.

    ``n_first`` turns of the context begin the conversation. Nothing is left out if the context is ``whole``. A
    template that fails on a part of the conversation depends on the rest.
    """
    def added(before: list[tuple[str, str]]) -> str | None:
        base, text = template(before) if before else "", template([*before, *turns])
        return text[len(base):] if text.startswith(base) else None

    try:
        if spans(template, context, turns, learnt="")[2] is not None:
            return True
        if whole:
            return False
        first, late = context[:n_first], context[n_first:]
        return not context or len({added(c) for c in (context, late, first + late[1:])}) > 1
    except Exception:  # whatever the template raises; it is raised again if the whole conversation raises it
        return True


def _groups(parts: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Key and rows of each group of rows that come sorted by the first columns."""
    key, rows = None, []
    for part in parts:
        for row in zip(*(c.to_pylist() for c in part.columns)):
            if rows and row[:n_keys] != key:
                yield key, rows
                rows = []
            key = row[:n_keys]
            rows.append(row[n_keys:])
    if rows:
        yield key, rows


def _in_blocks(turns: DataFrame, block: int, context: int) -> DataFrame:
    """Turns at ``pos`` of ``total`` in their block, and copies in the blocks whose context they are."""
    own, last = F.floor(F.col("pos") / block), F.floor((F.col("total") - 1) / block)
    none = F.array().cast("array<bigint>")
    late = F.when((F.pmod("pos", F.lit(block)) >= block - context) & (own < last), F.array(own + 1)).otherwise(none)
    first = F.when((F.col("pos") < context) & (own < last), F.sequence(own + 1, last)).otherwise(none)

    def places(blocks: Column, before: bool) -> Column:
        return F.transform(blocks, lambda b: F.struct(b.alias("block"), F.lit(before).alias("before")))

    return turns.select("conv_id", "pos", "turn", "role", "text", F.explode(F.concat(
        places(F.array(own), False), places(F.array_union(late, first), True))).alias("p")) \
        .select("conv_id", "p.block", "pos", "turn", "role", "text", "p.before")


def _dealt(placed: DataFrame) -> DataFrame:
    return placed.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "pos", "turn", "role", "text")


def format_conversations(conversations: DataFrame, template: Template = inst_template, block: int = BLOCK,
                         context: int = CONTEXT, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, block, n_turns, formatted, loss (array of start, end in code points), rewrites, whole.

    A row per ``block`` turns of a conversation, by their position in it; ``formatted`` of its blocks joined in
    order is the conversation. ``whole``: the block was rendered after all turns before it. Later blocks of a
    long conversation are rendered after its ``context`` first turns and the ``context`` turns just before the
    block. If one of them rewrites history, adds another text when some of this context is missing, or fails,
    the whole conversation is rendered prefix by prefix, which takes time that grows with the square of its
    length, and is one row, with block 0. A template that depends only on turns that are no block's context, in a
    way that does not show in these comparisons, cannot be told from one that does not: rows that rest on the
    comparison have ``whole`` false. ``rewrites`` is the position of the first turn that rewrites, or null.
    Turns are ordered by turn, role, text, nulls first; repeated rows are turns of their own. Numbers may be
    sparse or negative. Null role and text are empty; rows without conv_id are one conversation. Other columns
    are ignored.
    """
    turns = conversations.select(
        F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))]) \
        .withColumn("bucket", F.floor(F.col("turn") / block))

    # Positions come from the counts of buckets of numbers, so that a long conversation is not sorted in one task.
    of_conv = Window.partitionBy("conv_id")
    before = of_conv.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    long = materialize(turns.groupBy("conv_id", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("conv_id").alias("l_conv"), F.col("bucket").alias("l_bucket"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(of_conv).alias("total"))
        .filter(F.col("total") > block), "long-conversations")

    def alone(table: DataFrame) -> DataFrame:
        return table.select("conv_id", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("pos"), "turn",
                            "role", "text", F.lit(False).alias("before"))

    if long.isEmpty():
        placed = alone(turns)
    else:
        counted = turns.join(long, F.col("conv_id").eqNullSafe(F.col("l_conv"))
                             & F.col("bucket").eqNullSafe(F.col("l_bucket")), "left")
        rank = F.row_number().over(Window.partitionBy("conv_id", "bucket").orderBy("turn", "role", "text"))
        parts = _in_blocks(counted.filter("total IS NOT NULL").withColumn("pos", F.col("start") + rank - 1), block, context)

        def looking_back(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for key, rows in _groups(groups, 2):
                early, here = ([(role, text) for _, _, role, text, before in rows if before == x] for x in (True, False))
                n_first = sum(before and pos < context for pos, *_, before in rows)
                if depends(template, early, n_first, here, len(early) == key[1] * block):
                    yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64())], ["far_conv"])

        far = materialize(_dealt(parts).mapInArrow(tidy(looking_back), "far_conv long").distinct(), "looking-back")
        same = F.col("conv_id").eqNullSafe(F.col("far_conv"))
        placed = alone(counted.filter("total IS NULL")).unionByName(parts.join(far, same, "left_anti"))
        if not far.isEmpty():
            placed = placed.unionByName(alone(counted.filter("total IS NOT NULL").join(far, same, "left_semi")))

    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("n_turns", pa.int64()), ("formatted", pa.string()),
                        ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                        ("rewrites", pa.int64()), ("whole", pa.bool_())])

    def rendered(key: tuple, rows: list[tuple]) -> dict:
        early, here = ([(role, text) for _, _, role, text, before in rows if before == x] for x in (True, False))
        formatted, marked, rewrites = spans(template, early, here)
        return {"conv_id": key[0], "block": key[1], "n_turns": len(here), "formatted": formatted,
                "loss": [{"start": a, "end": b} for a, b in marked], "rewrites": rewrites,
                "whole": len(early) == key[1] * block}

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for key, rows in _groups(parts, 2):
            out.append(rendered(key, rows))
            size += len(out[-1]["formatted"])
            if size > 1 << 22:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    return _dealt(placed).mapInArrow(tidy(batches), "conv_id long, block long, n_turns long, formatted string, "
                                     "loss array<struct<start:long,end:long>>, rewrites long, whole boolean")


def digests(formatted: DataFrame) -> DataFrame:
    """Per conversation what can be read back from the output of ``format_conversations`` with ``inst_template``.

    conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, rewrites. The digests run over
    the blocks of a conversation in order, so no conversation is held as a whole.
    """
    schema = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), ("n_turns", pa.int64()), ("turns", pa.string()),
                        ("learnt", pa.string()), ("chars", pa.int64()), ("rewrites", pa.bool_())])

    def read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for x in part.to_pylist():
                turns = read_turns(x["formatted"])
                out.append({"conv_id": x["conv_id"], "block": x["block"], "n_turns": len(turns),
                            "turns": "".join(f"{role}\n{text}\n" for role, text in turns),
                            "learnt": "".join(unescape(x["formatted"][s["start"]:s["end"]]) for s in x["loss"]),
                            "chars": len(x["formatted"]), "rewrites": x["rewrites"] is not None})
            yield pa.RecordBatch.from_pylist(out, schema)

    result = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
                        ("rewrites", pa.bool_())])

    def summed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = object(), None, []

        def row() -> dict:
            n, turns, chars, learnt, total, rewrites = state
            return {"conv_id": key, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": chars,
                    "loss_sha256": learnt.hexdigest(), "formatted_chars": total, "rewrites": rewrites}

        for part in parts:
            for conv, n, turns, learnt, chars, rewrites in zip(*(part[c].to_pylist() for c in (
                    "conv_id", "n_turns", "turns", "learnt", "chars", "rewrites"))):
                if state is None or conv != key:
                    out += [row()] if state else []
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, False]
                state[0] += n
                state[1].update(turns.encode())
                state[2] += len(learnt)
                state[3].update(learnt.encode())
                state[4] += chars
                state[5] |= rewrites
            if len(out) > 1000:
                yield pa.RecordBatch.from_pylist(out, result)
                out = []
        if state:
            yield pa.RecordBatch.from_pylist([*out, row()], result)

    back = formatted.mapInArrow(tidy(read), "conv_id long, block long, n_turns long, turns string, learnt string, "
                                      "chars long, rewrites boolean")
    ordered = back.repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return ordered.mapInArrow(tidy(summed), "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                      "loss_sha256 string, formatted_chars long, rewrites boolean")
