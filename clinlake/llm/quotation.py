"""Quotation linking: who answers whom, and what is left without the quotes.

A message's lines carry a quote level: the number of ``>`` marks in front of
them, each with at most one space behind it.  Consecutive lines of a level
above zero form a quoted passage (a passage ends where the level changes and
at an attribution line of any level).
A passage is normalised (quote marks and attribution lines off, words
lower-cased and joined by one space) and hashed.  Own lines are split into
paragraphs at blank lines and at quoted lines.  A passage is linked to the
messages of the same conversation that hold its words as one or more
consecutive whole own lines, however many, and however the quote is wrapped.
Of several, the nearest earlier turn is the original.  A part of a line is no
original of a passage.

Runs of lines are hashed only at lengths that their conversation quotes, and
quotes and runs of one hash are sorted by turn together, so a very common line
costs rows in proportion to the messages that hold or quote it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clinlake.llm import stages
from clinlake.llm.text import pieces as text_pieces

# ASCII classes, and a dot that stops at every line end.
MARKS = re.compile(r"^\s{0,3}((?:>\s?)+)", re.ASCII)
ATTRIBUTION = re.compile(r"^\s*(?:on .{0,200} wrote|.{0,120} (?:writes|schrieb|escribió|a écrit))\s*:\s*$".replace(
    ".{", r"[^\n\r\x85\u2028\u2029]{"), re.ASCII | re.IGNORECASE)
_VISIBLE = re.compile(r"\S", re.ASCII)
_LINE_END = re.compile(r"\r\n?")
_NO_WORD = regex.compile(r"[^\p{L}\p{N}]+")


def normalised(text: str) -> str:
    return _NO_WORD.sub(" ", text.lower()).strip(" ")


def passages(text: str) -> tuple[int, list[tuple[int, str]], str]:
    """The highest quote level of a text's lines, its quoted passages as
    (level, normalised words), and its own paragraphs, joined by blank lines.

    Consecutive lines of one level are a run; blank own lines and attribution
    lines end a run and are part of none, and runs of blank lines are none.
    """
    highest, level, held = 0, -1, []
    quotes, own = [], []

    def push() -> None:
        whole = "\n".join(held)
        if level >= 0 and _VISIBLE.search(whole):
            own.append(whole) if level == 0 else quotes.append((level, normalised(whole)))

    for line in _LINE_END.sub("\n", text).split("\n"):
        marks = MARKS.match(line)
        at = marks.group(1).count(">") if marks else 0
        body = line[marks.end():] if marks else line
        highest = max(highest, at)
        if ATTRIBUTION.match(body) or (at == 0 and not body.strip(" ")):
            push()
            level, held = -1, []
        elif at == level:
            held.append(body)
        else:
            push()
            level, held = at, [body]
    push()
    return highest, quotes, "\n\n".join(own)


def _parsed(messages: DataFrame) -> DataFrame:
    """``messages`` with the parts of their text (see `passages`) in its place."""
    kept = [f for f in messages.schema.fields if f.name != "text"]
    schema = T.StructType([*kept, T.StructField("max_level", T.LongType()), T.StructField("own_text", T.StringType()), T.StructField(
        "quotes", T.ArrayType(T.StructType([T.StructField("level", T.IntegerType()), T.StructField("norm", T.StringType())])))])
    quote = pa.list_(pa.struct([("level", pa.int32()), ("norm", pa.string())]))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_pieces(batches):
            highest, quotes, own = zip(*[passages(t or "") for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f.name) for f in kept], pa.array(highest, pa.int64()), pa.array(own, pa.string()),
                 pa.array([[{"level": n, "norm": x} for n, x in q] for q in quotes], quote)], schema.fieldNames())

    return messages.mapInArrow(parse, schema)


def _key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def link_quotes(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text") -> DataFrame:
    """One row per row of ``messages``: ``conv_id``, ``turn``, ``role``,
    ``own_text`` (without quotes and attribution lines), ``n_quotes``,
    ``max_level``, ``n_linked``, ``parent_turn``, ``depth``.

    ``parent_turn`` is the original of the message's last linked passage of
    the lowest level it quotes; without one it is the turn before (null for
    the first).  ``depth`` is the number of messages of earlier turns in its
    conversation; `reply_order` adds its place in the reply tree.  A null text has no lines and an empty ``own_text``.  Rows
    with a null conversation or turn are kept and linked to nothing; rows of
    equal conversation and turn are each a message, and quotes link to the
    turn.  Repeated rows give repeated results, an empty table none.  Other
    columns are not read.
    """
    base = messages.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                           F.col(f"`{role_col}`").cast("string").alias("role"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # Equal rows are one message until the end, told apart by what they hold.
    base = base.withColumn("row_key", _key(F.concat_ws("\x1f", F.to_json(F.struct("conv_id", "turn", "role", "text")))))
    counted = base.groupBy("row_key").agg(*[F.first(c).alias(c) for c in ("conv_id", "turn", "role", "text")], F.count(F.lit(1)).alias("rows"))
    parsed = stages.store(_parsed(counted), "chat-parts")
    quotes = (parsed.select("row_key", "conv_id", "turn", F.posexplode("quotes").alias("at", "q"))
              .select("row_key", "conv_id", "turn", "at", "q.level", "q.norm")
              .where("norm <> '' and conv_id is not null and turn is not null").withColumn("hash", _key(F.col("norm"))))

    originals = _nearest(quotes.select("conv_id", "hash", "turn").distinct(), _whole_lines(parsed, quotes))
    originals = quotes.join(originals, ["conv_id", "hash", "turn"])
    per_message = originals.groupBy("row_key").agg(
        F.count(F.lit(1)).alias("n_linked"), F.min(F.struct("level", (-F.col("at")).alias("last"), "source")).alias("best"))
    placed = parsed.join(_turns(parsed), ["conv_id", "turn"], "left").join(per_message, "row_key", "left")
    return (placed.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
            .select("conv_id", "turn", "role", "own_text",
                    F.size("quotes").cast("long").alias("n_quotes"), "max_level",
                    F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
                    F.coalesce("best.source", "previous").alias("parent_turn"), "depth"))


def line_runs(own_text: str, lengths: np.ndarray) -> list[bytes]:
    """The md5 of every run of whole lines that is, normalised, as long as one of ``lengths``."""
    lines = [x for x in map(normalised, own_text.split("\n")) if x]
    whole, ends = " ".join(lines), np.cumsum([len(x) + 1 for x in lines]) - 1
    starts = np.append(0, ends[:-1] + 1) if lines else ends
    found = set()
    for n in lengths[lengths <= len(whole)].tolist():
        found.update(whole[end - n:end] for end in np.intersect1d(starts + n, ends, assume_unique=True).tolist())
    return [hashlib.md5(x.encode()).digest() for x in found]


def _whole_lines(parsed: DataFrame, quotes: DataFrame) -> DataFrame:
    """``(conv_id, hash, source)``: the runs of whole own lines of each turn that
    are as long, normalised, as some passage of their conversation.

    Of every run between two line ends only those of a length that is quoted are
    hashed, so a run may be of any length and none is listed for nothing.
    """
    quoted = quotes.groupBy("conv_id").agg(F.collect_set(F.length("norm")).alias("lengths"))
    own = (parsed.where("conv_id is not null and turn is not null and own_text <> ''").select("conv_id", "turn", "own_text")
           .join(quoted, "conv_id"))
    schema = T.StructType([own.schema["conv_id"], T.StructField("hash", T.BinaryType()), T.StructField("source", T.LongType())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_pieces(batches, 256):
            found = [line_runs(t, np.array(n)) for t, n in zip(b.column("own_text").to_pylist(), b.column("lengths").to_pylist())]
            of = pa.array(np.repeat(np.arange(len(found)), [len(x) for x in found]))
            yield pa.RecordBatch.from_arrays([b.column("conv_id").take(of), pa.array([h for x in found for h in x], pa.binary()), b.column("turn").take(of)],
                                             schema.fieldNames())

    return own.mapInArrow(hashed, schema).distinct()


def _nearest(quotes: DataFrame, sources: DataFrame, span: int = 4096) -> DataFrame:
    """``quotes`` (conv_id, hash, turn) with ``source``, the nearest earlier turn of
    ``sources`` of that hash; those without one are left out.  Both sides are
    sorted by turn together, in spans, so no pairs are made."""
    events = (quotes.withColumn("source", F.lit(None).cast("long")).unionByName(sources.withColumn("turn", F.col("source")))
              .withColumn("span", F.floor(F.col("turn") / span)))
    by_span = Window.partitionBy("conv_id", "hash").orderBy("span")
    spans = events.groupBy("conv_id", "hash", "span").agg(F.max("source").alias("last")).select(
        "conv_id", "hash", "span", F.max("last").over(by_span.rowsBetween(Window.unboundedPreceding, -1)).alias("before"))
    by_turn = Window.partitionBy("conv_id", "hash", "span").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    near = events.withColumn("near", F.max("source").over(by_turn)).where("source is null")
    return near.join(spans, ["conv_id", "hash", "span"]).select(
        "conv_id", "hash", "turn", F.coalesce("near", "before").alias("source")).where("source is not null")


def _turns(parsed: DataFrame, span: int = 4096) -> DataFrame:
    """``(conv_id, turn, previous, depth, nth)``: the turn before, and the messages
    and turns of all turns before.  Turns are summed in spans first, so a
    conversation of any length is a few rows per window."""
    turns = (parsed.where("conv_id is not null and turn is not null").groupBy("conv_id", "turn").agg(F.sum("rows").alias("n"))
             .withColumn("span", F.floor(F.col("turn") / span)))
    by_span = Window.partitionBy("conv_id").orderBy("span")
    earlier = by_span.rowsBetween(Window.unboundedPreceding, -1)
    spans = turns.groupBy("conv_id", "span").agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("turns"), F.max("turn").alias("last")).select(
        "conv_id", "span", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("start"),
        F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("first"), F.lag("last").over(by_span).alias("last_before"))
    by_turn = Window.partitionBy("conv_id", "span").orderBy("turn")
    within = turns.select("conv_id", "turn", "span", F.lag("turn").over(by_turn).alias("near"), F.coalesce(
        F.sum("n").over(by_turn.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("inside"),
        (F.row_number().over(by_turn) - 1).alias("at"))
    return within.join(spans, ["conv_id", "span"]).select(
        "conv_id", "turn", F.coalesce("near", "last_before").alias("previous"), (F.col("start") + F.col("inside")).alias("depth"),
        (F.col("first") + F.col("at")).alias("nth"))


def reply_order(linked: DataFrame) -> DataFrame:
    """``linked`` (of `link_quotes`) with ``reply_depth`` and ``position``, one row per message.

    ``reply_depth`` is the number of turns above the message in the reply tree
    that ``parent_turn`` spans, and ``position`` its place, from 0, in the
    conversation read in reply order: a message stands before all that answer
    it, directly or not, these before any later answer to the same message,
    and answers to one message are in order of turn.  Messages of one turn
    share a depth and stand together; the turn answers the latest turn that
    one of them quotes.  Both are null without a conversation or a turn.
    """
    key = ["conv_id", "turn"]
    linked = stages.store(linked, "linked-messages")  # read twice: for the tree, and for the rows
    turns = linked.where("conv_id is not null and turn is not null").groupBy(key).agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.max(F.when(F.col("n_linked") > 0, F.col("parent_turn"))), F.max("parent_turn")).alias("parent"))
    turns = stages.store(turns, "reply-turns")
    nodes = stages.store(_pieces(turns.join(_turns(turns), key).withColumnRenamed("depth", "before")), "reply-nodes")
    stages.remove(turns)
    if nodes.where("turn = head and parent is not null").limit(1).count():
        placed = nodes.join(_placed_pieces(nodes), ["conv_id", "head"], "left").select(
            *key, (F.coalesce("head_depth", F.lit(0)) + F.col("nth") - F.col("head_nth")).alias("reply_depth"),
            (F.coalesce("head_position", F.lit(0)) + F.col("before") - F.col("head_before")).alias("start"))
    else:
        placed = nodes.select(*key, F.col("nth").alias("reply_depth"), F.col("before").alias("start"))
    order = F.xxhash64(*linked.columns)
    alike = Window.partitionBy(*key, F.when(F.col("start").isNull(), order)).orderBy(order)
    out = linked.join(placed, key, "left").withColumn("position", F.col("start") + F.row_number().over(alike) - 1)
    return out.select(*linked.columns, "reply_depth", "position")


def _pieces(nodes: DataFrame, span: int = 4096) -> DataFrame:
    """``nodes`` (a row per turn) cut into pieces of turns that each answer the one
    before: with the piece's first turn ``head``, its ``head_before`` and ``head_nth``.

    In reply order a piece stays whole, because the turn after is the first answer."""
    head = F.when(F.col("previous").isNull() | (F.col("parent") != F.col("previous")), F.struct("turn", "before", "nth"))
    nodes = nodes.withColumn("start", head).withColumn("span", F.floor(F.col("turn") / span))
    by_span = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = nodes.groupBy("conv_id", "span").agg(F.max("start").alias("last")).select("conv_id", "span", F.max("last").over(by_span).alias("far"))
    by_turn = Window.partitionBy("conv_id", "span").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    found = nodes.withColumn("near", F.max("start").over(by_turn)).join(spans, ["conv_id", "span"]).withColumn("start", F.coalesce("near", "far"))
    return found.select("conv_id", "turn", "rows", "parent", "before", "nth", F.col("start.turn").alias("head"),
                        F.col("start.before").alias("head_before"), F.col("start.nth").alias("head_nth"))


def _placed_pieces(nodes: DataFrame) -> DataFrame:
    """``(conv_id, head, head_depth, head_position)`` for the pieces of
    conversations that have several.

    The walk round the tree of pieces enters and leaves each once; every event
    knows the one before.  Sums along the walk come by pointer jumping over
    stored rounds, twice as far each time.
    """
    sizes = nodes.groupBy("conv_id", "head").agg(F.sum("rows").alias("n"))
    forks = nodes.where("turn = head and parent is not null").select("conv_id", "head", F.col("parent").alias("turn"))
    above = forks.join(nodes.select("conv_id", "turn", F.col("head").alias("up"), (F.col("nth") - F.col("head_nth")).alias("off")), ["conv_id", "turn"])
    pieces = (sizes.join(forks.select("conv_id").distinct(), "conv_id", "left_semi")
              .join(above.drop("turn"), ["conv_id", "head"], "left"))
    # Answers to a later turn of a piece come before those to an earlier one.
    siblings = Window.partitionBy("conv_id", "up").orderBy(F.desc("off"), "head")
    pieces = stages.store(pieces.withColumn("sibling", F.when(F.col("up").isNotNull(), F.lag("head").over(siblings)))
                          .withColumn("deep", F.coalesce(F.col("off") + 1, F.lit(0))), "reply-pieces")
    last = pieces.where("up is not null").groupBy("conv_id", F.col("up").alias("head")).agg(
        F.max(F.struct((-F.col("off")).alias("off"), "head")).alias("last"))
    enter = pieces.select("conv_id", "head", F.lit(0).alias("side"), F.coalesce("sibling", "up").alias("to"),
                          F.col("sibling").isNotNull().cast("int").alias("to_side"), F.col("n").alias("messages"), "deep")
    leave = pieces.join(last, ["conv_id", "head"], "left").select(
        "conv_id", "head", F.lit(1).alias("side"), F.coalesce("last.head", "head").alias("to"), F.col("last").isNotNull().cast("int").alias("to_side"),
        F.lit(0).cast("long").alias("messages"), (-F.col("deep")).alias("deep"))
    walk = stages.store(enter.unionByName(leave), "reply-walk")
    while walk.where("to is not null").limit(1).count():
        far = walk.select("conv_id", F.col("head").alias("to"), F.col("side").alias("to_side"), F.col("to").alias("next"),
                          F.col("to_side").alias("next_side"), F.col("messages").alias("more"), F.col("deep").alias("deeper"))
        moved = walk.where("to is not null").join(far, ["conv_id", "to", "to_side"]).select(
            "conv_id", "head", "side", F.col("next").alias("to"), F.col("next_side").alias("to_side"),
            (F.col("messages") + F.col("more")).alias("messages"), (F.col("deep") + F.col("deeper")).alias("deep"))
        after = stages.store(walk.where("to is null").unionByName(moved), "reply-walk")
        stages.remove(walk)
        walk = after
    placed = walk.where("side = 0").join(pieces.select("conv_id", "head", "n"), ["conv_id", "head"])
    return placed.select("conv_id", "head", F.col("deep").alias("head_depth"), (F.col("messages") - F.col("n")).alias("head_position"))


def conversations(linked: DataFrame) -> DataFrame:
    """``(conv_id, n_messages, chat)`` in reply order: each line of ``chat`` is
    ``<|role|>`` and the message's own text, ordered by ``position``.

    A conversation is one row by nature; where it is beyond ordinary memory,
    read the rows of `reply_order` by position instead.
    """
    entry = F.struct("position", "turn", F.coalesce("role", F.lit("unknown")).alias("role"), "own_text")
    grouped = reply_order(linked).where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(entry)).alias("turns"))
    return grouped.select("conv_id", F.size("turns").cast("long").alias("n_messages"), F.array_join(
        F.transform("turns", lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["own_text"])), "\n").alias("chat"))
