"""Conversations from reply trees: one for each chosen way from the first message to a last one.

Messages know the one they answer. Self-joins double how far back a message looks: after ``k``
rounds it knows the message ``2 ** k`` steps up, and the scores between; so the longest thread
takes as many joins as its length has binary digits. Branches are ranked by their mean score
before any is written out, and only the chosen ones are.

A turn is written as ``### role: text</turn>`` and a line end. Control strings inside roles and
texts are escaped by a backslash, so that the output can be read back in full.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import prepare, staged

ASSISTANT = "assistant"

#: Fixed values of the template.
OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
_ESCAPES = [("\\", "\\\\"), ("###", "\\#"), ("</turn>", "\\/"), (":", "\\:")]
_PLAIN = {"\\": "\\", "#": "###", "/": "</turn>", ":": ":"}
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): (.*?)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str, role: bool = False) -> str:
    """Without control strings; a role without a colon either."""
    for plain, escaped in _ESCAPES[: 4 if role else 3]:
        text = text.replace(plain, escaped)
    return text


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _PLAIN[m[1]], text)


def formatted(turns: list[tuple[str | None, str | None]], learned: str = ASSISTANT) -> tuple[str, list[tuple[int, int]]]:
    """A conversation, and where in it the texts of the role to learn from begin and end, in characters."""
    parts, mask, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role or '', True)}{MIDDLE}", escape(text or "")
        if role == learned:
            mask.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), mask


def read_back(conversation: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(conversation)]


def replies(rows: DataFrame, tree: str = "conv_id", order: str = "turn") -> DataFrame:
    """``tree, node, parent, role, text`` of conversations that are lists: each turn answers the one before.

    Turns are numbered by a sort that is spread by ranges of conversation and turn, so that a
    conversation of any length is dealt over many tasks. Rows of one turn stand in order of
    their role, then of a hash of their text; equal rows are turns of their own. A null turn
    comes first; null conversations are one.
    """
    rows = rows.select(F.col(tree).cast("long").alias("tree"), F.col(order).alias("turn"), "role", "text", F.xxhash64("text").alias("tie"))
    keys = ["tree", "turn", "role", "tie"]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys, "text")
    rows = staged(rows.select("tree", "role", "text", F.monotonically_increasing_id().alias("node")), "turns")
    part = F.shiftright("node", 33)
    # the last row of each part, and of the one before: as many rows as there are parts
    ends = rows.groupBy(part.alias("part")).agg(F.max(F.struct("node", "tree")).alias("end"))
    ends = ends.select("part", F.lag("end").over(Window.partitionBy(F.lit(0)).orderBy("part")).alias("earlier"))
    before = F.lag(F.struct("node", "tree")).over(Window.partitionBy("part").orderBy("node"))
    linked = rows.select(part.alias("part"), "tree", "node").withColumn("before", before)
    linked = linked.join(F.broadcast(ends), "part").select("tree", "node", F.coalesce("before", "earlier").alias("before"))
    parent = F.when(F.col("before.tree").eqNullSafe(F.col("tree")), F.col("before.node"))
    return linked.select("node", parent.alias("parent")).join(rows, "node").select("tree", "node", "parent", "role", "text")


def chosen_paths(nodes: DataFrame, branches: int | None = None) -> DataFrame:
    """``tree, leaf, rank, node, up``: the nodes of each chosen branch, ``up`` steps above its last message.

    ``nodes`` has ``tree, node, parent, score``; node ids are unique, a parent that is null or not there
    makes a root. Branches of a tree are ranked by mean score, null scores counting as 0, the
    smaller leaf first of equals, and the first ``branches`` are chosen, or all. Messages that
    answer each other in a circle have no root and are in no branch.
    """
    known = nodes.select(F.col("node").alias("parent"))
    links = nodes.select("node", "parent").where("parent is not null").join(known, "parent", "left_semi")
    scores = nodes.select("node", "tree", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    jump = links.join(scores.select(F.col("node").alias("parent"), "score"), "parent").select("node", F.col("parent").alias("to"), "score")
    jumps = [staged(jump, "jumps")]
    leaves = scores.join(links.select(F.col("parent").alias("node")).distinct(), "node", "left_anti")
    limit = nodes.count().bit_length()
    while not jumps[-1].isEmpty() and len(jumps) <= limit:
        last = jumps[-1]
        onward = last.select(F.col("node").alias("to"), F.col("to").alias("far"), F.col("score").alias("more"))
        jump = last.join(onward, "to").select("node", F.col("far").alias("to"), (F.col("score") + F.col("more")).alias("score"))
        jumps.append(staged(jump, "jumps"))
    endless = jumps.pop()
    # length and score of each branch: the longest jumps first
    branch = leaves.select("tree", F.col("node").alias("leaf"), F.col("node").alias("at"), "score", F.lit(0).cast("long").alias("up"))
    branch = branch.join(endless.select(F.col("node").alias("leaf")), "leaf", "left_anti")
    for k in range(len(jumps) - 1, -1, -1):
        jump = jumps[k].select(F.col("node").alias("at"), F.col("to"), F.col("score").alias("more"))
        step = F.when(F.col("to").isNull(), 0).otherwise(1 << k)
        branch = branch.join(jump, "at", "left").select("tree", "leaf", F.coalesce("to", "at").alias("at"), (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"), (F.col("up") + step).alias("up"))
    if branches is None:
        branch = branch.select("tree", "leaf")
    else:
        mean = F.col("score") / (F.col("up") + 1)
        order = Window.partitionBy("tree").orderBy(mean.desc(), "leaf")
        branch = branch.select("tree", "leaf", F.row_number().over(order).alias("rank")).where(F.col("rank") <= branches).drop("rank")
    paths = staged(branch.select("tree", "leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("up")), "paths")
    for k, jump in enumerate(jumps):
        further = paths.join(jump.select("node", "to"), "node").select("tree", "leaf", F.col("to").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        paths = staged(paths.unionByName(further), "paths")
    return paths


def conversations(nodes: DataFrame, branches: int | None = None, learned: str = ASSISTANT) -> DataFrame:
    """``tree, leaf, n_turns, conversation, mask``: each chosen branch as one text.

    ``nodes`` has ``tree, node, parent, role, text, score``. ``mask`` lists where texts of the role to
    learn from begin and end, in characters of ``conversation``. Null roles and texts count as
    empty. An empty table gives an empty result; other columns, whatever their names, are left out.
    """
    prepare(nodes.sparkSession)
    paths = chosen_paths(nodes, branches)
    turns = paths.join(nodes.select("node", "role", "text"), "node")
    turns = turns.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text"))).alias("turns"))

    @F.arrow_udf("struct<conversation: string, mask: array<struct<begin: bigint, end: bigint>>>")
    def write(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            texts, masks = [], []
            for turns in lists:
                text, mask = formatted([(t["role"], t["text"]) for t in turns.as_py()], learned)
                texts.append(text)
                masks.append([{"begin": a, "end": b} for a, b in mask])
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(masks, kind)], ["conversation", "mask"])

    turns = turns.select("tree", "leaf", F.size("turns").cast("long").alias("n_turns"), write("turns").alias("out"))
    return turns.select("tree", "leaf", "n_turns", "out.conversation", "out.mask")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def digests(written: DataFrame) -> DataFrame:
    """``tree, leaf, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, all read back from the output."""
    prepare(written.sparkSession)

    @F.arrow_udf("struct<n_turns: bigint, turns_sha256: string, loss_chars: bigint, loss_sha256: string, formatted_chars: bigint>")
    def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, masks in batches:
            rows = []
            for text, mask in zip(texts.to_pylist(), masks.to_pylist(), strict=True):
                turns = read_back(text)
                loss = "".join([unescape(text[m["begin"] : m["end"]]) for m in mask])
                rows.append((len(turns), _sha("".join([f"{r}\n{t}\n" for r, t in turns])), len(loss), _sha(loss), len(text)))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            yield pa.StructArray.from_arrays(columns, ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return written.select("tree", "leaf", read("conversation", "mask").alias("d")).select("tree", "leaf", "d.*")
