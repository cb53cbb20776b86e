"""Chat formatting as a prefix tree (operator 4).

Conversations that begin with the same turns share those turns. The tree is
path-compressed: a node is the longest run of turns between places where
conversations part or end, so a long conversation that nothing else touches is
one node, and a node's path has no more members than the conversations that
made it have turns. Nodes are laid out depth first in one stream of characters,
each once; a node's position ids go on from its parent's, and it attends to
itself and to the intervals of its ancestors. Sorting nodes by their paths is
the depth-first order, so the layout is a range partitioning, a running sum per
partition and the sums of the partitions before it; a tree of any size is
spread over many tasks.

A turn reads ``### role: text</turn>`` and a line feed. A backslash before each
backslash, # and < of a text (and : of a role) keeps control strings out of
texts and is taken off on reading.

Defined results: null texts and roles are empty; rows are in order of turn (null
first), then role, then text; a null conv_id is a conversation; repeated rows are
turns; equal conversations share all nodes; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwatch.llm.common import prepare, table, written

LOSS_ROLE = "assistant"
HEAD, COLON, TAIL = "### ", ": ", "</turn>\n"
_TURN = re.compile(r"### ((?:[^\\:#<]|\\.)*+): ((?:[^\\#<]|\\.)*+)</turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)

CONTROL = r"\### Assistant: </turn> ok"


def escaped(text: str, role: bool = False) -> str:
    return re.sub(r"[\\#<:]" if role else r"[\\#<]", r"\\\g<0>", text)


def plain(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


_ROWS = "conv_id long, i int, node string, parent string, last boolean, role string, text string"


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, i, node, parent, last, role, text: each turn with the id of the path to it."""
    row = F.struct(F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for conv, turns in zip(b.column("conv_id").to_pylist(), b.column("turns").to_pylist(), strict=True):
                parent = None
                for i, t in enumerate(turns):
                    head = f"{parent or ''}:{len(t['role'])}:".encode()
                    node = hashlib.sha256(head + t["role"].encode() + t["text"].encode()).hexdigest()[:32]
                    rows.append((conv, i, node, parent, i + 1 == len(turns), t["role"], t["text"]))
                    parent = node
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.string(), pa.string())
            cols = list(zip(*rows, strict=True)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                             names=["conv_id", "i", "node", "parent", "last", "role", "text"])

    prepare(conversations.sparkSession)
    return written(grouped.mapInArrow(run, _ROWS), "chat-turns")


_TURNS = "array<struct<role:string,text:string>>"


def compressed(rows: DataFrame) -> DataFrame:
    """conv_id, path (node ids from the root), segments (node, turns): each conversation as the
    tree's path-compressed nodes. A node is named by its last turn's id."""
    edges = written(rows.groupBy("parent", "node").agg(F.max("last").alias("ends")), "chat-edges")
    parting = edges.where("parent is not null").groupBy("parent").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    cuts = written(parting.select(F.col("parent").alias("cut")).union(edges.where("ends").select("node")).distinct(), "chat-cuts")
    marked = rows.join(cuts, F.col("node") == F.col("cut"), "left")
    turn = F.struct("i", "node", F.col("cut").isNotNull().alias("cut"), "role", "text")
    whole = marked.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    kind = pa.list_(pa.struct([("node", pa.string()), ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            paths, segments = [], []
            for turns in b.column("turns").to_pylist():
                own, held = [], []
                for t in turns:
                    held.append({"role": t["role"], "text": t["text"]})
                    if t["cut"]:
                        own.append({"node": t["node"], "turns": held})
                        held = []
                segments.append(own)
                paths.append([x["node"] for x in own])
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), pa.array(paths, pa.list_(pa.string())), pa.array(segments, kind)],
                                             names=["conv_id", "path", "segments"])

    return written(whole.mapInArrow(run, f"conv_id long, path array<string>, segments array<struct<node:string,turns:{_TURNS}>>"), "chat-conversations")


def formatted(turns: list[dict]) -> tuple[str, list[dict]]:
    """A node's text and the parts of it under the loss mask."""
    out, losses, at = [], [], 0
    for t in turns:
        head = f"{HEAD}{escaped(t['role'], role=True)}{COLON}"
        body = escaped(t["text"])
        if t["role"] == LOSS_ROLE:
            losses.append({"start": at + len(head), "end": at + len(head) + len(body)})
        out.append(f"{head}{body}{TAIL}")
        at += len(out[-1])
    return "".join(out), losses


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _laid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Formats nodes and adds where each starts within its partition."""
    at, part = 0, TaskContext.get().partitionId()
    for b in batches:
        got = [formatted(t) for t in b.column("turns").to_pylist()]
        n = np.array([len(x) for x, _ in got], np.int64)
        ends = at + np.cumsum(n)
        at = int(ends[-1]) if len(ends) else at
        yield pa.RecordBatch.from_arrays(
            [b.column("node"), b.column("path"), pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], _SPANS), pa.array(n),
             pa.array(np.full(len(n), part)), pa.array(ends - n)], names=["node", "path", "formatted", "losses", "n", "part", "local"])


def layout(convs: DataFrame) -> DataFrame:
    """The stream's nodes: node, parent, depth, formatted, losses (start, end within formatted),
    start, n, position, attends (start, end in the stream of each ancestor)."""
    spark = convs.sparkSession
    each = convs.select("path", F.posexplode("segments").alias("j", "s"))
    nodes = each.select(F.col("s.node").alias("node"), F.slice("path", 1, F.col("j") + 1).alias("path"), F.col("s.turns").alias("turns"))
    nodes = nodes.groupBy("node").agg(F.first("path").alias("path"), F.first("turns").alias("turns"))
    span = "array<struct<start:bigint,end:bigint>>"
    schema = f"node string, path array<string>, formatted string, losses {span}, n long, part long, local long"
    laid = written(nodes.repartitionByRange("path").sortWithinPartitions("path").mapInArrow(_laid, schema), "chat-nodes")
    # One row per partition.
    sums, at = [], 0
    for r in laid.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect():
        sums.append((r.part, at))
        at += r.n
    offsets = F.broadcast(spark.createDataFrame(sums or [(0, 0)], "part long, base long"))
    laid = laid.join(offsets, "part").withColumn("start", F.col("base") + F.col("local"))
    place = written(laid.select(F.col("node").alias("up"), F.col("start").alias("a"), F.col("n").alias("size")), "chat-places")
    ups = laid.select("node", F.posexplode(F.slice("path", 1, F.size("path") - 1)).alias("k", "up"))
    seen = (ups.join(place, "up").groupBy("node")
            .agg(F.sort_array(F.collect_list(F.struct("k", "a", (F.col("a") + F.col("size")).alias("b")))).alias("above")))
    above = written(seen.select(F.col("node").alias("__node"), F.transform("above", lambda x: F.struct(x["a"].alias("start"), x["b"].alias("end"))).alias("attends")),
                    "chat-above")
    out = laid.join(above, F.col("node") == F.col("__node"), "left")
    attends = F.coalesce("attends", F.array().cast(span))
    position = F.aggregate(attends, F.lit(0).cast("long"), lambda acc, x: acc + x["end"] - x["start"])
    return out.select("node", F.get("path", F.size("path") - 2).alias("parent"), F.size("path").alias("depth"), "formatted", "losses", "start", "n",
                      position.alias("position"), attends.alias("attends"))


def read_back(convs: DataFrame, nodes: DataFrame) -> DataFrame:
    """conv_id and its digests, from the stream's nodes alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for parts in b.column("parts").to_pylist():
                text = "".join(p["formatted"] for p in parts)
                turns, at = [], 0
                while at < len(text):
                    m = _TURN.match(text, at)
                    if m is None:
                        raise ValueError("the stream holds no whole turn here")
                    turns.append((plain(m[1]), plain(m[2])))
                    at = m.end()
                loss = "".join(plain(p["formatted"][x["start"]:x["end"]]) for p in parts for x in p["losses"])
                digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
                rows.append((len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            cols = list(zip(*rows, strict=True)) if rows else [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("conv_id"), *[pa.array(c, k) for c, k in zip(cols, kinds, strict=True)]],
                                             names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    each = convs.select("conv_id", F.posexplode("path").alias("i", "node"))
    found = each.join(nodes.select("node", "formatted", "losses"), "node")
    whole = found.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("i", "formatted", "losses"))).alias("parts"))
    return whole.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op4_prefix_tree(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    control = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                    F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL).alias("text"))
    convs = compressed(turns_of(rows.unionByName(control)))
    return read_back(convs, written(layout(convs), "chat-stream"))


ORACLE = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) t(i))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(14 + length(regexp_replace(role, '([\\#<:])', '\\\1', 'g')) + length(regexp_replace(text, '([\\#<])', '\\\1', 'g')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""
