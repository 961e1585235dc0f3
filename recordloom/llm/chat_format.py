"""Chat formatting from reply trees (operator 10).

Messages point to the message that they answer. Self-joins that double their
stride each round find every message's distance to its root and the score summed
on the way, so a path of n messages takes log2(n) joins. Leaves are ranked in their
tree by the mean score of their path; a second series of the same joins lists the
messages of each chosen path, which is formatted as one conversation.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from recordloom.llm.common import discard, map_arrow, materialize, table

# The control strings of the template.
BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
_CONTROL = re.compile("|".join(map(re.escape, (END, BEGIN, CLOSE, OPEN))))
_TURN = re.compile(rf"(?s){re.escape(OPEN)} (.*?)\n(.*?) {re.escape(CLOSE)}| (.*?){re.escape(END)}")


def escape(text: str) -> str:
    """Doubles backslashes and puts one behind the first letter of each control string, so none is left."""
    return _CONTROL.sub(lambda m: m[0][0] + "\\" + m[0][1:], text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"(?s)\\(.)", r"\1", text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """A conversation as one string and its loss mask: the spans (start, end) of assistant texts.

    An assistant turn is `` text</s>``; any other is ``[INST] role\\ntext [/INST]``.
    Line ends in a role are written as control strings are, by backslash.
    """
    out, mask, at = [BEGIN], [], len(BEGIN)
    for role, text in turns:
        body = escape(text)
        if role == "assistant":
            mask.append((at + 1, at + 1 + len(body)))
            out.append(f" {body}{END}")
        else:
            out.append(f"{OPEN} {escape(role).replace('\n', '\\n')}\n{body} {CLOSE}")
        at += len(out[-1])
    return "".join(out), mask


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation, exactly as they were."""
    turns, at = [], len(BEGIN)
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        role = "assistant" if m[1] is None else re.sub(r"(?s)\\(.)", lambda x: "\n" if x[1] == "n" else x[1], m[1])
        turns.append((role, unescape(m[3] if m[1] is None else m[2])))
        at = m.end()
    return turns


def chain(rows: DataFrame) -> DataFrame:
    """Reply edges of conversations told row by row: each row answers the row before it, by turn, role and text.

    ``rows(conv_id, turn, role, text)`` gives ``tree, node, parent, role, text, score``;
    nodes are numbered in order. All rows are kept, also of equal turn.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    return rows.select(F.col("conv_id").alias("tree"), F.row_number().over(order).cast("long").alias("node"), "role", "text").select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def paths(nodes: DataFrame, *, branches: int = 1) -> DataFrame:
    """The best root-to-leaf paths of each tree: ``tree, leaf, rank, node, depth`` for each message on them.

    ``nodes(tree, node, parent, score)``: a message given several times is one message,
    as ``single`` has it; ``tree`` may be null and is then one tree; a message without
    a node is none; a message whose parent is null or not there is a root. Null scores
    count as 0. Paths are ranked by mean score, longer ones first among equals, then
    by leaf. Messages on a circle, or behind one, have no root and so no path;
    ``rootless`` reports them.
    """
    jumps, on_path = _paths(nodes.select("tree", "node", "parent", "score"), branches)
    for used in jumps:
        discard(used)
    return on_path


def single(nodes: DataFrame) -> DataFrame:
    """One row for each tree and node that isn't null: of several the one of the smallest other columns, in their order."""
    rest = [c for c in nodes.columns if c not in ("tree", "node")]
    one = nodes.where("node is not null").groupBy("tree", "node").agg(F.min(F.struct(*rest)).alias("x"))
    return one.select("tree", "node", *(F.col("x")[c].alias(c) for c in rest)).select(*nodes.columns)


def rootless(nodes: DataFrame) -> DataFrame:
    """The messages ``(tree, node)`` from which no root is reached: those on a circle of replies, or answering one."""
    jumps, _ = _paths(nodes.select("tree", "node", "parent", "score"), 0)
    return jumps[-1].where("to is not null").select("tree", "node")


def _paths(nodes: DataFrame, branches: int) -> tuple[list[DataFrame], DataFrame]:
    own = materialize(single(nodes).withColumn("score", F.coalesce("score", F.lit(0.0))), "nodes")
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    up = own.select(F.col("tree").alias("t2"), F.col("node").alias("n2"))
    there = own.join(up, same("tree", "t2") & (F.col("parent") == F.col("n2")), "left").select("tree", "node", F.col("n2").alias("to"), F.lit(1).cast("long").alias("steps"), "score")
    jumps = [materialize(there, "jumps")]
    while True:
        last = jumps[-1]
        on = last.select(F.col("tree").alias("t2"), F.col("node").alias("n2"), F.col("to").alias("to2"), F.col("steps").alias("s2"), F.col("score").alias("sc2"))
        # ``steps`` and ``score`` cover the messages from ``node`` to just before ``to``, or to the root; those there go no further.
        further = last.where("to is not null").join(on, same("tree", "t2") & (F.col("to") == F.col("n2"))).select("tree", "node", F.col("to2").alias("to"), (F.col("steps") + F.col("s2")).alias("steps"), (F.col("score") + F.col("sc2")).alias("score"))
        nxt = last.where("to is null").union(further)
        jumps.append(materialize(nxt, "jumps"))
        open_, before = (j.where("to is not null").count() for j in jumps[-1:] + jumps[-2:-1])
        if not open_ or open_ == before:
            break
    full = jumps[-1].where("to is null")
    parents = own.where("parent is not null").select(F.col("tree").alias("t2"), F.col("parent").alias("n2"))
    leaves = full.join(parents, same("tree", "t2") & (F.col("node") == F.col("n2")), "left_anti")
    best = Window.partitionBy("tree").orderBy((F.col("score") / F.col("steps")).desc(), F.col("steps").desc(), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    on_path = materialize(chosen.select("tree", F.col("node").alias("leaf"), "rank", "steps", "node", F.col("steps").alias("depth")), "paths")
    for i in range(len(jumps) - 2, -1, -1):
        on = jumps[i].where("to is not null").select(F.col("tree").alias("t2"), F.col("node").alias("n2"), "to")
        stride = F.lit(1 << i)
        further = on_path.join(on, same("tree", "t2") & (F.col("node") == F.col("n2"))).select("tree", "leaf", "rank", "steps", F.col("to").alias("node"), (F.col("depth") - stride).alias("depth"))
        before, on_path = on_path, materialize(on_path.union(further), "paths")
        discard(before)
    discard(own)
    return jumps, on_path.select("tree", "leaf", "rank", "node", "depth")


def conversations(nodes: DataFrame, *, branches: int = 1, unique: bool = False) -> DataFrame:
    """The chosen paths of reply trees, formatted: ``conv_id, leaf, rank, formatted, mask``.

    ``nodes(tree, node, parent, role, text, score)`` as in ``paths``, other columns aside;
    null roles and texts count as empty. ``unique`` says that no message is given twice,
    which saves looking for such. ``mask`` holds start and end of each assistant text in
    ``formatted``, in code points. A conversation is one string and so is put
    together in one task; only its own messages are there. No nodes, no rows.
    """
    own = nodes.select("tree", "node", "parent", "role", "text", "score")
    own = materialize(own if unique else single(own), "messages")
    p = paths(own, branches=branches).withColumnRenamed("tree", "t2").withColumnRenamed("node", "n2")
    rows = own.join(p, F.col("tree").eqNullSafe(F.col("t2")) & (F.col("node") == F.col("n2")))
    turns = rows.groupBy("tree", "leaf", "rank").agg(F.sort_array(F.collect_list(F.struct("depth", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))
    schema = StructType([StructField("conv_id", own.schema["tree"].dataType), StructField("leaf", own.schema["node"].dataType), StructField("rank", LongType()), StructField("formatted", StringType()), StructField("mask", ArrayType(ArrayType(LongType())))])

    def run(trees: list, leaves: list, ranks: list, lists: list) -> list:
        made = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in lists]
        return [trees, leaves, ranks, [f for f, _ in made], [[list(span) for span in mask] for _, mask in made]]

    return map_arrow(turns, run, schema)


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted conversations: turns and texts under the loss mask, as digests."""
    schema = StructType([StructField("conv_id", formatted.schema["conv_id"].dataType), StructField("n_turns", LongType()), StructField("turns_sha256", StringType()), StructField("loss_chars", LongType()), StructField("loss_sha256", StringType()), StructField("formatted_chars", LongType())])
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()

    def run(ids: list, texts: list, masks: list) -> list:
        turns = [read_turns(t) for t in texts]
        loss = ["".join(unescape(t[s:e]) for s, e in mask) for t, mask in zip(texts, masks, strict=True)]
        return [ids, list(map(len, turns)), [digest("".join(f"{role}\n{text}\n" for role, text in own)) for own in turns], list(map(len, loss)), list(map(digest, loss)), list(map(len, texts))]

    return map_arrow(formatted.select("conv_id", "formatted", "mask"), run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return digests(conversations(chain(rows.unionByName(more)), unique=True))
