"""Chat formatting with a prefix tree.

Conversations that share their first turns share the tree nodes of these turns.
A node is one formatted turn after its ancestors; its tokens are emitted once,
depth-first, with position ids that go on from its parent and the intervals of
its ancestors in the tree's sequence: a token attends to these and, causally,
to its own segment.  A tree is a set of segment rows, never one row or group;
a conversation is one row (its digests need its whole text), a turn carries its
own numbers only, so work and memory grow with the number of turns.

Depth-first order comes from sorting: node ids are chained digests, different
conversations are range-sorted by their arrays of node ids, and what a
conversation does not share with the one before it is emitted there.  Offsets
are prefix sums of per-partition totals; the last path of each range partition
(one row each) is the neighbour of the next one's first.

Template: ``### role: text</turn>`` and a line end per turn.  In texts ``\\`` becomes
``\\\\``, ``###`` becomes ``\\h`` and ``</turn>`` becomes ``\\e``, and in roles also ``:``
becomes ``\\c`` and a line end ``\\n``; reading back undoes this exactly.  The
loss is on the assistant's texts.

Defined results: NULL role and NULL text are empty; turns are ordered by (turn,
role, text), NULL turn first, repeated rows stay; rows with a NULL conv_id form
one conversation; an empty table gives empty results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakelayer.llm.common import materialize

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
ESCAPES = {"\\": "\\\\", "###": "\\h", "</turn>": "\\e"}
ROLE_ESCAPES = {**ESCAPES, ":": "\\c", "\n": "\\n"}
UNESCAPE = {v[1]: k for k, v in ROLE_ESCAPES.items()}
SPANS = "array<struct<start:bigint,end:bigint>>"
TURN = re.compile(r"### ([^:]*): (.*?)</turn>\n", re.DOTALL)


def escape(c: Column, table: dict[str, str] = ESCAPES) -> Column:
    for plain, code in table.items():
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: UNESCAPE[m[1]], text)


def tokenizer_of(spark, path: str | None):
    """A function for the executors that gives (encode, decode).  The vocabulary
    file, of fixed size, is read on the driver and broadcast; without a path
    the tokens are UTF-8 bytes."""
    held = spark.sparkContext.broadcast(Path(path).read_text(encoding="utf-8") if path else None)

    def make():
        if held.value is None:
            return lambda texts: [list(t.encode()) for t in texts], lambda ids: [bytes(i).decode() for i in ids]
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        t = Tokenizer.from_str(held.value)
        t.encode_special_tokens = True  # special tokens' strings in a text are ordinary text
        return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)], lambda ids: t.decode_batch(ids, skip_special_tokens=False)

    return make


def paths_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, turns): a conversation's node ids and its turns."""

    @F.pandas_udf("array<string>")
    def chain(turns: pd.Series) -> pd.Series:
        import hashlib

        def one(digests):
            node, out = "", []
            for d in digests:
                node = hashlib.sha256((node + d).encode()).hexdigest()[:32]
                out.append(node)
            return out

        return turns.map(one)

    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("t"))
    convs = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    digest = F.transform("turns", lambda t: F.sha2(F.concat(F.length(t["role"]).cast("string"), F.lit(":"), t["role"], t["text"]).cast("binary"), 256))
    return convs.withColumn("path", chain(digest))


def segments_of(nodes: DataFrame, tokenizer) -> DataFrame:
    """Tokens of each node (node_id, role, text): head, text and end are encoded
    apart, so the loss span falls between tokens."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        to_ids, _ = tokenizer()
        for b in batches:
            head, body = to_ids(b["head"].tolist()), to_ids(b["body"].tolist())
            end = to_ids(["</turn>\n"])[0]
            loss = (b["role"] == "assistant").tolist()
            yield pd.DataFrame(
                {
                    "node_id": b["node_id"],
                    "token_ids": [h + t + end for h, t in zip(head, body, strict=True)],
                    "loss_start": [len(h) for h in head],
                    "loss_end": [len(h) + len(t) * y for h, t, y in zip(head, body, loss, strict=True)],
                }
            )

    head = F.concat(F.lit("### "), escape(F.col("role"), ROLE_ESCAPES), F.lit(": "))
    rows = nodes.select("node_id", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    return rows.mapInPandas(encode, "node_id string, token_ids array<int>, loss_start int, loss_end int").withColumn("n_tokens", F.size("token_ids"))


def merged(intervals: Column) -> Column:
    """Neighbouring [start, end) intervals joined; they come in ascending order."""

    def add(acc, x):
        last = F.get(acc, F.size(acc) - 1)
        joined = F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), x["end"].alias("end"))))
        return F.when((F.size(acc) > 0) & (last["end"] == x["start"]), joined).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(intervals, F.array().cast(SPANS), add)


OWN_NODES = "leaf string, tree_id string, depth int, node_id string, parent_id string, n bigint, base bigint, start bigint, position bigint"


def own_nodes(batches: Iterator[pd.DataFrame], together: int = 100_000) -> Iterator[pd.DataFrame]:
    """The nodes of each path from ``shared`` on, with their places; some 100,000
    nodes, or a path's, at a time."""
    columns = ("leaf", "tree_id", "depth", "node_id", "parent_id", "n", "base", "start", "position")
    held, n = [], 0

    def whole() -> pd.DataFrame:
        return pd.DataFrame({c: np.concatenate([h[k] for h in held]) for k, c in enumerate(columns)})

    for b in batches:
        for leaf, tree, base, shared, path, sizes in zip(b["leaf"], b["tree_id"], b["base"], b["shared"], b["path"], b["sizes"], strict=True):
            sizes = np.asarray(sizes, dtype=np.int64)
            position = np.cumsum(sizes) - sizes
            ids, own = np.asarray(path, dtype=object), len(sizes) - shared
            parents = np.concatenate([np.array([None], dtype=object), ids])[shared : len(ids)]
            same = (np.full(own, x, dtype=object) for x in (leaf, tree))
            start = base + position[shared:] - sizes[:shared].sum()
            held.append((*same, np.arange(shared, len(ids), dtype=np.int32), ids[shared:], parents, sizes[shared:], np.full(own, base), start, position[shared:]))
            n += own
            if n >= together:
                yield whole()
                held, n = [], 0
    if held:
        yield whole()


def prefix_tree(conversations: DataFrame, tokenizer_path: str | None = TOKENIZER, partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(segments, members) of conversations (conv_id, turn, role, text).

    segments: tree_id, node_id, parent_id, depth, start (in the tree's sequence),
    n_tokens, token_ids, position_ids, loss_start, loss_end (in the segment),
    ancestors (array of [start, end)).  members: conv_id, depth, node_id."""
    spark = conversations.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    convs = materialize(paths_of(conversations.select("conv_id", "turn", "role", "text")))
    turns = convs.select("conv_id", F.posexplode(F.arrays_zip("path", "turns")).alias("depth", "t"))
    nodes = turns.groupBy(F.col("t.path").alias("node_id")).agg(F.any_value("t.turns.role").alias("role"), F.any_value("t.turns.text").alias("text"))
    tokens = materialize(segments_of(nodes, tokenizer_of(spark, tokenizer_path)))

    # Different paths with their nodes' sizes.
    leaves = convs.select(F.element_at("path", -1).alias("leaf"), "path").dropDuplicates(["leaf"])
    steps = leaves.select("leaf", F.posexplode("path").alias("depth", "node_id")).join(tokens.select("node_id", "n_tokens"), "node_id")
    step = F.sort_array(F.collect_list(F.struct("depth", "node_id", "n_tokens")))
    paths = steps.groupBy("leaf").agg(step.alias("s")).select("leaf", F.col("s.node_id").alias("path"), F.col("s.n_tokens").alias("sizes"))
    paths = materialize(paths.repartitionByRange(n, "path").withColumn("pid", F.spark_partition_id()))

    # What a path shares with the one before it in the order.
    ends = paths.groupBy("pid").agg(F.max("path").alias("end"))
    ends = ends.select("pid", F.lag("end").over(Window.partitionBy(F.lit(0)).orderBy("pid")).alias("end"))  # a row per partition
    within = Window.partitionBy("pid").orderBy("path")
    paths = paths.join(ends, "pid").withColumn("before", F.coalesce(F.lag("path").over(within), "end", F.array().cast("array<string>")))
    paths = paths.withColumn("shared", F.size(F.array_intersect("path", "before"))).drop("before", "end")

    def total(sizes: Column) -> Column:
        return F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x)

    own = F.slice("sizes", F.col("shared") + 1, F.size("sizes"))
    paths = materialize(paths.withColumn("own", total(own)))
    sums = paths.groupBy("pid").agg(F.sum("own").alias("n"))
    offset = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    running = F.sum("own").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("own")
    paths = paths.join(sums.select("pid", offset.alias("offset")), "pid").withColumn("at", F.col("offset") + running)
    paths = paths.withColumn("tree_id", F.get("path", F.lit(0))).drop("offset", "pid", "own")
    trees = paths.groupBy("tree_id").agg(F.min("at").alias("first"))
    paths = materialize(paths.join(trees, "tree_id").withColumn("base", F.col("at") - F.col("first")).drop("at", "first"))

    # A path's own nodes follow each other from its base on; the shared ones stand
    # where they were emitted.  No row of a turn holds more than its own numbers.
    emitted = materialize(paths.mapInPandas(own_nodes, OWN_NODES))
    lent = paths.select("leaf", F.posexplode(F.slice("path", F.lit(1), F.col("shared"))).alias("depth", "node_id"))
    lent = lent.join(emitted.select("node_id", "start", (F.col("start") + F.col("n")).alias("end")), "node_id")
    spans = F.sort_array(F.collect_list(F.struct("depth", "start", "end")))
    lead = lent.groupBy("leaf").agg(spans.alias("spans")).select("leaf", merged(F.transform("spans", lambda s: F.struct(s["start"], s["end"]))).alias("lead"))
    segments = emitted.join(lead, "leaf", "left").withColumn("lead", F.coalesce("lead", F.array().cast(SPANS)))
    since = F.when(F.col("start") > F.col("base"), F.array(F.struct(F.col("base").alias("start"), F.col("start").alias("end")))).otherwise(F.array().cast(SPANS))
    last = F.slice("lead", F.greatest(F.size("lead"), F.lit(1)), F.lit(1))  # the only one that may go on
    above = F.concat(F.slice("lead", F.lit(1), F.greatest(F.size("lead") - 1, F.lit(0))), merged(F.concat(last, since)))
    segments = segments.select("tree_id", "node_id", "parent_id", "depth", "start", "position", above.alias("ancestors"))
    segments = segments.join(tokens, "node_id")
    ids = F.when(F.col("n_tokens") > 0, F.sequence(F.col("position"), F.col("position") + F.col("n_tokens") - 1))
    segments = segments.withColumn("position_ids", ids.cast("array<int>")).drop("position")
    members = turns.select("conv_id", "depth", F.col("t.path").alias("node_id"))
    return segments, members


def read_back(segments: DataFrame, members: DataFrame, tokenizer_path: str | None = TOKENIZER) -> DataFrame:
    """Per conversation what its segments hold, decoded from the tokens: conv_id,
    formatted, loss (the text under the loss mask, unescaped), turns (role, text)."""
    tokenizer = tokenizer_of(segments.sparkSession, tokenizer_path)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        _, to_text = tokenizer()
        for b in batches:
            ids = [list(map(int, i)) for i in b["token_ids"]]
            masked = [i[a:z] for i, a, z in zip(ids, b["loss_start"], b["loss_end"], strict=True)]
            yield pd.DataFrame({"node_id": b["node_id"], "formatted": to_text(ids), "loss": [unescape(t) for t in to_text(masked)]})

    texts = materialize(segments.select("node_id", "token_ids", "loss_start", "loss_end").mapInPandas(decode, "node_id string, formatted string, loss string"))

    @F.pandas_udf("array<struct<role:string,text:string>>")
    def parse(formatted: pd.Series) -> pd.Series:
        return formatted.map(lambda f: [{"role": unescape(r), "text": unescape(t)} for r, t in TURN.findall(f)])

    rows = members.join(texts, "node_id").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("depth", "formatted", "loss"))).alias("s"))
    whole = rows.select("conv_id", F.array_join("s.formatted", "").alias("formatted"), F.array_join("s.loss", "").alias("loss"))
    return whole.withColumn("turns", parse("formatted"))


def digests(conversations: DataFrame, tokenizer_path: str | None = TOKENIZER) -> DataFrame:
    """What the formatted conversations read back as, in digests."""
    segments, members = prefix_tree(conversations, tokenizer_path)
    back = read_back(segments, members, tokenizer_path)
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SPOKEN = "\\### Assistant: </turn> ok"

SQL = """
WITH a AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
b AS (SELECT *, replace(replace(replace(text, '\\', '\\\\'), '###', '\\h'), '</turn>', '\\e') AS body,
             replace(replace(replace(replace(replace(role, '\\', '\\\\'), '###', '\\h'), '</turn>', '\\e'), ':', '\\c'), chr(10), '\\n') AS head FROM a)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
       sum(length(head) + length(body) + 14)::BIGINT AS formatted_chars
FROM b GROUP BY conv_id"""
