import hashlib
import random

from pyspark.sql import functions as F

from lakelayer.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n_tokens string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        out[c] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def messy_rows():
    rng = random.Random(5)
    rows = [
        (None, 0, "user", "no id"),
        (1, None, None, None),
        (1, 0, "us:er\n### x</turn>", "a\\h </turn>\n### ####### \\\\"),
        (1, 0, "us:er\n### x</turn>", "a\\h </turn>\n### ####### \\\\"),
        (2, 0, "assistant", ""),
        (3, 0, "user", chat.SPOKEN),
        (3, 1, "assistant", chat.SPOKEN + "<|endoftext|> é日"),
        (4, 0, "user", "w " * 20_000),
    ]
    for c in range(10, 60):  # a third of the conversations share the first turns
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, "assistant" if t % 2 else "user", rng.choice(["hi", "hello", "tell me"]) if t else "same start"))
    return rows


def test_reads_back_exactly(spark):
    rows = messy_rows()
    for path in (chat.TOKENIZER, None):
        got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digests(table(spark, rows), path).collect()}
        assert got == expected(rows)


def test_tree_is_depth_first_with_ancestors(spark):
    segments, members = chat.prefix_tree(table(spark, messy_rows()), None, partitions=5)
    rows = {r["node_id"]: r for r in segments.collect()}
    assert len(rows) == members.select("node_id").distinct().count()  # shared turns once
    trees = {}
    for r in rows.values():
        trees.setdefault(r["tree_id"], []).append(r)
    for tree in trees.values():
        tree.sort(key=lambda r: r["start"])
        at, stack = 0, []
        for r in tree:
            assert r["start"] == at  # no gap, no overlap
            at += r["n_tokens"]
            stack = stack[: r["depth"]]
            assert r["parent_id"] == (stack[-1]["node_id"] if stack else None)  # depth-first
            held = [p for a in r["ancestors"] for p in range(a["start"], a["end"])]
            assert held == [p for s in stack for p in range(s["start"], s["start"] + s["n_tokens"])]
            first = sum(s["n_tokens"] for s in stack)
            assert r["position_ids"] == list(range(first, first + r["n_tokens"]))
            stack.append(r)


def test_empty(spark):
    assert chat.digests(table(spark, [])).count() == 0


def test_very_long_conversations(spark):
    """Work grows with the turns: 50,000 turns in one conversation, and a second one
    that shares half of them."""
    rows = [(1, k, "user" if k % 2 else "assistant", f"t{k}") for k in range(50_000)]
    rows += [(2, k, r, t if k < 25_000 else t + "!") for _, k, r, t in rows[:30_000]]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    segments, members = chat.prefix_tree(df, None)
    assert segments.count() == 55_000 and members.count() == 80_000
    last = segments.orderBy(F.desc("depth")).limit(1).collect()[0]
    assert last["depth"] == 49_999 and sum(a["end"] - a["start"] for a in last["ancestors"]) == last["position_ids"][0]
    assert all(len(r["ancestors"]) <= 2 for r in segments.select("ancestors").collect())
    got = {r["conv_id"]: r for r in chat.digests(df, None).collect()}
    assert {k: r["n_turns"] for k, r in got.items()} == {1: 50_000, 2: 30_000}
    assert got[1]["loss_sha256"] == hashlib.sha256("".join(t for _, _, r, t in rows[:50_000] if r == "assistant").encode()).hexdigest()
