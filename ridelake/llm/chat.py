"""Chats as a prefix tree: shared first turns are emitted once, depth first.

A turn is written as ``### role:``, a line end, the text, and ``</turn>`` with a line end. In roles and texts a backslash
goes before each backslash, ``#``, ``<``, and in roles before ``:`` too, so no text holds a control string and every
output can be read back. Each turn is a node, named by a hash of all turns up to it; conversations that begin alike share
nodes. Nodes are sorted depth first into one stream of tokens. A node carries

* ``position``, the position id of its first token: the tokens before it on its own conversation's path;
* ``start`` and ``end``, its place in the stream;
* ``visible``, the end of its subtree: the tokens of [start, visible) and no others attend to it, so that each token
  attends to its ancestors and to itself;
* ``loss_from`` and ``loss_to``, the places in the stream of the text that is learned (an assistant's), or null.
"""

from __future__ import annotations

import hashlib
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.llm.common import sliced
from ridelake.operators.ordering import running_total
from ridelake.session import materialise

LEARNED = "assistant"
SLICE_ROWS = 50  # conversations that a task turns into Python values at a time
_HEAD = re.compile(r"### ((?:[^\\:]|\\.)*):\n", re.DOTALL)
_BODY = re.compile(r"((?:[^\\<]|\\.)*)</turn>\n", re.DOTALL)


def escape(text: str, role: bool = False) -> str:
    return re.sub(r"([\\#<:])" if role else r"([\\#<])", r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def turn_parts(role: str, text: str) -> tuple[str, str, str]:
    return f"### {escape(role, True)}:\n", escape(text), "</turn>\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation; fails on anything else."""
    turns, at = [], 0
    while at < len(formatted):
        head = _HEAD.match(formatted, at)
        body = head and _BODY.match(formatted, head.end())
        if not body:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(head[1]), unescape(body[1])))
        at = body.end()
    return turns


_workers: dict[str, object] = {}


def _tokenizer(path: str):
    """One tokenizer per worker process, which encodes in one thread."""
    if path not in _workers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        _workers[path] = Tokenizer.from_file(path)
        _workers[path].encode_special_tokens = True
    return _workers[path]


def _nodes(turns: list[tuple[str, str]]) -> list[str]:
    """A name per turn, of all turns up to it."""
    held, out = hashlib.sha256(), []
    for role, text in turns:
        for part in (role.encode(), text.encode()):
            held.update(len(part).to_bytes(8, "little") + part)
        out.append(held.hexdigest()[:32])
    return out


class Tree:
    """``nodes``: the stream, one row per node; ``conversations``: each key's path of nodes."""

    def __init__(self, nodes: DataFrame, conversations: DataFrame, key: str, tokenizer: str):
        self.nodes, self.conversations, self.key, self.tokenizer = nodes, conversations, key, tokenizer


def build(rows: DataFrame, tokenizer: str, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Tree:
    """Format all conversations; ``tokenizer`` must be lossless (byte level).

    Turns are ordered by ``turn`` (null first), then role and text; repeated rows are turns of their own. Null roles and
    texts are empty. Rows with a null key are one conversation, with a null key. One conversation is held by one
    task, and its nodes name their ancestors, so the cost of one grows with the square of its turns.
    """
    picked = rows.select(
        F.col(key).alias("key"), F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("t")
    )
    chats = picked.groupBy("key").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    chats = chats.select("key", F.col("turns.role").alias("roles"), F.col("turns.text").alias("texts"))
    kind = chats.schema["key"].dataType.simpleString()
    schema = pa.schema(
        [("node", pa.string()), ("path", pa.string()), ("depth", pa.int32()), ("position", pa.int64()), ("n_tokens", pa.int64()), ("loss_at", pa.int64()), ("loss_n", pa.int64()), ("ids", pa.list_(pa.int32())), ("above", pa.list_(pa.string()))]
    )

    def spread(batches):
        tokens = _tokenizer(tokenizer)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                whose, out, texts = [], [], []
                met: dict[str, int] = {}
                for k, (roles, bodies) in enumerate(zip(part.column("roles").to_pylist(), part.column("texts").to_pylist())):
                    names = _nodes(list(zip(roles, bodies)))
                    for d, (r, b) in enumerate(zip(roles, bodies)):
                        if names[d] not in met:  # shared turns are encoded once
                            met[names[d]] = len(texts)
                            texts += turn_parts(r, b)
                        whose.append(k)
                        out.append((names[d], "".join(n[:16] for n in names[: d + 1]), d, r == LEARNED, names[: d + 1]))
                ids = [tokens.encode(t, add_special_tokens=False).ids for t in texts]
                rows_, position = [], 0
                sent: set[str] = set()
                for name, path, depth, learned, above in out:
                    head, body, tail = ids[met[name] : met[name] + 3]
                    own = head + body + tail
                    position = 0 if depth == 0 else position
                    first = name not in sent and not sent.add(name)
                    rows_.append((name, path, depth, position, len(own), len(head) if learned else None, len(body) if learned else None, own if first else None, above if first else None))
                    position += len(own)
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows_), schema)] if rows_ else [pa.array([], f.type) for f in schema]
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(whose, pa.int64())), *columns], names=["key", *schema.names])

    placed = chats.mapInArrow(spread, f"key {kind}, node string, path string, depth int, position long, n_tokens long, loss_at long, loss_n long, ids array<int>, above array<string>")
    placed = materialise(placed, "chat-turns")
    distinct = materialise(placed.where("ids is not null").drop("key").dropDuplicates(["node"]), "chat-nodes")

    def add_up(batches):
        for batch in batches:
            sums: dict[str, int] = {}
            for n, above in zip(batch.column("n_tokens").to_pylist(), batch.column("above").to_pylist()):
                for name in above:
                    sums[name] = sums.get(name, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(list(sums.values()), pa.int64())], names=["node", "below"])

    # a node's tokens count for all its ancestors; what one batch holds is added up before it travels
    subtree = distinct.select("n_tokens", "above").mapInArrow(add_up, "node string, below long").groupBy("node").agg(F.sum("below").alias("below"))
    ordered = running_total(distinct.select("node", "path", "n_tokens"), [F.col("path"), F.col("node")], "n_tokens", "end").select("node", "end")
    start = F.col("end") - F.col("n_tokens")
    nodes = distinct.join(ordered, "node").join(subtree, "node").select(
        "node", F.element_at("above", F.when(F.col("depth") > 0, -2).otherwise(-1)).alias("above"), "depth", "position", start.alias("start"), "end",
        (start + F.col("below")).alias("visible"), (start + F.col("loss_at")).alias("loss_from"), (start + F.col("loss_at") + F.col("loss_n")).alias("loss_to"), "ids",
    ).withColumn("parent", F.when(F.col("depth") > 0, F.col("above"))).drop("above")
    paths = placed.select(F.col("key").alias(key), "depth", "node")
    return Tree(materialise(nodes, "chat-stream"), paths, key, tokenizer)


def read_back(tree: Tree) -> DataFrame:
    """(key, formatted, learned) of each conversation, from the stream: its whole text and the parts under the loss mask."""
    key, path = tree.key, tree.tokenizer
    node = tree.nodes.select("node", "ids", (F.col("loss_from") - F.col("start")).alias("a"), (F.col("loss_to") - F.col("start")).alias("b"))
    turns = tree.conversations.join(node, "node").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("depth", "ids", "a", "b"))).alias("turns"))
    kind = turns.schema[key].dataType.simpleString()

    def decode(batches):
        tokens = _tokenizer(path)
        for batch in (b.slice(at, SLICE_ROWS) for b in batches for at in range(0, b.num_rows, SLICE_ROWS)):
            whole, learned = [], []
            for turns in batch.column("turns").to_pylist():
                whole.append(tokens.decode([i for t in turns for i in t["ids"]], skip_special_tokens=False))
                learned.append([tokens.decode(t["ids"][t["a"] : t["b"]], skip_special_tokens=False) for t in turns if t["a"] is not None])
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(whole, pa.string()), pa.array(learned, pa.list_(pa.string()))], names=[key, "formatted", "learned"])

    return turns.select(key, "turns").mapInArrow(decode, f"`{key}` {kind}, formatted string, learned array<string>")


def digests(texts: DataFrame, key: str) -> DataFrame:
    """(key, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of what ``read_back`` returns."""
    kind = texts.schema[key].dataType.simpleString()
    schema = pa.schema([("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def digest(batches):
        for batch in sliced(batches, "formatted"):
            rows = []
            for formatted, learned in zip(batch.column("formatted").to_pylist(), batch.column("learned").to_pylist()):
                turns = parse(formatted)
                loss = "".join(map(unescape, learned))
                rows.append((len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
            yield pa.RecordBatch.from_arrays([batch.column(key), *(pa.array(c, f.type) for c, f in zip(zip(*rows), schema))], names=[key, *schema.names])

    return texts.mapInArrow(digest, f"`{key}` {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
