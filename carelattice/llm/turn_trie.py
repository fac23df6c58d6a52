"""The trie of all conversation prefixes, by peeling last turns.

Conversations are sequences of turns; every distinct sequence of first turns is a
node. A group of sequences is peeled from its maximum depth on: sequences that end at
a depth join the nodes that survive there, equal ones are one node, whose numbers are
final at that moment; then every node loses its last turn, and those left with the
same turns meet as children of one parent.

To peel in parallel, sequences are dealt by the shortest of their prefixes that no
more than ``GROUP`` sequences share. What a group leaves is one row per such prefix.
These rows meet in their parents by a grouped sum and are, with the sequences that end
in a crowded prefix, the sequences of the next round. Crowded prefixes are at most
one in ``GROUP`` of a depth's, so few rounds remain, whatever is shared how often.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.llm.common import by_record, written

# Distinct sequences peeled together, turns borrowed at most, and ids hashed as one block.
GROUP = 1_000
BORROWED = 8
ID_BLOCK = 1_024
# Bytes of a prefix's key.
KEY = 16

NODE = ("depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
        "saved_tokens bigint, ends_sha256 string, key binary")
_NODE_NAMES = [c.split()[0] for c in NODE.split(", ")]
_UP = ("struct<path: binary, sizes: binary, n_convs: bigint, conv_id: bigint, n_children: bigint, n_leaves: bigint, "
       "saved: bigint>")
NO_ENDS = hashlib.sha256().hexdigest()


def borrowed_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from its base."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % (BORROWED + 1)).cast("int")


def base_of(conv_id: Column) -> Column:
    return conv_id - conv_id % 5


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path, sizes): rebuilt conversations as chains of prefix keys.

    ``path`` holds 16 bytes per turn, the MD5 of the turn and of the key before it;
    ``sizes`` the bytes of each turn's text as 8-byte numbers. A conversation and its
    base lie in one family of five; a family is read in order, base first, and of the
    base only eight turns are remembered. A conversation's path, 24 bytes a turn, is
    held by its task.

    Turns come by turn (NULL first), role and text; NULL roles and texts are empty,
    repeated rows stay. Rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", role.alias("role"), text.alias("text")).select(
        base_of(F.col("conv_id")).alias("family"), borrowed_turns(F.col("conv_id")).alias("borrowed"), "conv_id", "turn",
        "role", "text", F.unhex(F.md5(F.concat_ws(":", F.octet_length("role"), "role", "text").cast("binary"))).alias("digest"),
        F.octet_length("text").cast("bigint").alias("size"))
    ordered = turns.repartition("family").sortWithinPartitions(
        "family", F.col("conv_id") != F.col("family"), "conv_id", "turn", "role", "text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: list | None = None
        lent: tuple[int, list] = (0, [])

        def chained(conv: list) -> tuple[int, bytes, bytes]:
            family, conv_id, borrowed, own = conv
            head = [] if conv_id == family else [t for t in (lent[1] if lent[0] == family else [])[:borrowed]]
            turns = head + (own if conv_id == family else own[borrowed:])
            key, path = b"", []
            for digest, _ in turns:
                key = hashlib.md5(key + digest).digest()
                path.append(key)
            return conv_id, b"".join(path), np.array([n for _, n in turns], np.int64).tobytes()

        def closed(rows: list[tuple]) -> pa.RecordBatch:
            ids, paths, sizes = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(paths, pa.binary()), pa.array(sizes, pa.binary())],
                names=["conv_id", "path", "sizes"])

        for batch in by_record(batches, 4096):
            done = []
            for family, conv_id, borrowed, digest, size in zip(*[batch.column(i).to_pylist() for i in range(5)]):
                if now is None or now[1] != conv_id:
                    if now is not None:
                        done.append(chained(now))
                        if now[0] == now[1]:
                            lent = (now[0], now[3][:BORROWED])
                    now = [family, conv_id, borrowed, []]
                now[3].append((digest, size))
            if done:
                yield closed(done)
        if now is not None:
            yield closed([chained(now)])

    return ordered.select("family", "conv_id", "borrowed", "digest", "size").mapInArrow(
        run, "conv_id bigint, path binary, sizes binary")


def last_key(path: str) -> Column:
    """The key of a whole path; that of the root is empty."""
    return F.substring(path, -KEY, KEY)


def listed_ids(ids: DataFrame) -> DataFrame:
    """(key, ends): SHA-256 of the decimal ids of every key, ascending and comma-joined.

    ``ids`` is (key, conv_id) without repeats. Ids are joined in blocks of consecutive
    numbers, all in parallel; one task per key then hashes its blocks in order.
    """
    block = F.floor(F.col("conv_id") / ID_BLOCK)
    blocks = ids.groupBy("key", block.alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    ordered = blocks.repartition("key").sortWithinPartitions("key", "block").select("key", "ids")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None

        def closed(rows: list[tuple]) -> pa.RecordBatch:
            keys, ends = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(ends, pa.string())], names=["key", "ends"])

        for batch in by_record(batches, 4096):
            done = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key != now or digest is None:
                    if digest is not None:
                        done.append((now, digest.hexdigest()))
                    now, digest = key, hashlib.sha256(text.encode())
                else:
                    digest.update(b"," + text.encode())
            if done:
                yield closed(done)
        if digest is not None:
            yield closed([(now, digest.hexdigest())])

    return ordered.mapInArrow(run, "key binary, ends string")


class _Node:
    __slots__ = ("n_convs", "conv_id", "n_children", "n_leaves", "saved", "ends", "path", "sizes", "children")

    def __init__(self, path: bytes, sizes: np.ndarray) -> None:
        self.path, self.sizes = path, sizes
        self.n_convs = self.n_children = self.n_leaves = self.saved = 0
        self.conv_id, self.ends = None, None
        self.children: list[list] = []

    def add(self, n_convs: int, conv_id: int, n_children: int, n_leaves: int, saved: int, ends: str | None) -> None:
        self.n_convs += n_convs
        self.conv_id = conv_id if self.conv_id is None else min(conv_id, self.conv_id)
        self.n_children += n_children
        self.n_leaves += n_leaves
        self.saved += saved
        self.ends = ends or self.ends


def peel(sequences: list[tuple], home: int) -> Iterator[tuple[int, _Node, bool]]:
    """(depth, node, is_last) of every node from the deepest to those at depth ``home``.

    A sequence is (path, sizes, n_convs, conv_id, n_children, n_leaves, saved, ends).
    A node comes when it is complete, its children's parents with it: ``children``
    holds the rows of its children. Nodes at ``home`` come last.
    """
    ending: dict[int, list[tuple]] = {}
    for s in sequences:
        ending.setdefault(len(s[0]) // KEY, []).append(s)
    alive: dict[bytes, _Node] = {}
    for depth in range(max(ending, default=home), home - 1, -1):
        for path, sizes, *numbers in ending.pop(depth, ()):
            key = path[KEY * (depth - 1):] if depth else b""
            node = alive.get(key)
            if node is None:
                node = alive[key] = _Node(path, np.frombuffer(sizes, np.int64))
            node.add(*numbers)
        shorter: dict[bytes, _Node] = {}
        for key, node in alive.items():
            node.n_leaves = node.n_leaves if node.n_children else 1
            if depth:
                node.saved += (node.n_convs - 1) * int(node.sizes[depth - 1])
            yield depth, node, depth == home
            if depth > home:
                up = node.path[KEY * (depth - 2):KEY * (depth - 1)] if depth > 1 else b""
                parent = shorter.get(up)
                if parent is None:
                    parent = shorter[up] = _Node(node.path, node.sizes)
                parent.add(node.n_convs, node.conv_id, 1, node.n_leaves, node.saved, None)
                parent.children.append([depth, node.conv_id, None, node.n_convs, node.n_children, node.n_leaves,
                                        node.saved, node.ends or NO_ENDS, key])
        alive = shorter


_SEQUENCE = ["path", "sizes", "n_convs", "conv_id", "n_children", "n_leaves", "saved", "ends"]


def _peeled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of all groups, and per group the row it leaves (as a node with ``up`` set)."""
    names = [*_NODE_NAMES, "up"]
    up_type = pa.struct([("path", pa.binary()), ("sizes", pa.binary()), *[
        (c, pa.int64()) for c in ("n_convs", "conv_id", "n_children", "n_leaves", "saved")]])
    rows: list[list] = []

    def flushed() -> pa.RecordBatch:
        columns = list(zip(*rows))
        kinds = [*[pa.int64()] * 7, pa.string(), pa.binary(), up_type]
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def group(sequences: list[tuple], home: int, parent: int | None) -> None:
        for depth, node, is_last in peel(sequences, home):
            for child in node.children:
                child[2] = node.conv_id
                rows.append([*child, None])
            if is_last:
                up = None
                if depth:
                    up = {"path": node.path[:KEY * (depth - 1)], "sizes": node.sizes[:depth - 1].tobytes(),
                          "n_convs": node.n_convs, "conv_id": node.conv_id, "n_children": 1, "n_leaves": node.n_leaves,
                          "saved": node.saved}
                rows.append([depth, node.conv_id, parent, node.n_convs, node.n_children, node.n_leaves, node.saved,
                             node.ends or NO_ENDS, node.path[KEY * (depth - 1):KEY * depth] if depth else b"", up])

    now, held = None, []
    for batch in by_record(batches):
        for row in batch.to_pylist():
            at = (row["home"], row["home_depth"])
            if at != now:
                if held:
                    group(held, now[1], parent)
                now, held = at, []
            parent = row["parent_conv_id"]
            held.append(tuple(row[c] for c in _SEQUENCE))
            if len(rows) > 10_000:
                yield flushed()
    if held:
        group(held, now[1], parent)
    if rows:
        yield flushed()


def _prefixes(sequences: DataFrame) -> DataFrame:
    """(last, conv_id, depth, key): every prefix of every sequence, the root included."""
    depth = (F.octet_length("path") / KEY).cast("int")
    at = F.explode(F.sequence(F.lit(0), depth)).alias("depth")
    return sequences.select("last", "conv_id", "path", at).select(
        "last", "conv_id", "depth",
        F.when(F.col("depth") == 0, F.lit(b"")).otherwise(F.substring("path", KEY * (F.col("depth") - 1) + 1, F.lit(KEY))).alias("key"))


def trie(chains: DataFrame) -> DataFrame:
    """One row per node, as NODE says, of conversations given by :func:`rebuilt`.

    conv_id is the smallest member, parent_conv_id that of the parent (NULL for the
    root), n_convs the members, n_leaves and saved_tokens (members but one times the
    bytes of the last text, summed) are those of the whole subtree, ends_sha256 is the
    digest of the ids of the members that end in the node. Conversations without turns
    are members of the root alone. No conversations, no row.
    """
    ids = written(chains.select(last_key("path").alias("key"), "conv_id", "path", "sizes"), "chains")
    # Equal conversations are one sequence.
    ended = ids.groupBy("key").agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"),
        F.any_value("path").alias("path"), F.any_value("sizes").alias("sizes"))
    zero = F.lit(0).cast("bigint")
    sequences = written(
        ended.join(listed_ids(ids.select("key", "conv_id")), "key").select(
            F.col("key").alias("last"), "path", "sizes", "n_convs", "conv_id", zero.alias("n_children"),
            zero.alias("n_leaves"), zero.alias("saved"), "ends"), "sequences")
    nodes: DataFrame | None = None
    while True:
        prefixes = written(_prefixes(sequences), "prefixes")
        crowded = written(
            prefixes.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("conv_id"))
            .where(F.col("n") > GROUP).select("key", F.col("conv_id").alias("least")), "crowded")
        deepest = prefixes.join(crowded, "key").groupBy("last").agg(F.max(F.struct("depth", "least")).alias("deepest"))
        own = (F.octet_length("path") / KEY).cast("int")
        placed = written(
            sequences.join(deepest, "last", "left").select(
                *_SEQUENCE, F.coalesce(F.col("deepest.depth") + 1, F.lit(0)).alias("home_depth"),
                F.col("deepest.least").alias("parent_conv_id"), own.alias("own")), "placed")
        home = F.when(F.col("home_depth") == 0, F.lit(b"")).otherwise(
            F.substring("path", KEY * (F.col("home_depth") - 1) + 1, F.lit(KEY)))
        grouped = placed.where("home_depth <= own").withColumn("home", home).drop("own")
        peeled = written(
            grouped.repartition("home").sortWithinPartitions("home_depth", "home").mapInArrow(
                _peeled, f"{NODE}, up {_UP}"), "nodes")
        found = peeled.drop("up")
        nodes = found if nodes is None else nodes.unionByName(found)
        if crowded.isEmpty():
            return nodes
        # Groups and sequences that end in crowded prefixes meet there.
        up = peeled.where("up is not null").select("up.*", F.lit(None).cast("string").alias("ends"))
        stay = placed.where("home_depth > own").select(*_SEQUENCE)
        sequences = written(
            up.select(*_SEQUENCE).unionByName(stay).withColumn("last", last_key("path")).groupBy("last").agg(
                F.any_value("path").alias("path"), F.any_value("sizes").alias("sizes"),
                F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"),
                F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"),
                F.sum("saved").alias("saved"), F.max("ends").alias("ends")), "sequences")
