"""The prefix trie of conversations by truncation peeling.

A conversation is the path of its turns; a node is a beginning that some conversation has. Peeling starts at the deepest end:
conversations that end at a depth join the nodes that survived from below, a node is finished, its last turn is stripped,
and what it summed up goes to the beginning that is left. Nodes come up and are summed in that one pass; none are listed before.

A turn stands in its path as a digest of the whole beginning up to it, so a path is a byte string, beginnings are prefixes of it, and paths
sorted by range have the conversations below a node side by side. Each task peels its own run of sorted paths with a stack
as deep as the current path; copies of a path are one row. Only nodes on the first and the last path of a run may go on
in another task: they are handed on, a row or two per run, and peeled again over ever fewer runs until one is left. So the work of a
task is a range of paths, however many conversations share their first turns.

Members of a node that end there are hashed in the order of their ids, streamed through one task per path: a hash of an ordered list
has no parts. Turns of one conversation are sorted in one row: ``WIDTH`` bytes and a length per turn.

Defined cases: NULL turns come first, ties are in order of the digests of their turns; NULL role and text are empty; rows without a
conversation id are left out; conversations without turns end at the root; an empty table has no nodes, not even the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from twinproof.llm.tables import written

#: Bytes of a digest in a path, and runs of handed-on nodes that one run takes together.
WIDTH, MERGE = 16, 64


def turns(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, turns)``: per conversation its turns in order, each a struct of ``turn``, ``digest`` and ``length`` of the text in code points."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat(F.octet_length(r).cast("string"), F.lit(":"), r, t), 256)), 1, WIDTH)
    slim = rows.select(F.col(conv_id).cast("long").alias("conv_id"), F.struct(F.col(turn).cast("long").alias("turn"), digest.alias("digest"), F.length(t).cast("long").alias("length")).alias("t"))
    return slim.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def rebuilt(conversations: DataFrame, every: int = 100, shared: int = 6) -> DataFrame:
    """Conversations whose first turns are those of the one that their block of ``every`` ids begins with; fewer than ``shared`` of them, by the hash of the id."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    own = conversations.select("conv_id", "turns", head.cast("int").alias("head"), (F.col("conv_id") - F.col("conv_id") % every).alias("donor"))
    first = conversations.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("donor"), F.slice("turns", 1, shared).alias("given"))
    rest = F.slice("turns", F.col("head") + 1, F.greatest(F.size("turns") - F.col("head"), F.lit(0)))
    given = F.coalesce(F.slice("given", F.lit(1), F.col("head")), F.slice("turns", 1, 0))
    return own.join(first, "donor", "left").select("conv_id", F.concat(given, rest).alias("turns"))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, lengths = [], []
        for own in batch.column("turns").to_pylist():
            state, path = b"", []
            for t in own:
                state = hashlib.blake2b(state + t["digest"], digest_size=WIDTH).digest()
                path.append(state)
            paths.append(b"".join(path))
            lengths.append([t["length"] for t in own])
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pa.array(paths, pa.binary()), pa.array(lengths, pa.list_(pa.int64()))], names=["conv_id", "path", "lengths"])


def paths(conversations: DataFrame) -> DataFrame:
    """``(conv_id, path, lengths)``; the bytes up to ``WIDTH * d`` of a path are equal for equal first ``d`` turns only."""
    return conversations.select("conv_id", "turns").mapInArrow(_paths, "conv_id long, path binary, lengths array<long>")


#: What a node sums up: members met so far, the smallest of them, finished children, leaves and savings below.
_SUMS = ["n_convs", "conv_id", "n_children", "n_leaves", "saved_tokens"]
_OUT = "key binary, parent_key binary, depth long, " + ", ".join(f"{c} long" for c in _SUMS) + ", path binary, lengths array<long>, sums array<array<long>>"
_LONGS = pa.list_(pa.int64())
_OUT_ARROW = pa.schema([
    ("key", pa.binary()), ("parent_key", pa.binary()), ("depth", pa.int64()), *[(c, pa.int64()) for c in _SUMS],
    ("path", pa.binary()), ("lengths", _LONGS), ("sums", pa.list_(_LONGS)),
])


def _common(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common from the beginning."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[: mid * WIDTH] == b[: mid * WIDTH] else (low, mid - 1)
    return low


def _add(node: list, members: int, smallest: int | None, children: int, leaves: int, saved: int) -> None:
    node[0] += members
    node[1] = min((x for x in (node[1], smallest) if x is not None), default=None)
    node[2] += children
    node[3] += leaves
    node[4] += saved


def peel(items: Iterator[tuple], whole: bool) -> Iterator[tuple]:
    """Items ``(path, lengths, sums of the last nodes of the path)`` in the order of their paths to rows of ``_OUT``.

    A row is a finished node, or an item of nodes to be handed on; with ``whole`` all items of the trie are here, and every node is finished.
    """
    stack: list[list] = []  # sums of the nodes on the current path, the root first
    path, lengths, mark = b"", [], None  # nodes below ``mark`` on the stack are on the first path

    def strip(keep: int) -> Iterator[tuple]:
        """Takes the last turns off, deepest first, until ``keep`` nodes are left."""
        open_ = []
        while len(stack) > keep:
            node, depth = stack.pop(), len(stack)
            if depth < mark and not whole:
                open_.append(node)
                continue
            members, smallest, children, leaves, saved = node
            leaves = leaves if children else 1
            saved += (members - 1) * (lengths[depth - 1] if depth else 0)
            key = path[max(0, depth - 1) * WIDTH : depth * WIDTH]
            parent = path[max(0, depth - 2) * WIDTH : (depth - 1) * WIDTH] if depth else None
            yield key, parent, depth, members, smallest, children, leaves, saved, None, None, None
            if stack:
                _add(stack[-1], members, smallest, 1, leaves, saved)
        if open_:
            depth = keep + len(open_) - 1
            yield *[None] * 8, path[: depth * WIDTH], lengths[:depth], open_[::-1]

    for new, its, sums in items:
        keep = 0 if mark is None else _common(path, new) + 1
        yield from strip(keep)
        depth = len(new) // WIDTH
        mark = depth + 1 if mark is None else min(mark, keep)
        path, lengths = new, its
        stack += [[0, None, 0, 0, 0] for _ in range(depth + 1 - len(stack))]
        for node, own in zip(stack[depth + 1 - len(sums) :], sums):
            _add(node, *own)
    mark = len(stack)  # the last path may go on in the next run
    yield from strip(0)


def _peeled(items: DataFrame, whole: bool) -> DataFrame:
    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT_ARROW)], schema=_OUT_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for row in peel((row for b in batches for row in zip(*[c.to_pylist() for c in b.columns])), whole):
            out.append(row)
            if len(out) == 10_000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    return items.sortWithinPartitions("path").select("path", "lengths", "sums").mapInArrow(run, _OUT)


def nodes(found: DataFrame) -> DataFrame:
    """``(key, parent_key, depth, conv_id, n_convs, n_children, n_leaves, saved_tokens)`` of all nodes of ``paths``."""
    ended = found.groupBy("path").agg(F.first("lengths").alias("lengths"), F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
    nothing = F.lit(0).cast("long")
    items = ended.select("path", "lengths", F.array(F.array("n", "conv_id", nothing, nothing, nothing)).alias("sums"))
    runs, every = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), None
    while True:
        dealt = items.repartition(1) if runs == 1 else items.repartitionByRange(runs, "path")
        rows = written(_peeled(dealt, runs == 1), "trie-peeled")
        finished = rows.where("key IS NOT NULL").select("key", "parent_key", "depth", *_SUMS)
        every = finished if every is None else every.unionByName(finished)
        if runs == 1:
            return every
        runs, items = -(-runs // MERGE), rows.where("key IS NULL")


#: The last digest of a path, empty for the root.
_LAST = f"substring(path, greatest(1, length(path) - {WIDTH - 1}), {WIDTH})"


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the ids of each key, of rows sorted by key and id."""
    key, state = None, None
    for batch in batches:
        out = []
        for k, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if k != key:
                if key is not None:
                    out.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(str(conv).encode())
            else:
                state.update(f",{conv}".encode())
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([d for _, d in out], pa.string())], names=["key", "ends_sha256"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["key", "ends_sha256"])


def ends(found: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` of the nodes at which conversations end."""
    slim = found.select(F.expr(_LAST).alias("key"), "conv_id")
    return slim.repartition("key").sortWithinPartitions("key", "conv_id").mapInArrow(_ends, "key binary, ends_sha256 string")


def report(rows: DataFrame, every: int = 100, shared: int = 6, columns: Sequence[str] = ("conv_id", "turn", "role", "text")) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    found = written(paths(rebuilt(written(turns(rows, *columns), "trie-turns"), every, shared)), "trie-paths")
    all_ = written(nodes(found), "trie-nodes")
    parents = all_.where("n_children > 0").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    closed = all_.join(parents, "parent_key", "left").join(ends(found), "key", "left")
    return closed.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
