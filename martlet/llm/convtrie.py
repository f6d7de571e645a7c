"""The prefix trie of conversations, and what sharing prefixes saves.

A node is a distinct sequence of first turns. Sequences of turn ids (128 bits of the SHA-256 of
role and text) are dealt to shards by ranges of their order, so the members of a node are
neighbours. A task reads its shard in order, chunk by chunk:

* The chunk's turns get dense ids, and its sequences become a matrix of turn ids, padded with 0. A
  lexsort of the columns brings equal beginnings together; where a column differs from the row
  before, or any column to its left does (changes are OR-accumulated along the row), a node
  starts. Deep sequences come in blocks of columns, each block of the rows that reach it.
* With the cells in order of depth, one ``reduceat`` at the node starts adds up every depth: members,
  children, leaves, and the words of rows and of distinct nodes from there on to the end.

All nodes are whole but those on the path of a chunk's first and last row. These boundary nodes
are added up by key in Spark. As the first row of a shard cannot be compared with the last one of
the shard before, what both count (nodes, children and leaves on their common path) is taken off
once per pair of neighbours, from a table of one row per shard.

The conversations that end at a node are digested in order of their ids: in the chunk, or, for boundary
nodes, by a task that streams through the sorted ids and keeps a running digest. A conversation
that any number of others equal is thus cut over shards; only its digest, sequential by
definition, is one task's work, over ids alone. A task holds the ids and word counts of a
conversation, 20 bytes a turn.

Defined results: turns come by ``turn``, a null first, equal turns by the digest of role and text;
repeated rows are turns of their own. A null role or text is empty. Rows without ``conv_id`` take
no part. An empty table has no conversations and so no nodes. Other columns take no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlet.session import materialise, remove_folder, shared_folder

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 64
CHUNK_ROWS = 1 << 13
CHUNK_CELLS = 1 << 18
_NOBODY = np.iinfo(np.int64).max
_NODE = (
    "conv_id long, depth long, parent_conv_id long, parent_key string, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
_PART = "key string, row_words long, node_words long"
_EDGE = (
    "shard int, first_ids array<binary>, first_words array<int>, last_ids array<binary>, "
    "last_words array<int>"
)
_SUMS = ("n_convs", "n_children", "n_leaves", "row_words", "node_words")


def sequences(
    messages: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, turns``: an array of (turn, id, words) in order, per conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.unhex(F.substring(digest, 1, 32)).alias("id"),
        F.regexp_count(text, F.lit(WORD)).alias("words"),
    )
    rows = messages.where(F.col(conv_col).isNotNull())
    rows = rows.select(F.col(conv_col).cast("long").alias("conv_id"), turn.alias("turn"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def with_shared_heads(found: DataFrame, group: int, heads: Column, most: int) -> DataFrame:
    """Each conversation with its first turns taken from the first of its group.

    ``heads`` tells per ``conv_id`` how many, ``most`` at most; a group is ``group`` ids in a row.
    """
    base = F.col("conv_id") - F.col("conv_id") % group
    firsts = found.where(base == F.col("conv_id")).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("first")
    )
    joined = found.withColumns({"base": base, "heads": heads.cast("int")}).join(
        firsts, "base", "left"
    )
    head = F.when(F.col("first").isNotNull(), F.slice("first", F.lit(1), F.col("heads")))
    nothing = F.slice("turns", 1, 0)
    own = F.slice("turns", F.col("heads") + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(F.coalesce(head, nothing), own).alias("turns"))


@dataclass
class Chunk:
    """Sequences in a row: their conversations, lengths, and the ids and words of all turns."""

    conv: np.ndarray
    length: np.ndarray
    ids: np.ndarray  # (turns, 2) of big-endian 64-bit halves
    words: np.ndarray

    @staticmethod
    def read(batch: pa.RecordBatch) -> Chunk:
        lists = batch.column(1)
        length = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        flat = lists.flatten()
        ends = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1]
        data = memoryview(flat.buffers()[2])[ends[0] : ends[-1]] if len(flat) else b""
        words = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        ids = np.frombuffer(data, ">u8").reshape(-1, 2)
        return Chunk(batch.column(0).to_numpy(), length, ids, words)

    @staticmethod
    def joined(parts: list[Chunk]) -> Chunk:
        columns = ((p.conv, p.length, p.ids, p.words) for p in parts)
        return Chunk(*(np.concatenate(c) for c in zip(*columns)))

    def row(self, at: int) -> Chunk:
        """One sequence, without its conversation."""
        end = int(self.length[: at + 1].sum()) if at >= 0 else int(self.length.sum())
        start = end - int(self.length[at])
        nobody = np.array([_NOBODY])
        return Chunk(nobody, self.length[at:][:1], self.ids[start:end], self.words[start:end])

    def path(self) -> list[str]:
        """Keys of the nodes of a single sequence, the root first."""
        digest = hashlib.sha256()
        keys = [digest.hexdigest()]
        for pair in self.ids:
            digest.update(pair.tobytes())
            keys.append(digest.hexdigest())
        return keys


def dense(ids: np.ndarray) -> np.ndarray:
    """Ids from 1 in the same order as the given pairs."""
    order = np.lexsort((ids[:, 1], ids[:, 0]))
    ranked = ids[order]
    step = np.append(True, (ranked[1:] != ranked[:-1]).any(axis=1)) if len(ids) else []
    found = np.empty(len(ids), np.int64)
    found[order] = np.cumsum(step)
    return found


def node_starts(ids: np.ndarray, length: np.ndarray, block: int = BLOCK) -> tuple:
    """(order, new): rows in order of their sequences, and per cell whether a node starts there.

    ``ids`` holds the cells row by row, in the given order of rows, and so does ``new``.
    """
    n, start = len(length), np.cumsum(length) - length
    order, new = np.arange(n), np.zeros(len(ids), bool)
    slots, group = np.arange(n), np.zeros(n, np.int64)  # of the rows that reach the block
    changes = []
    for left in range(0, int(length.max(initial=0)), block):
        rows = order[slots]
        width = int(min(block, length[rows].max() - left))
        inside = left + np.arange(width) < length[rows][:, None]
        matrix = np.zeros((len(rows), width), np.int64)
        cells = (start[rows][:, None] + left + np.arange(width))[inside]
        matrix[inside] = ids[cells]
        # Of equal rows, those that go on behind the block come last.
        onward = length[rows] > left + width
        place = np.lexsort((onward, *matrix.T[::-1], group))
        rows, matrix, inside, group = rows[place], matrix[place], inside[place], group[place]
        order[slots] = rows
        changed = np.ones((len(rows), width), bool)
        changed[1:] = matrix[1:] != matrix[:-1]
        changed[1:, 0] |= group[1:] != group[:-1]
        changed = np.logical_or.accumulate(changed, axis=1)
        changes.append((slots, left + np.arange(width), inside, changed))
        onward = onward[place]
        group = np.cumsum(changed[:, -1])[onward]
        slots = slots[onward]
    for slots, columns, inside, changed in changes:  # later blocks have moved rows among equals
        cells = start[order[slots]][:, None] + columns
        new[cells[inside]] = changed[inside]
    return order, new


class ShardReader:
    """Reads the sequences of a shard in order; gives nodes, parts of boundary nodes, and ends."""

    def __init__(self, block: int = BLOCK) -> None:
        self.block = block
        self.first = self.last = None

    def add(self, chunk: Chunk | None) -> Iterator[dict]:
        """The next sequences, or None after the last one."""
        if chunk is None:
            if self.last is not None:
                yield from self._nodes(self.last, True, closing=True)
            return
        if self.first is None:
            self.first = chunk.row(0)
        carried = self.last is not None
        chunk = Chunk.joined([self.last, chunk]) if carried else chunk
        self.last = chunk.row(-1)
        yield from self._nodes(chunk, carried)

    def _nodes(self, chunk: Chunk, carried: bool, closing: bool = False) -> Iterator[dict]:
        """``carried``: the first row was the last one of the chunk before, and counted there."""
        order, new = node_starts(dense(chunk.ids), chunk.length, self.block)
        n, length = len(order), chunk.length[order]
        own = np.ones(n, np.int64)
        own[0] = not carried
        conv = chunk.conv[order]

        # Cells row by row in order of the rows.
        begin = np.cumsum(length) - length
        row = np.repeat(np.arange(n), length)
        depth = np.arange(len(row)) - begin[row]
        cell = (np.cumsum(chunk.length) - chunk.length)[order][row] + depth
        new, words = new[cell], chunk.words[cell]
        fresh = new & (own[row] > 0)

        # A row is the last of a leaf's if the next one does not begin with all of it.
        leaf = np.zeros(n, np.int64)
        leaf[-1] = closing
        ended = length[:-1] - 1
        reach = begin[1:] + np.maximum(ended, 0)
        holds = length[1:] > ended
        holds[holds] = ~new[reach[holds]] | (ended[holds] < 0) if len(new) else True
        leaf[:-1] = ~holds

        def to_end(values):
            """Sums from a cell to the end of its row."""
            total = np.append(0, np.cumsum(values))
            return total[(begin + length)[row]] - total[:-1]

        last = depth == length[row] - 1
        child = np.append(fresh[1:], False) & ~last
        by_depth = np.argsort(depth, kind="stable")
        starts = np.flatnonzero(new[by_depth])

        def reduced(values, add=np.add):
            return add.reduceat(values[by_depth], starts) if len(starts) else values[:0]

        counts = {
            "n_convs": reduced(own[row]),
            "n_children": reduced(child.astype(np.int64)),
            "n_leaves": reduced(leaf[row]),
            "row_words": reduced(to_end(words * own[row])),
            "node_words": reduced(to_end(words * fresh)),
            "conv_id": reduced(conv[row], np.minimum),
            "depth": depth[by_depth][starts] + 1,
        }
        root = {
            "n_convs": int(own.sum()),
            "n_children": int(fresh[depth == 0].sum()),
            "n_leaves": int(leaf.sum()),
            "row_words": int((words * own[row]).sum()),
            "node_words": int((words * fresh).sum()),
            "conv_id": int(conv.min()),
            "depth": 0,
        }
        node = np.empty(len(row), np.int64)  # of each cell
        node[by_depth] = np.cumsum(new[by_depth]) - 1
        above = np.where(depth > 0, np.append(-1, node[:-1])[: len(row)], -1)
        parent = above[by_depth][starts]  # -1: the root

        keys = {-1: hashlib.sha256().hexdigest()}
        for at in {0, n - 1}:
            path = chunk.row(int(order[at])).path()
            keys |= dict(zip(node[begin[at] : begin[at] + length[at]].tolist(), path[1:]))
        end = np.full(n, -1)
        end[length > 0] = node[(begin + length - 1)[length > 0]]
        boundary = np.zeros(len(starts) + 1, bool)
        boundary[list(keys)] = True  # the last place is the root's
        yield from self._parts(counts, root, parent, keys)
        yield from self._ends(end[own > 0], conv[own > 0], keys, boundary)
        yield self._whole(counts, parent, keys, boundary, end[own > 0], conv[own > 0])

    def _parts(self, counts, root, parent, keys) -> Iterator[dict]:
        found = {name: [] for name in ("key", "parent_key", *root)}
        for at, key in keys.items():
            found["key"].append(key)
            found["parent_key"].append(None if at < 0 else keys[int(parent[at])])
            for name in root:
                found[name].append(root[name] if at < 0 else int(counts[name][at]))
        found["conv_id"] = [None if c == _NOBODY else c for c in found["conv_id"]]
        yield {"kind": "part"} | found

    def _ends(self, end, conv, keys, boundary) -> Iterator[dict]:
        mine = boundary[end]
        if mine.any():
            key = [keys[at] for at in end[mine].tolist()]
            yield {"kind": "end", "key": key, "conv_id": conv[mine]}

    def _whole(self, counts, parent, keys, boundary, end, conv) -> dict:
        inner = ~boundary[:-1]
        held = boundary[parent[inner]]
        digests = np.full(len(inner), hashlib.sha256().hexdigest(), object)
        ending = ~boundary[end]
        end, conv = end[ending], conv[ending]
        cuts = np.flatnonzero(np.append(True, end[1:] != end[:-1])) if len(end) else []
        for a, b in zip(cuts, [*cuts[1:], len(end)]):
            digests[end[a]] = hashlib.sha256(",".join(map(str, conv[a:b].tolist())).encode()).hexdigest()
        of_parent = parent[inner]
        near = np.append(counts["conv_id"], _NOBODY)[of_parent]
        found = {name: counts[name][inner] for name in ("conv_id", "depth", *_SUMS[:3])}
        return {
            "kind": "node",
            **found,
            "saved_tokens": (counts["row_words"] - counts["node_words"])[inner],
            "ends_sha256": digests[inner],
            "parent_conv_id": pa.array(near, mask=held),
            "parent_key": [keys.get(at) for at in of_parent.tolist()],
        }

    def edge(self, shard: int) -> Iterator[dict]:
        """The first and the last sequence of the shard."""
        if self.first is not None:
            found = {"kind": "edge", "shard": [shard]}
            for name, row in (("first", self.first), ("last", self.last)):
                found[f"{name}_ids"] = [[pair.tobytes() for pair in row.ids]]
                found[f"{name}_words"] = [row.words.tolist()]
            yield found


def _chunks(batches: Iterator[pa.RecordBatch], rows: int, cells: int) -> Iterator[Chunk]:
    """Chunks of about so many rows or cells, whichever is reached first."""
    held, size = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            held.append(Chunk.read(batch.slice(start, rows)))
            size += len(held[-1].ids)
            if sum(len(c.length) for c in held) >= rows or size >= cells:
                yield Chunk.joined(held)
                held, size = [], 0
    if held:
        yield Chunk.joined(held)


def conversation_trie(
    found: DataFrame,
    *,
    block: int = BLOCK,
    chunk_rows: int = CHUNK_ROWS,
    chunk_cells: int = CHUNK_CELLS,
) -> DataFrame:
    """All nodes of the trie of ``conv_id, turns`` (one row per conversation, ids distinct).

    ``conv_id`` (the smallest member), ``depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens`` (words that need no second reading, over the subtree) and ``ends_sha256``.
    """
    spark = found.sparkSession
    folder = f"{shared_folder(spark)}/trie-{uuid4().hex}"
    fields = ["kind string", _NODE, _PART, _EDGE]
    schema = spark.createDataFrame([], ", ".join(fields)).schema
    arrow = _arrow(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = ShardReader(block)
        for chunk in _chunks(batches, chunk_rows, chunk_cells):
            for rows in reader.add(chunk):
                yield _batch(rows, arrow)
        for rows in (*reader.add(None), *reader.edge(TaskContext.get().partitionId())):
            yield _batch(rows, arrow)

    rows = found.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.words").alias("words"))
    ordered = rows.repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    ordered.mapInArrow(read, schema).write.partitionBy("kind").parquet(folder)

    def of(kind: str) -> DataFrame:
        return spark.read.schema(schema).parquet(folder).where(F.col("kind") == kind)

    parts = of("part").select("key", "parent_key", "depth", "conv_id", *_SUMS)
    edges = materialise(parts.unionByName(_doubled(of("edge"))))
    met = materialise(
        edges.groupBy("key").agg(
            F.max("parent_key").alias("parent_key"),
            F.max("depth").alias("depth"),
            F.min("conv_id").alias("conv_id"),
            *[F.sum(name).alias(name) for name in _SUMS],
        )
    )
    parents = met.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("theirs"))
    digests = _digests(of("end").select("key", "conv_id"))
    nobody = F.lit(hashlib.sha256().hexdigest())
    boundary = (
        met.withColumn("saved_tokens", F.col("row_words") - F.col("node_words"))
        .join(digests, "key", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", nobody))
        .join(parents, "parent_key", "left")
        .withColumnRenamed("theirs", "parent_conv_id")
    )
    nodes = of("node")
    below = nodes.where("parent_key IS NOT NULL").drop("parent_conv_id").join(parents, "parent_key")
    names = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        "ends_sha256",
    ]
    whole = (
        boundary.select(names)
        .unionByName(below.withColumnRenamed("theirs", "parent_conv_id").select(names))
        .unionByName(nodes.where("parent_key IS NULL").select(names))
    )
    result = materialise(whole)
    for path in (folder, *{file.rsplit("/", 1)[0] for t in (edges, met) for file in t.inputFiles()}):
        remove_folder(spark, path)
    return result


def _arrow(schema) -> pa.Schema:
    kinds = {
        "string": pa.string(),
        "bigint": pa.int64(),
        "int": pa.int32(),
        "array<binary>": pa.list_(pa.binary()),
        "array<int>": pa.list_(pa.int32()),
    }
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema])


def _batch(rows: dict, schema: pa.Schema) -> pa.RecordBatch:
    size = len(rows["conv_id"] if "conv_id" in rows else rows["shard"])
    arrays = []
    for f in schema:
        if f.name == "kind":
            arrays.append(pa.array([rows["kind"]] * size))
        elif f.name in rows:
            arrays.append(pa.array(rows[f.name], f.type))
        else:
            arrays.append(pa.nulls(size, f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _doubled(edges: DataFrame) -> DataFrame:
    """What neighbouring shards both count, as parts to add: per node of their common path."""
    by_shard = Window.orderBy("shard")  # one row per shard
    pairs = edges.select(
        "first_ids",
        "first_words",
        F.lag("last_ids").over(by_shard).alias("last_ids"),
    ).where("last_ids IS NOT NULL")
    names = ["key", *_SUMS]

    def take_off(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {name: [] for name in names}
            for first, words, last in zip(*(c.to_pylist() for c in batch.columns)):
                shared = 0
                while shared < min(len(first), len(last)) and first[shared] == last[shared]:
                    shared += 1
                digest, left = hashlib.sha256(), sum(words[:shared])
                for depth in range(shared + 1):
                    if depth:
                        digest.update(first[depth - 1])
                    if depth > 1:
                        left -= words[depth - 2]
                    counts = (0, -(depth < shared), -(shared == len(last)), 0, -left)
                    for name, value in zip(names, (digest.hexdigest(), *counts)):
                        found[name].append(value)
            yield pa.RecordBatch.from_pydict(found, pa.schema(
                [("key", pa.string()), *((name, pa.int64()) for name in _SUMS)]
            ))

    made = pairs.mapInArrow(take_off, "key string, " + ", ".join(f"{name} long" for name in _SUMS))
    nothing = {name: F.lit(None).cast(kind) for name, kind in
               (("parent_key", "string"), ("depth", "long"), ("conv_id", "long"))}
    return made.withColumns(nothing)


def _digests(ends: DataFrame) -> DataFrame:
    """``key, ends_sha256``: the digest of the sorted ids of each key, read as a stream."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running, done = None, None, []
        for batch in batches:
            keys = batch.column(0).dictionary_encode()
            names, codes = keys.dictionary.to_pylist(), keys.indices.to_numpy()
            conv = batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else []
            for a, b in zip(cuts, [*cuts[1:], len(codes)]):
                if names[codes[a]] != key:
                    if key is not None:
                        done.append((key, running.hexdigest()))
                    key, running = names[codes[a]], hashlib.sha256()
                else:
                    running.update(b",")
                running.update(",".join(map(str, conv[a:b].tolist())).encode())
            yield _pairs(done)
            done = []
        if key is not None:
            yield _pairs([(key, running.hexdigest())])

    ordered = ends.repartition("key").sortWithinPartitions("key", "conv_id")
    return ordered.mapInArrow(digest, "key string, ends_sha256 string")


def _pairs(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), pa.string()) for c in columns], ["key", "ends_sha256"]
    )
