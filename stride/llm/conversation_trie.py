"""Conversation prefix trie by time-forward processing.

Every distinct sequence of a conversation's first d turns is a node of depth d,
from the textless root on.  A node is named by its smallest member (the least
conv_id that begins with it) and its depth; totals over its subtree tell how
much of the corpus shared prefixes save.

Turns are numbered and prefixes hashed without sending a conversation through
one task: rows are dealt by (conversation, bucket of 1,024 turns), a turn's
hash depends on content and place, and a prefix is the running XOR of two such
64-bit hashes inside the bucket, with one carried value per bucket.  Nodes are
pre-aggregated groups of equal prefixes.

Subtree totals go up by time-forward processing.  Nodes are sorted by reverse
level order (Spark's external sort); a node takes the messages of its children
from a priority queue, adds its own value and sends the total to its parent's
place in the queue, which spills to task-private files.  Shards are subtrees: a
node's weight is the number of rows of its members from it downwards, so
weights fall along every path, and the nodes of weight up to ``shard_rows``
form subtrees of that size at most, many of which share a task.  Their roots'
totals, pre-aggregated by parent, are the input of the next band, nodes up to
``shard_rows`` squared, and so on up to the root: two bands for 16 million
rows, three for 68 billion.  A first turn shared by a third of all
conversations is a heavy node of a later band, and its subtrees lie in as many
shards as there are.

Cases: rows without conv_id are no conversation's; a null turn comes first; a
null role or text is empty; turns with equal numbers come in the order of their
content's hash, repeated rows are turns of their own; equal conversations share
all nodes, the smallest id names them; very long texts count whole, by code
points, and are hashed once; very long conversations make deep paths, not large
groups; an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stride.llm.common import cut


@dataclass(frozen=True)
class TrieRules:
    shard_rows: int = 4096
    queue_entries: int = 1 << 18  # messages a task keeps in memory
    bucket_turns: int = 1024
    chunk_ids: int = 4096

    def __post_init__(self):
        if self.shard_rows < 2 or self.queue_entries < 2:
            raise ValueError("shards and queues hold two entries at least")


@dataclass
class Trie:
    #: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens: one row per node
    nodes: DataFrame
    #: conv_id, depth, member: one row per conversation, at the node it ends with
    ends: DataFrame


def _bucket(c: str, n: int) -> Column:
    """Floor of an integer over n."""
    return F.expr(f"({c} - pmod({c}, {n}L)) div {n}L")


def numbered(conversations: DataFrame, rules: TrieRules = TrieRules()) -> DataFrame:
    """conversations (conv_id, turn, role, text) -> (conv_id, place from 1, content, size): a hash and the code points of each turn."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        # the role's length keeps (role, text) apart
        F.unhex(F.md5(F.concat_ws(":", F.length(role).cast("string"), role, text).cast("binary"))).alias("content"),
        F.length(text).cast("bigint").alias("size"))
    # a null turn lies in the lowest bucket
    rows = rows.withColumn("bucket", _bucket("greatest(turn, -9223372036854770000L)", rules.bucket_turns))
    inside = Window.partitionBy("conv_id", "bucket").orderBy(F.col("turn").asc_nulls_first(), "content")
    across = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("conv_id", "bucket").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("conv_id").alias("_c"), F.col("bucket").alias("_b"), F.coalesce(F.sum("n").over(across), F.lit(0)).alias("before"))
    place = rows.withColumn("nth", F.row_number().over(inside)).join(
        before, (F.col("conv_id") == F.col("_c")) & (F.col("bucket") == F.col("_b")))
    return place.select("conv_id", (F.col("before") + F.col("nth")).cast("bigint").alias("place"), "content", "size")


def lengths(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of conversations that have turns."""
    return turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))


def _paths(turns: DataFrame, members: DataFrame, rules: TrieRules) -> DataFrame:
    """(conv_id, depth, k1, k2, size, n_turns): a row per conversation and prefix, depth 0 included."""
    rows = turns.select("conv_id", F.col("place").alias("depth"), "size", _bucket("place", rules.bucket_turns).alias("bucket"),
                        F.xxhash64("content", "place").alias("h1"), F.xxhash64(F.lit("second"), "place", "content").alias("h2"))
    inside = Window.partitionBy("conv_id", "bucket").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy("conv_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = rows.groupBy("conv_id", "bucket").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2")).select(
        "conv_id", "bucket", *[F.coalesce(F.bit_xor(x).over(across), F.lit(0).cast("bigint")).alias(x) for x in ("x1", "x2")])
    local = rows.select("*", *[F.bit_xor(h).over(inside).alias(f"l{h}") for h in ("h1", "h2")])
    keyed = local.join(carried, ["conv_id", "bucket"]).select(
        "conv_id", "depth", "size", F.col("lh1").bitwiseXOR(F.col("x1")).alias("k1"), F.col("lh2").bitwiseXOR(F.col("x2")).alias("k2"))
    zero = F.lit(0).cast("bigint")
    root = members.select("conv_id", zero.alias("depth"), zero.alias("size"), zero.alias("k1"), zero.alias("k2"), "n_turns")
    return keyed.join(members.select(F.col("conv_id").alias("_c"), "n_turns"), F.col("conv_id") == F.col("_c")).drop("_c").unionByName(root)


def _band(weight: Column, shard_rows: int) -> Column:
    """0 up to shard_rows, 1 up to its square, and so on."""
    band, limit = F.lit(0), shard_rows
    while limit < 1 << 62:
        band, limit = band + (weight > F.lit(limit)).cast("int"), limit * shard_rows
    return band


def _placed(paths: DataFrame, rules: TrieRules) -> tuple[DataFrame, DataFrame]:
    """Nodes with parent, band and the top of their shard; paths with the name of every node on them."""
    key = ["depth", "k1", "k2"]
    nodes = paths.groupBy(*key).agg(
        F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.any_value("size").alias("_size"),
        F.sum(F.col("n_turns") - F.col("depth") + 1).alias("_weight"))
    # written first: a join of two plain shuffles is one whose hot node (a first turn that many share) the skew join splits
    nodes = cut(nodes.select(*[F.col(c).alias(f"_{c}") for c in key], "owner", "n_convs", "_size",
                             _band(F.col("_weight"), rules.shard_rows).alias("band")), "trie-distinct")
    same = (F.col("depth") == F.col("_depth")) & (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2"))
    named = cut(paths.join(nodes, same).select("conv_id", "depth", "n_turns", "owner", "n_convs", F.col("_size").alias("size"), "band"), "trie-paths")
    tops = named.groupBy("conv_id", "band").agg(F.min(F.struct("depth", "owner")).alias("top")).select(
        F.col("conv_id").alias("_c"), F.col("band").alias("_band"), "top")
    parents = named.select(F.col("conv_id").alias("_p"), (F.col("depth") + 1).alias("_below"), F.col("owner").alias("parent"))
    own = named.where(F.col("owner") == F.col("conv_id")).select("conv_id", "depth", "n_convs", "size", "band")
    placed = own.join(tops, (F.col("conv_id") == F.col("_c")) & (F.col("band") == F.col("_band"))).join(
        parents, (F.col("conv_id") == F.col("_p")) & (F.col("depth") == F.col("_below")), "left")
    return cut(placed.select("conv_id", "depth", "parent", "n_convs", "size", "band", F.col("top.depth").alias("top_depth"),
                             F.col("top.owner").alias("top_owner")), "trie-nodes"), named


class SpillingQueue:
    """A priority queue of integer tuples, smallest first; past ``limit`` entries the later half goes to a task-private file."""

    def __init__(self, limit: int):
        self.limit, self.near, self.runs, self.spilled = limit, [], [], 0

    def push(self, entry: tuple) -> None:
        import heapq

        heapq.heappush(self.near, entry)
        if len(self.near) > self.limit:
            self._spill()

    def _spill(self) -> None:
        import heapq
        import tempfile

        import numpy as np

        self.near.sort()  # a sorted list is a heap
        half = self.limit // 2
        late, self.near = self.near[half:], self.near[:half]
        file = tempfile.TemporaryFile()  # unlinked at once: nothing stays behind
        np.array(late, dtype=np.int64).tofile(file)
        file.seek(0)
        self.spilled += 1
        run = self._read(file, len(late[0]))
        heapq.heappush(self.runs, (next(run), self.spilled, run))

    @staticmethod
    def _read(file, width: int):
        import numpy as np

        with file:
            while len(part := np.fromfile(file, dtype=np.int64, count=width * 4096)):
                yield from map(tuple, part.reshape(-1, width).tolist())

    def pop_if(self, key: tuple) -> tuple | None:
        """The smallest entry where it begins with ``key``."""
        import heapq

        n = len(key)
        if self.runs and (not self.near or self.runs[0][0] < self.near[0]):
            entry, number, run = self.runs[0]
            if entry[:n] != key:
                return None
            following = next(run, None)
            if following is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (following, number, run))
            return entry
        return heapq.heappop(self.near) if self.near and self.near[0][:n] == key else None


DONE = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, top boolean"


def _forward(nodes: DataFrame, rules: TrieRules) -> DataFrame:
    """Nodes of whole shards with the sums of what earlier bands sent -> the same nodes with their subtree's totals."""
    limit = rules.queue_entries

    def run(batches):
        import pyarrow as pa

        queue = SpillingQueue(limit)
        for batch in batches:
            out: dict = {k.split()[0]: [] for k in DONE.split(", ")}
            cols = [batch.column(c).to_pylist() for c in
                    ("conv_id", "depth", "parent", "n_convs", "size", "top_depth", "from_leaves", "from_saved", "from_children")]
            for conv, depth, parent, n, size, top_depth, leaves, saved, children in zip(*cols):
                saved += (n - 1) * size
                while (message := queue.pop_if((-depth, conv))) is not None:
                    leaves, saved, children = leaves + message[2], saved + message[3], children + 1
                leaves = leaves if children else 1
                if depth > top_depth:
                    queue.push((1 - depth, parent, leaves, saved))
                for column, v in zip(out.values(), (conv, depth, parent, n, children, leaves, saved, depth == top_depth)):
                    column.append(v)
            types = [pa.int64()] * 7 + [pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(out.values(), types)], names=list(out))

    reverse = nodes.repartition("top_owner", "top_depth").sortWithinPartitions(F.col("depth").desc(), "conv_id")
    return reverse.mapInArrow(run, DONE)


def _totals(placed: DataFrame, rules: TrieRules) -> DataFrame:
    bands = placed.agg(F.max("band")).first()[0]
    done, sent = None, None
    for band in range(-1 if bands is None else bands + 1):
        rows = placed.where(F.col("band") == band)
        if sent is None:
            given = rows.select("*", *[F.lit(0).cast("bigint").alias(c) for c in ("from_leaves", "from_saved", "from_children")])
        else:
            sums = sent.groupBy("_to", "_at").agg(F.sum("n_leaves").alias("from_leaves"), F.sum("saved_tokens").alias("from_saved"),
                                                  F.count(F.lit(1)).alias("from_children"))
            given = rows.join(sums, (F.col("conv_id") == F.col("_to")) & (F.col("depth") == F.col("_at")), "left").fillna(
                0, ["from_leaves", "from_saved", "from_children"])
        now = cut(_forward(given, rules), f"trie-band-{band}")
        roots = now.where("top AND parent_conv_id IS NOT NULL").select(
            F.col("parent_conv_id").alias("_to"), (F.col("depth") - 1).alias("_at"), "n_leaves", "saved_tokens")
        done, sent = (now, roots) if done is None else (done.unionByName(now), sent.unionByName(roots))
    return placed.sparkSession.createDataFrame([], DONE) if done is None else done


def build(turns: DataFrame, members: DataFrame, rules: TrieRules = TrieRules()) -> Trie:
    """The trie of conversations given as turns (conv_id, place, content, size) and members (conv_id, n_turns, 0 included)."""
    placed, named = _placed(_paths(turns, members, rules), rules)
    ends = named.where(F.col("depth") == F.col("n_turns")).select(F.col("owner").alias("conv_id"), "depth", F.col("conv_id").alias("member"))
    return Trie(_totals(placed, rules).drop("top"), ends)


def trie(conversations: DataFrame, rules: TrieRules = TrieRules()) -> Trie:
    """The trie of a table of conversations (conv_id, turn, role, text)."""
    turns = cut(numbered(conversations, rules), "trie-turns")
    return build(turns, lengths(turns), rules)


def ends_sha256(ends: DataFrame, rules: TrieRules = TrieRules()) -> DataFrame:
    """(conv_id, depth, ends_sha256): SHA-256 of each node's ending members, ascending, comma-joined.

    Ids are joined in chunks first; one hash then runs over a node's chunks in
    their order, a stream of rows, however many members a node has.
    """
    def run(batches):
        import hashlib

        import pyarrow as pa

        at, running = None, None
        for batch in batches:
            out: tuple = ([], [], [])
            for conv, depth, ids in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "depth", "ids")]):
                if at != (conv, depth):
                    if at:
                        for column, v in zip(out, (*at, running.hexdigest())):
                            column.append(v)
                    at, running = (conv, depth), hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield _batch(pa, out)
        if at:
            yield _batch(pa, ([at[0]], [at[1]], [running.hexdigest()]))

    def _batch(pa, out):
        return pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.string()))],
                                          names=["conv_id", "depth", "ends_sha256"])

    chunk = _bucket("greatest(member, -9223372036854770000L)", rules.chunk_ids)
    chunks = ends.groupBy("conv_id", "depth", chunk.alias("chunk")).agg(
        F.array_join(F.sort_array(F.collect_list("member")).cast("array<string>"), ",").alias("ids"))
    return chunks.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "chunk").mapInArrow(
        run, "conv_id bigint, depth bigint, ends_sha256 string")


def digest(found: Trie, rules: TrieRules = TrieRules()) -> DataFrame:
    """The nodes with ``ends_sha256``; a node no conversation ends with has the empty text's hash."""
    hashes = ends_sha256(found.ends, rules).select(F.col("conv_id").alias("_c"), F.col("depth").alias("_d"), "ends_sha256")
    both = found.nodes.join(hashes, (F.col("conv_id") == F.col("_c")) & (F.col("depth") == F.col("_d")), "left").drop("_c", "_d")
    return both.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
