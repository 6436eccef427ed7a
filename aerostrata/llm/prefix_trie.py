"""A trie of conversations that share their first turns, as balanced parentheses.

A node is a sequence of first turns (role and text); the conversations that start with it are
its members.  Shared beginnings need to be stored, encoded or computed once only, and the trie
says how much that saves.

1. Every conversation becomes a path: the 16-byte hashes of its turns, one after the other.
   From the first turn on that no other conversation has at that depth it has no sharers, so the
   path ends there and the turns after it are nodes of one conversation each, which need no trie.
2. Equal paths are counted, and the different ones sorted and cut into shards of neighbours.
3. A shard's trie is written as parentheses in preorder, one pair per node, from what each
   path has in common with the one before it.  Blocks of the excess (open minus closed) with
   their minima find the closing parenthesis of every node, which delimits its subtree;
   counting the pairs ``()`` up to there gives leaves, and sums along the preorder give members
   and savings of subtrees as differences.
4. Nodes on the first and on the last path of a shard (its spines) may go on in the neighbouring shards.
   Each spine is a path again, its nodes weighted with what hangs off them; all spines are a
   much smaller set of paths, and the same steps merge them, until one shard is left.

Defined cases: turns are ordered by turn number, null first, then by role and text; a null role or text is
empty; rows that agree in all columns are turns of their own; rows without a conversation id are left out, as
nothing names their conversation; conversations without turns end at the root; an empty table has no nodes;
other columns play no part.  Texts are hashed in Spark and never pass through Python, so their length does not matter.
A row holds 24 bytes for each turn of a path, that is only for turns that another conversation has at the same depth.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostrata.llm.ordered import in_order, without_gaps
from aerostrata.llm.staging import map_arrow, stored

KEY = 16
#: A shard is closed with this many nodes, but not before it has ``LEAST_PATHS`` paths.
SHARD_NODES, LEAST_PATHS = 1 << 16, 8
#: Parentheses in a block of the excess.
BLOCK = 64


def turns_in_order(conversations: DataFrame, folder: str) -> DataFrame:
    """``conv_id``, ``pos`` (from 0), ``key`` and ``size`` (bytes of the text) of every turn."""
    filled = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")),
    ).where("conv_id IS NOT NULL")
    keys = ["conv_id", "turn", "role", "text"]
    # beginnings of texts are enough to deal rows out, further equal rows go round
    ranges = ["conv_id", "turn", "role", F.substring("text", 1, 100)]
    laid = in_order(filled, keys, f"{folder}/ordered", ranges)
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    numbered = without_gaps(laid).select(
        "conv_id",
        "at",
        F.substring(F.unhex(said), 1, KEY).alias("key"),
        F.octet_length("text").cast("long").alias("size"),
    )
    first = stored(numbered.groupBy("conv_id").agg(F.min("at").alias("first")), f"{folder}/first")
    placed = numbered.join(first, "conv_id").select("conv_id", (F.col("at") - F.col("first")).alias("pos"), "key", "size")
    return stored(placed, f"{folder}/turns")


def rebuilt(turns: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Turns of conversations whose beginning is that of the first of their ``group`` ids.

    The first ``h`` turns, ``h`` being the checksum of the id modulo ``most``, are those of conversation
    ``c - c % group``; the conversation's own turns follow from there on.
    """
    h = lambda c: F.crc32(F.col(c).cast("string")) % most
    own = turns.where(F.col("pos") >= h("conv_id"))
    ids = turns.select("conv_id").distinct().withColumn("base", F.col("conv_id") - F.pmod("conv_id", F.lit(group)))
    # each base is read by at most ``group`` conversations, and only its first turns
    begun = turns.where(F.col("pos") < most - 1).withColumnRenamed("conv_id", "base")
    copied = ids.join(begun, "base").where(F.col("pos") < h("conv_id")).select(*turns.columns)
    moved = own.unionByName(copied)
    # where the base has fewer than h turns the own ones follow without a gap
    known = ids.join(turns.groupBy(F.col("conv_id").alias("base")).agg(F.count("*").alias("n")), "base", "left")
    gap = F.greatest(F.lit(0), h("conv_id") - F.coalesce("n", F.lit(0)))
    gaps = known.select(F.col("conv_id").alias("c"), gap.alias("gap"), h("conv_id").alias("h")).where("gap > 0")
    return moved.join(gaps, F.col("conv_id") == F.col("c"), "left").select(
        "conv_id",
        (F.col("pos") - F.when(F.col("pos") >= F.col("h"), F.col("gap")).otherwise(0)).alias("pos"),
        "key",
        "size",
    )


def paths(turns: DataFrame, ids: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Paths of all conversations ``ids`` and the turns after the end of their path.

    The first has ``conv_id``, ``path``, ``sizes`` (8 bytes a turn) and ``tail`` (turns that follow); ``turns``
    is a stored table.
    """
    alone = turns.groupBy("pos", "key").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).where("n = 1")
    cut = alone.groupBy("conv_id").agg(F.min("pos").alias("cut"))
    cut = stored(cut, f"{folder}/cut")
    marked = turns.join(cut, "conv_id", "left")
    inside = F.col("cut").isNull() | (F.col("pos") <= F.col("cut"))
    in_turn = F.array_sort(F.collect_list(F.struct("pos", "key", "size")))
    joined = lambda shown: F.unhex(F.array_join(F.transform(in_turn, shown), ""))
    whole = marked.where(inside).groupBy("conv_id").agg(
        joined(lambda t: F.hex(t["key"])).alias("path"),
        joined(lambda t: F.lpad(F.hex(t["size"]), 16, "0")).alias("sizes"),
    )
    tails = marked.where(~inside).select("conv_id", "pos")
    counts = tails.groupBy("conv_id").agg(F.count("*").alias("tail"))
    every = ids.join(whole, "conv_id", "left").join(counts, "conv_id", "left").select(
        "conv_id",
        F.coalesce("path", F.lit(b"")).alias("path"),
        F.coalesce("sizes", F.lit(b"")).alias("sizes"),
        F.coalesce("tail", F.lit(0)).cast("long").alias("tail"),
    )
    return every, tails


# A path with what hangs off its last nodes, and off none before: numbers of 8 bytes, one per node.
_WEIGHTS = ["members", "conv", "kids", "leaves", "saved"]
_PATH_TYPES = "path binary, sizes binary, " + ", ".join(f"{w} binary" for w in _WEIGHTS)
_NODE_TYPES = (
    "id binary, parent binary, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long"
)
_NODE_COLUMNS = [c.split()[0] for c in _NODE_TYPES.split(", ")]
_SCHEMA = pa.schema(
    [(c, pa.binary()) for c in ["path", "sizes", *_WEIGHTS, "id", "parent"]]
    + [(c, pa.int64()) for c in _NODE_COLUMNS[2:]]
)
_NO_CONV = np.iinfo(np.int64).max


def _numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, ">i8").astype(np.int64)


def _bytes(numbers: np.ndarray) -> bytes:
    return numbers.astype(">i8").tobytes()


def _common(a: bytes, b: bytes) -> int:
    """The number of first turns that two paths have in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // KEY
    differ = np.frombuffer(a[:n], np.uint8) != np.frombuffer(b[:n], np.uint8)
    return int(differ.argmax()) // KEY


class Shard:
    """Neighbouring paths as one trie in balanced parentheses.

    Nodes are numbered in the order in which they open; the root is number 0.
    """

    def __init__(self):
        self.parens: list[np.ndarray] = []
        self.depths: list[np.ndarray] = []
        self.keys: list[bytes] = []
        self.sizes: list[np.ndarray] = []
        self.weights: list[list[np.ndarray]] = [[] for _ in _WEIGHTS]
        self.added: list[tuple[np.ndarray, list[np.ndarray]]] = []
        self.nodes = np.zeros(0, np.int64)  # of the last path, by depth
        self.first = self.last = b""
        self.n_nodes = self.n_paths = 0

    def add(self, path: bytes, sizes: np.ndarray, weights: list[np.ndarray]) -> None:
        """The next path in order: what it has not in common with the last one is opened."""
        depth, common = len(path) // KEY, -1
        if self.n_paths:
            common = _common(self.last, path)
            self.parens.append(np.zeros(len(self.last) // KEY - common, bool))
        else:
            self.first = path
        new = np.arange(common + 1, depth + 1)
        self.parens.append(np.ones(len(new), bool))
        self.depths.append(new)
        self.keys += [path[d * KEY - KEY : d * KEY] for d in new.tolist()]
        self.sizes.append(np.concatenate([[0], sizes])[new])
        self.nodes = np.concatenate([self.nodes[: common + 1], self.n_nodes + np.arange(len(new))])
        full = [np.full(depth + 1, _NO_CONV if name == "conv" else 0) for name in _WEIGHTS]
        for kept, all_, given in zip(self.weights, full, weights, strict=True):
            all_[depth + 1 - len(given) :] = given
            kept.append(all_[common + 1 :])
        if depth - len(weights[0]) < common:  # something hangs off nodes that are open already
            self.added.append((self.nodes[: common + 1], [w[: common + 1] for w in full]))
        self.n_nodes += len(new)
        self.n_paths += 1
        self.last = path

    def trie(self) -> Trie:
        parens = np.concatenate([*self.parens, np.zeros(len(self.last) // KEY + 1, bool)])
        members, conv, kids, leaves, saved = (np.concatenate(w) for w in self.weights)
        for nodes, more in self.added:
            members[nodes] += more[0]
            conv[nodes] = np.minimum(conv[nodes], more[1])
            kids[nodes] += more[2]
            leaves[nodes] += more[3]
            saved[nodes] += more[4]
        weights = {"members": members, "conv": conv, "kids": kids, "leaves": leaves, "saved": saved}
        return Trie(parens, np.concatenate(self.depths), np.concatenate(self.sizes), weights)


def _in_block(excess: np.ndarray, at: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """From each place on the first one in its block with an excess of the goal or less, or -1."""
    out, which = np.full(len(at), -1), np.arange(len(at))
    while len(which):
        hit = excess[at] <= goal[which]
        out[which[hit]] = at[hit]
        at, which = at[~hit] + 1, which[~hit]
        inside = at % BLOCK != 0
        at, which = at[inside], which[inside]
    return out


def find_close(parens: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """The closing parenthesis of each opening one, by minima of the excess over blocks.

    It is the first place behind at which the excess is below that of the opening: in the rest of its
    block, or else in the next block whose minimum is low enough, found over a tree of minima.
    """
    excess = np.cumsum(np.where(parens, 1, -1))
    goal = excess[opens] - 1
    excess = np.concatenate([excess, np.full(-len(excess) % BLOCK, -1)])
    levels = [excess.reshape(-1, BLOCK).min(axis=1)]
    while len(levels[-1]) > 1:
        low = np.concatenate([levels[-1], np.full(len(levels[-1]) % 2, len(excess))])
        levels.append(low.reshape(-1, 2).min(axis=1))

    behind = opens + 1
    out, inside = np.full(len(opens), -1), behind % BLOCK != 0
    out[inside] = _in_block(excess, behind[inside], goal[inside])
    left = np.flatnonzero(out < 0)
    goal = goal[left]
    block, level = -(-behind[left] // BLOCK), np.zeros(len(left), np.int64)
    searching = np.ones(len(left), bool)
    while searching.any():  # to the right, and up where a pair of blocks begins
        for k, low in enumerate(levels):
            here = np.flatnonzero(searching & (level == k))
            found = low[block[here]] <= goal[here]
            searching[here[found]] = False
            on = here[~found]
            right = block[on] + 1
            up = right % 2 == 0
            block[on], level[on] = np.where(up, right // 2, right), np.where(up, k + 1, k)
    for k in range(len(levels) - 1, 0, -1):  # down, to the left where that is low enough
        here = np.flatnonzero(level == k)
        child = block[here] * 2
        block[here] = np.where(levels[k - 1][child] <= goal[here], child, child + 1)
        level[here] = k - 1
    out[left] = _in_block(excess, block * BLOCK, goal)
    return out


class Trie:
    """Balanced parentheses with the figures of every subtree; arrays have an entry per node."""

    def __init__(self, parens: np.ndarray, depths: np.ndarray, sizes: np.ndarray, weights: dict[str, np.ndarray]):
        self.depths, self.sizes, self.weights = depths, sizes, weights
        opens = np.flatnonzero(parens)
        closes = find_close(parens, opens)
        self.n = len(opens)
        opened = np.cumsum(parens)
        #: The nodes of a subtree are those from its top's number up to here.
        self.ends = opened[closes]
        self.parents = self._parents()
        self.kids = weights["kids"] + np.bincount(self.parents[1:], minlength=self.n)
        # a pair "()" is a leaf unless something hangs off it
        pairs = np.flatnonzero(parens[:-1] & ~parens[1:])
        leaf = np.zeros(len(parens) + 1, np.int64)
        leaf[pairs + 1] = self.kids[opened[pairs] - 1] == 0
        rank = np.cumsum(leaf)
        self.leaves = rank[closes] - rank[opens] + self._sums(weights["leaves"])
        self.members = self._sums(weights["members"])
        self.saved = self._sums(weights["saved"] + (self.members - 1) * sizes)
        self.conv = self._minima(weights["conv"])

    def _parents(self) -> np.ndarray:
        last, out = {}, np.zeros(self.n, np.int64)
        for node, depth in enumerate(self.depths.tolist()):
            last[depth] = node
            out[node] = last[depth - 1] if depth else 0
        return out

    def _sums(self, values: np.ndarray) -> np.ndarray:
        """Sums over subtrees, as differences of a cumulative array."""
        sums = np.concatenate([[0], np.cumsum(values)])
        return sums[self.ends] - sums[: self.n]

    def _minima(self, values: np.ndarray) -> np.ndarray:
        """Minima over subtrees, from the last node to the first."""
        out = values.tolist()
        for node in range(self.n - 1, 0, -1):
            parent = self.parents[node]
            if out[node] < out[parent]:
                out[parent] = out[node]
        return np.array(out, np.int64)

    def hanging(self, spine: np.ndarray) -> dict[str, np.ndarray]:
        """The weights of nodes on a spine with what the other nodes add to them."""
        out = {name: values.copy() for name, values in self.weights.items()}
        kids = np.flatnonzero(~spine & spine[self.parents])
        at = self.parents[kids]
        for name, values in (("members", self.members), ("leaves", self.leaves), ("saved", self.saved)):
            np.add.at(out[name], at, values[kids])
        np.add.at(out["kids"], at, 1)
        np.minimum.at(out["conv"], at, self.conv[kids])
        return out


def _ids(keys: list[bytes], depths: np.ndarray) -> list[bytes]:
    """The SHA-256 of each node's path."""
    states, out = {}, []
    for key, depth in zip(keys, depths.tolist(), strict=True):
        state = states[depth - 1].copy() if depth else hashlib.sha256()
        state.update(key)
        states[depth] = state
        out.append(state.digest())
    return out


def _emitted(shard: Shard, whole: bool):
    """The nodes whose figures are known, and the spines unless the shard is the whole trie."""
    trie = shard.trie()
    spine = np.zeros(trie.n, bool)
    first, last = np.arange(len(shard.first) // KEY + 1), shard.nodes
    if not whole:
        spine[first] = spine[last] = True
    ids, none = _ids(shard.keys, trie.depths), [None] * trie.n
    done = np.flatnonzero(~spine)
    known = ~spine[trie.parents[done]] & (trie.depths[done] > 0)
    numbers = [trie.conv, trie.depths, trie.conv[trie.parents], trie.members, trie.kids, trie.leaves, trie.saved]
    columns = [pa.array(none, pa.binary()).slice(0, len(done)) for _ in range(2 + len(_WEIGHTS))]
    columns.append(pa.array([ids[i] for i in done.tolist()], pa.binary()))
    columns.append(pa.array([ids[i] for i in trie.parents[done].tolist()], pa.binary()))
    for i, values in enumerate(numbers):
        columns.append(pa.array(values[done], pa.int64(), mask=~known if i == 2 else None))
    yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)
    if whole:
        return
    weights = trie.hanging(spine)
    rows = [(shard.first, first, 0)]
    if shard.last != shard.first:
        rows.append((shard.last, last, _common(shard.first, shard.last) + 1))
    out = []
    for path, nodes, begin in rows:  # nodes on both spines count on the first
        out.append([path, _bytes(trie.sizes[nodes[1:]]), *(_bytes(weights[w][nodes[begin:]]) for w in _WEIGHTS)])
    columns = [pa.array(c, pa.binary()) for c in zip(*out, strict=True)]
    columns += [pa.nulls(len(out), f.type) for f in list(_SCHEMA)[len(columns) :]]
    yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def _merged(rows: DataFrame, folder: str) -> DataFrame:
    """The nodes of the trie of all paths; ``rows`` is a stored table of different, weighted paths.

    Each round turns eight neighbouring paths or more into two spines, but for the last ones of a task.
    """
    columns = ["path", "sizes", *_WEIGHTS]
    rounds = []
    while True:
        size = rows.agg(
            F.count("*").alias("paths"), F.coalesce(F.sum(F.octet_length("path") / KEY + 1), F.lit(0)).alias("nodes")
        ).first()
        whole = size.nodes <= SHARD_NODES or size.paths <= LEAST_PATHS
        if whole:
            dealt = rows.coalesce(1)
        else:
            tasks = min(int(size.nodes) // SHARD_NODES, size.paths // (2 * LEAST_PATHS)) + 1
            # beginnings of paths are enough to deal them out
            dealt = rows.repartitionByRange(tasks, F.substring("path", 1, 32 * KEY))

        def build(batches, whole=whole, most_nodes=SHARD_NODES):
            shard = Shard()
            for batch in batches:
                for path, sizes, *weights in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if not whole and shard.n_nodes >= most_nodes and shard.n_paths >= LEAST_PATHS:
                        yield from _emitted(shard, whole)
                        shard = Shard()
                    shard.add(path, _numbers(sizes), [_numbers(w) for w in weights])
            if shard.n_paths:
                yield from _emitted(shard, whole)

        ordered = dealt.select(*columns).sortWithinPartitions("path")
        found = stored(map_arrow(ordered, build, f"{_PATH_TYPES}, {_NODE_TYPES}"), f"{folder}/{len(rounds)}")
        rounds.append(found.where("id IS NOT NULL").select(*_NODE_COLUMNS))
        if whole:
            break
        rows = found.where("path IS NOT NULL").select(*columns)
    first, later = rounds[0], rounds[1:]
    if not later:
        return first
    # a node below a spine has its parent in a later round; those are few beside the first
    for more in later[1:]:
        later[0] = later[0].unionByName(more)
    spines = stored(later[0], f"{folder}/spines")
    above = spines.select(F.col("id").alias("above"), F.col("conv_id").alias("above_conv"))
    every = first.unionByName(spines)
    pending = F.col("parent_conv_id").isNull() & (F.col("depth") > 0)
    joined = every.where(pending).join(above, F.col("parent") == F.col("above"))
    joined = joined.withColumn("parent_conv_id", F.col("above_conv")).select(*_NODE_COLUMNS)
    return every.where(~pending).unionByName(joined)


def _ends(ends: DataFrame) -> DataFrame:
    """``end`` and the SHA-256 of the ids that end there, in order and joined by commas.

    A hash can only be taken in order, so the ids of one node pass through one task, as a sorted
    stream of which nothing is held.
    """
    schema = pa.schema([("end", pa.binary()), ("ends_sha256", pa.string())])

    def hashed(batches):
        end, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for node, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if node != end:
                    if end is not None:
                        done.append((end, state.hexdigest()))
                    end, state = node, hashlib.sha256(str(conv_id).encode())
                else:
                    state.update(b",%d" % conv_id)
            columns = list(zip(*done, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        if end is not None:
            yield pa.RecordBatch.from_arrays([pa.array([end], pa.binary()), pa.array([state.hexdigest()])], schema=schema)

    ordered = ends.repartition("end").sortWithinPartitions("end", "conv_id").select("end", "conv_id")
    return map_arrow(ordered, hashed, "end binary, ends_sha256 string")


def trie(turns: DataFrame, ids: DataFrame, folder: str) -> DataFrame:
    """One row per node of the trie of conversations.

    ``turns`` (``conv_id``, ``pos`` from 0, ``key``, ``size``) and ``ids``, all conversations, are stored tables.  A node
    has ``conv_id`` (its smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` (bytes of the texts of its subtree that need not be repeated) and ``ends_sha256``.
    """
    every, tails = paths(turns, ids, folder)
    every = stored(every, f"{folder}/paths")
    number = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
    on = F.max(F.when(F.col("tail") > 0, 1).otherwise(0)).cast("long")
    weights = {"members": F.count("*"), "conv": F.min("conv_id"), "kids": on, "leaves": on, "saved": F.lit(0).cast("long")}
    different = every.groupBy("path").agg(F.min("sizes").alias("sizes"), *(w.alias(c) for c, w in weights.items()))
    different = different.select("path", "sizes", *(number(F.col(c)).alias(c) for c in weights))
    nodes = _merged(stored(different, f"{folder}/different"), f"{folder}/rounds")

    ends = every.where("tail = 0").select(F.unhex(F.sha2("path", 256)).alias("end"), "conv_id")
    ends = stored(_ends(ends), f"{folder}/ends")
    figures = _NODE_COLUMNS[2:]
    shared = nodes.join(ends, F.col("id") == F.col("end"), "left").select(
        *figures, F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    )
    lengths = every.where("tail > 0").select("conv_id", (F.octet_length("path") / KEY + F.col("tail")).cast("long").alias("turns"))
    last = F.col("pos") + 1 == F.col("turns")
    one = F.lit(1).cast("long")
    alone = tails.join(lengths, "conv_id").select(
        "conv_id",
        (F.col("pos") + 1).alias("depth"),
        F.col("conv_id").alias("parent_conv_id"),
        one.alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"),
        one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.sha2(F.when(last, F.col("conv_id").cast("string")).otherwise(""), 256).alias("ends_sha256"),
    )
    return shared.unionByName(alone)
