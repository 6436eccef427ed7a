"""Packing token pieces into sequences: large-item matching, then best fit.

Documents are tokenized once and cut only where one is longer than a sequence.
How a piece is packed depends on its length alone, so the plan is made from the
histogram of lengths (as many numbers as a sequence has tokens):

* pieces above a third of the capacity stand at most twice in a sequence; the
  longest is matched with the longest that still fits beside it, whole runs of equal
  pairs at a time;
* smaller pieces, the longest first, go into the tightest gap that takes them, again
  for all equal gaps at once, and into new sequences when there is none.

The plan says for ranks ``from..`` of a length where they stand.  Ranks come from counts per
task and length, so no piece is ever gathered with the others of its length.

Defined cases: a null text is empty; a document without tokens gives no piece unless
an end id is appended; document ids may be null or repeat (pieces of each row stay
its own, told apart by ``uid``); a text of any length is cut into as many full pieces as it needs; pieces of equal length
(ties) are interchangeable and placed in the order of their tasks; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.llm.staging import binary_column, map_arrow, row_ids, stored
from aerostrata.llm.word_memory import text_groups, tokenizer_memory

_PIECES = (
    "uid long, doc_id long, piece int, start long, length long, ids binary, "
    "task int, rank long"
)
_PLAN = pa.schema(
    [(name, pa.int64()) for name in ("length", "rank_from", "rank_to", "bin_from", "per_bin", "at")]
)


def _ranks(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """For each length the number of equal ones before it; ``seen`` is carried on."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    begins = np.flatnonzero(np.diff(ordered, prepend=-1))
    sizes = np.diff(np.append(begins, len(ordered)))
    ranks = np.empty(len(lengths), np.int64)
    ranks[order] = np.arange(len(ordered)) - np.repeat(begins, sizes) + seen[ordered]
    seen[ordered[begins]] += sizes
    return ranks


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int,
    end_id: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece of at most ``capacity`` tokens, with its rank among equal lengths of a task."""

    def cut(batches):
        memory, rows = tokenizer_memory(tokenizer), 0
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in text_groups(texts):
                ids, counts = memory.encode(texts[i:j])
                if end_id is not None:
                    counts = counts + 1
                    ended = np.full(int(counts.sum()), end_id, np.uint32)
                    inner = np.ones(len(ended), bool)
                    inner[np.cumsum(counts) - 1] = False
                    ended[inner] = ids
                    ids = ended
                n = -(-counts // capacity)
                of = np.repeat(np.arange(j - i), n)
                piece = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(capacity, counts[of] - start)
                columns = [
                    pa.array(row_ids(task, rows, j - i)[of]),
                    batch.column(0)[i:j].take(pa.array(of)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start),
                    pa.array(length),
                    binary_column(ids.astype("<u4"), length * 4),
                    pa.array(np.full(len(of), task, np.int32)),
                    pa.array(_ranks(length, seen)),
                ]
                names = ["uid", "doc_id", "piece", "start", "length", "ids", "task", "rank"]
                yield pa.RecordBatch.from_arrays(columns, names)
                rows += j - i

    chosen = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return map_arrow(chosen, cut, _PIECES)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, ...]]:
    """Where every rank of every length stands.

    A row ``(length, rank_from, rank_to, bin_from, per_bin, at)`` puts those ranks,
    ``per_bin`` to a sequence, into sequences from ``bin_from`` on, side by side from
    offset ``at``.  There are at most ``4 * capacity`` kinds of sequence and in each
    fewer than ``sqrt(2 * capacity)`` lengths, so the plan does not grow with the data.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    used = np.zeros(capacity + 1, np.int64)
    rows: list[tuple[int, ...]] = []
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    bins = 0

    def place(length: int, n: int, first: int, per_bin: int, at: int) -> None:
        rows.append((length, int(used[length]), int(used[length]) + n, first, per_bin, at))
        used[length] += n
        left[length] -= n

    third = capacity // 3
    for length in range(capacity, third, -1):
        while left[length]:
            other = min(length, capacity - length)
            while other > third and left[other] < 1 + (other == length):
                other -= 1
            first = bins
            if other <= third:
                n = int(left[length])
                place(length, n, first, 1, 0)
                gap = capacity - length
            elif other == length:
                n = int(left[length]) // 2
                place(length, 2 * n, first, 2, 0)
                gap = capacity - 2 * length
            else:
                n = int(min(left[length], left[other]))
                place(length, n, first, 1, 0)
                place(other, n, first, 1, length)
                gap = capacity - length - other
            bins += n
            gaps[gap].append((first, n))

    for length in range(third, 0, -1):
        gap = length
        while left[length]:
            while gap <= capacity and not gaps[gap]:
                gap += 1
            per_bin = min(gap, capacity) // length
            if gap > capacity:
                first, n = bins, -(-int(left[length]) // per_bin)
                bins += n
                gap = capacity
            else:
                first, n = gaps[gap].pop()
            full = min(n, int(left[length]) // per_bin)
            if full:
                place(length, full * per_bin, first, per_bin, capacity - gap)
                gaps[gap - per_bin * length].append((first, full))
            rest = int(left[length])
            if full < n and rest:
                place(length, rest, first + full, rest, capacity - gap)
                gaps[gap - rest * length].append((first + full, 1))
                full += 1
            if full < n:
                gaps[gap].append((first + full, n - full))
    return rows


def pack(cut: DataFrame, capacity: int) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``cut`` must be a stored table."""
    spark = cut.sparkSession
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    found = counts.groupBy("length").agg(F.sum("n").alias("n")).collect()  # capacity rows at most
    rows = plan({r.length: r.n for r in found}, capacity)
    columns = list(zip(*rows, strict=True)) or [()] * len(_PLAN)
    arrays = [pa.array(c, pa.int64()) for c in columns]
    placing = spark.createDataFrame(pa.Table.from_arrays(arrays, schema=_PLAN))

    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(offsets, ["task", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    p, r = placing.alias("p"), ranked.alias("r")
    within = F.col("r.rank") - F.col("p.rank_from")
    fits = (
        (F.col("r.length") == F.col("p.length"))
        & (within >= 0)
        & (F.col("r.rank") < F.col("p.rank_to"))
    )
    kept = [f"r.{c}" for c in cut.columns if c not in ("task", "rank")]
    return r.join(F.broadcast(p), fits).select(
        *kept,
        (F.col("bin_from") + F.floor(within / F.col("per_bin"))).cast("long").alias("sequence_id"),
        (F.col("at") + within % F.col("per_bin") * F.col("r.length")).alias("offset"),
    )


def packed(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    capacity: int,
    end_id: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """The stored pieces with their ids, and where each stands (without ids).

    Both have ``uid`` and ``piece``, which name a piece.
    """
    cut = stored(pieces(docs, tokenizer, capacity, end_id, id_col, text_col), folder)
    return cut, pack(cut.drop("ids"), capacity)


def sequences(cut: DataFrame, placed: DataFrame) -> DataFrame:
    """One row per sequence with its ids in order: what a training job reads."""
    parts = placed.select("uid", "piece", "sequence_id", "offset").join(
        cut.select("uid", "piece", "ids"), ["uid", "piece"]
    )
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # a sequence's pieces: bounded
    joined = F.aggregate(ordered, F.lit(b""), lambda all_, part: F.concat(all_, part["ids"]))
    return parts.groupBy("sequence_id").agg(joined.alias("ids"))
