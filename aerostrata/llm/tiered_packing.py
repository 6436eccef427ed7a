"""Packing documents into sequences of several context sizes.

Sequences have one of a few sizes, powers of two; one that is filled exactly needs no padding.
Documents are tokenized once and cut only where one is longer than the largest size.  How a
chunk is packed depends on its length alone, so the plan is made from the histogram of
lengths (as many numbers as the largest size), whole runs of equal chunks at a time:

1. a chunk is routed to the smallest size, its tier, that holds it;
2. from the largest tier down, chunks of a tier open sequences of its size, the longest first;
3. the gap of such a sequence is filled from shorter tiers, always with the longest chunk that
   still fits; where none does, the shortest of the longer ones (of this tier only when the
   shorter tiers are empty) is cut, and what is left of it is routed anew;
4. fewer tokens than the smallest tier, which remain at the end, go into powers of two below it.

So no more sequences are opened than there are tokens to fill them, every one is full, and a
cut is made at most once per sequence.

5. Sequences are numbered by tier and, within it, by descending cost of attention (the sum of
   squares of the pieces' lengths).  A step group has sequences of one tier and a fixed number
   of tokens; they are dealt to the groups of a tier in turns, forth and back, so that groups
   of equal tokens have nearly equal cost.

Defined cases: a null or empty text has only the end id, or no piece without one; document ids may be
null or repeat (pieces of each row stay its own, told apart by ``uid``); a very long text fills
sequences of the largest size; equal lengths are told apart by their rank within and over tasks, so
every run of a stored tokenization gives one plan; an empty table gives no rows; other
columns are left out, whatever their names.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.llm.staging import binary_column, map_arrow, row_ids, stored
from aerostrata.llm.word_memory import text_groups, tokenizer_memory

TIERS = (512, 1024, 2048, 4096)
STEP_TOKENS = 8 * 4096
#: A plan of more rows is joined without a broadcast (64 bytes each).
MOST_BROADCAST = 500_000

_PLAN = pa.schema(
    [
        (name, pa.int64())
        for name in ("length", "rank_from", "rank_to", "cut_from", "cut_length", "first_sequence", "per_sequence", "at")
    ]
)


class _Pool:
    """Runs of equal chunks that are not placed yet, by length.

    A run is (chunk length, first rank, number, start of the part): equal parts of chunks with
    neighbouring ranks.
    """

    def __init__(self, histogram: dict[int, int]):
        self.runs = {length: [(length, 0, n, 0)] for length, n in histogram.items() if n and length}
        self.lengths = sorted(self.runs)
        self.tokens = sum(length * n for length, n in histogram.items())

    def put(self, length: int, run: tuple[int, int, int, int]) -> None:
        if length not in self.runs:
            self.runs[length] = []
            bisect.insort(self.lengths, length)
        self.runs[length].append(run)
        self.tokens += length * run[2]

    def take(self, length: int, most: int) -> tuple[int, int, int, int]:
        """Up to ``most`` equal parts of this length."""
        runs = self.runs[length]
        chunk, rank, n, start = runs.pop()
        if n > most:
            runs.append((chunk, rank + most, n - most, start))
            n = most
        elif not runs:
            del self.runs[length]
            self.lengths.pop(bisect.bisect_left(self.lengths, length))
        self.tokens -= length * n
        return chunk, rank, n, start

    def at_most(self, limit: int) -> int:
        """The longest length up to a limit, or 0."""
        at = bisect.bisect_right(self.lengths, limit)
        return self.lengths[at - 1] if at else 0

    def above(self, limit: int) -> int:
        """The shortest length beyond a limit, or 0."""
        at = bisect.bisect_right(self.lengths, limit)
        return self.lengths[at] if at < len(self.lengths) else 0


def _pack_tier(pool: _Pool, size: int, shorter: int, longest: int) -> list[tuple[int, list]]:
    """Full sequences of one size: (number, parts), a part being (run, length, number per sequence).

    Chunks longer than ``shorter``, the next smaller size, open them.
    """
    done = []
    length = pool.at_most(longest)
    while length > shorter and pool.tokens >= size:
        run = pool.take(length, pool.tokens // size)
        if length > size:
            pool.put(length - size, (run[0], run[1], run[2], run[3] + size))
        todo = [(run[2], max(size - length, 0), [(run, min(length, size), 1)])]
        while todo:
            n, gap, parts = todo.pop()
            if not gap:
                done.append((n, parts))
                continue
            fits = pool.at_most(min(gap, shorter or gap))
            if fits:
                run = pool.take(fits, n * (gap // fits))
                each, use = max(1, run[2] // n), fits
                if run[2] > n * each:  # what does not go round stays in the pool
                    over = run[2] - n * each
                    pool.put(fits, (run[0], run[1] + n * each, over, run[3]))
                    run = (run[0], run[1], n * each, run[3])
            else:
                whole = pool.above(gap)
                run = pool.take(whole, n)
                each, use = 1, gap
                pool.put(whole - gap, (run[0], run[1], run[2], run[3] + gap))
            here = run[2] // each
            if here < n:  # the other sequences are filled with something else
                rest = [((c, r + here * k, m - here * k, s), size_, k) for (c, r, m, s), size_, k in parts]
                todo.append((n - here, gap, rest))
                parts = [((c, r, here * k, s), size_, k) for (c, r, m, s), size_, k in parts]
            todo.append((here, gap - each * use, [*parts, (run, use, each)]))
        length = pool.at_most(longest)
    return done


def plan(histogram: dict[int, int], tiers: tuple[int, ...] = TIERS) -> tuple[list[tuple[int, ...]], list[tuple[int, int, int]]]:
    """Where every part of every chunk stands, and the tiers as (size, first sequence, number).

    A row ``(length, rank_from, rank_to, cut_from, cut_length, first_sequence, per_sequence, at)``
    puts that part of those ranks, ``per_sequence`` to a sequence, into sequences from
    ``first_sequence`` on, side by side from offset ``at``.  Its rows are those of the different
    kinds of sequence; their number depends on the lengths that occur, not on how many documents have them.
    """
    sizes = sorted(tiers)
    if any(size & (size - 1) for size in sizes):
        raise ValueError("context sizes must be powers of two")
    smaller = [1 << bit for bit in range(sizes[0].bit_length() - 1)]
    pool, largest = _Pool(histogram), sizes[-1]
    rows, spans, first = [], [], 0
    for size in reversed(smaller + sizes):
        shorter = max((s for s in sizes if s < size), default=0)
        kinds = _pack_tier(pool, size, shorter, largest)
        cost = lambda kind: sum(length * length * each for _, length, each in kind[1])
        begin = first
        for n, parts in sorted(kinds, key=cost, reverse=True):
            at = 0
            for (chunk, rank, number, start), length, each in parts:
                rows.append((chunk, rank, rank + number, start, length, first, each, at))
                at += length * each
            first += n
        if first > begin:
            spans.append((size, begin, first - begin))
    return rows, spans


_CHUNKS = "doc_id long, doc_tokens long, start long, length long, ids binary, task int, rank long, uid long"


def chunks(
    docs: DataFrame, tokenizer: str, most: int, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Token ids of every document in chunks of at most ``most``, with their rank among equal lengths of a task."""

    def tokenized(batches):
        memory, task, rows = tokenizer_memory(tokenizer), TaskContext.get().partitionId(), 0
        seen = np.zeros(most + 1, np.int64)
        end = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in text_groups(texts):
                ids, counts = memory.encode(texts[i:j])
                ids = np.insert(ids, np.cumsum(counts).repeat(len(end)), np.tile(end, j - i))
                counts = counts + len(end)
                parts = -(-counts // most)
                of = np.repeat(np.arange(j - i), parts)
                start = (np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)) * most
                length = np.minimum(most, counts[of] - start)
                order = np.argsort(length, kind="stable")
                each, first, n = np.unique(length[order], return_index=True, return_counts=True)
                rank = np.empty(len(of), np.int64)
                rank[order] = np.arange(len(of)) + np.repeat(seen[each] - first, n)
                seen[each] += n
                columns = [
                    batch.column(0)[i:j].take(pa.array(of)),
                    *(pa.array(x) for x in (counts[of], start, length)),
                    binary_column(ids.astype("<u4", copy=False), length * 4),
                    pa.array(np.full(len(of), task, np.int32)),
                    pa.array(rank),
                    pa.array(row_ids(task, rows, j - i)[of]),
                ]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _CHUNKS.split(", ")])
                rows += j - i

    return map_arrow(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")), tokenized, _CHUNKS)


def _before(cut: DataFrame) -> DataFrame:
    """For every task and length the chunks, and those of this length in earlier tasks."""
    counts = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("task", "length", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def _ranked(cut: DataFrame) -> DataFrame:
    """Chunks whose rank counts over all tasks."""
    ranked = cut.join(_before(cut).drop("n"), ["task", "length"])
    return ranked.withColumn("rank", F.col("rank") + F.col("before")).drop("before")


def _parted(cut: DataFrame, rows: list[tuple[int, ...]]) -> DataFrame:
    """The chunks of the tasks and lengths in which the plan cuts any.

    Ranks ascend with tasks, so every cut row of the plan covers neighbouring tasks: one row of a length and two
    tasks for each of them, no more than the plan has.
    """
    ranges = sorted({(row[0], row[1], row[2]) for row in rows if row[4] < row[0]})
    wanted = cut.sparkSession.createDataFrame(ranges, "length long, rank_from long, rank_to long")
    there = (F.col("before") < F.col("rank_to")) & (F.col("before") + F.col("n") > F.col("rank_from"))
    spans = (
        _before(cut.drop("ids")).join(F.broadcast(wanted), "length").where(there)
        .groupBy("length", "rank_from", "rank_to").agg(F.min("task").alias("first_task"), F.max("task").alias("last_task"))
        .select(F.col("length").alias("s_length"), "first_task", "last_task")
    )
    inside = (F.col("length") == F.col("s_length")) & F.col("task").between(F.col("first_task"), F.col("last_task"))
    return cut.join(F.broadcast(spans) if len(rows) <= MOST_BROADCAST else spans, inside, "leftsemi")


def _dealt(sequence: Column, spans: list[tuple[int, int, int]], step_tokens: int) -> tuple[Column, Column]:
    """Context size and step group of a sequence."""
    size, group, groups = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for tier, first, n in spans:
        steps = math.ceil(n * tier / step_tokens)
        rank = sequence - first
        turn, place = F.floor(rank / steps), rank % steps
        step = F.when(turn % 2 == 0, place).otherwise(steps - 1 - place)
        here = sequence >= first
        size = F.when(here, tier).otherwise(size)
        group = F.when(here, groups + step).otherwise(group)
        groups += steps
    return size, group


def packed(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None = None,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The stored chunks with their ids, where each piece of a document stands (stored, without ids), and the chunks
    of which some are cut.

    ``uid`` names a row of ``docs``, ``start`` counts its ids before the piece, ``doc_tokens`` all of them;
    ``sequence_id`` and ``offset`` say where the piece stands, ``context`` is the sequence's size and
    ``step_group`` the group of sequences that are trained on together.  A piece is part of the chunk
    that starts at ``chunk_start``; ``ids_crc32`` is the checksum of a piece that is a whole chunk.
    """
    spark, largest = docs.sparkSession, max(tiers)
    cut = chunks(docs, tokenizer, largest, end_id, id_col, text_col).withColumn("ids_crc32", F.crc32("ids"))
    cut = stored(cut, f"{folder}/chunks")
    found = cut.groupBy("length").agg(F.count("*").alias("n")).collect()  # as many rows as the largest size
    rows, spans = plan({r.length: r.n for r in found}, tiers)
    columns = list(zip(*rows, strict=True)) or [()] * len(_PLAN)
    arrays = [pa.array(c, pa.int64()) for c in columns]
    placing = spark.createDataFrame(pa.Table.from_arrays(arrays, schema=_PLAN))
    if len(rows) <= MOST_BROADCAST:
        placing = F.broadcast(placing)

    p, c = placing.alias("p"), _ranked(cut.drop("ids")).alias("c")
    within = F.col("c.rank") - F.col("p.rank_from")
    fits = (F.col("c.length") == F.col("p.length")) & (within >= 0) & (F.col("c.rank") < F.col("p.rank_to"))
    sequence = (F.col("first_sequence") + F.floor(within / F.col("per_sequence"))).cast("long")
    context, group = _dealt(F.col("sequence_id"), spans, step_tokens)
    pieces = c.join(p, fits).select(
        "uid",
        "doc_id",
        F.col("start").alias("chunk_start"),
        (F.col("start") + F.col("cut_from")).alias("start"),
        F.col("cut_length").alias("length"),
        F.when(F.col("cut_length") == F.col("c.length"), F.col("ids_crc32")).alias("ids_crc32"),
        sequence.alias("sequence_id"),
        (F.col("at") + within % F.col("per_sequence") * F.col("cut_length")).alias("offset"),
        "doc_tokens",
    )
    placed = pieces.withColumn("context", context).withColumn("step_group", group)
    return cut, stored(placed, f"{folder}/placed"), _parted(cut, rows)


def with_ids(cut: DataFrame, placed: DataFrame) -> DataFrame:
    """Pieces with their ``ids`` (little-endian, 32 bits)."""
    chunk = cut.select(F.col("uid").alias("c_uid"), F.col("start").alias("c_start"), F.col("ids").alias("chunk_ids"))
    first = ((F.col("start") - F.col("chunk_start")) * 4 + 1).cast("int")
    return (
        placed.join(chunk, (F.col("uid") == F.col("c_uid")) & (F.col("chunk_start") == F.col("c_start")))
        .withColumn("ids", F.substring("chunk_ids", first, (F.col("length") * 4).cast("int")))
        .drop("c_uid", "c_start", "chunk_ids")
    )


def checksums(placed: DataFrame, parted: DataFrame) -> DataFrame:
    """Pieces with the checksums of all their ids.

    That of a whole chunk is known; only pieces that were cut, one in a sequence at most, look up their ids, among
    the chunks of which some are cut.
    """
    whole = placed.where("ids_crc32 IS NOT NULL")
    parts = with_ids(parted, placed.where("ids_crc32 IS NULL"))
    return whole.unionByName(parts.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))
