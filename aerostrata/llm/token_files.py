"""Token ids in files: canonical, length-limited Huffman codes from global counts.

Writing takes three jobs, each stored before the next starts:

1. every text is tokenized once and its ids are stored with a row number;
2. ids are counted over all rows; the counts, as many as the vocabulary has entries
   at most, give one code for the whole file;
3. every document is coded on its own, then the codes alone (the smallest form of
   the data) are shuffled into ascending document order and joined to blocks.

A file is a folder with two Parquet tables.  ``codes`` has the bit length of each
id; lengths are all that a canonical code needs.  ``blocks`` has one row per block
of whole documents: their ids and token counts, the coded bytes, and the bit offset
of every 128th token of a document.  Blocks are read independently.  A reader starts
at all bit offsets at once and looks each code up in a table of
``2 ** longest code`` entries.

Defined cases: a null text is empty; null document ids come first; documents with
equal ids stand next to each other in the order they were read; repeated rows are kept; an
empty table gives an empty file; a text of any length is coded whole in one block, which then is as
long as it; ties in counts are broken by the smaller id, so equal counts give equal files; other columns of the input are left out.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerostrata.llm.staging import binary_column, map_arrow, ragged, row_ids, slices, stored
from aerostrata.llm.word_memory import text_groups, tokenizer_memory, vocabulary_size

LONGEST_CODE = 18
MARK_EVERY = 128
BLOCK_BYTES = 1 << 18
PART_BYTES = 64 << 20
#: Tokens or bytes worked on together, so that columns of them stay in a core's cache.
AT_ONCE = 250_000

_CODES = "id int, n long, bits int"
_BLOCKS = (
    "part int, block int, first long, n_tokens long, doc_ids array<bigint>, "
    "doc_tokens array<bigint>, marks binary, payload binary"
)


@dataclass(frozen=True)
class TokenFile:
    """Where a written file lies."""

    folder: str

    @property
    def codes(self) -> str:
        return f"{self.folder}/codes"

    @property
    def blocks(self) -> str:
        return f"{self.folder}/blocks"


def code_lengths(counts: np.ndarray, longest: int) -> np.ndarray:
    """Bit lengths of an optimal prefix code of at most ``longest`` bits (package merge).

    ``counts`` are positive.  Every level holds the single ids and the pairs of the
    level below in order of weight; an id is as long as the number of levels that
    take it.
    """
    n = len(counts)
    if n == 0:
        return np.zeros(0, np.uint8)
    if n == 1:
        return np.ones(1, np.uint8)
    if 1 << longest < n:
        raise ValueError(f"{n} ids need codes of more than {longest} bits")
    order = np.argsort(counts, kind="stable")
    single = counts[order].astype(np.int64)
    weights, levels = single, []
    for _ in range(longest - 1):
        half = len(weights) // 2 * 2
        merged = np.concatenate([single, weights[0:half:2] + weights[1:half:2]])
        by_weight = np.argsort(merged, kind="stable")
        weights = merged[by_weight]
        levels.append(by_weight < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for is_single in reversed(levels):
        taken = int(np.count_nonzero(is_single[:take]))
        lengths[:taken] += 1
        take = 2 * (take - taken)
    lengths[:take] += 1
    out = np.empty(n, np.uint8)
    out[order] = lengths
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of length, then id; ids without a code have length zero."""
    codes = np.zeros(len(lengths), np.uint64)
    longest = int(lengths.max(initial=0))
    code = 0
    for bits in range(1, longest + 1):
        own = np.flatnonzero(lengths == bits)
        codes[own] = code + np.arange(len(own), dtype=np.uint64)
        code = (code + len(own)) << 1
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """For each string of as many bits as the longest code: id * 32 + code length."""
    longest = int(lengths.max(initial=0))
    own = np.flatnonzero(lengths)
    own = own[np.argsort(lengths[own], kind="stable")]
    entries = own.astype(np.uint32) << np.uint32(5) | lengths[own].astype(np.uint32)
    filled = np.repeat(entries, np.int64(1) << (longest - lengths[own].astype(np.int64)))
    table = np.zeros(1 << longest, np.uint32)
    table[: len(filled)] = filled
    return table, longest


def pack_bits(codes: np.ndarray, lengths: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Bytes with each code at its bit position; positions ascend, codes have 32 bits at most."""
    words = np.zeros(size // 4 + 3, np.uint64)
    if len(codes):
        word = at >> 5
        shift = (64 - lengths.astype(np.int64) - (at & 31)).astype(np.uint64)
        begins = np.flatnonzero(np.diff(word, prepend=-1))
        sums = np.add.reduceat(codes << shift, begins)
        words[word[begins]] += sums >> np.uint64(32)
        words[word[begins] + 1] += sums & np.uint64(0xFFFFFFFF)
    return words.astype(">u4").view(np.uint8)[:size]


def unpack_ids(
    payload: np.ndarray, starts: np.ndarray, counts: np.ndarray, table: np.ndarray, longest: int
) -> np.ndarray:
    """Ids of stretches of at most 128 tokens, all stretches in step.

    ``starts`` are bit positions.  In every round each stretch that is not at its
    end reads one code.
    """
    data = np.concatenate([payload, np.zeros(8, np.uint8)])
    window = np.ndarray((len(data) - 3,), ">u4", data, 0, (1,))
    out = np.zeros(int(counts.sum()), np.uint32)
    order = np.argsort(-counts, kind="stable")
    place = (np.cumsum(counts) - counts)[order]
    position, left = starts[order].astype(np.int64), counts[order]
    alive = np.searchsorted(-left, -np.arange(int(counts.max(initial=0))), "left")
    mask = np.uint32((1 << longest) - 1)
    for step, n in enumerate(alive.tolist()):
        at = position[:n]
        bits = window[at >> 3].astype(np.uint32)
        found = table[(bits >> (32 - longest - (at & 7)).astype(np.uint32)) & mask]
        out[place[:n] + step] = found >> np.uint32(5)
        position[:n] = at + (found & np.uint32(31)).astype(np.int64)
    return out


def encode_documents(
    docs: DataFrame, tokenizer: str, end_id: int | None, id_col: str, text_col: str
) -> DataFrame:
    """Row number, document id, token count and ids (little-endian) of every text."""
    wide = max(vocabulary_size(tokenizer), (end_id or 0) + 1) > 1 << 16
    kind = np.dtype("<u4" if wide else "<u2")

    def encode(batches):
        memory, rows = tokenizer_memory(tokenizer), 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for i, j in text_groups(texts):
                ids, counts = memory.encode(texts[i:j])
                if end_id is not None:
                    counts = counts + 1
                    ended = np.full(int(counts.sum()), end_id, kind)
                    inner = np.ones(len(ended), bool)
                    inner[np.cumsum(counts) - 1] = False
                    ended[inner] = ids
                    ids = ended
                columns = [
                    pa.array(row_ids(part, rows, j - i)),
                    batch.column(0)[i:j],
                    pa.array(counts),
                    binary_column(ids.astype(kind), counts * kind.itemsize),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["uid", "doc_id", "n_tokens", "ids"])
                rows += j - i

    chosen = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return map_arrow(chosen, encode, "uid long, doc_id long, n_tokens long, ids binary")


def _kind(width: int) -> np.dtype:
    return np.dtype(f"<u{width}")


def _flat(column: pa.Array, kind: np.dtype) -> np.ndarray:
    """The bytes of all values of a binary column, as numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _batches(batch: pa.RecordBatch, sizes: list[int], budget: int):
    for i, j in slices(sizes, budget):
        yield batch.slice(i, j - i)


def _counted(encoded: DataFrame, width: int, vocabulary: int) -> DataFrame:
    def count(batches):
        total = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for part in _batches(batch, batch.column(0).to_pylist(), 4_000_000):
                total += np.bincount(_flat(part.column(1), _kind(width)), minlength=vocabulary)
        used = np.flatnonzero(total)
        columns = [pa.array(used.astype(np.int32)), pa.array(total[used])]
        yield pa.RecordBatch.from_arrays(columns, ["id", "n"])

    counts = map_arrow(encoded.select("n_tokens", "ids"), count, "id int, n long")
    return counts.groupBy("id").agg(F.sum("n").alias("n"))


def _bounds(encoded: DataFrame, parts: int) -> list[tuple]:
    """The first row, in file order, of each of about ``parts`` even ranges."""
    key = F.struct(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "uid")
    ranges = encoded.select(key.alias("key")).repartitionByRange(parts, "key")
    firsts = ranges.groupBy(F.spark_partition_id()).agg(F.min("key").alias("key")).orderBy("key")
    return [tuple(row.key) for row in firsts.collect()]


def _coded(encoded: DataFrame, width: int, lengths: np.ndarray, bounds: list[tuple]) -> DataFrame:
    codes = canonical_codes(lengths)

    def code(batches):
        for whole in batches:
            for batch in _batches(whole, whole.column(2).to_pylist(), AT_ONCE):
                uids, doc_ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                counts = batch.column(2).to_numpy()
                ids = _flat(batch.column(3), _kind(width))
                bits = lengths[ids].astype(np.int64)
                ends = np.zeros(len(bits) + 1, np.int64)
                np.cumsum(bits, out=ends[1:])
                token_at = np.concatenate([[0], np.cumsum(counts)])
                first_bit = ends[token_at[:-1]]
                own_bits = ends[token_at[1:]] - first_bit
                size = (own_bits + 7) // 8
                byte_at = np.cumsum(size) - size
                at = ends[:-1] + np.repeat(byte_at * 8 - first_bit, counts)
                n_marks = -(-counts // MARK_EVERY)
                step = np.arange(int(n_marks.sum())) - np.repeat(np.cumsum(n_marks) - n_marks, n_marks)
                marked = np.repeat(token_at[:-1], n_marks) + step * MARK_EVERY
                marks = (ends[marked] - np.repeat(first_bit, n_marks)).astype("<u4")
                parts = [
                    max(0, bisect.bisect_right(bounds, (d is not None, d or 0, u)) - 1)
                    for d, u in zip(doc_ids, uids, strict=True)
                ]
                columns = [
                    pa.array(parts, pa.int32()),
                    *(batch.column(i) for i in range(3)),
                    binary_column(marks, n_marks * 4),
                    binary_column(pack_bits(codes[ids], bits, at, int(size.sum())), size),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, ["part", "uid", "doc_id", "n_tokens", "marks", "payload"]
                )

    return map_arrow(
        encoded.select("uid", "doc_id", "n_tokens", "ids"),
        code,
        "part int, uid long, doc_id long, n_tokens long, marks binary, payload binary",
    )


def _blocks(ordered: DataFrame) -> DataFrame:
    """Blocks of whole documents from rows in file order."""

    def join(batches):
        part = block = first = 0
        rows: list[tuple] = []
        size = 0

        def closed():
            at = np.cumsum([0] + [len(r[3]) for r in rows])
            marks = [np.frombuffer(r[2], "<u4") + 8 * int(a) for r, a in zip(rows, at[:-1], strict=True)]
            tokens = [r[1] for r in rows]
            values = [
                part, block, first, sum(tokens), [r[0] for r in rows], tokens,
                np.concatenate(marks).astype("<u4").tobytes(), b"".join(r[3] for r in rows),
            ]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            names = ["part", "block", "first", "n_tokens", "doc_ids", "doc_tokens", "marks", "payload"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

        for batch in batches:
            for part_of, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (size + len(row[3]) > BLOCK_BYTES or part_of != part):
                    yield closed()
                    first, block = (first + sum(r[1] for r in rows), block + 1) if part_of == part else (0, 0)
                    rows, size = [], 0
                part = part_of
                rows.append(row)
                size += len(row[3])
        if rows:
            yield closed()

    return map_arrow(ordered, join, _BLOCKS)


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    longest_code: int = LONGEST_CODE,
) -> TokenFile:
    """Tokenize all texts and write their ids in ascending document order."""
    spark, file = docs.sparkSession, TokenFile(folder)
    vocabulary = max(vocabulary_size(tokenizer), (end_id or 0) + 1)
    width = 4 if vocabulary > 1 << 16 else 2
    encoded = stored(
        encode_documents(docs, tokenizer, end_id, id_col, text_col), f"{folder}/ids"
    )
    counts = _counted(encoded, width, vocabulary).orderBy("id").toPandas()
    ids, n = counts["id"].to_numpy(), counts["n"].to_numpy()
    lengths = np.zeros(vocabulary, np.uint8)
    lengths[ids] = code_lengths(n, min(25, max(longest_code, len(ids).bit_length())))
    table = pa.table({"id": ids.astype(np.int32), "n": n.astype(np.int64), "bits": lengths[ids].astype(np.int32)})
    spark.createDataFrame(table).coalesce(1).write.parquet(file.codes)

    coded_bytes = int((n * lengths[ids].astype(np.int64)).sum()) // 8
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), coded_bytes // PART_BYTES + 1)
    bounds = _bounds(encoded, parts)
    coded = _coded(encoded, width, lengths, bounds)
    ordered = coded.repartitionById(max(1, len(bounds)), F.col("part")).sortWithinPartitions(
        "part", F.col("doc_id").asc_nulls_first(), "uid"
    )
    chosen = ordered.select("part", "doc_id", "n_tokens", "marks", "payload")
    _blocks(chosen).write.option("compression", "uncompressed").parquet(file.blocks)
    return file


def read(spark: SparkSession, file: TokenFile) -> DataFrame:
    """One row per document: doc_id, start (tokens before it), n_tokens, ids (LE, 32 bits)."""
    codes = spark.read.schema(_CODES).parquet(file.codes).toPandas()
    lengths = np.zeros(int(codes["id"].max()) + 1 if len(codes) else 0, np.uint8)
    lengths[codes["id"].to_numpy()] = codes["bits"].to_numpy()
    names = ["doc_id", "start", "n_tokens", "ids"]

    def decode(batches):
        table, longest = decoding_table(lengths)
        for whole in batches:
            sizes = pa.compute.binary_length(whole.column("payload")).to_pylist()
            for batch in _batches(whole, sizes, AT_ONCE):
                payload = _flat(batch.column("payload"), np.dtype(np.uint8))
                marks = _flat(batch.column("marks"), np.dtype("<u4")).astype(np.int64)
                tokens = batch.column("doc_tokens")
                counts = tokens.flatten().to_numpy()
                per_block = np.diff(tokens.offsets.to_numpy())
                sizes = pa.compute.binary_length(batch.column("payload")).to_numpy().astype(np.int64)
                n_marks = -(-counts // MARK_EVERY)
                block = np.repeat(np.arange(len(per_block)), per_block)
                marks += 8 * np.repeat((np.cumsum(sizes) - sizes)[block], n_marks)
                step = np.arange(len(marks)) - np.repeat(np.cumsum(n_marks) - n_marks, n_marks)
                left = np.minimum(MARK_EVERY, np.repeat(counts, n_marks) - step * MARK_EVERY)
                ids = unpack_ids(payload, marks, left, table, longest)
                sums = np.cumsum(counts) - counts
                block_first = ragged(sums, np.cumsum(per_block) - per_block, np.minimum(per_block, 1))
                before = batch.column("before").to_numpy()[block]
                columns = [
                    batch.column("doc_ids").flatten(),
                    pa.array(before + sums - block_first[block]),
                    pa.array(counts),
                    binary_column(ids.astype("<u4"), counts * 4),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    blocks = spark.read.schema(_BLOCKS).parquet(file.blocks)
    # one row per range of the file: as many as the writing job had partitions
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    placed = blocks.join(F.broadcast(offsets), "part").select(
        "doc_ids", "doc_tokens", "marks", "payload", (F.col("offset") + F.col("first")).alias("before")
    )
    return map_arrow(placed, decode, "doc_id long, start long, n_tokens long, ids binary")
