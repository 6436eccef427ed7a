"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint has 64 bits.  For a radius ``r`` every bit position carries a non-zero
vector of ``r + 1`` bits, and each of the ``2 ** (r + 1) - 1`` non-zero vectors ``v``
masks the positions whose vector has an odd product with it.  Any ``r`` positions
leave some ``v`` that is even with all of them, so fingerprints that differ in at
most ``r`` bits agree under that mask and meet in that table: no pair is missed.

Equal fingerprints are one node from the start.  Fingerprints that share a bucket
with another are linked without looking at pairs: each names the centres near it
(itself with up to half the radius of bits turned, only bits outside the shared
mask), and fingerprints at one centre are within the radius of each other.  They
are linked to one of them, which loses no link between components.  A centre has few
possible members, so no group grows with the data, whatever the bucket sizes.

Defined cases: a null or empty text has no shingles and fingerprint zero, and is
linked like any other; a text with fewer words than a shingle is one shingle; null
ids never win a component unless there is no other; a bit set in exactly half the shingles (a tie) is 0; a text of
any length is folded shingle by shingle into 64 counters; repeated rows stay, in one component; an empty table
gives no rows; other columns are kept, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostrata.llm.components import components
from aerostrata.llm.staging import map_arrow, stored, unused

SEED = 42
_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle_words: int) -> int:
    """The SimHash of a text over its word shingles, repeats included (unsigned)."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    whole = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle_words + 1)
    last = ends[min(shingle_words, len(words)) - 1 :][:n].tolist()
    first = [0, *(ends[: n - 1] + 1).tolist()]
    ones = np.zeros(64, np.int64)
    for i in range(0, n, _AT_ONCE):
        spans = zip(first[i : i + _AT_ONCE], last[i : i + _AT_ONCE], strict=True)
        hashes = np.array([xxh64_intdigest(whole[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def with_fingerprint(
    docs: DataFrame, shingle_words: int, out: str, text_col: str = "text"
) -> DataFrame:
    """All columns of ``docs`` and the fingerprint as a signed 64-bit number."""

    def add(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            found = np.array([fingerprint(t, shingle_words) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(found.view(np.int64))], [*kept.names, out]
            )

    kept = docs.schema
    given = unused(docs, "_text")
    schema = T.StructType([*kept.fields, T.StructField(out, T.LongType())])
    return map_arrow(docs.select(F.col(text_col).cast("string").alias(given), "*"), add, schema)


def masks(radius: int) -> list[int]:
    """The covering masks over 64 bits, one per table (unsigned)."""
    vectors = (1 << (radius + 1)) - 1
    at = [1 + i % vectors for i in range(64)]
    return [
        sum(1 << i for i in range(64) if (at[i] & v).bit_count() % 2)
        for v in range(1, vectors + 1)
    ]


def _signed(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def candidates(distinct: DataFrame, radius: int) -> DataFrame:
    """``fp`` and ``free``: fingerprints that share a bucket, and the bits outside its masks."""
    tables = [
        F.struct(
            F.lit(k).alias("table"),
            F.col("fp").bitwiseAND(_signed(m)).alias("key"),
            _signed(m ^ ((1 << 64) - 1)).alias("free"),
        )
        for k, m in enumerate(masks(radius))
    ]
    rows = distinct.select("fp", F.explode(F.array(*tables)).alias("t")).select("fp", "t.*")
    shared = rows.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.join(shared, ["table", "key"]).groupBy("fp").agg(F.bit_or("free").alias("free"))


def links(found: DataFrame, radius: int, folder: str) -> DataFrame:
    """Links ``a``, ``b`` that connect all candidates within the radius of each other."""
    inner, outer = radius // 2, (radius + 1) // 2
    near = found.select("fp", "free", F.col("fp").alias("centre"), F.lit(0).alias("turned"), F.lit(-1).alias("bit"))
    all_near = near
    for turned in range(1, outer + 1):
        bits = F.filter(
            F.sequence(F.lit(0), F.lit(63)),
            lambda b: (b > F.col("bit")) & (F.call_function("bit_get", F.col("free"), b) == 1),
        )
        near = near.select("fp", "free", "centre", F.explode(bits).alias("bit")).select(
            "fp",
            "free",
            F.col("centre").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("centre"),
            F.lit(turned).alias("turned"),
            "bit",
        )
        all_near = all_near.unionByName(near)
    members = all_near.select("centre", "fp", "turned")
    hub = F.min(F.when(F.col("turned") <= inner, F.col("fp")))
    hubs = members.groupBy("centre").agg(hub.alias("hub"), F.max("fp").alias("most"), F.min("fp").alias("least"))
    hubs = hubs.where("hub IS NOT NULL AND most <> least").select("centre", "hub")
    pairs = members.join(hubs, "centre").where("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b"))
    return stored(pairs.distinct(), folder)


def linked(fingerprints: DataFrame, radius: int, folder: str) -> DataFrame:
    """``fp``, ``component_id``: for each fingerprint the smallest document id reachable.

    ``fingerprints`` has ``doc_id`` and ``fp`` and is a stored table.
    """
    distinct = stored(fingerprints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), f"{folder}/distinct")
    pairs = links(candidates(distinct, radius), radius, f"{folder}/links")
    roots = components(pairs, f"{folder}/components")
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "doc_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return placed.select("fp", "root").join(smallest, "root").select("fp", "component_id")


def near_duplicates(
    docs: DataFrame,
    folder: str,
    shingle_words: int,
    radius: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` and ``component_id``."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = with_fingerprint(given, shingle_words, "fp").select("doc_id", "fp")
    rows = stored(found, f"{folder}/fingerprints")
    return rows.join(linked(rows, radius, folder), "fp").select("doc_id", "fp", "component_id")


def one_of_each(
    docs: DataFrame,
    folder: str,
    shingle_words: int,
    radius: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` with one document of each component: that of the smallest id.

    Of rows that share that id the first stored one stays.
    """
    fp, row = unused(docs, "_fp"), unused(docs, "_row")
    marked = with_fingerprint(docs, shingle_words, fp, text_col)
    rows = stored(marked.withColumn(row, F.monotonically_increasing_id()), f"{folder}/documents")
    narrow = rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    classes = linked(narrow.select("doc_id", "fp"), radius, folder)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = narrow.join(classes, "fp").groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp"))).agg(
        F.min(order).alias("first")
    )
    chosen = first.select(F.col("first.row").alias(row))
    return rows.join(chosen, row, "left_semi").drop(fp, row)
