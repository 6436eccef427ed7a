"""Line dedup by winnowing: later repeats of a run of lines are deleted.

A run counts from ``min_words`` words on.  From every line on, the shortest stretch
of lines with that many words is a window, so every run that counts holds a whole
window.  The smallest line hash of a window is its fingerprint; as it depends on the
window's lines only, two copies of a run always share a selected fingerprint.

1. Per document the selected fingerprints are stored with their windows.
2. Fingerprints are counted; only windows at a fingerprint that stands at two places
   or more go on.
3. These are joined by content to their first place in the corpus.  Every later one
   is deleted.  Windows of neighbouring lines overlap, so they reach from the first line
   of a repeated run to the last line at which one of its windows ends.
4. What is left of a run is shorter than a window.  So every window carries the lines
   that follow it before the next line's window ends, as hashes of the stretch up to
   each of them; repeated windows are joined by these, too.

A line is deleted exactly if it lies in a run of ``min_words`` words or more whose lines
stand, in that order, at an earlier place: in a document with a smaller id, or earlier in
the same one.

Lines without a word are not compared; inside a deleted run they go with it.

Defined cases: a null text stays null and has no lines; null ids come first; documents that share an id
are ordered by a hash of their texts; rows that agree in id and text are one document and get the same
lines; equal smallest hashes in a window (ties) are one fingerprint; a text of any length is
compared line by line and whole, and a line longer than a window is a window of its own; an empty table gives no rows; other columns are kept, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostrata.llm.staging import map_arrow, stored

MIN_WORDS = 50

_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
_FOUND = (
    "doc_id long, text_hash long, fingerprint binary, "
    "windows array<struct<first:int,last:int,key:binary,more:binary>>"
)
#: Bytes of a line that follows a window: its number and the hash of the lines up to it.
_PLACE, _HASH = 4, 8


def _windows(text: str, min_words: int):
    """Fingerprint, first line, last line, content key and following lines of every window of a text."""
    from xxhash import xxh3_64, xxh3_128_digest

    lines = text.split("\n")
    words = np.array([len(_WORDS.findall(line)) for line in lines])
    at = np.flatnonzero(words)
    if not len(at) or words.sum() < min_words:
        return
    hashes = [xxh3_128_digest(lines[i].encode()) for i in at.tolist()]
    sums = np.cumsum(words[at])
    before = sums - words[at]
    lasts = np.searchsorted(sums, before + min_words)
    for first, last in enumerate(lasts.tolist()):
        if last == len(at):
            return
        inside = hashes[first : last + 1]
        key = inside[0] if first == last else xxh3_128_digest(b"".join(inside))
        more, so_far = [], xxh3_64()
        # of the last line no window starts, its end is that of the text
        for i in range(last + 1, int(lasts[first + 1]) if first + 1 < len(at) else len(at)):
            so_far.update(hashes[i])
            more.append(int(at[i]).to_bytes(_PLACE) + so_far.digest())
        yield min(inside), int(at[first]), int(at[last]), key, b"".join(more)


def fingerprints(docs: DataFrame, min_words: int) -> DataFrame:
    """One row per selected fingerprint of a document, with the windows that it stands for."""

    def select(batches):
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text_hash, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                chosen: dict[bytes, list[dict]] = {}
                for fingerprint, first, last, key, more in _windows(text or "", min_words):
                    window = {"first": first, "last": last, "key": key, "more": more}
                    chosen.setdefault(fingerprint, []).append(window)
                rows += [(doc_id, text_hash, f, w) for f, w in chosen.items()]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            window = pa.struct(
                [("first", pa.int32()), ("last", pa.int32()), ("key", pa.binary()), ("more", pa.binary())]
            )
            types = [pa.int64(), pa.int64(), pa.binary(), pa.list_(window)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                ["doc_id", "text_hash", "fingerprint", "windows"],
            )

    return map_arrow(docs.select("doc_id", "text_hash", "text"), select, _FOUND)


def _following(more: Column) -> Column:
    """Number of each following line and hash of the lines up to it."""
    size = _PLACE + _HASH

    def line(i: Column) -> Column:
        place = F.conv(F.hex(F.substring(more, i * size + 1, F.lit(_PLACE))), 16, 10).cast("int")
        return F.struct(place.alias("last"), F.substring(more, i * size + 1 + _PLACE, F.lit(_HASH)).alias("upto"))

    return F.transform(F.sequence(F.lit(0), (F.length(more) / size).cast("int") - 1), line)


def repeated_lines(found: DataFrame, folder: str) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``lines``: the numbers of the lines to delete.

    ``found`` is a stored table of fingerprints.  What is folded by fingerprint or content is
    stored before it is joined: only then can Spark split the rows of a frequent one.
    """
    shared = found.groupBy("fingerprint").agg(F.sum(F.size("windows")).alias("n")).where("n > 1")
    shared = stored(shared.select("fingerprint"), f"{folder}/shared")
    windows = (
        found.join(shared, "fingerprint")
        .select("doc_id", "text_hash", F.explode("windows").alias("w"))
        .select("doc_id", "text_hash", "w.*")
    )
    place = F.struct("doc_id", "text_hash", "first")
    seen = windows.groupBy("key").agg(F.min(place).alias("earliest"), F.max(place).alias("latest"))
    seen = stored(seen.where("earliest < latest").select("key", "earliest"), f"{folder}/seen")
    matched = stored(windows.join(seen, "key"), f"{folder}/matched")
    later = matched.where(F.col("earliest") < place).select("doc_id", "text_hash", "first", "last")

    # of the lines that follow equal windows, those that are equal, too
    longer = matched.where(F.length("more") > 0).select(
        "doc_id", "text_hash", "first", "key", F.explode(_following(F.col("more"))).alias("f")
    )
    longer = longer.select("doc_id", "text_hash", "first", "key", "f.*")
    again = longer.groupBy("key", "upto").agg(F.min(place).alias("earliest"), F.max(place).alias("latest"))
    again = stored(again.where("earliest < latest").select("key", "upto", "earliest"), f"{folder}/again")
    longer = longer.join(again, ["key", "upto"]).where(F.col("earliest") < place)
    later = later.unionByName(longer.select("doc_id", "text_hash", "first", "last"))
    lines = F.array_distinct(F.flatten(F.collect_list(F.sequence("first", "last"))))
    return later.groupBy("doc_id", "text_hash").agg(lines.alias("lines"))


def deduplicated(
    docs: DataFrame,
    folder: str,
    min_words: int = MIN_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    lines_col: str | None = None,
    deleted_col: str | None = None,
) -> DataFrame:
    """``docs`` without later repeats of runs of lines.

    ``lines_col`` and ``deleted_col`` add the number of lines before and of those deleted.
    """
    columns = docs.columns
    text = F.col(text_col).cast("string")
    keyed = docs.select(
        F.struct("*").alias("doc"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
    )
    found = stored(fingerprints(keyed, min_words), f"{folder}/fingerprints")
    delete = repeated_lines(found, folder).withColumnsRenamed({"doc_id": "d_id", "text_hash": "d_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("text_hash") == F.col("d_hash"))
    df = keyed.join(delete, same, "left").withColumn("all_lines", F.split("text", "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("all_lines") - 1), F.col("lines"))
    left = F.array_join(F.transform(kept, lambda i: F.get("all_lines", i)), "\n")
    new = F.when(F.col("lines").isNull(), F.col("text")).otherwise(left)
    out = [(new if c == text_col else F.col(f"doc.`{c}`")).alias(c) for c in columns]
    if lines_col:
        out.append(F.when(F.col("text").isNull(), 0).otherwise(F.size("all_lines")).cast("long").alias(lines_col))
    if deleted_col:
        out.append(F.when(F.col("lines").isNull(), 0).otherwise(F.size("lines")).cast("long").alias(deleted_col))
    return df.select(*out)
