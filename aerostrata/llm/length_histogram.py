"""Token counts as an exact histogram of encoded lengths.

Texts are tokenized in parallel and folded to counts per length inside each task, so
the shuffle carries at most the different lengths of a task.  Sums from the longest
length down (and from the shortest up) then answer every question about context
limits: how many documents fit, how many tokens there are, how many are left if
longer documents are cut.  Sums are taken inside groups of neighbouring lengths and
over the groups, so no task sorts all lengths.

Defined cases: a null text is empty and has length zero (without an end token); an empty table gives
no rows and answers zero; other columns play no part; repeated rows count each; a text of any
length is one row of the histogram; equal lengths share a row, so ties cannot occur.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.llm.staging import map_arrow
from aerostrata.llm.word_memory import text_groups, tokenizer_memory

GROUP = 1024


def histogram(
    docs: DataFrame, tokenizer: str, extra_tokens: int = 0, text_col: str = "text"
) -> DataFrame:
    """``length`` and ``n_docs`` for every length that occurs."""

    def count(batches):
        memory = tokenizer_memory(tokenizer)
        found: dict[int, int] = {}
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for i, j in text_groups(texts):
                lengths, n = np.unique(memory.count(texts[i:j]) + extra_tokens, return_counts=True)
                for length, k in zip(lengths.tolist(), n.tolist(), strict=True):
                    found[length] = found.get(length, 0) + k
        columns = [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["length", "n_docs"])

    counted = map_arrow(docs.select(F.col(text_col).cast("string")), count, "length long, n_docs long")
    return counted.groupBy("length").agg(F.sum("n_docs").alias("n_docs"))


def suffix_sums(lengths: DataFrame) -> DataFrame:
    """The histogram, a stored table as it is read twice, with sums for each length as a limit.

    ``docs_longer`` and ``tokens_longer`` are over documents above the length,
    ``docs_up_to`` and ``tokens_up_to`` over the others, and ``truncated_tokens``
    is what is left of all documents if longer ones are cut to it.
    """
    rows = lengths.select(
        "length",
        "n_docs",
        (F.col("length") * F.col("n_docs")).alias("tokens"),
        F.floor(F.col("length") / GROUP).alias("part"),
    )
    # one row for every GROUP lengths: as many as the longest text has thousands of tokens
    per_part = rows.groupBy("part").agg(F.sum("n_docs").alias("n"), F.sum("tokens").alias("t"))
    above = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    later = per_part.select(
        "part",
        F.coalesce(F.sum("n").over(above), zero).alias("later_n"),
        F.coalesce(F.sum("t").over(above), zero).alias("later_t"),
        F.sum("n").over(whole).alias("all_n"),
        F.sum("t").over(whole).alias("all_t"),
    )
    longer = Window.partitionBy("part").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.join(later, "part").select(
        "length",
        "n_docs",
        (F.coalesce(F.sum("n_docs").over(longer), zero) + F.col("later_n")).alias("docs_longer"),
        (F.coalesce(F.sum("tokens").over(longer), zero) + F.col("later_t")).alias("tokens_longer"),
        "all_n",
        "all_t",
    )
    up_to = F.col("all_t") - F.col("tokens_longer")
    return sums.select(
        "length",
        "n_docs",
        "docs_longer",
        "tokens_longer",
        (F.col("all_n") - F.col("docs_longer")).alias("docs_up_to"),
        up_to.alias("tokens_up_to"),
        (up_to + F.col("length") * F.col("docs_longer")).alias("truncated_tokens"),
    )


def truncated_total(lengths: DataFrame, limit: int) -> DataFrame:
    """One row: the tokens left if every document is cut to ``limit``."""
    left = F.least(F.col("length"), F.lit(limit)) * F.col("n_docs")
    return lengths.agg(F.coalesce(F.sum(left), F.lit(0)).cast("long").alias("truncated_tokens"))


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """One row: the smallest length that at least ``share`` of the documents do not exceed."""
    reached = F.col("docs_up_to") >= F.lit(share) * (F.col("docs_up_to") + F.col("docs_longer"))
    return sums.where(reached).agg(F.min("length").alias("length"))
