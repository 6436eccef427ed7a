"""Quality rules as a ledger of bits: measured once, judged by versioned policies.

``with_ledger`` evaluates every rule on every text a single time and gives the
measurements beside one number whose bit ``i`` says that rule ``i`` failed.
``stored_ledger`` keeps them with the ids of the documents as a table.  A
policy is a mask of rules, so a new policy (``judged``), or the effect of leaving a rule out
(``ablations``), needs that table only and never the texts again.

All of it is column expressions in one pass without a shuffle.  Words are the
stretches between blanks and the control characters from tab to carriage return.

Defined cases: a null text has no words; measurements of texts without words are
zero, and rules that compare with a share of the words do not fail there; repeated
rows are judged alike and each has its line in the ledger, as have null ids; ties (windows that are
equal) count every place; a text of any length is judged whole inside its row; an empty table gives
an empty ledger and no ablations; other columns are kept, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostrata.llm.staging import stored, unused

# Fixed values of the word and symbol definitions.
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

#: Rule by bit number: its name and when it fails.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > n_words AND n_symbols > 2"),
    ("repeated_lines", "100 * n_dup_lines > 30 * n_lines AND n_dup_lines > 1"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 15 * n_words"),
]


def mask(*names: str) -> int:
    """The bits of rules by name."""
    bits = {name: 1 << i for i, (name, _) in enumerate(RULES)}
    return reduce(lambda a, b: a | b, (bits[name] for name in names), 0)


#: Policies by version.  Word lengths are recorded but do not reject: scripts without
#: blanks between words would fail them.
POLICIES: dict[str, int] = {
    "base": mask("few_words", "repeated_words"),
    "v1": mask("few_words", "repeated_words", "symbols", "repeated_lines"),
}


def _words(text: Column) -> Column:
    spaced = F.translate(text, BLANKS, " " * len(BLANKS))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _add(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def with_ledger(docs: DataFrame, text_col: str = "text", out: str = "quality") -> DataFrame:
    """All columns of ``docs`` and a struct ``out``: the measurements and ``failed``."""
    if out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the input has a column {out} already")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    df = docs.select(F.struct("*").alias("doc"), text.alias("text"))
    df = _add(
        df,
        words=_words(F.col("text")),
        lines=F.filter(F.split("text", "\n"), lambda line: _without(line, BLANKS) != ""),
    )
    df = _add(
        df,
        n_words=F.size("words").cast("long"),
        word_chars=F.length(_without(F.col("text"), BLANKS)).cast("long"),
        n_symbols=(F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long"),
        n_lines=F.size("lines").cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        windows=F.when(
            F.size("words") >= WINDOW,
            F.transform(
                F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)),
                lambda i: F.xxhash64(F.slice("words", i, WINDOW)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    # most texts repeat no window and skip the sort
    df = _add(
        df,
        ordered=F.when(
            F.size(F.array_distinct("windows")) < F.size("windows"),
            F.array_sort(F.transform("windows", lambda x, i: F.struct(x.alias("x"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<x:bigint,i:int>>")),
    )

    def again(entry: Column, k: Column) -> Column:
        same = lambda at: F.coalesce(F.get("ordered", at)["x"] == entry["x"], F.lit(False))
        return same(k - 1) | same(k + 1)

    df = _add(
        df,
        found=F.array_sort(F.transform(F.filter("ordered", again), lambda entry: entry["i"])),
    )
    covered = F.transform(
        "found", lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get("found", k + 1) - at, F.lit(WINDOW)))
    )
    df = _add(
        df, n_repeat_words=F.aggregate(covered, F.lit(0), lambda a, b: a + b).cast("long")
    )
    failed = reduce(
        lambda a, b: a.bitwiseOR(b),
        (F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)) for i, (_, rule) in enumerate(RULES)),
    )
    ledger = F.struct(*MEASURES, failed.cast("long").alias("failed"))
    # a one-row explode keeps filters on the ledger from being moved below it, where
    # every use of a measurement would compute it anew
    return df.select("doc.*", F.explode(F.array(ledger)).alias(out))


def stored_ledger(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger as a stored table: the id, the measurements and ``failed``, one row per document."""
    rows = docs.select(F.col(id_col), F.col(text_col))
    ledger = unused(rows, "ledger")
    judged = with_ledger(rows, text_col, ledger)
    return stored(judged.select(id_col, f"{ledger}.*"), folder)


def judged(ledger: DataFrame, **policies: int) -> DataFrame:
    """A stored ledger with a verdict per policy, true for documents that it keeps."""
    return ledger.select("*", *[(~rejected(F.col("failed"), policy)).alias(name) for name, policy in policies.items()])


def rejected(failed: Column, policy: int) -> Column:
    """Whether any rule of the policy failed."""
    return failed.bitwiseAND(F.lit(policy)) != 0


def ablations(ledger: DataFrame, policy: int, failed: str = "quality.failed") -> DataFrame:
    """For every rule of a policy: documents failing it, failing only it, and kept without it.

    Documents are counted per bit pattern first; the patterns alone are compared
    with the rules.
    """
    counts = ledger.groupBy(F.col(failed).bitwiseAND(F.lit(policy)).alias("bits")).agg(
        F.count("*").alias("n")
    )
    rules = [(name, 1 << i) for i, (name, _) in enumerate(RULES) if policy >> i & 1]
    total = lambda condition, name: F.coalesce(
        F.sum(F.when(condition, F.col("n"))), F.lit(0)
    ).alias(name)
    bits, rule = F.col("bits"), F.col("r.bit")
    listed = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(b).cast("long").alias("bit")) for n, b in rules])
    return (
        counts.withColumn("r", F.explode(listed))
        .groupBy("r.rule")
        .agg(
            total(bits.bitwiseAND(rule) != 0, "failing"),
            total(bits == rule, "failing_only_this"),
            total(bits.bitwiseAND(F.bitwise_not(rule)) == 0, "kept_without_it"),
        )
    )
