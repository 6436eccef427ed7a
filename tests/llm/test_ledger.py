"""The stored ledger of quality rules, and empty tables and long texts for the text operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aerostrata.llm import licences, pseudonyms, quality_rules, winnowing
from aerostrata.llm.staging import run_folder
from tests.llm.test_texts import measures

GOOD = " ".join(f"word{i}" for i in range(40))
ROWS = [(1, GOOD, 5), (1, GOOD, 5), (None, "few words", 6), (2, None, 7), (3, "again " * 40, 8), (4, "", 9)]


@pytest.fixture(scope="module")
def ledger(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, failed int")
    return quality_rules.stored_ledger(docs, run_folder(spark, "test"))


def test_a_ledger_has_a_line_per_document_and_no_texts(ledger):
    assert ledger.columns == ["doc_id", *quality_rules.MEASURES, "failed"]
    assert sorted(r.doc_id or 0 for r in ledger.collect()) == [0, 1, 1, 2, 3, 4]
    plan = ledger._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" in plan and "split" not in plan


def test_policies_are_applied_to_the_stored_bits(ledger):
    verdicts = quality_rules.judged(ledger, base=quality_rules.POLICIES["base"], none=0, words=quality_rules.mask("few_words"))
    found = {(r.doc_id, r.base, r.none, r.words) for r in verdicts.collect()}
    assert found == {
        (1, True, True, True), (None, False, True, False), (2, False, True, False),
        (3, False, True, True), (4, False, True, False),
    }


def test_ablations_equal_policies_without_the_rule(ledger):
    policy = quality_rules.POLICIES["v1"]
    for r in quality_rules.ablations(ledger, policy, "failed").collect():
        kept = quality_rules.judged(ledger, kept=policy & ~quality_rules.mask(r.rule)).where("kept").count()
        assert r.kept_without_it == kept
        alone = ledger.where(F.col("failed").bitwiseAND(policy) == quality_rules.mask(r.rule)).count()
        assert r.failing_only_this == alone


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert quality_rules.stored_ledger(docs, run_folder(spark, "test")).count() == 0
    assert quality_rules.with_ledger(docs).count() == 0
    assert licences.with_licences(docs).count() == 0
    assert pseudonyms.pseudonymized(docs, "key").count() == 0


def test_long_texts(spark):
    """A text of five million characters, on a single line and on many."""
    filler = [f"word{i} " for i in range(300_000)]
    lines = "\n".join("".join(filler[i : i + 10]) for i in range(0, len(filler), 10))
    notice = "Licensed under the MIT License."
    texts = ["".join(filler) + notice, lines + "\n" + notice + "\n" + lines]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = licences.with_licences(docs).orderBy("doc_id").select("licences").collect()
    assert [r.licences for r in found] == [[], ["MIT"]]
    judged = quality_rules.with_ledger(docs).orderBy("doc_id").collect()
    assert [r.quality[:-1] for r in judged] == [tuple(measures(t)) for t in texts]
    left = winnowing.deduplicated(docs, run_folder(spark, "test"), lines_col="n", deleted_col="gone").orderBy("doc_id").collect()
    assert [(r.n, r.gone) for r in left] == [(1, 0), (60_001, 30_000)]
