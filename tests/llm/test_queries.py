"""The registered queries: SQL where there is some, and the pipeline stage by stage."""

from __future__ import annotations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from aerostrata.llm import quality_rules, queries
from aerostrata.llm.staging import run_folder, stored
from tests import comparing
from tests.conftest import SMALL
from tests.llm.test_duplicates import expected_fingerprint, roots, without_repeated_runs
from tests.llm.test_texts import measures


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_equals_sql(spark, small_duck, monkeypatch, name):
    monkeypatch.setitem(comparing.TYPES, "BOOLEAN", "BOOLEAN")
    found = queries.queries()[name](spark, SMALL)
    assert comparing.compare(found, small_duck, queries.oracle_sql()[name]) is None


def test_one_query_per_operator_and_the_pipeline():
    names = set(queries.queries())
    assert {n.split("_")[0] for n in names - {"pipeline"}} == {f"op{i}" for i in range(1, 14)}
    assert names <= set(entry.queries())


def test_every_stage_against_plain_python(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    rows = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    def after(name, df):
        out = stored(stages[name](spark, df, SMALL), run_folder(spark, "test"))
        return out, {r.doc_id: r for r in out.collect()}

    df, kept = after("quality rules", docs)
    assert df.columns == columns

    def good(text):
        n_words, _, symbols, dup, repeated, n_lines = measures(text)
        return not (
            n_words < 20 or 100 * repeated > 30 * n_words
            or symbols > 2 and 10 * symbols > n_words or dup > 1 and 100 * dup > 30 * n_lines
        )

    rows = {i: t for i, t in rows.items() if good(t)}
    assert {i: r.text for i, r in kept.items()} == rows

    df, left = after("line dedup", df)
    wanted = without_repeated_runs(rows.items(), 50)
    rows = {i: t for i, (t, _, gone) in wanted.items() if not gone or t.translate(dict.fromkeys(map(ord, quality_rules.BLANKS)))}
    assert df.columns == columns and {i: r.text for i, r in left.items()} == rows
    assert all(r.n_chars == len(r.text) for r in left.values())

    df, single = after("near-duplicates", df)
    prints = {i: expected_fingerprint(t) for i, t in rows.items()}
    near = [(i, j) for i in prints for j in prints if i < j and (prints[i] ^ prints[j]).bit_count() <= 2]
    rows = {i: t for i, t in rows.items() if roots(prints, near)[i] == i}
    assert df.columns == columns and {i: r.text for i, r in single.items()} == rows

    df, hidden = after("private values", df)
    assert df.columns == columns and set(hidden) == set(rows)
    shape = lambda t: "".join("9" if c.isdigit() else "a" if c.isalpha() else c for c in t)
    changed = [i for i in rows if hidden[i].text != rows[i]]
    assert changed and all("@" in rows[i] or shape(rows[i]) != rows[i] for i in changed)

    tokens = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    packed = stages["packing"](spark, df, SMALL).collect()
    sizes = {i: len(tokens.encode(r.text, add_special_tokens=False).ids) + 1 for i, r in hidden.items()}
    assert {i: sum(r.length for r in packed if r.doc_id == i) for i in sizes} == sizes
    assert len({r.sequence_id for r in packed}) <= sum(sizes.values()) / 2048 + 2


def test_run_gives_the_pieces_of_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SMALL)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.count() > 0
