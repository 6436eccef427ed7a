"""Replacing tables and rewriting some of their files, cut short at every step."""

from __future__ import annotations

import hashlib
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from aerostrata.operators import layout, silver
from aerostrata.schemas import Layers
from aerostrata.sources import catalog, derived, files, replacing
from tests.conftest import SMALL
from tests.test_gold_insights import same


@pytest.fixture
def table(spark, tmp_path):
    layers = Layers(env=f"r{abs(hash(str(tmp_path)))}")
    catalog.create_databases(spark, layers, str(tmp_path))
    yield f"{layers.silver}.t"
    catalog.drop_databases(spark, layers)


def ids(spark, table):
    return sorted(r[0] for r in spark.table(table).select("id").collect())


def names(spark, table):
    return [n for n in (table, replacing.staged_name(table), replacing.old_name(table)) if spark.catalog.tableExists(n)]


class Ended(Exception):
    """The run ends here."""


def test_rows_are_counted_by_the_write(spark, table):
    metrics = {"least": F.min("id"), "even": F.count_if(F.col("id") % 2 == 0)}
    assert replacing.replace(spark.range(1, 8), table, metrics=metrics) == {"rows": 7, "least": 1, "even": 3}
    assert replacing.replace(spark.range(0), table) == {"rows": 0}
    assert names(spark, table) == [table] and ids(spark, table) == []


def test_a_table_can_be_replaced_from_itself(spark, table):
    catalog.replace_table(spark.range(10), table)
    catalog.replace_table(spark.table(table).where("id > 6"), table)
    assert ids(spark, table) == [7, 8, 9]


def test_partitions_move_with_their_table(spark, table):
    for n in (9, 12):
        catalog.replace_table(spark.range(n).withColumn("p", F.col("id") % 3), table, ["p"])
        assert ids(spark, table) == list(range(n)) and spark.table(table).where("p = 1").count() == n // 3
    assert files.partition_columns(spark, table) == ["p"]


def test_a_write_that_fails_midway_keeps_the_old_rows(spark, table):
    catalog.replace_table(spark.range(5), table)
    bad = spark.range(0, 100, 1, 4).select(F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("id"))
    with pytest.raises(Exception, match="no"):
        catalog.replace_table(bad, table)
    assert ids(spark, table) == list(range(5))
    catalog.replace_table(spark.range(2), table)
    assert ids(spark, table) == [0, 1] and names(spark, table) == [table]


def test_a_staged_table_with_other_rows_is_refused(spark, table):
    catalog.replace_table(spark.range(5), table)
    spark.range(3).write.saveAsTable(replacing.staged_name(table))
    with pytest.raises(ValueError, match="3 rows of 4"):
        replacing.check(spark, replacing.staged_name(table), spark.range(3), 4)
    spark.range(3).write.saveAsTable(replacing.staged_name(table))
    with pytest.raises(ValueError, match="3 rows of 3"):
        replacing.check(spark, replacing.staged_name(table), spark.range(3).toDF("x"), 3)
    assert names(spark, table) == [table] and ids(spark, table) == list(range(5))


@pytest.mark.parametrize(("step", "rows", "told"), [(0, 5, "undone"), (1, 7, "finished"), (2, 7, "finished")])
def test_a_swap_cut_short_is_mended(spark, table, monkeypatch, step, rows, told):
    """It ends before the first renaming, between both, or before the old table is dropped."""
    catalog.replace_table(spark.range(5), table)
    done, rename = [], replacing._rename

    def until(spark_, *names_):
        if len(done) == step:
            raise Ended
        done.append(names_)
        rename(spark_, *names_)
        if len(done) == step == 2:
            raise Ended

    with monkeypatch.context() as m:
        m.setattr(replacing, "_rename", until)
        with pytest.raises(Ended):
            catalog.replace_table(spark.range(7), table)
    assert replacing.recover(spark, table) == told
    assert ids(spark, table) == list(range(rows)) and names(spark, table) == [table]
    assert replacing.recover(spark, table) == "kept"


def test_what_other_ends_leave_behind(spark, table):
    """A first write that was not checked; a lost staged table; a recovery cut short before another write."""
    spark.range(3).write.saveAsTable(replacing.staged_name(table))
    assert replacing.recover(spark, table) == "undone" and names(spark, table) == []
    spark.range(4).write.saveAsTable(replacing.old_name(table))
    assert replacing.recover(spark, table) == "undone" and ids(spark, table) == [0, 1, 2, 3]
    spark.range(1).write.saveAsTable(replacing.staged_name(table))
    spark.range(2).write.saveAsTable(replacing.old_name(table))
    assert replacing.recover(spark, table) == "undone" and names(spark, table) == [table]


def test_reclustering_starts_by_mending(spark, table):
    catalog.replace_table(spark.range(9), table)
    spark.sql(f"ALTER TABLE {table} RENAME TO {replacing.old_name(table)}")
    layout.recluster(spark, table, ["id"], files=2)
    assert ids(spark, table) == list(range(9)) and len(spark.table(table).inputFiles()) == 2


def on_disk(spark, table):
    """Hash of every data file by name."""
    found = {}
    for url in spark.table(table).inputFiles():
        path = Path(urlparse(url).path)
        found[path.name] = hashlib.sha256(path.read_bytes()).hexdigest()
    return found


def with_small_files(spark, table, small):
    """One large file, and ``small`` files of a few rows."""
    catalog.replace_table(spark.range(0, 200_000, 1, 1).withColumn("v", F.sha2(F.col("id").cast("string"), 256)), table)
    large = on_disk(spark, table)
    added = spark.range(200_000, 200_000 + small * 20, 1, small).withColumn("v", F.lit("x"))
    added.write.mode("append").format("parquet").saveAsTable(table)
    return large


def test_small_files_become_few_and_large_ones_stay(spark, table):
    large = with_small_files(spark, table, 1000)
    before = spark.table(table).agg(F.count("*"), F.bit_xor(F.xxhash64("id", "v"))).first()
    sizes = {r.file: r.size for r in files.files(spark.table(table)).collect()}
    assert len(sizes) == 1001
    target = sum(sorted(sizes.values())[:-1]) // 5
    assert target < 2 * max(sizes.values())
    assert layout.compact(spark, table, target)
    after = on_disk(spark, table)
    assert large.items() <= after.items() and 5 <= len(after) - 1 <= 7
    rows = sorted(r.rows for r in files.files(spark.table(table)).collect())
    assert rows[-1] == 200_000 and rows[-2] <= 1.1 * rows[1]
    assert spark.table(table).agg(F.count("*"), F.bit_xor(F.xxhash64("id", "v"))).first() == before
    assert not layout.compact(spark, table, 1)


def test_compaction_keeps_partitions(spark, table):
    rows = spark.range(0, 600, 1, 30).withColumn("p", F.col("id") % 3)
    catalog.replace_table(rows, table, ["p"])
    assert len(spark.table(table).inputFiles()) == 90
    assert layout.compact(spark, table)
    assert len(spark.table(table).inputFiles()) == 3 and ids(spark, table) == list(range(600))
    assert spark.table(table).where("p = 2").count() == 200


def test_compaction_reads_no_more_than_the_target_in_a_task(spark, table, monkeypatch):
    """Rows that take thousands of times their stored size in memory are not shuffled; a lone small file stays."""
    p = F.when(F.col("id") % 4 < 3, F.concat(F.lit("a/'"), (F.col("id") % 4).cast("string")))
    rows = spark.range(0, 4000, 1, 10).select("id", F.repeat(F.lit("x"), 10_000).alias("v"), F.col("id").cast("double").alias("w"), p.alias("p"))
    lone = spark.range(1).select("id", F.lit("y").alias("v"), F.lit(0.5).alias("w"), F.lit("lone").alias("p"))
    catalog.replace_table(rows.unionByName(lone), table, ["p"])
    sums = lambda: spark.table(table).groupBy("p").agg(F.count("*"), F.bit_xor(F.xxhash64("id", "v", "w"))).orderBy("p").collect()
    before, sizes = sums(), [r["size"] for r in files.files(spark.table(table)).collect()]
    assert len(sizes) == 41
    lone_file = lambda: [r.file for r in files.files(spark.table(table).where("p = 'lone'")).collect()]
    kept = lone_file()
    plans, stage, settings = [], files.stage, spark.conf.getAll

    def seen(spark, table, chosen, laid_out, *more):
        def planned(rows):
            out = laid_out(rows)
            plans.append(out._jdf.queryExecution().executedPlan().toString())
            return out

        return stage(spark, table, chosen, planned, *more)

    monkeypatch.setattr(files, "stage", seen)
    monkeypatch.setattr(layout, "PARTITIONS_AT_ONCE", 3)
    assert layout.compact(spark, table, 4 * max(sizes) + 100)
    assert len(plans) == 2 and not any("Exchange" in plan for plan in plans)
    assert sums() == before and spark.conf.getAll == settings
    found = files.files(spark.table(table)).collect()
    assert 4 * 3 <= len(found) - 1 <= 4 * 5 and lone_file() == kept
    assert max(r.rows for r in found) <= 500


@pytest.mark.parametrize("step", ["before the marker", "marked", "half moved", "half deleted"])
def test_a_rewrite_cut_short_is_mended(spark, table, monkeypatch, step):
    catalog.replace_table(spark.range(0, 100, 1, 8), table)
    before = on_disk(spark, table)
    moved, deleted = files.Folder.move, files.Folder.delete_file
    calls = []

    def counted(method, most):
        def run(*args):
            if len(calls) == most:
                raise Ended
            calls.append(args)
            return method(*args)

        return run

    def end(*_):
        raise Ended

    with monkeypatch.context() as m:
        if step == "before the marker":
            m.setattr(files.Folder, "mark", end)
        elif step == "marked":
            m.setattr(files, "_finish", end)
        elif step == "half moved":
            m.setattr(files.Folder, "move", counted(moved, 1))
        else:
            m.setattr(files.Folder, "delete_file", counted(deleted, 3))
        with pytest.raises(Ended):
            files.rewrite(spark, table, F.col(files.SIZE) > 0, lambda rows: rows.repartition(2))
    spark.catalog.refreshTable(table)
    assert set(ids(spark, table)) == set(range(100))  # nothing is missing at any time
    assert files.recover(spark, table) == (step != "before the marker")
    assert ids(spark, table) == list(range(100))
    assert on_disk(spark, table) == before if step == "before the marker" else len(on_disk(spark, table)) == 2
    assert files.recover(spark, table) == 0


def test_a_rewrite_that_loses_rows_is_refused(spark, table):
    catalog.replace_table(spark.range(0, 100, 1, 4), table)
    with pytest.raises(ValueError, match="99 rows were written for 100"):
        files.rewrite(spark, table, F.col(files.SIZE) > 0, lambda rows: rows.where("id > 0"))
    assert ids(spark, table) == list(range(100)) and files.recover(spark, table) == 0


def brute_depth(ranges, value):
    return sum(low <= value <= high for _, low, high in ranges)


def test_depth_against_counting(spark):
    import random

    draw = random.Random(2)
    for n in (1, 2, 40):
        ranges = []
        for i in range(n):
            low, high = sorted((draw.randint(10, 40), draw.randint(10, 40)))
            ranges.append((f"f{i}", str(low), str(high)))
        frame = spark.createDataFrame([("c", *r) for r in ranges], "column_name string, file string, low string, high string")
        found = {r.value: r.depth for r in layout.depths(frame).where("begun > 0").collect()}
        assert found == {low: brute_depth(ranges, low) for _, low, _ in ranges}
        row = layout.clustering_depth(frame).first()
        pairs = sum(a[1] <= b[2] and b[1] <= a[2] for i, a in enumerate(ranges) for b in ranges[:i])
        assert (row.files, row.max_depth, row.overlapping_pairs) == (n, max(found.values()), pairs)
        points = {v for r in ranges for v in r[1:] if brute_depth(ranges, v) > n // 2}
        wanted = {f for f, low, high in ranges if any(low <= v <= high for v in points)}
        assert {r.file for r in layout.deep_files(frame, n // 2).collect()} == wanted


def test_an_added_day_rewrites_few_files(spark, table):
    flights = silver.flights(derived.flights_raw(spark, SMALL)).drop("transformation_timestamp")
    stored = catalog.replace_table(flights, f"{table}_all")
    layout.write_clustered(stored, table, ["flight_date"], files=20)
    assert layout.recluster_deep(spark, table, ["flight_date"], most=3) == 0
    day = flights.limit(200).withColumn("flight_date", F.lit("1995-06-15")).repartition(4)
    day.write.mode("append").format("parquet").saveAsTable(table)
    before, content = on_disk(spark, table), spark.table(table)
    wanted = [tuple(r) for r in content.collect()]
    found = files.ranges(content, ["flight_date"])
    assert layout.clustering_depth(found).first().max_depth >= 5
    rewritten = layout.recluster_deep(spark, table, ["flight_date"], most=3)
    after = on_disk(spark, table)
    assert 5 <= rewritten <= 7 and len(before.items() & after.items()) == 24 - rewritten
    assert sorted(map(str, wanted)) == sorted(str(tuple(r)) for r in spark.table(table).collect())
    left = files.ranges(spark.table(table), ["flight_date"])
    assert layout.clustering_depth(left).first().max_depth <= rewritten
    assert same(spark.table(f"{table}_all"), stored)
