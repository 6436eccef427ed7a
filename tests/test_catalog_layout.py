from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostrata.operators import gold, governance, layout, quality, silver, views
from aerostrata.plans import pipeline, registry
from aerostrata.schemas import FLIGHTS_RAW, Layers
from aerostrata.sources import bronze, catalog, derived
from tests.conftest import DATA, SMALL
from tests.test_gold_insights import same


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """A whole environment, stored with clustered Silver tables."""
    layers = Layers(env="built")
    catalog.create_databases(spark, layers, str(tmp_path_factory.mktemp("built")))
    pipeline.run(
        derived.flights_raw(spark, SMALL),
        derived.customer_raw(spark, SMALL),
        layers,
        flight_files=4,
        customer_files=2,
    )
    return layers


@pytest.fixture
def scratch(spark, tmp_path):
    layers = Layers(env=f"t{abs(hash(str(tmp_path)))}")
    catalog.create_databases(spark, layers, str(tmp_path))
    return layers


def test_default_names():
    layers = Layers()
    assert layers.databases == ["dev_air_raw", "dev_air_silver", "dev_air_mart", "dev_air_meta"]
    assert [t for _, t in layers.by_layer()][-1] == "dev_air_meta.pii_detection_result"


def test_creating_databases_twice_is_harmless(spark, scratch):
    catalog.create_databases(spark, scratch)
    assert all(spark.catalog.databaseExists(name) for name in scratch.databases)


def test_overwrite_may_change_the_schema(spark, scratch):
    table = f"{scratch.raw}.t"
    catalog.replace_table(spark.range(3), table)
    found = catalog.replace_table(spark.range(2).select(F.col("id").cast("string").alias("name")), table)
    assert found.columns == ["name"] and found.count() == 2


def test_row_replacement_keeps_the_schema(spark, scratch):
    table = f"{scratch.meta}.t"
    catalog.replace_rows(spark.range(3), table)
    assert catalog.replace_rows(spark.range(5), table).count() == 5
    with pytest.raises(ValueError, match="would change"):
        catalog.replace_rows(spark.range(1).select(F.col("id").cast("int").alias("id")), table)
    with pytest.raises(ValueError, match="would change"):
        catalog.replace_rows(spark.range(1).toDF("other"), table)
    assert spark.table(table).count() == 5


def test_missing_tables_are_counted_as_null(spark, scratch):
    catalog.replace_table(spark.range(3), scratch.flights_raw)
    rows = {r.table_name: r.row_count for r in quality.layer_row_counts(spark, scratch).collect()}
    assert len(rows) == 8 and rows.pop("flights_raw") == 3
    assert set(rows.values()) == {None}
    assert catalog.table_or_none(spark, scratch.customer_raw) is None


def test_preview_is_a_top_n(spark):
    df = spark.range(100).select((100 - F.col("id")).alias("n"))
    shown = catalog.preview(df, 3, "n")
    assert [r.n for r in shown.collect()] == [1, 2, 3]


def test_stored_layers(spark, built):
    rows = {r.table_name: r.row_count for r in quality.layer_row_counts(spark, built).collect()}
    assert rows == {
        "flights_raw": 6000,
        "customer_raw": 150,
        "flights_silver": 5982,
        "customer_silver": 150,
        "flight_delay_kpi": 8,
        "route_performance": 220,
        "customer_segment_stats": 67,
        "pii_detection_result": 150,
    }


def test_views_equal_the_operators(spark, built):
    flights, customers = spark.table(built.flights_silver), spark.table(built.customer_silver)
    routes = views.airline_route_analysis(gold.leg_rollup(flights))
    assert same(spark.table(built.airline_route_analysis).select(routes.columns), routes)
    detail = views.customer_segment_detail(gold.customer_segment_stats(customers))
    assert same(spark.table(built.customer_segment_detail).select(detail.columns), detail)
    masked = governance.masked_customers(customers)
    assert same(spark.table(built.customer_masked_view).select(masked.columns), masked)


def test_pipeline_can_run_again(spark, built):
    pipeline.build_gold(spark, built)
    pipeline.detect_personal_data(spark, built)
    pipeline.publish_views(spark, built)
    assert spark.table(built.pii_detection_result).count() == 150


def test_shared_folder_comes_from_the_session():
    def a_session(master, **settings):
        conf = SimpleNamespace(get=lambda name, default: settings.get(name.replace(".", "_"), default))
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    named = a_session("yarn", spark_checkpoint_dir="hdfs:///shared/work/")
    assert catalog.shared_folder(named) == "hdfs:///shared/work"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        catalog.shared_folder(a_session("yarn"))
    own = catalog.shared_folder(a_session("local[2]"))
    assert own == catalog.shared_folder(a_session("local[*]")) and "aerostrata-" in own


def hit_files(spark, path: str, column: str) -> float:
    """Mean number of files whose value range covers a value of the column."""
    ranges = (
        spark.read.parquet(path)
        .groupBy(F.input_file_name().alias("file"))
        .agg(F.min(column).alias("low"), F.max(column).alias("high"))
    )
    values = spark.read.parquet(path).select(F.col(column).alias("v")).distinct()
    hits = values.join(ranges, F.col("v").between(F.col("low"), F.col("high"))).groupBy("v").count()
    return hits.agg(F.avg("count")).first()[0]


def test_clustering_narrows_every_column(spark, tmp_path):
    flights = silver.flights(derived.flights_raw(spark, DATA))
    flights.repartition(16).write.parquet(f"{tmp_path}/plain")
    layout.z_ordered(flights, layout.FLIGHT_CLUSTERING, files=16).write.parquet(f"{tmp_path}/z")
    for column in layout.FLIGHT_CLUSTERING:
        assert hit_files(spark, f"{tmp_path}/plain", column) > 15
        assert hit_files(spark, f"{tmp_path}/z", column) < 8
    stored, source = spark.read.parquet(f"{tmp_path}/z"), flights.drop("transformation_timestamp")
    assert same(stored.select(source.columns), source)


def test_stored_table_can_be_clustered_later(spark, scratch):
    raw = catalog.replace_table(derived.flights_raw(spark, SMALL), scratch.flights_raw)
    before = catalog.replace_table(raw, f"{scratch.raw}.copy")
    for _ in range(2):
        layout.recluster(spark, scratch.flights_raw, ["flight_date", "airline"], files=4)
    after = spark.table(scratch.flights_raw)
    assert after.schema == before.schema and same(after, before)
    assert len(after.inputFiles()) == 4
    assert not spark.catalog.tableExists(f"{scratch.flights_raw}_clustered")


def test_clustering_splits_a_frequent_value(spark):
    """Nine tenths of the rows are copies of one row; no file may take them all."""
    rows = spark.range(0, 100_000, numPartitions=8).select(
        F.when(F.col("id") % 10 > 0, "UK").otherwise(F.concat(F.lit("C"), F.col("id") % 70)).alias("country"),
        F.when(F.col("id") % 10 > 0, "Economy").alias("segment"),
    )
    laid_out = layout.z_ordered(rows, layout.CUSTOMER_CLUSTERING, files=10)
    sizes = laid_out.groupBy(F.spark_partition_id().alias("p")).count()
    assert sizes.agg(F.max("count")).first()[0] < 20_000
    assert laid_out.columns == rows.columns
    assert same(laid_out.groupBy("country", "segment").count(), rows.groupBy("country", "segment").count())


@pytest.mark.parametrize("bits", [None, 3])
def test_clustering_by_three_columns_with_many_values(spark, tmp_path, bits):
    rows = spark.range(20_000).select(
        "id", (F.col("id") % 40).cast("string").alias("a"), F.col("id").cast("string").alias("b"),
        (F.col("id") * 7919 % 20_000).alias("c"),
    )
    rows.write.parquet(f"{tmp_path}/rows")
    stored = spark.read.parquet(f"{tmp_path}/rows")
    laid_out = layout.z_ordered(stored, ["a", "b", "c"], files=8, bits=bits)
    assert laid_out.rdd.getNumPartitions() == 8 and same(laid_out, rows)
    laid_out.write.parquet(f"{tmp_path}/z")
    assert hit_files(spark, f"{tmp_path}/z", "b") < 7 and hit_files(spark, f"{tmp_path}/z", "c") < 7


def test_too_many_cells_are_refused(spark):
    with pytest.raises(ValueError, match="cells"):
        layout.z_ordered(spark.range(3), ["id"], bits=21)


def test_bounds_cut_values_into_even_ranges(spark):
    many = spark.range(1000).select((F.col("id") * 3).alias("v"))
    bounds = layout._bounds(many, "v", 4)
    assert 8 <= len(bounds) <= 16 and bounds == sorted(bounds) and bounds[0] == 0
    codes = {r[0]: r[1] for r in many.select("v", layout._code("v", bounds, 4)).collect()}
    assert [codes[v] for v in sorted(codes)] == sorted(codes.values()) and max(codes.values()) >= 14
    assert layout._bounds(many.limit(5), "v", 4) == sorted(r[0] for r in many.limit(5).collect())


def test_clustering_reads_its_input_twice_and_shuffles_rows_once(spark, tmp_path):
    flights = silver.flights(derived.flights_raw(spark, SMALL)).drop("transformation_timestamp")
    flights.write.parquet(f"{tmp_path}/flights")
    stored = spark.read.parquet(f"{tmp_path}/flights")
    laid_out = layout.z_ordered(stored, layout.FLIGHT_CLUSTERING, files=4)
    plan = laid_out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # the rows, and the stored tuples of the other pass
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_bronze_is_enforced(spark, scratch, make_flights, make_customers):
    flights = make_flights({}).withColumn("distance", F.lit("500")).withColumn("extra", F.lit(1))
    pipeline.load_bronze(flights, make_customers({}), scratch)
    assert spark.table(scratch.flights_raw).schema == FLIGHTS_RAW
    with pytest.raises(Exception, match="distance"):
        pipeline.load_bronze(make_flights({}).drop("distance"), make_customers({}), scratch)
    wrong = make_flights({}).withColumn("distance", F.lit("far"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        pipeline.load_bronze(wrong, make_customers({}), scratch)


def test_reading_a_missing_column_fails(spark):
    schema = T.StructType.fromDDL("c_custkey bigint, no_such string")
    with pytest.raises(ValueError, match="no_such"):
        bronze.read_table(spark, f"{SMALL}/customer.parquet", schema)
    surplus = bronze.read_table(spark, f"{SMALL}/customer.parquet", T.StructType.fromDDL("c_custkey bigint"))
    assert surplus.columns == ["c_custkey"]


def test_scratch_tables_of_calls_are_apart(spark):
    """A frame of an earlier call still reads its own rows after a later one."""
    query = registry.queries()["table_overwrite_roundtrip"]
    first = query(spark, SMALL)
    second = query(spark, DATA)
    assert first.count() == 6000 < second.count()
    layers = catalog.scratch_layers(spark)
    catalog.replace_table(spark.range(2), layers.flights_raw)
    catalog.drop_databases(spark, layers)
    assert not spark.catalog.databaseExists(layers.raw)


def test_a_month_range_reads_its_folders_only(spark):
    found = registry.queries()["silver_flights_by_month"](spark, SMALL)
    found = found.where(F.col("flight_month").between("1995-03", "1995-08"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "flight_month" in filters


def test_the_route_view_does_not_read_flights(spark, built):
    plan = spark.table(built.airline_route_analysis)._jdf.queryExecution().executedPlan().toString()
    assert "flight_legs" in plan and "flights_silver" not in plan


def test_clustered_files_are_even(spark):
    flights = silver.flights(derived.flights_raw(spark, DATA))
    laid_out = layout.z_ordered(flights, layout.FLIGHT_CLUSTERING, files=16)
    sizes = [r["count"] for r in laid_out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.1 * min(sizes)


def test_clustering_of_empty_and_constant_columns(spark):
    rows = spark.range(10).select(F.lit("x").alias("a"), F.lit(None).cast("string").alias("b"))
    assert layout.z_ordered(rows, ["a", "b"], files=2).count() == 10
    assert layout.z_ordered(rows.limit(0), ["a", "b"], files=2).count() == 0
