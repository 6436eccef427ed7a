"""Multi-column clustering of stored files."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerostrata.sources import files as stored_files
from aerostrata.sources import replacing
from aerostrata.sources.catalog import shared_folder

FLIGHT_CLUSTERING = ["flight_date", "airline_code"]
CUSTOMER_CLUSTERING = ["country", "segment"]
ROWS_PER_FILE = 4_000_000
TARGET_BYTES = 128 << 20
#: Partitions that one job puts together, each with a scan of its own.
PARTITIONS_AT_ONCE = 100

#: Cells of the z-curve have this many bits in all unless told otherwise, and at most.
CELL_BITS, MOST_CELL_BITS = 16, 20


def _bounds(tuples: DataFrame, column: str, bits: int) -> list:
    """The smallest values of at most ``2 ** bits`` ranges of a column, in order.

    Few different values are their own ranges; more of them are cut into even ranges by
    range partitioning, of which only the smallest values come back.
    """
    most = 1 << bits
    values = tuples.select(column).where(F.col(column).isNotNull()).distinct()
    first = [r[0] for r in values.orderBy(column).limit(most + 1).collect()]
    if len(first) <= most:
        return first
    parts = values.repartitionByRange(most, column).groupBy(F.spark_partition_id())
    return sorted(r[0] for r in parts.agg(F.min(column).alias("low")).select("low").collect())


def _code(column: str, bounds: list, bits: int) -> Column:
    """The range of a value, stretched to ``bits`` bits; NULL and no bounds give zero.

    A value is compared with every ``step``-th bound and then with those in between.
    """
    if not bounds:
        return F.lit(0).cast("bigint")
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    literals = lambda values: F.array(*[F.lit(v) for v in values])
    reached = lambda values: F.size(F.filter(values, lambda b: b <= F.col(column)))
    group = reached(literals([g[0] for g in groups])) - 1
    inner = F.get(F.array(*[literals(g) for g in groups]), group)
    number = group * step + reached(inner) - 1
    code = F.floor(number * F.lit(1 << bits) / F.lit(len(bounds))).cast("bigint")
    return F.coalesce(code, F.lit(0).cast("bigint"))


def _interleaved(codes: list[Column], bits: int) -> Column:
    """One number from the bits of all codes, taken in turn from the highest."""
    picked = [
        F.shiftleft(
            F.shiftright(code, bit).bitwiseAND(1), bit * len(codes) + len(codes) - 1 - position
        )
        for bit in range(bits)
        for position, code in enumerate(codes)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), picked)


def z_ordered(
    df: DataFrame,
    columns: list[str],
    files: int | None = None,
    bits: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> DataFrame:
    """The same rows, laid out so that each given column has narrow file ranges.

    The input is read twice.  The first pass folds it to the different tuples of the
    given columns with their counts, which are stored; they give the ranges of each
    column, the rows of each cell of the z-curve and the number of files.  The second
    numbers the rows along the curve and cuts them into even files: a cell that covers
    much of the table is spread over its stretch by read position, so it is cut
    over as many tasks as it fills.  Full rows are shuffled once, by file.

    ``df`` must be a stored table, with projections and filters at most: there the read
    position is the same when a task is run again.  There are at most ``2 ** 20`` cells,
    whatever the number of columns and the data, so their table is broadcast.
    """
    bits = bits or max(1, CELL_BITS // len(columns))
    if bits * len(columns) > MOST_CELL_BITS:
        raise ValueError(f"{len(columns)} columns of {bits} bits make more than 2**{MOST_CELL_BITS} cells")
    spark, original = df.sparkSession, df.columns
    path = f"{shared_folder(spark)}/clustering-{uuid.uuid4().hex}"
    counted = df.groupBy(*columns).agg(F.count("*").alias("_rows"))
    counted.write.parquet(path)
    tuples = spark.read.schema(counted.schema).parquet(path)
    codes = [_code(c, _bounds(tuples, c, bits), bits) for c in columns]
    z = _interleaved(codes, bits)

    curve = Window.orderBy("_cell")
    before = curve.rowsBetween(Window.unboundedPreceding, -1)
    whole = curve.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cells = tuples.groupBy(z.alias("_cell")).agg(F.sum("_rows").alias("_rows"))
    cells = cells.select(
        "_cell",
        "_rows",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        F.sum("_rows").over(whole).alias("_total"),
    )
    total = tuples.agg(F.sum("_rows")).first()[0] or 0
    files = files or total // rows_per_file + 1

    spread = F.xxhash64("_position")
    place = (F.col("_start") + F.pmod(spread, F.col("_rows"))) / F.col("_total")
    return (
        df.withColumn("_position", F.monotonically_increasing_id())
        .withColumn("_z", z)
        .join(F.broadcast(cells), F.col("_z") == F.col("_cell"))
        .withColumn("_file", F.least(F.floor(place * files), F.lit(files - 1)).cast("int"))
        .repartitionById(files, "_file")
        .sortWithinPartitions("_z")
        .select(*original)
    )


def write_clustered(
    df: DataFrame,
    table: str,
    columns: list[str],
    files: int | None = None,
    partition_by: list[str] | None = None,
    metrics: dict[str, Column] | None = None,
) -> dict:
    """Store the rows as a managed table with clustered files, replacing the old one safely.

    Gives the number of rows and the values of ``metrics``, taken by the writing job.
    """
    return replacing.replace(z_ordered(df, columns, files), table, partition_by, metrics)


def recluster(spark: SparkSession, table: str, columns: list[str], files: int | None = None) -> None:
    """Rewrite a stored table clustered; its rows and schema stay the same.

    A failure at any point leaves the old or the new rows under the table's name, or is mended
    by ``replacing.recover``.
    """
    replacing.recover(spark, table)
    stored_files.recover(spark, table)
    by = stored_files.partition_columns(spark, table)
    write_clustered(spark.table(table), table, columns, files, by)


def _packed_scan(target_bytes: int) -> dict[str, str]:
    """Settings under which a scan puts whole files together up to a size, and a task writes them without sorting."""
    return {
        "spark.sql.files.maxPartitionBytes": f"{target_bytes}b",
        "spark.sql.files.openCostInBytes": "0b",
        "spark.sql.files.minPartitionNum": "1",
        "spark.sql.maxConcurrentOutputFileWriters": "8",
    }


def compact(spark: SparkSession, table: str, target_bytes: int = TARGET_BYTES) -> bool:
    """Rewrite the small files of a stored table as few of about ``target_bytes``.

    Files of at least half that size are neither read nor touched, nor is one that is the only small one of
    its partition.  Rows are not shuffled: the scan of each partition puts whole small files together up to the target and each
    of its tasks writes one file.  So no task reads more than ``target_bytes``, however far the rows unfold in
    memory.  Each rewrite takes up to ``PARTITIONS_AT_ONCE`` partitions.  Says whether anything was rewritten.
    """
    stored_files.recover(spark, table)
    small = F.col(stored_files.SIZE) < target_bytes // 2
    by = [F.col(c).cast("string").alias(f"_{i}") for i, c in enumerate(stored_files.partition_columns(spark, table))]
    listed = spark.table(table).where(small).select(*by, F.col(stored_files.FILE).alias("_file")).distinct()
    many = listed.groupBy(*[f"_{i}" for i in range(len(by))]).agg(F.count("*").alias("_files")).where("_files > 1")
    # a row per partition, as the driver lists them for any scan
    partitions = [tuple(r) for r in many.drop("_files").collect()]
    inside = [
        reduce(and_, [column.eqNullSafe(F.lit(v)) for column, v in zip(by, values, strict=True)], F.lit(True))
        for values in partitions
    ]
    for i in range(0, len(inside), PARTITIONS_AT_ONCE):
        some = inside[i : i + PARTITIONS_AT_ONCE]
        packed = lambda rows, some=some: reduce(DataFrame.unionAll, [rows.where(p) for p in some])
        stored_files.rewrite(spark, table, small & reduce(or_, some), packed, _packed_scan(target_bytes))
    return bool(inside)


def depths(ranges: DataFrame) -> DataFrame:
    """How many files can hold a value, at every value where a file's range begins.

    ``ranges`` has ``file``, ``column_name``, ``low`` and ``high``.  A sweep over the ends of the ranges, of which
    there are two a file: ranges that begin up to a value less those that ended before it.
    """
    ends = F.explode(
        F.array(
            F.struct(F.col("low").alias("value"), F.lit(1).alias("begun"), F.lit(0).alias("ended")),
            F.struct(F.col("high").alias("value"), F.lit(0).alias("begun"), F.lit(1).alias("ended")),
        )
    )
    steps = ranges.select("column_name", ends.alias("e")).groupBy("column_name", "e.value")
    steps = steps.agg(F.sum("e.begun").alias("begun"), F.sum("e.ended").alias("ended"))
    so_far = Window.partitionBy("column_name").orderBy("value")
    before = so_far.rowsBetween(Window.unboundedPreceding, -1)
    depth = F.sum("begun").over(so_far) - F.coalesce(F.sum("ended").over(before), F.lit(0))
    return steps.select("column_name", "value", "begun", depth.cast("long").alias("depth"))


def clustering_depth(ranges: DataFrame) -> DataFrame:
    """Per column: files, greatest and mean number of files that a range's first value falls into, and overlaps.

    ``overlapping_pairs`` counts the pairs of files whose ranges meet: each of them is found at the
    later of the two beginnings.
    """
    swept = depths(ranges)
    begun, depth = F.col("begun"), F.col("depth")
    # ranges that begin at one value meet each other and those that are open already
    pairs = begun * (depth - begun) + begun * (begun - 1) / 2
    return swept.groupBy("column_name").agg(
        F.sum("begun").alias("files"),
        F.max("depth").alias("max_depth"),
        F.round(F.sum(begun * depth) / F.sum("begun"), 4).alias("mean_depth"),
        F.sum(pairs).cast("long").alias("overlapping_pairs"),
    )


def deep_files(ranges: DataFrame, most: int) -> DataFrame:
    """Files that can hold a value which more than ``most`` files can hold.

    They must do so in every column that has such values; where no column has any, no file is deep.
    """
    deep = depths(ranges).where(F.col("depth") > most).select("column_name", "value")
    columns = [r.column_name for r in deep.select("column_name").distinct().collect()]  # clustering columns
    no_file = F.lit(None).cast("string").alias("file")
    point = lambda df, file, value, order, n: df.select(
        "column_name", file, F.col(value).alias("value"), F.lit(order).alias("order"), F.lit(n).alias("n")
    )
    # at one value: ranges begin, deep values are counted, ranges end
    points = point(deep, no_file, "value", 1, 1)
    points = points.unionByName(point(ranges, F.col("file"), "low", 0, 0))
    points = points.unionByName(point(ranges, F.col("file"), "high", 2, 0))
    so_far = Window.partitionBy("column_name").orderBy("value", "order")
    counted = points.withColumn("deep", F.sum("n").over(so_far)).where("file IS NOT NULL")
    inside = counted.groupBy("file", "column_name").agg((F.max("deep") - F.min("deep")).alias("inside"))
    return (
        inside.where(F.col("column_name").isin(columns) & (F.col("inside") > 0))
        .groupBy("file")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") == len(columns))
        .select("file")
    )


def recluster_deep(
    spark: SparkSession, table: str, columns: list[str], most: int, at_once: int = 1000, files: int | None = None
) -> int:
    """Cluster only the files that overlap most, and give how many were rewritten.

    After an insert of rows that spread over few values only the files of these values and the new ones
    are read.  At most ``at_once`` files are taken in one call, the first by name; a further
    call takes the next.
    """
    stored_files.recover(spark, table)
    found = stored_files.ranges(spark.table(table), columns)
    chosen = [r.file for r in deep_files(found, most).orderBy("file").limit(at_once).collect()]
    if len(chosen) > 1:
        wanted = F.col(stored_files.FILE).isin(chosen)
        stored_files.rewrite(spark, table, wanted, lambda rows: z_ordered(rows, columns, files or len(chosen)))
    return len(chosen) if len(chosen) > 1 else 0
