"""Reading, upserting and refreshing the partitioned Parquet tables.

An upsert reads and rewrites only the storage partitions its batch touches:

1. the batch, reduced to one row per key, is written to a staging table next to the
   target.  That cuts its lineage: neither a lost executor nor the second read below
   recomputes it, and a replay starts from the same rows;
2. the few partition values it contains (one per month or year) are listed and used as
   a static partition filter on the target;
3. target partitions and batch are joined on the key (full outer) and written to a new version
   folder, which the table's pointer then names (see :mod:`barlake.storage.versions`).  A write that breaks
   off leaves the table as it was.  One writer per table at a time.

A storage partition is divided into files by ranges of keys, as many as its size asks for.  Sizes are those of
the stored files and of the staged batch, and boundaries come from the keys of both, so the merged rows
are computed once."""

from __future__ import annotations

from functools import reduce
from math import ceil
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from barlake.operators.lookups import between_days
from barlake.operators.series import dedup_first
from barlake.schemas import FLAGS, TableSpec, require_columns
from barlake.storage import versions

#: Size of a file, about.
FILE_BYTES = 128 << 20
#: Keys looked at for each boundary between two files.
KEYS_PER_FILE = 200


def init_table(spark: SparkSession, path: str, spec: TableSpec) -> None:
    """Create the table if there is nothing yet; an existing table is left alone.

    A log that is only appended to is a plain folder: appending replaces nothing."""
    if spec.append_only:
        spark.createDataFrame([], spec.stored_schema).write.mode("ignore").partitionBy(spec.partition).parquet(path)
    else:
        versions.create(spark, path)


def read_table(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Table columns plus the storage partition, as of now: later writes do not change the frame.

    Files older than a column read it as NULL; flags then count as false.  A folder of Parquet files
    without a pointer is read as it is."""
    snapshot = versions.current(spark, path)
    reader, names = spark.read, spec.stored_schema.names
    if snapshot is None:
        stored = reader.schema(spec.stored_schema).parquet(path)
    elif not snapshot.folders:
        stored = spark.createDataFrame([], spec.stored_schema)
    else:
        schema = StructType([*spec.stored_schema.fields, StructField(versions.VERSION, StringType())])
        stored = reader.schema(schema).option("basePath", path).parquet(*snapshot.paths(path)).select(*names)
    return stored.withColumns({f: F.coalesce(f, F.lit(False)) for f in FLAGS if f in spec.columns})


def rejected_path(path: str) -> str:
    """Where the rows refused by upserts into the table at ``path`` are kept."""
    return f"{path.rstrip('/')}__rejected"


def rejected_rows(spark: SparkSession, path: str) -> DataFrame:
    """``table_name``, ``reason`` and the row as JSON; empty if nothing was ever refused."""
    schema = "table_name STRING, reason STRING, row STRING"
    spark.createDataFrame([], schema).write.mode("ignore").parquet(rejected_path(path))
    return spark.read.schema(schema).parquet(rejected_path(path))


def read_bars(spark: SparkSession, path: str, spec: TableSpec, start: str, end: str) -> DataFrame:
    """A range of days, with the matching month filter for partition pruning."""
    return between_days(read_table(spark, path, spec), start, end)


def _merged_column(
    spec: TableSpec, name: str, written: set[str], keep: tuple[str, ...], in_batch: Column, in_table: Column
) -> Column:
    old, new = F.col(f"t.{name}"), F.col(f"b.{name}")
    default = F.lit(spec.insert_defaults.get(name)).cast(spec.schema[name].dataType)
    if name not in written:
        value = F.when(in_table, old).otherwise(default)
    elif name in keep:
        value = F.when(in_table, old).otherwise(new)
    else:
        value = F.when(in_batch, new).otherwise(old)
    return value.alias(name)


def merge(
    table: DataFrame, batch: DataFrame, spec: TableSpec, columns: list[str], keep: tuple[str, ...] = ()
) -> DataFrame:
    """State of ``table`` after upserting ``batch``, both with one row per key.

    ``columns`` are the non-key columns the batch writes, NULLs included; those in
    ``keep`` only into new rows.  Other columns keep their stored value; in new rows they
    take the table's default."""
    key = list(spec.key)
    t = table.withColumn("in_table", F.lit(True)).alias("t")
    b = batch.withColumn("in_batch", F.lit(True)).alias("b")
    joined = t.join(b, [F.col(f"t.{k}") == F.col(f"b.{k}") for k in key], "full_outer")
    in_table, in_batch = F.col("in_table").isNotNull(), F.col("in_batch").isNotNull()
    keys = [F.coalesce(f"t.{k}", f"b.{k}").alias(k) for k in key]
    rest = [
        _merged_column(spec, c, set(columns), keep, in_batch, in_table) for c in spec.columns if c not in key
    ]
    return joined.select(*keys, *rest).select(*spec.columns)


def upsert(
    spark: SparkSession,
    path: str,
    spec: TableSpec,
    batch: DataFrame,
    columns: list[str] | None = None,
    order: str | None = None,
    required: tuple[str, ...] = (),
    unique: bool = False,
    keep: tuple[str, ...] = (),
    count_by: str | None = None,
) -> int:
    """Insert or update by primary key; returns the number of keys written.  With ``count_by``, a key
    column, the rows written per value of it are left in :func:`written_path`.

    ``columns`` defaults to the table columns the batch has; those in ``keep`` are set on
    insert and not changed later (see :func:`merge`).  If the batch repeats a key
    the first row wins: first by ``order``, or else by a hash of the written values, so that
    the choice does not depend on how the batch is partitioned.  ``unique=True`` says that
    there is one row per key; a batch that breaks this is refused before anything is written.

    Rows with a NULL in the key never reach the table: they are added to the table of
    rejected rows (:func:`rejected_path`), with the reason; equal ones count once unless ``unique``."""
    require_columns(batch.columns, [*spec.key, *required], spec.name)
    written = [c for c in (columns or batch.columns) if c in spec.columns and c not in spec.key]
    typed = [F.col(c).cast(spec.schema[c].dataType).alias(c) for c in (*spec.key, *written)]
    unknown = reduce(or_, [F.col(k).isNull() for k in spec.key])
    if unique:
        rows = batch.select(*typed)
    else:
        values = (*spec.key, *written)
        rows = batch.select(*typed, *([F.col(order).alias("arrival")] if order else []))
        rows = rows if order else rows.withColumn("arrival", F.xxhash64(*values))
        # rows without a key are no repeats of each other: all that differ are kept, to be refused below
        rows = rows.withColumn("refused", F.when(unknown, F.to_json(F.struct(*values))))
        rows = dedup_first(rows, (*spec.key, "refused"), "arrival").drop("arrival", "refused")
    staged = _stage(spark, rows.withColumn(spec.partition, spec.partition_value()), path)

    # one row per month or year in the batch: a short list by construction
    known = unknown.alias("unknown")
    if unique:  # keys are counted only where nothing has made them single yet
        each = staged.groupBy(spec.partition, *spec.key).agg(F.count("*").alias("n"))
        counts = each.groupBy(spec.partition, known).agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect()
        if any(r["most"] > 1 and not r["unknown"] for r in counts):
            raise ValueError(f"{spec.name}: the batch repeats a key; nothing was written")
    else:
        counts = staged.groupBy(spec.partition, known).agg(F.count("*").alias("n")).collect()
    if any(r["unknown"] for r in counts):
        reason = F.lit(f"no value in the key ({', '.join(spec.key)})")
        refused = staged.filter(unknown).select(F.lit(spec.name).alias("table_name"), reason.alias("reason"), F.to_json(F.struct(*spec.key, *written)).alias("row"))
        refused.write.mode("append").parquet(rejected_path(path))
        staged = staged.filter(~unknown)
    touched = {r[spec.partition]: r["n"] for r in counts if not r["unknown"]}
    if not touched:
        if count_by:
            staged.groupBy(count_by).agg(F.count("*").alias("n_rows")).write.mode("overwrite").parquet(written_path(path))
        return 0
    before = _before(spark, path, spec)
    table = read_table(spark, path, spec).filter(F.col(spec.partition).isin(list(touched)))
    bounds = _ranges(spark, spec, staged, table, touched, versions.size_of(spark, _staging(path)), before)
    _write(spark, merge(table, staged.drop(spec.partition), spec, written, keep), path, spec, before, bounds)
    if count_by:
        counted = staged.groupBy(count_by).agg(F.count("*").alias("n_rows"))
        counted.write.mode("overwrite").parquet(written_path(path))
    return sum(touched.values())


def written_path(path: str) -> str:
    """Where an upsert with ``count_by`` leaves its rows per value."""
    return f"{path.rstrip('/')}__written"


def write_partitions(rows: DataFrame, path: str, spec: TableSpec) -> None:
    """Replace exactly the storage partitions that occur in ``rows``.

    Files hold a range of keys and are sorted, so that their statistics serve lookups by instrument."""
    spark = rows.sparkSession
    typed = rows.select(*[F.col(c).cast(spec.schema[c].dataType).alias(c) for c in spec.columns])
    staged = _stage(spark, typed.withColumn(spec.partition, spec.partition_value()), path)
    counts = staged.groupBy(spec.partition).agg(F.count("*").alias("n")).collect()
    if counts:
        before = _before(spark, path, spec)
        replaced = {r[spec.partition]: r["n"] for r in counts}
        bounds = _ranges(spark, spec, staged, None, replaced, versions.size_of(spark, _staging(path)), before)
        _write(spark, staged.drop(spec.partition), path, spec, before, bounds)


def rebuild(spark: SparkSession, path: str, spec: TableSpec, rows: DataFrame) -> DataFrame:
    """Write a table from scratch under a new path, leaving any older one in place."""
    if versions.exists(spark, path):
        raise FileExistsError(f"{path}: a rebuilt table needs a path of its own")
    init_table(spark, path, spec)
    write_partitions(rows, path, spec)
    return read_table(spark, path, spec)


def _before(spark: SparkSession, path: str, spec: TableSpec) -> versions.Snapshot:
    """The state to be changed.  A plain folder of Parquet files becomes a version, copied once."""
    snapshot = versions.current(spark, path)
    if snapshot is not None or not versions.exists(spark, path):
        return snapshot or versions.Snapshot()
    empty = versions.Snapshot()
    version = versions.version_folder(empty)
    plain = read_table(spark, path, spec)
    if not plain.isEmpty():
        rebalanced = plain.hint("rebalance", spec.partition).sortWithinPartitions(spec.partition, *spec.key)
        rebalanced.write.partitionBy(spec.partition).parquet(f"{path.rstrip('/')}/_{version}")
        versions.move(spark, f"{path.rstrip('/')}/_{version}", f"{path.rstrip('/')}/{version}")
    return versions.publish(spark, path, empty, version)


def _ranges(
    spark: SparkSession, spec: TableSpec, staged: DataFrame, table: DataFrame | None, counts: dict, staged_bytes: int, before: versions.Snapshot
) -> tuple[DataFrame, int]:
    """Per storage partition the number of its first file and the least keys of its others, and how many files there are.

    The batch's bytes are shared out by its counts; a stored partition adds those of its files."""
    of_batch = {value: staged_bytes * n / sum(counts.values()) for value, n in counts.items()}
    stored = {value: before.sizes.get(f"{spec.partition}={value}", 0) if table is not None else 0 for value in counts}
    size = {value: of_batch[value] + stored[value] for value in counts}
    if spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true":
        files = {value: max(1, ceil(b / FILE_BYTES)) for value, b in size.items()}
    else:  # a session that keeps its partitions gets that many
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        files = {value: max(1, round(parts * b / sum(size.values()))) for value, b in size.items()}
    divided = {value: n for value, n in files.items() if n > 1}
    keys: dict = {value: [] for value in counts}
    if divided:
        rows = staged.select(spec.partition, *spec.key)
        rows = rows if table is None else rows.unionByName(table.select(spec.partition, *spec.key))
        n_rows = sum(counts[value] * size[value] / of_batch[value] for value in divided)
        step = max(1, int(n_rows / (KEYS_PER_FILE * sum(divided.values()))))
        some = rows.filter(F.col(spec.partition).isin(list(divided)) & (F.pmod(F.xxhash64(*spec.key), F.lit(step)) == 0))
        for row in some.collect():  # about KEYS_PER_FILE for each file
            keys[row[spec.partition]].append(tuple(row[k] for k in spec.key))
    bounds, first = [], 0
    for value in sorted(counts):
        known = sorted(set(keys[value]))
        cuts = [known[len(known) * i // files[value]] for i in range(1, files[value])] if known else []
        bounds.append((value, first, sorted(set(cuts))))
        first += len(bounds[-1][2]) + 1
    key = StructType([StructField(k, spec.schema[k].dataType) for k in spec.key])
    shape = [(spec.partition, StringType()), ("first_file", IntegerType()), ("cuts", ArrayType(key))]
    return spark.createDataFrame(bounds, StructType([StructField(n, t) for n, t in shape])), first


def laid_out(rows: DataFrame, spec: TableSpec, bounds: DataFrame, files: int) -> DataFrame:
    """``rows`` with their storage partition, a task a file, sorted by key.

    ``bounds`` has a row per storage partition and a key per file: it is broadcast."""
    key = F.struct(*spec.key)
    file = F.col("first_file") + F.size(F.filter("cuts", lambda cut: cut <= key))
    typed = rows.select(*[F.col(c).cast(spec.schema[c].dataType).alias(c) for c in spec.columns])
    placed = typed.withColumn(spec.partition, spec.partition_value()).join(F.broadcast(bounds), spec.partition)
    ranged = placed.repartitionById(files, file).select(*spec.columns, spec.partition)
    return ranged.sortWithinPartitions(spec.partition, *spec.key)


def _write(spark: SparkSession, rows: DataFrame, path: str, spec: TableSpec, before: versions.Snapshot, bounds: tuple[DataFrame, int]) -> None:
    version = versions.version_folder(before)
    laid_out(rows, spec, *bounds).write.partitionBy(spec.partition).parquet(f"{path.rstrip('/')}/{version}")
    versions.publish(spark, path, before, version)


def _staging(path: str) -> str:
    return f"{path.rstrip('/')}__staging"


def _stage(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """Write a batch next to its table and read it back."""
    rows.write.mode("overwrite").parquet(_staging(path))
    return spark.read.schema(rows.schema).parquet(_staging(path))
