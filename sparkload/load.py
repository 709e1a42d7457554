"""Loading tables end to end, with checks and a report."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .functions.copytext import row_bytes
from .functions.text import quote
from .model import TableSpec
from .operators.casting import ERRORS
from .operators.integrity import check_table, sequence_state
from .operators.rejects import GOOD, OUTCOME, REJECTED, checked_rows, reject_rows
from .operators.partitioning import PARTITION, route_partition
from .publishing import current_version, new_version_folder, read_published, read_text_file, switch_to, verify_rows, write_text_file
from .session import session_conf
from .sinks import SAVE_MODES, require_same_columns, write_table

REPORT_SCHEMA = "table string, errors bigint, rows bigint, bytes bigint, seconds double"


@dataclass(frozen=True)
class LoadOptions:
    """How to load.

    mode is a load mode of ``sinks.write_table``. schema_only writes no rows, data_only skips
    all checks, on_error 'stop' fails the run at a bad row where 'reject' sets it aside.
    """

    mode: str = "drop_create"
    schema_only: bool = False
    data_only: bool = False
    keys: bool = True
    foreign_keys: bool = True
    reset_sequences: bool = True
    on_error: str = "reject"
    user_rules: tuple = ()
    fmt: str = "parquet"
    # Bytes in the report are those of COPY text; counting them costs a little per value.
    count_bytes: bool = True
    # Selects source rows before the casts, where it can prune the scan.
    where: str | None = None
    # A handful of open files per task, so that splitting rows by outcome needs no sort.
    open_files: int = 8
    # Each load is a version of its own: readers keep the one before until this one is whole (see ``publishing``).
    versioned: bool = False
    # Rows of a batch sent to a database, and rows of a file at most (0: any number).
    batch_rows: int = 50_000
    max_records_per_file: int = 0


@dataclass
class TableLoad:
    """What one table's load produced. Counts come from the write itself."""

    spec: TableSpec
    good: DataFrame
    rejects: DataFrame
    errors: int
    rows: int
    bytes: int
    seconds: float
    checks: DataFrame | None = None
    sequences: DataFrame | None = None


@dataclass
class LoadReport:
    tables: dict[str, TableLoad] = field(default_factory=dict)
    phases: list[tuple[str, float]] = field(default_factory=list)
    seconds: float = 0.0


RUN = "_run"
SCHEMA_FILE = "_load_schema.json"  # readers of the data pass over names with an underscore


def keep_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    write_text_file(spark, f"{path}/{SCHEMA_FILE}", schema.json())


def stored_schema(spark: SparkSession, path: str, fmt: str) -> StructType:
    """The schema kept with a table, else that of its files."""
    kept = read_text_file(spark, f"{path}/{SCHEMA_FILE}")
    return StructType.fromJson(json.loads(kept)) if kept else spark.read.format(fmt).load(path).schema


def table_path(target: str, spec: TableSpec) -> str:
    return f"{target.rstrip('/')}/{spec.qualified_name}"


def load_table(raw: DataFrame, spec: TableSpec, dialect: str, target: str, options: LoadOptions = LoadOptions()) -> TableLoad:
    """Cast, split and write one table in a single pass over its source.

    Rows go to ``load_outcome=good`` and ``load_outcome=rejected`` below the table's
    folder. Rows, errors and bytes are observed in that same write, right before the
    files, where a repeated task is counted once. Rejects and counts are this load's; after an append, the good
    rows are all that the table holds. The schema is kept beside the data, as a load without rows leaves no file.

    With ``versioned`` all this happens in a fresh folder. Its rows are counted again in the files, and only then
    does the table's pointer name it: a load that fails, wherever it does, leaves what ``read_loaded`` gives.
    """
    spark = raw.sparkSession
    keys = tuple(spec.primary_key)
    start = time.perf_counter()
    checked = checked_rows(raw, spec.columns, dialect, options.user_rules, keys, options.where)
    if options.schema_only:
        checked = checked.filter(F.lit(False))
    if options.on_error == "stop":
        stop = F.raise_error(F.concat(F.lit(f"{spec.qualified_name}: "), F.to_json(ERRORS))).cast("boolean")
        checked = checked.filter(F.when(F.col(ERRORS).isNull(), F.lit(True)).otherwise(stop))
    names = [quote(c.name) for c in spec.columns]
    layout = [OUTCOME]
    if spec.partitioning:
        checked = route_partition(checked, spec.partitioning)
        no_home = F.col(ERRORS).isNull() & F.col(PARTITION).isNull()
        key_text = F.expr(spec.partitioning.key).cast("string")
        homeless = F.array(
            F.struct(
                F.lit(spec.partitioning.key).alias("column"),
                key_text.alias("value"),
                F.lit("no partition for the row").alias("reason"),
            )
        )
        checked = checked.withColumn(ERRORS, F.when(no_home, homeless).otherwise(F.col(ERRORS)))
        layout.append(PARTITION)
    is_good = F.col(ERRORS).isNull()
    # Appended loads share the folder; the run tells their rejects apart.
    run = uuid.uuid4().hex
    outcome = checked.withColumn(OUTCOME, F.when(is_good, GOOD).otherwise(REJECTED)).withColumn(RUN, F.lit(run))
    if spec.partitioning:
        outcome = outcome.hint("rebalance", F.col(OUTCOME), F.col(PARTITION))

    size = row_bytes(checked.select(*names).schema) if options.count_bytes else F.lit(0).cast("bigint")
    seen = Observation()
    measured = outcome.observe(
        seen,
        F.count_if(is_good).alias("rows"),
        F.count_if(~is_good).alias("errors"),
        F.sum(F.when(is_good, size)).alias("bytes"),
    )
    root = path = table_path(target, spec)
    before = None
    if options.versioned:
        if options.mode == "append":
            raise ValueError("a version is a whole table; append does not make one")
        before, path = current_version(spark, root), new_version_folder(root)
        if options.mode == "create" and before:
            raise ValueError(f"{root} has a version already")
    if options.mode == "truncate":
        if before:
            kept = StructType.fromJson(json.loads(before.schema))
        else:
            kept = stored_schema(spark, root, options.fmt)
        fields = {f.name: f.dataType for f in kept.fields}
        require_same_columns(kept.names, measured.columns)
        cast = [F.col(quote(c)).cast(fields[c]).alias(c) if c in spec.column_names else F.col(quote(c)) for c in measured.columns]
        measured = measured.select(*cast)
    with session_conf(spark, spark__sql__maxConcurrentOutputFileWriters=str(options.open_files)):
        # Static overwrite: a load without rejects must also remove the rejects of the one before.
        writer = measured.write.mode(SAVE_MODES[options.mode]).option("partitionOverwriteMode", "static")
        writer = writer.option("maxRecordsPerFile", options.max_records_per_file)
        writer.partitionBy(*layout).format(options.fmt).save(path)
    counts = seen.get
    if options.versioned:
        n = (counts["rows"] or 0) + (counts["errors"] or 0)
        verify_rows(spark, path, options.fmt, measured.schema, n)
        switch_to(spark, root, path, n, measured.schema, options.fmt, before)
    elif options.mode != "append" or options.schema_only:
        keep_schema(spark, path, measured.schema)
    stored = spark.read.schema(measured.schema).format(options.fmt).load(path)
    good = stored.filter(F.col(OUTCOME) == GOOD).select(*names)
    rejects = reject_rows(stored.filter((F.col(OUTCOME) == REJECTED) & (F.col(RUN) == run)), spec.qualified_name, keys)
    return TableLoad(
        spec, good, rejects, counts["errors"] or 0, counts["rows"] or 0, counts["bytes"] or 0,
        time.perf_counter() - start,
    )


def read_loaded(spark: SparkSession, target: str, spec: TableSpec) -> DataFrame:
    """The good rows of the version of a table that is current."""
    found = read_published(spark, table_path(target, spec))
    return found.filter(F.col(OUTCOME) == GOOD).select(*[quote(c) for c in spec.column_names])


def load_database(
    spark: SparkSession,
    specs,
    source: Callable[[TableSpec], DataFrame],
    dialect: str,
    target: str,
    options: LoadOptions = LoadOptions(),
) -> LoadReport:
    """Load tables one after the other, then check keys, references and sequences.

    ``source`` gives the raw frame of a table. Each table is one distributed job; the
    first table that fails ends the run. Checks run after all data is there, so
    references may point to any table of the set. They are lazy frames.
    """
    report = LoadReport()
    start = time.perf_counter()
    for spec in specs:
        report.tables[spec.qualified_name] = load_table(source(spec), spec, dialect, target, options)
    copied = time.perf_counter()
    report.phases.append(("copy", copied - start))
    if not options.data_only:
        parents = {name: t.good for name, t in report.tables.items()}
        for loaded in report.tables.values():
            loaded.checks = check_table(
                loaded.good, loaded.spec, parents if options.foreign_keys else None, options.keys
            )
            counters = [c.name for c in loaded.spec.columns if c.auto_increment]
            if counters and options.reset_sequences:
                loaded.sequences = sequence_state(loaded.good, counters)
        report.phases.append(("create checks", time.perf_counter() - copied))
    report.seconds = time.perf_counter() - start
    return report


def publish_table(
    loaded: TableLoad, target: str, mode: str = "create", fmt: str = "table", jdbc: dict | None = None, options: LoadOptions = LoadOptions()
) -> None:
    """Copy the good rows of a load to a catalog table or, over JDBC, to a database, in batches or files of the options' sizes."""
    sizes = {"batch_rows": options.batch_rows, "max_records_per_file": options.max_records_per_file}
    write_table(loaded.good, target, mode, fmt, jdbc=jdbc, comment=loaded.spec.comment, **sizes)


# --- report --------------------------------------------------------------------------


def load_report(spark: SparkSession, report: LoadReport) -> DataFrame:
    """One row per table: table, errors, rows, bytes, seconds."""
    rows = [(name, t.errors, t.rows, t.bytes, t.seconds) for name, t in report.tables.items()]
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def format_bytes(n: int) -> str:
    if n >= 1024 * 1024:
        return f"{n / (1024 * 1024):.1f} MB"
    return f"{n / 1024:.1f} kB" if n >= 1024 else f"{n} B"


def format_seconds(seconds: float) -> str:
    return f"{seconds:.3f}s"


def format_report(report: LoadReport) -> str:
    """The report as text: phases apart from tables, totals over all tables last."""
    rows = [(name, 0, 0, "", format_seconds(s)) for name, s in report.phases]
    tables = [
        (n, t.errors, t.rows, format_bytes(t.bytes), format_seconds(t.seconds)) for n, t in report.tables.items()
    ]
    total = (
        "Total import time",
        sum(t.errors for t in report.tables.values()),
        sum(t.rows for t in report.tables.values()),
        format_bytes(sum(t.bytes for t in report.tables.values())),
        format_seconds(report.seconds),
    )
    width = max(23, *(len(r[0]) for r in [*rows, *tables, total]))

    def line(cells) -> str:
        name, errors, count, size, seconds = (str(c) for c in cells)
        return f"{name:>{width}}  {errors:>9}  {count:>9}  {size:>9}  {seconds:>14}"

    rule = "  ".join("-" * n for n in (width, 9, 9, 9, 14))
    body = [line(("table name", "errors", "rows", "bytes", "time")), rule]
    for group in (rows, tables):
        if group:
            body += [*map(line, group), rule]
    return "\n".join([*body, line(total)])
