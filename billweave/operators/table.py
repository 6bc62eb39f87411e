"""The billing table: month-partitioned Parquet whose columns only ever grow."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billweave.functions.periods import period_of
from billweave.operators.columns import (
    DEFINITION_FIELDS,
    conform,
    merged_definitions,
    table_schema,
)
from billweave.operators.ledger import interrupted_loads, interrupted_months, live_deliveries, read_ledger
from billweave.operators.state import loaded_pairs, not_in
from billweave.session import read_if_present
from billweave.sources.listing import list_files, path_group

# The columns the table's logic depends on.
PERIOD_START = "bill_billing_period_start_date"
PERIOD_END = "bill_billing_period_end_date"
USAGE_START = "line_item_usage_start_date"
SORT_KEYS = [USAGE_START, "line_item_usage_account_id", "line_item_product_code"]
PARTITION = "billing_period"
KIND = "kind"

# Each file's rows of a delivery, as counted after the file was written; kept beside the data.
STATISTICS_SCHEMA = (
    "kind string, file_name string, execution_id string, rows bigint, min_start timestamp_ntz, max_end timestamp_ntz, "
    "billing_period string"
)
FILE_KEYS = [KIND, PARTITION, "file_name"]
STORED_FILE = r"/kind=([^/]+)/billing_period=([^/]+)/([^/]+\.parquet)$"

DEFINITIONS_SCHEMA = (
    "original_name string, normalized_name string, category string, source_type string, "
    "table_type string, rank_period string, rank_pos int, version int"
)


@dataclass(frozen=True)
class ReplaceCounts:
    """Rows a replace saw, and those it kept out as they belong to no or to another month.

    ``loaded`` and ``by_delivery`` are the rows written, and the rows kept out, of each month and delivery.
    """

    rows_seen: int
    null_period_rows: int
    other_period_rows: int
    by_delivery: dict[tuple[str, str], int] = field(default_factory=dict)
    loaded: dict[tuple[str, str], int] = field(default_factory=dict)

    @property
    def rejected(self) -> int:
        return self.null_period_rows + self.other_period_rows


class RenamedColumn(ValueError):
    """A column name stands for different originals."""


class BillingTable:
    """A folder with ``rows`` (data and rejects), ``columns`` (definitions), ``statistics``, ``ledger`` and ``events``.

    Rows are partitioned by month only, so a new delivery of a month takes the place of the old
    one. There is no table format underneath: a reader during an overwrite may see a month missing
    until its new files are committed.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.stored = f"{self.root}/rows"
        self.data, self.rejects = f"{self.stored}/{KIND}=data", f"{self.stored}/{KIND}=rejects"
        self.columns = f"{self.root}/columns"
        self.recorded = f"{self.root}/statistics"
        self.ledger = f"{self.root}/ledger"
        self.events = f"{self.root}/events"
        self._definitions: list[Row] | None = None

    def _recorded(self) -> list[Row]:
        """Definitions in table order, read once per object: a few hundred rows of metadata.

        Of a name recorded twice, by two writers at once, the first definition stays.
        """
        if self._definitions is None:
            rows = read_if_present(self.spark, self.columns, DEFINITIONS_SCHEMA).collect()
            # Newest month first within one version: sort by position, then by month downwards.
            rows.sort(key=lambda d: d.rank_pos)
            rows.sort(key=lambda d: d.rank_period, reverse=True)
            rows.sort(key=lambda d: d.version)
            first: dict[str, Row] = {}
            for row in rows:
                first.setdefault(row.normalized_name, row)
            self._definitions = list(first.values())
        return self._definitions

    def definitions(self) -> DataFrame:
        """The table's column definitions."""
        return self.spark.createDataFrame(self._recorded(), DEFINITIONS_SCHEMA)

    def schema(self) -> T.StructType:
        """Table schema, delivery tag first, then columns in the order they came in."""
        return table_schema(self._recorded())

    def rows(self) -> DataFrame:
        """The table under its full schema; older files read back NULL in later columns."""
        fields = self.schema().fields + [T.StructField(PARTITION, T.StringType())]
        return read_if_present(self.spark, self.data, T.StructType(fields))

    def exists(self) -> bool:
        return bool(self._recorded())

    def has_rows(self) -> bool:
        return not self.statistics().isEmpty()

    def evolve(self, defs: DataFrame, on_renamed: str = "fail") -> list[str]:
        """Record the columns of ``defs`` that the table lacks; returns their names.

        Existing columns keep their type. A name that stands for different originals, in ``defs`` or
        in the table, would mix their data and fails, unless ``on_renamed`` is ``"keep"``.
        """
        recorded = {d.normalized_name: d for d in self._recorded()}
        # One row per column name: metadata that the driver needs for the schema anyway.
        incoming = merged_definitions(defs).collect()
        if on_renamed == "fail":
            for d in incoming:
                known = {recorded[d.normalized_name].original_name} if d.normalized_name in recorded else set()
                originals = known | {d.original_name, *d.other_originals}
                if len(originals) > 1:
                    raise RenamedColumn(f"column {d.normalized_name} has different originals: {sorted(originals)}")
        version = max((d.version for d in recorded.values()), default=0) + 1
        new = [d for d in incoming if d.normalized_name not in recorded]
        new.sort(key=lambda d: (d.rank_period, -d.rank_pos), reverse=True)
        if new:
            fields = [*DEFINITION_FIELDS, "rank_period", "rank_pos"]
            rows = [(*[d[field] for field in fields], version) for d in new]
            self.spark.createDataFrame(rows, DEFINITIONS_SCHEMA).coalesce(1).write.mode("append").parquet(self.columns)
            self._definitions = None
        return [d.normalized_name for d in new]

    def replace(
        self, rows: DataFrame, gather: bool = False, max_records_per_file: int = 0, order: list[str] | None = None
    ) -> ReplaceCounts:
        """Replace every month that ``rows`` holds by these rows, in one job and one pass over them.

        ``rows`` has ``billing_period``, the month it was delivered for. A row dated in no month or
        in another one must not replace that month, so it goes to ``rejects``, in place of those that
        the last load of that month left there. Data and rejects are committed together.

        Rows scanned from parts are written as they come, without a shuffle, since a part holds one
        month. With ``gather`` rows of any order are first brought together by month, or each task
        would write a file for each month; adaptive execution splits large months and joins small
        ones by measured size. With ``order`` each file is sorted by these columns.
        """
        month = period_of(F.col(PERIOD_START))
        other = month != F.col(PARTITION)
        seen = Observation()
        kind = F.when(month == F.col(PARTITION), "data").otherwise("rejects")
        tagged = conform(rows, self.schema(), PARTITION)
        placed = tagged.hint("rebalance", F.col(PARTITION)) if gather else tagged
        counted = placed.observe(
            seen,
            F.count("*").alias("rows_seen"),
            F.count_if(month.isNull()).alias("null_period_rows"),
            F.count_if(other).alias("other_period_rows"),
        ).withColumn(KIND, kind)
        (
            (counted.sortWithinPartitions(KIND, PARTITION, *order) if order else counted)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("maxRecordsPerFile", max_records_per_file)
            .partitionBy(KIND, PARTITION)
            .parquet(self.stored)
        )
        written = self.record_statistics()
        kinds = {
            kind: {(r[PARTITION], r.execution_id): r.rows for r in written if r[KIND] == kind} for kind in ("data", "rejects")
        }
        return ReplaceCounts(**seen.get, by_delivery=kinds["rejects"], loaded=kinds["data"])

    def _files(self) -> DataFrame:
        """Data and reject files that are there now."""
        path = F.col("path")
        keys = [path_group(path, STORED_FILE, k).alias(name) for k, name in enumerate(FILE_KEYS, 1)]
        return list_files(self.spark, self.stored, "*.parquet").where(path.rlike(STORED_FILE)).select(*keys)

    def _statistics(self) -> DataFrame:
        return read_if_present(self.spark, self.recorded, STATISTICS_SCHEMA)

    def record_statistics(self) -> list[Row]:
        """Count the files that have no statistics yet, those just written; returns their rows by kind, month and delivery.

        Of these files' months three narrow columns are read. Files whose writer was lost before it recorded them are
        found in the same way by whoever asks next.
        """
        new = self._files().join(self._statistics().select(*FILE_KEYS).distinct(), FILE_KEYS, "left_anti").persist()
        try:
            months = [r[0] for r in new.select(PARTITION).distinct().collect()]
            if not months:
                return []
            names = {f.name: f.dataType for f in self.schema().fields}
            start, end = (
                F.col(c) if c in names else F.lit(None).cast("timestamp_ntz") for c in (PERIOD_START, PERIOD_END)
            )
            fields = [*self.schema().fields, *(T.StructField(n, T.StringType()) for n in (KIND, PARTITION))]
            rows = self.spark.read.schema(T.StructType(fields)).parquet(self.stored).where(F.col(PARTITION).isin(months))
            counts = (
                rows.withColumn("file_name", F.col("_metadata.file_name"))
                .groupBy(*FILE_KEYS, "execution_id")
                .agg(
                    F.count("*").alias("rows"),
                    F.min(start).alias("min_start"),
                    F.max(F.when(start.isNotNull(), end)).alias("max_end"),
                )
                .join(new, FILE_KEYS, "left_semi")
                .select(*[f.split()[0] for f in STATISTICS_SCHEMA.split(", ")])
                .persist()
            )
            try:
                # Asked first: the write makes Spark compute anew what it holds from that folder.
                summed = counts.groupBy(KIND, PARTITION, "execution_id").agg(F.sum("rows").alias("rows")).collect()
                counts.coalesce(1).write.mode("append").parquet(self.recorded)
                return summed
            finally:
                counts.unpersist()
        finally:
            new.unpersist()

    def statistics(self, months: list[str] | None = None) -> DataFrame:
        """Rows, first start and last end of each data file's deliveries, of all months or of some; no row is read.

        They are those of the files that are there: statistics of replaced files do not count, and files without any
        are counted first.
        """
        self.record_statistics()
        known = self._statistics().where(F.col(KIND) == "data")
        known = known if months is None else known.where(F.col(PARTITION).isin(months))
        # A file that two writers found unrecorded at once is recorded twice.
        return known.dropDuplicates([*FILE_KEYS, "execution_id"]).join(self._files(), FILE_KEYS, "left_semi")

    def info(self, name: str) -> DataFrame:
        """Name, column count, row count and date range, from the statistics."""
        return self.statistics().agg(
            F.lit(name).alias("table_name"),
            F.lit(len(self.schema().fields)).alias("column_count"),
            F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
            F.min("min_start").alias("min_date"),
            F.max("max_end").alias("max_date"),
        )

    def rejected_rows(self) -> DataFrame:
        """Rows kept out of the table: of each month those of its last load that had any."""
        fields = [*self.schema().fields, T.StructField(PARTITION, T.StringType())]
        return read_if_present(self.spark, self.rejects, T.StructType(fields))

    def deliveries(self, state: str = "rows", months: list[str] | None = None) -> DataFrame:
        """Loaded (month, delivery) pairs, of all months or of some, from the data or from the ledger of loads.

        The data answer by their files' statistics; the ledger is right as long as nothing else writes the table. A load that began and never came to an end does not
        count, so it is made again.
        """
        ledger = read_ledger(self.spark, self.ledger)
        if state == "ledger":
            pairs = live_deliveries(ledger)
            pairs = pairs if months is None else pairs.where(F.col(PARTITION).isin(months))
        else:
            pairs = loaded_pairs(self.statistics(months))
        return not_in(not_in(pairs, interrupted_loads(ledger)), interrupted_months(ledger), keys=[PARTITION])

    def row_counts(self, periods: list[str]) -> DataFrame:
        """Rows per delivery in some months, from the statistics."""
        return self.statistics(periods).groupBy(PARTITION, "execution_id").agg(F.sum("rows").alias("rows"))


def delete_counts(rows: DataFrame) -> DataFrame:
    """Rows a replace of each month would delete."""
    return rows.groupBy(PARTITION).agg(F.count("*").alias("deleted_rows"))
