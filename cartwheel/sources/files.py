"""File landing zone: CSV snapshots and incrementally arriving JSON files.

Readers return DataFrames (batch or streaming) with two lineage columns:
``ingestion_timestamp`` (one value per batch / micro-batch) and
``source_file`` (the hidden ``_metadata.file_path`` column of file sources).
Schemas are explicit by default: schema inference on a stream would fix
the schema at the first files seen, and on a batch it costs a full extra
pass over the input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..functions.timestamps import parse_timestamp


@dataclass(frozen=True)
class Layout:
    """Where each input lands, relative to one root folder.

    Fixed values: the folder names of the landing zone (context, events/transactions, events/labels).
    """

    root: str

    @property
    def landing(self) -> str:
        return f"{self.root.rstrip('/')}/landing_zone"

    @property
    def customers(self) -> str:
        return f"{self.landing}/context"

    @property
    def events(self) -> str:
        return f"{self.landing}/events/transactions"

    @property
    def labels(self) -> str:
        return f"{self.landing}/events/labels"

    @property
    def control(self) -> str:
        return f"{self.landing}/control"

    def table(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/checkpoints/{name}"


def with_lineage(df: DataFrame) -> DataFrame:
    """Add ``ingestion_timestamp`` and ``source_file`` to a file-source frame."""
    return (df.withColumn("ingestion_timestamp", F.current_timestamp())
              .withColumn("source_file", F.col("_metadata.file_path")))


def read_customers_csv(spark: SparkSession, path: str, schema: StructType | None = None,
                       infer: bool = False) -> DataFrame:
    """Batch read of a folder of customer CSV snapshots (header row).

    Columns are matched by header name, in any order; columns beyond the
    schema are left out and a missing one is an error. All files of one
    folder must have the same header (Spark checks it while reading).
    Values that do not fit the declared type become NULL.
    """
    reader = spark.read.format("csv").option("header", "true")
    if infer:
        return with_lineage(reader.option("inferSchema", "true").load(path))
    wanted = schema or schemas.customers_csv()
    header = reader.load(path).schema          # strings, named by the header
    missing = [f.name for f in wanted if f.name not in header.names]
    if missing:
        raise ValueError(f"CSV header under {path} lacks {missing}; it has {header.names}")
    rows = with_lineage(reader.schema(header).option("enforceSchema", "false").load(path))
    typed = [(parse_timestamp(f.name) if f.dataType.typeName() == "timestamp" else F.col(f.name).try_cast(f.dataType)).alias(f.name)
             for f in wanted]
    return rows.select(*typed, "ingestion_timestamp", "source_file")


def rescue_json(lines: DataFrame, schema: StructType) -> DataFrame:
    """Parse a ``value`` column of JSON lines, batch or streaming, losing nothing.

    Adds ``_rescued_data``: the whole line if it is not a JSON object or a
    field does not fit its type, else the fields outside the schema as JSON
    text, else NULL. Other columns of ``lines`` are kept.
    """
    marked = StructType([*schema.fields, StructField("_bad", StringType())])
    row = F.from_json("value", marked, {"columnNameOfCorruptRecord": "_bad", "mode": "PERMISSIVE"})
    every = F.from_json("value", "map<string,string>")
    extra = F.map_filter(every, lambda k, v: ~k.isin(schema.names))
    kept = [c for c in lines.columns if c != "value"]
    parsed = lines.withColumns({"_row": row, "_extra": extra})
    bad = F.col("_row").isNull() | F.col("_row._bad").isNotNull()
    rescued = F.when(bad, F.col("value")).when(F.size("_extra") > 0, F.to_json("_extra"))
    return parsed.select(*(F.col(f"_row.{n}").alias(n) for n in schema.names), rescued.alias("_rescued_data"), *kept)


def read_json(spark: SparkSession, path: str, schema: StructType, rescue: bool = False) -> DataFrame:
    """Batch read of landed JSON files (used for backfills and tests).
    ``rescue`` adds ``_rescued_data`` (:func:`rescue_json`)."""
    if rescue:
        return rescue_json(with_lineage(spark.read.text(path)), schema)
    return with_lineage(spark.read.schema(schema).json(path))


def stream_json(spark: SparkSession, path: str, schema: StructType,
                max_files_per_trigger: int | None = None, latest_first: bool = False,
                clean_source: str | None = None, archive_dir: str | None = None,
                rescue: bool = False) -> DataFrame:
    """Incremental JSON file source: each new file is read exactly once.

    Malformed lines surface as NULL columns (PERMISSIVE) and are then caught
    by the quality rules instead of failing the stream. ``clean_source``
    (``archive`` / ``delete``) moves processed files out of the landing zone.
    """
    if rescue:
        reader = spark.readStream.format("text")
    else:
        reader = spark.readStream.schema(schema).format("json").option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if latest_first:
        reader = reader.option("latestFirst", "true")
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if archive_dir:
            reader = reader.option("sourceArchiveDir", archive_dir)
    rows = with_lineage(reader.load(path))
    return rescue_json(rows, schema) if rescue else rows


def stream_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Incremental CSV source (header row) for snapshot deliveries. A header that
    differs from the schema fails the stream instead of shifting columns."""
    reader = spark.readStream.format("csv").option("header", "true").option("enforceSchema", "false")
    return with_lineage(reader.schema(schema or schemas.customers_csv()).load(path))


def with_comments(df: DataFrame, table: str, comments: dict[str, str] | None = None) -> DataFrame:
    """``df`` with comments in its columns' metadata, the table's own on the first column. Parquet files keep them."""
    texts = schemas.COLUMN_COMMENTS if comments is None else comments
    out = []
    for i, f in enumerate(df.schema.fields):
        more = {"comment": texts[f.name]} if f.name in texts else {}
        if i == 0 and table in schemas.TABLE_COMMENTS:
            more["table_comment"] = schemas.TABLE_COMMENTS[table]
        out.append(F.col(f"`{f.name}`").alias(f.name, metadata={**f.metadata, **more}))
    return df.select(*out)


def comments_of(df: DataFrame) -> tuple[str | None, dict[str, str]]:
    """(table comment, column comments) of a table read back."""
    fields = df.schema.fields
    return fields[0].metadata.get("table_comment"), {f.name: f.metadata["comment"] for f in fields if "comment" in f.metadata}


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Full-refresh (``overwrite``) or append write of a table folder."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
