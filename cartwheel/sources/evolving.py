"""JSON ingest with column types that are inferred and may change from file to file.

Every triggered run infers the types of its new files and merges them into the stored schema: a column that is a whole number
in one file and a decimal in another becomes a decimal, one that does not fit a number becomes text, new columns are added.
Each change is a new schema version. A batch is written under the version it was read with::

    root/schemas/<version>.json
    root/data/schema=<version>/batch_id=<batch>/...

A reader takes the newest version and casts the files of older ones up to it, so nothing is rewritten. A replayed batch
merges to the same schema and replaces its own folder. Inference reads the new files once more than a fixed schema does.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, DoubleType, LongType, NullType, StringType, StructField, StructType

from .files import with_lineage
from ..schemas import LINEAGE_COLUMNS


def wider(a: DataType, b: DataType) -> DataType:
    """The narrowest type that holds both: long < double < text; structs and arrays by their parts; else text."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if {type(a), type(b)} == {LongType, DoubleType}:
        return DoubleType()
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(wider(a.elementType, b.elementType))
    return StringType()


def merged(a: StructType, b: StructType) -> StructType:
    """All columns of both, those of ``a`` first."""
    types = {f.name: f.dataType for f in a.fields}
    for f in b.fields:
        types[f.name] = wider(types[f.name], f.dataType) if f.name in types else f.dataType
    return StructType([StructField(n, t) for n, t in types.items()])


def _settled(kind: DataType) -> DataType:
    """No column stays without a type: one that was null in all files so far is text."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _settled(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_settled(kind.elementType))
    return kind if isinstance(kind, (BooleanType, DoubleType, LongType, StringType)) else StringType()


class _Schemas:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._root = f"{root.rstrip('/')}/schemas"
        self._fs = self._path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str = ""):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._root}/{name}".rstrip("/"))

    def all(self) -> dict[int, StructType]:
        if not self._fs.exists(self._path()):
            return {}
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path())]
        return {int(n.removesuffix(".json")): self._read(n) for n in names if n.endswith(".json") and not n.startswith(".")}

    def _read(self, name: str) -> StructType:
        stream = self._fs.open(self._path(name))
        try:
            return StructType.fromJson(json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def add(self, number: int, schema: StructType) -> None:
        draft, final = self._path(f".{number}.draft"), self._path(f"{number}.json")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(schema.json().encode()))
        finally:
            out.close()
        if not self._fs.rename(draft, final):
            raise RuntimeError(f"schema {number} of {self._root} was written by another run")


def ingest(spark: SparkSession, landing: str, root: str, checkpoint: str, max_files_per_trigger: int = 1000):
    """One triggered run: every new JSON file under ``landing`` once, into ``root``. Lineage columns are added."""
    from ..streaming.flows import run_for_each_batch

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        files = [r[0] for r in batch.select("file").distinct().collect()]        # at most max_files_per_trigger
        if not files:
            return
        schemas = _Schemas(session, root)
        known = schemas.all()
        number = max(known, default=-1)
        schema = known.get(number, StructType([]))
        new = _settled(merged(schema, session.read.json(files).schema))
        if new != schema:
            number += 1
            schemas.add(number, new)
        rows = with_lineage(session.read.schema(new).json(files))
        rows.write.mode("overwrite").parquet(f"{root.rstrip('/')}/data/schema={number}/batch_id={batch_id}")

    lines = spark.readStream.option("maxFilesPerTrigger", str(max_files_per_trigger)).text(landing)
    return run_for_each_batch(lines.select(F.col("_metadata.file_path").alias("file")), write, checkpoint)


def read(spark: SparkSession, root: str) -> DataFrame | None:
    """All rows under the newest schema, older files cast up to it."""
    known = _Schemas(spark, root).all()
    out = None
    for number, schema in sorted(known.items()):
        newest = known[max(known)]
        folder = f"{root.rstrip('/')}/data/schema={number}"
        if not _exists(spark, folder):
            continue                                  # a run that stored its schema and no rows yet
        rows = spark.read.parquet(folder).drop("batch_id")
        have = {f.name: f.dataType for f in schema.fields}
        cast = [(_up(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in newest.fields]
        rows = rows.select(*cast, *LINEAGE_COLUMNS)
        out = rows if out is None else out.unionByName(rows)
    return out


def _up(column, old: DataType, new: DataType):
    if old == new:
        return column
    if isinstance(old, (StructType, ArrayType)):      # parts may have been added inside: read anew as the wider type
        return F.to_json(column) if isinstance(new, StringType) else F.from_json(F.to_json(column), new)
    return column.cast(new)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
