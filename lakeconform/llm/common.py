"""Tables, shared scratch space and small helpers for the operators of this package."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side of at most this many counted bytes may be broadcast; beyond it the join shuffles.
BROADCAST_BYTES = 64 << 20
# Spark's own setting that deletes the shuffle files of a statement when it has ended.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the cluster's shared folder, removed when the session's JVM ends.

    The folder is ``spark.checkpoint.dir``; only a session on one machine may do without it and
    gets a temporary one. All paths of a session lie in one folder, which is there before it is
    marked for removal, since a path that is not there yet cannot be marked.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.gettempdir()
    home = f"{root.rstrip('/')}/lakeconform-llm/{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(home)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(folder)
    store.deleteOnExit(folder)
    return f"{home}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    The lineage ends there, so a lost executor costs no earlier work, and what was computed
    once is the same for every later use. Its shuffle files go when the table is written, as
    nothing reads them again: the disk in use is that of one step, not of all steps so far.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(FILE_CLEANUP)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FILE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def placed(df: DataFrame) -> DataFrame:
    """The frame with ``_row``: the number of its file, by path, and the row's place in the file.

    Unlike a number given while scanning, it does not depend on how files are split, and so not
    on the executors at hand. A frame that is not read from Parquet is stored with its numbers.
    """
    try:
        found = df.withColumns({"_file": F.col("_metadata.file_path"), "_index": F.col("_metadata.row_index")})
        paths = sorted(r[0] for r in found.select("_file").distinct().collect())
    except AnalysisException:
        return stored(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    files = df.sparkSession.createDataFrame(list(zip(paths, range(len(paths)))), "_file string, _number bigint")
    row = F.expr("shiftleft(_number, 40) | _index").alias("_row")
    return found.join(F.broadcast(files), "_file").select(*[f"`{c}`" for c in df.columns], row)


def _width(kind: T.DataType, value: str) -> str:
    """SQL for the bytes of a value: 16 for what has a fixed size, also as overhead of the rest."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return f"16 + coalesce(octet_length({value}), 0)"
    if isinstance(kind, T.ArrayType):
        inner = _width(kind.elementType, "e")
        return f"16 + coalesce(aggregate({value}, 0L, (a, e) -> a + {inner}), 0L)"
    if isinstance(kind, T.StructType):
        return " + ".join(["16", *[_width(f.dataType, f"{value}.`{f.name}`") for f in kind.fields]])
    return "16"


def held_bytes(df: DataFrame) -> int:
    """About how much memory the rows of a frame take; one number reaches the driver."""
    widths = " + ".join(["16", *[_width(f.dataType, f"`{f.name}`") for f in df.schema.fields]])
    return df.agg(F.expr(f"coalesce(sum({widths}), 0L)")).first()[0]


def narrow(df: DataFrame) -> DataFrame:
    """Broadcast a stored frame if its summed bytes allow, however wide its rows, else leave it."""
    return F.broadcast(df) if held_bytes(df) <= BROADCAST_BYTES else df


def numbered(df: DataFrame, keys: list[str], columns: list[str], name: str) -> tuple[DataFrame, dict]:
    """Sort by ``keys`` and store ``columns`` with ``_part`` and ``_local``, and the offsets.

    The global row number is ``offsets[_part] + _local``. The range exchange also sorts on the
    input position, so a key that holds a third of the rows is still cut into even ranges.
    Only one count per partition reaches the driver.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.select(*columns).withColumn("_input", F.monotonically_increasing_id())
    ordered = (
        placed.repartitionByRange(parts, *keys, "_input")
        .sortWithinPartitions(*keys, "_input")
        .drop("_input")
        .withColumn("_row", F.monotonically_increasing_id())
        .select(
            *columns,
            F.shiftright("_row", 33).cast("int").alias("_part"),
            F.col("_row").bitwiseAND((1 << 33) - 1).alias("_local"),
        )
    )
    rows = stored(ordered, name)
    counts = rows.groupBy("_part").agg(F.count("*").alias("n")).collect()
    offsets, total = {}, 0
    for part, n in sorted((r[0], r[1]) for r in counts):
        offsets[part] = total
        total += n
    return rows, {"offsets": offsets, "total": total}


def slices(texts: pa.Array, limit: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose UTF-8 bytes stay within ``limit``; a longer text stands alone."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, i
            start, held = i, 0
        held += int(size)
    if start < len(sizes):
        yield start, len(sizes)
