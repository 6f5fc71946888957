"""Tables in buckets that a run changes all together or not at all.

A table lies in folders ``_bucket=k``, by a hash of the columns it is changed by. A run stages
the buckets it makes anew beside the lake and, when all are there, writes a journal: from then on
the change holds. Publishing moves the staged folders to their places; if it breaks off, the next
run goes on where it stopped (:func:`recover`). Without a journal nothing has been changed, and
what was staged is dropped. One run at a time may change a lake.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeconform.operators.merge import unmatched
from lakeconform.sources.lake import Lake

BUCKET = "_bucket"
JOURNAL = "order int, staged string, target string"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


class Store:
    """Folders of the lake's file system, as Hadoop moves and deletes them."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark

    def path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(name)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def exists(self, name: str) -> bool:
        store, path = self.path(name)
        return store.exists(path)

    def delete(self, name: str) -> None:
        store, path = self.path(name)
        store.delete(path, True)

    def move(self, source: str, target: str) -> None:
        store, path = self.path(source)
        _, place = self.path(target)
        store.mkdirs(place.getParent())
        if not store.rename(path, place):
            raise OSError(f"could not move {source} to {target}")

    def children(self, name: str) -> list[str]:
        store, path = self.path(name)
        if not store.exists(path):
            return []
        return sorted(status.getPath().getName() for status in store.listStatus(path))


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """A table with its bucket column, or nothing if there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


@dataclass
class Transaction:
    """The staged changes of one run."""

    spark: SparkSession
    lake: Lake
    name: str
    buckets: int
    first_load: bool = False
    moves: list[tuple[str, str]] = field(default_factory=list)
    touched: dict[str, list[int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.store = Store(self.spark)
        self.root = f"{_staging(self.lake)}/{self.name}"
        self.store.delete(self.root)

    def _place(self, target: str) -> str:
        return f"{self.root}/data{target.removeprefix(self.lake.root)}"

    def staged(self, target: str) -> DataFrame:
        return self.spark.read.parquet(self._place(target))

    def current(self, target: str) -> DataFrame | None:
        """The table as it is published, without its bucket column; none in a first load."""
        found = None if self.first_load else read_table(self.spark, target)
        return None if found is None else found.drop(BUCKET)

    def latest(self, target: str) -> DataFrame | None:
        """The table as it will be: staged buckets in the place of published ones."""
        if target not in self.touched:
            return self.current(target)
        new = read_table(self.spark, self._place(target))
        old = None if self.first_load else read_table(self.spark, target)
        if old is not None:
            old = old.filter(~F.col(BUCKET).isin(self.touched[target]))
        parts = [part.drop(BUCKET) for part in (old, new) if part is not None]
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def stage_keys(
        self, target: str, after: DataFrame, gone: DataFrame | None, keys: Sequence[str], by: Sequence[str]
    ) -> None:
        """Replace all rows of the keys in ``gone`` and ``after`` by ``after``.

        ``by`` are the columns of the bucket, among ``keys``. Only buckets that hold such a key
        are read and made anew. Without a published table ``after`` is the table.
        """
        bucket = bucket_of(by, self.buckets).alias(BUCKET)
        place = self._place(target)
        old = None if self.first_load else read_table(self.spark, target)
        if old is None:
            self._write(place, after.withColumn(BUCKET, bucket))
            if not any(name.startswith(BUCKET) for name in self.store.children(place)):
                # No row at all: an empty file keeps the table's columns.
                after.limit(0).coalesce(1).write.parquet(f"{place}/{BUCKET}=0")
            self.touched[target] = list(range(self.buckets))
            self.moves.append((place, target))
            return
        touched = after.select(*keys) if gone is None else after.select(*keys).unionAll(gone.select(*keys))
        places = sorted(r[0] for r in touched.select(bucket).distinct().collect())
        if not places:
            return
        kept = unmatched(old.filter(F.col(BUCKET).isin(places)), touched, keys)
        self._write(place, kept.unionByName(after.withColumn(BUCKET, bucket), allowMissingColumns=True))
        made = set(self.store.children(place))
        self.touched[target] = places
        for k in places:
            part = f"{BUCKET}={k}"
            self.moves.append((f"{place}/{part}" if part in made else "", f"{target}/{part}"))

    def _write(self, place: str, rows: DataFrame) -> None:
        # Rebalancing keeps a bucket in few files and splits one that a frequent key has filled.
        rows.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(place)

    def stage_whole(self, target: str, rows: DataFrame) -> None:
        """Replace a folder as a whole (a batch's part, a small state table)."""
        place = self._place(target)
        rows.write.parquet(place)
        self.moves.append((place, target))

    def drop(self) -> None:
        """Forget what was staged."""
        self.store.delete(self.root)

    def publish(self) -> None:
        """From the journal on the change holds; then everything is moved to its place."""
        rows = [(i, staged, target) for i, (staged, target) in enumerate(self.moves)]
        self.spark.createDataFrame(rows, JOURNAL).coalesce(1).write.parquet(f"{self.root}/journal")
        _replay(self.store, self.root, rows)


def _staging(lake: Lake) -> str:
    return f"{lake.root}/_refresh"


def _replay(store: Store, root: str, moves: list[tuple[int, str, str]]) -> None:
    for _, staged, target in sorted(moves):
        if not staged:  # a bucket that has become empty
            store.delete(target)
        elif store.exists(staged):
            store.delete(target)
            store.move(staged, target)
    store.delete(root)


def recover(spark: SparkSession, lake: Lake) -> list[str]:
    """Finish what an earlier run had decided and drop what it had not; names of the finished."""
    store, finished = Store(spark), []
    for name in store.children(_staging(lake)):
        root = f"{_staging(lake)}/{name}"
        if store.exists(f"{root}/journal/_SUCCESS"):
            moves = [tuple(r) for r in spark.read.schema(JOURNAL).parquet(f"{root}/journal").collect()]
            _replay(store, root, moves)
            finished.append(name)
        else:
            store.delete(root)
    return finished

