"""Small helpers every operator of this package shares: files, broadcasts of checked size and Arrow maps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import durable, shared_dir, ship


class Files:
    """A few files of a shared folder through the Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.root = root.rstrip("/")
        self.fs = self.path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.path(f"{self.root}/{name}")

    def names(self, folder: str) -> list[str]:
        here = self._at(folder)
        return [x.getPath().getName() for x in self.fs.listStatus(here)] if self.fs.exists(here) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """A new file; one that is there already is an error, so of two writers one fails."""
        stream = self.fs.create(self._at(name), False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()

    def remove(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


def sent_if_small(df: DataFrame, most: int) -> DataFrame:
    """``df`` (written already) marked for broadcast if it has ``most`` rows at most, else as it is."""
    return F.broadcast(df) if df.count() <= most else df


def map_batches(df: DataFrame, fn: Callable[[dict], Iterator[dict]], schema: str) -> DataFrame:
    """Run ``fn`` over each Arrow batch: it takes {column: pyarrow array} and yields {column: values}."""
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for out in fn(cols):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], type=f.type, from_pandas=True) if not isinstance(out[f.name], pa.Array) else out[f.name].cast(f.type) for f in arrow],
                    schema=arrow,
                )

    return map_stream(df, run, schema)


def map_stream(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with the package sent to the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, StructType.fromDDL(schema))


def own_names(df: DataFrame, **columns: str) -> DataFrame:
    """Keep only the columns an operator needs, under its own names, whatever else the table holds."""
    return df.select(*[df[c].alias(n) for n, c in columns.items()])
