"""What several operators need: scratch tables in the shared folder, Arrow rows in bounded slices."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows that a task turns into Python objects at a time.
SLICE_ROWS = 256


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for a local master without that setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="clientele-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def ship(spark: SparkSession) -> None:
    """Hand this library to the Python workers, once per Spark context, as ``--py-files`` would."""
    context = spark.sparkContext
    if getattr(context, "_clientele_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="clientele-")), "clientele.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(target)
    context._clientele_shipped = True


class Scratch:
    """Tables of one run in the shared folder. Written tables cut the lineage and survive lost executors."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/clientele-{uuid.uuid4().hex}"
        self.count = 0

    def save(self, frame: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        frame.write.parquet(path)
        saved = self.spark.read.schema(frame.schema).parquet(path)
        saved._scratch_path = path
        return saved

    def drop(self, saved: DataFrame) -> None:
        """Delete a table that nothing reads any more."""
        self.remove(saved._scratch_path)

    def remove(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def map_slices(
    frame: DataFrame, schema: StructType | str, work: Callable[[pa.RecordBatch], pa.RecordBatch | None]
) -> DataFrame:
    """``mapInArrow`` that hands over at most ``SLICE_ROWS`` rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE_ROWS):
                done = work(batch.slice(begin, SLICE_ROWS))
                if done is not None and done.num_rows:
                    yield done

    ship(frame.sparkSession)
    return frame.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8 bytes; null is empty."""
    return [b"" if text is None else text for text in column.cast(pa.binary()).to_pylist()]


def hex_share(digest: Column, parts: Column) -> Column:
    """Which of so many even ranges of the first 8 hex digits a digest falls in."""
    return F.floor(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") * parts / F.lit(1 << 32)).cast("long")
