"""Tables that are rewritten from their own content, whole or by buckets of their key.

Such a table cannot be overwritten in place: the write would delete what it reads, and a failed job would leave nothing.
Each write therefore goes to a folder of its own, and a finished write is entered in a log, which readers follow: one small
file per version, which names the folders that the version consists of. A write that failed is not in the log.

A write is based on the version whose content it changes. Its entry is the next number, and an entry is created once only:
of two loads that start from one version, one raises ``ConflictError`` and leaves nothing behind that a reader sees.

Bucketed tables lie in a fixed number of buckets by a hash of the key. A write holds the new content of the buckets that its
changes touch; for the other buckets its entry names the folders that held them before. Rows may be split into those that
stand and closed ones, which are never written again: a bucket's closed rows lie in all the folders that closed some.
"""

from __future__ import annotations

import dataclasses
import json
import uuid
from collections.abc import Callable, Sequence
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clientele.sinks import folders
from clientele.sinks.folders import ConflictError

T = TypeVar("T")

#: Buckets of a table when its first version is written; the log keeps the number from then on.
BUCKETS = 64


@dataclasses.dataclass(frozen=True)
class Version:
    """An entry of the log: 0 before the first write."""

    number: int = 0
    folder: str | None = None
    buckets: int = BUCKETS
    standing: dict[str, str] = dataclasses.field(default_factory=dict)
    closed: dict[str, list[str]] = dataclasses.field(default_factory=dict)
    next_key: int | None = None


def newest(spark: SparkSession, path: str) -> Version:
    """The last finished write."""
    numbers = [x for x in folders.names(spark, f"{path}/log") if x.endswith(".json")]
    if not numbers:
        return Version()
    return Version(**json.loads(folders.read_text(spark, f"{path}/log/{numbers[-1]}")))


def enter(spark: SparkSession, path: str, version: Version) -> None:
    entry = json.dumps(dataclasses.asdict(version))
    folders.create_text(spark, f"{path}/log/{version.number:012d}.json", entry)


def retried(change: Callable[[], T], attempts: int = 5) -> T:
    """Make a change that reads, computes and writes; where another load was first, make it again from what that left."""
    for left in range(attempts - 1, -1, -1):
        try:
            return change()
        except ConflictError:
            if not left:
                raise


def new_folder(based_on: Version) -> str:
    return f"{based_on.number + 1:012d}-{uuid.uuid4().hex}"


def read_newest(spark: SparkSession, path: str, schema: StructType, version: Version | None = None) -> DataFrame:
    """The whole table as of its last finished write, or as of ``version``."""
    version = version or newest(spark, path)
    if version.folder is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/data/{version.folder}").select(*schema.names)


def write_version(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    based_on: Version | None = None,
) -> int:
    """Write ``df`` as the whole new content and make it visible once complete; the number of the version.

    ``based_on`` is the version that ``df`` was made from; without it, the one that is newest when the write starts.
    """
    based_on = based_on or newest(spark, path)
    folder = new_folder(based_on)
    df.write.partitionBy(*partition_by).parquet(f"{path}/data/{folder}")
    enter(spark, path, Version(based_on.number + 1, folder))
    return based_on.number + 1


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def touched_buckets(changes: DataFrame, keys: Sequence[str], version: Version) -> list[int]:
    """The buckets that hold the keys of the changes, at most as many as the table has."""
    return sorted(r[0] for r in changes.select(bucket_of(keys, version.buckets).alias("b")).distinct().collect())


def _read(spark: SparkSession, path: str, schema: StructType, places: list[str]) -> DataFrame:
    if not places:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/{x}" for x in places]).select(*schema.names)


def read_standing(
    spark: SparkSession, path: str, schema: StructType, version: Version, only: Sequence[int] | None = None
) -> DataFrame:
    """The rows of a bucketed table that are not closed, of all buckets or of some."""
    held = [(b, x) for b, x in version.standing.items() if only is None or int(b) in only]
    return _read(spark, path, schema, [f"{x}/closed_row=N/key_bucket={b}" for b, x in held])


def read_closed(
    spark: SparkSession, path: str, schema: StructType, version: Version, only: Sequence[int] | None = None
) -> DataFrame:
    held = [(b, x) for b, all_of in version.closed.items() if only is None or int(b) in only for x in all_of]
    return _read(spark, path, schema, [f"{x}/closed_row=Y/key_bucket={b}" for b, x in held])


def write_buckets(
    spark: SparkSession,
    rows: DataFrame,
    path: str,
    keys: Sequence[str],
    based_on: Version,
    touched: Sequence[int] | None = None,
    closed: Column | None = None,
    next_key: Callable[[], int] | None = None,
) -> Version:
    """Write the new content of the ``touched`` buckets (None: of all) and make it visible once complete.

    ``rows`` are their standing rows, and those that this write closes, told apart by ``closed``. Rows are spread by bucket
    so that a bucket is one file or, where it is large, several. ``next_key`` is asked once the rows are written.
    """
    folder = new_folder(based_on)
    placed = rows.withColumns(
        {
            "closed_row": F.when(F.lit(False) if closed is None else closed, "Y").otherwise("N"),
            "key_bucket": bucket_of(keys, based_on.buckets),
        }
    )
    spread = placed.hint("rebalance", "key_bucket")
    spread.write.partitionBy("closed_row", "key_bucket").parquet(f"{path}/data/{folder}")

    def written(flag: str) -> list[str]:
        there = folders.names(spark, f"{path}/data/{folder}/closed_row={flag}")
        return [x.removeprefix("key_bucket=") for x in there if x.startswith("key_bucket=")]

    gone = set(based_on.standing) if touched is None else {str(b) for b in touched}
    standing = {b: x for b, x in based_on.standing.items() if b not in gone} | dict.fromkeys(written("N"), folder)
    past = dict(based_on.closed)
    for b in written("Y"):
        past[b] = [*past.get(b, []), folder]
    free = next_key() if next_key else based_on.next_key
    version = Version(based_on.number + 1, None, based_on.buckets, standing, past, free)
    enter(spark, path, version)
    return version


def remove_old(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all but the last ``keep`` entries of the log, and the folders that none of those names; what went.

    Folders of writes that are still running are newer than the newest entry and stay. Readers of older versions fail.
    """
    entries = [x for x in folders.names(spark, f"{path}/log") if x.endswith(".json")]
    kept = entries[-max(1, keep) :]
    used = set()
    for name in kept:
        entry = Version(**json.loads(folders.read_text(spark, f"{path}/log/{name}")))
        used |= {entry.folder, *entry.standing.values(), *[x for own in entry.closed.values() for x in own]}
    newest_number = kept[-1].removesuffix(".json") if kept else ""
    gone = []
    for name in entries[: len(entries) - len(kept)]:
        folders.remove(spark, f"{path}/log/{name}")
    for name in folders.names(spark, f"{path}/data"):
        if name not in used and name.split("-")[0] <= newest_number:
            folders.remove(spark, f"{path}/data/{name}")
            gone.append(name)
    return gone
