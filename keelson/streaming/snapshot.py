"""Incremental form of the latest-value snapshot, folded in place while readers go on.

Each micro-batch is reduced to its latest row per key and written as one Parquet folder named after the batch. Reading
takes the maximum over the base and all later folders, so a batch that is replayed after a failure changes nothing: a
complete folder is left as it is, an incomplete one is written again.

``publish`` folds complete batches into a new base and then writes a pointer, a small file with the base's name and the
last folded batch. Readers take the newest pointer. What an earlier pointer refers to is deleted one publication later, so
a reader that started on it can finish. Names that begin with an underscore are no batches and no table partitions.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from keelson.operators.retrieve import materialize
from keelson.spec import ContractError


@dataclass(frozen=True)
class Pointer:
    """What a publication holds: its number, its base folder and the last batch folded into the base."""

    version: int
    base: str
    through: int


def _files(spark: SparkSession, path: str):
    """(Hadoop file system, Path class) for a path."""
    new = spark._jvm.org.apache.hadoop.fs.Path
    return new(path).getFileSystem(spark._jsc.hadoopConfiguration()), new


def _names(spark: SparkSession, path: str) -> list[str]:
    files, new = _files(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(new(path))) if files.exists(new(path)) else []


def _complete(spark: SparkSession, folder: str) -> bool:
    files, new = _files(spark, folder)
    return files.exists(new(f"{folder}/_SUCCESS"))


def _delete(spark: SparkSession, path: str) -> None:
    files, new = _files(spark, path)
    files.delete(new(path), True)


def pointers(spark: SparkSession, path: str) -> list[Pointer]:
    """Publications by number; at most the two newest exist for long."""
    found = []
    for name in _names(spark, f"{path}/_pointers"):
        if name.startswith("v") and name.endswith(".json"):
            found.append(Pointer(**json.loads(spark.read.text(f"{path}/_pointers/{name}", wholetext=True).first()[0])))
    return sorted(found, key=lambda p: p.version)


def _write_pointer(spark: SparkSession, path: str, pointer: Pointer) -> None:
    """A file that appears under its name at once: written under another name, then renamed, never onto an existing one."""
    files, new = _files(spark, path)
    hidden, final = new(f"{path}/_pointers/.{uuid4().hex}"), new(f"{path}/_pointers/v{pointer.version:012d}.json")
    out = files.create(hidden, False)
    out.write(bytearray(json.dumps(pointer.__dict__).encode()))
    out.close()
    if files.exists(final) or not files.rename(hidden, final):
        files.delete(hidden, False)
        raise ContractError(f"publication {pointer.version} exists already")


def batches(spark: SparkSession, path: str, after: int = -1) -> list[int]:
    """Numbers of the complete batches later than ``after``."""
    numbers = sorted(int(n.removeprefix("batch=")) for n in _names(spark, path) if n.startswith("batch="))
    return [n for n in numbers if n > after and _complete(spark, f"{path}/batch={n}")]


def feed_snapshot(stream: DataFrame, path: str, checkpoint: str, key: str, time: str, features: Sequence[str],
                  ordinal: str | None = None) -> StreamingQuery:
    """Start the query; it stops once the available input is used up."""
    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch={batch_id}"
        if _complete(batch.sparkSession, folder) and not batch.isEmpty() and _same_batch(batch, folder, key, time, features, ordinal):
            return
        materialize(batch, key, time, features, ordinal=ordinal).write.mode("overwrite").parquet(folder)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _same_batch(batch: DataFrame, folder: str, key: str, time: str, features: Sequence[str], ordinal: str | None) -> bool:
    """Whether a folder holds this batch's latest rows already: a replay, and not another stream's batch of that number."""
    latest = materialize(batch, key, time, features, ordinal=ordinal)
    held = batch.sparkSession.read.parquet(folder).select(*latest.columns)
    return latest.exceptAll(held).isEmpty()


def read_snapshot(spark: SparkSession, path: str, key: str, time: str, features: Sequence[str],
                  ordinal: str | None = None) -> DataFrame:
    """The latest row per key over the newest base and the batches after it. The frame stays readable for one publication."""
    known = pointers(spark, path)
    return _read(spark, path, known[-1] if known else None, batches(spark, path, known[-1].through if known else -1), key, time, features, ordinal)


def _read(spark: SparkSession, path: str, pointer: Pointer | None, numbers: Sequence[int], key: str, time: str,
          features: Sequence[str], ordinal: str | None) -> DataFrame:
    folders = [f"{path}/batch={n}" for n in numbers] + ([f"{path}/{pointer.base}"] if pointer else [])
    if not folders:
        raise ContractError(f"no snapshot at {path}")
    columns = [key, time, *([ordinal] if ordinal else []), *features]
    return materialize(spark.read.parquet(*folders).select(*columns), key, time, features, ordinal=ordinal)


def publish(spark: SparkSession, path: str, key: str, time: str, features: Sequence[str], ordinal: str | None = None) -> Pointer | None:
    """Fold the complete batches into a new base in place; None if there is nothing new.

    One publisher at a time: of two that fold the same publication, the second one fails and leaves nothing that is read.
    A batch that is not complete ends the fold, since later pointers would hide it.
    """
    known = pointers(spark, path)
    last = known[-1] if known else None
    through = last.through if last else -1
    complete = batches(spark, path, through)
    open_batches = {int(n.removeprefix("batch=")) for n in _names(spark, path) if n.startswith("batch=")} - set(complete)
    first_open = min((n for n in open_batches if n > through), default=None)
    folded = [n for n in complete if first_open is None or n < first_open]
    if not folded:
        return None
    version = last.version + 1 if last else 1
    pointer = Pointer(version, f"_bases/base-{version:012d}-{uuid4().hex}", folded[-1])
    _read(spark, path, last, folded, key, time, features, ordinal).write.parquet(f"{path}/{pointer.base}")
    _write_pointer(spark, path, pointer)
    # what only the publication before the last one needs
    for old in known[:-1]:
        _delete(spark, f"{path}/{old.base}")
        _delete(spark, f"{path}/_pointers/v{old.version:012d}.json")
    for n in batches(spark, path):
        if last and n <= last.through:
            _delete(spark, f"{path}/batch={n}")
    return pointer


def compact(spark: SparkSession, path: str, target: str, key: str, time: str, features: Sequence[str],
            ordinal: str | None = None) -> None:
    """The snapshot as one table of its own, elsewhere."""
    read_snapshot(spark, path, key, time, features, ordinal).write.mode("overwrite").parquet(target)
