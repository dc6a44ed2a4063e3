"""Publishing of files to another store: every file is listed, copied, verified, and shown at once."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkprep.plans.staging import delete, rename, stage, unstage
from sparkprep.sources.listing import list_files, system_of

BLOCK = 4 << 20
COPIED = "relative string, length bigint, md5 string"


class PublishError(Exception):
    """Copies that differ from their sources; nothing was shown."""


def _each(rows: DataFrame, act: Callable[[str], tuple]) -> DataFrame:
    """``relative, length, md5`` of what ``act`` does with each ``relative``; it runs in the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            found = [act(name) for name in names]
            arrays = [pa.array(names, pa.string()), pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, ["relative", "length", "md5"])

    return rows.select("relative").mapInArrow(run, COPIED)


def _digest(root: str, relative: str, copy: str | None = None) -> tuple[int, str]:
    """Length and MD5 of a file, read block by block, and copied on the way if ``copy`` names a place."""
    system, base = system_of(root)
    size, digest, out = 0, hashlib.md5(), None
    if copy is not None:
        other, place = system_of(copy)
        place = f"{place}/{relative}"
        other.create_dir(place.rpartition("/")[0], recursive=True)
        out = other.open_output_stream(place)
    with system.open_input_stream(f"{base}/{relative}") as stream:
        while block := stream.read(BLOCK):
            size += len(block)
            digest.update(block)
            if out:
                out.write(block)
    if out:
        out.close()
    return size, digest.hexdigest()


def _show(root: str, target: str, relative: str) -> tuple[int, None]:
    """Move a file to its name; a task that runs again finds it there."""
    system, base = system_of(root)
    place = f"{system_of(target)[1]}/{relative}"
    if system.get_file_info(f"{base}/{relative}").type != fs.FileType.NotFound:
        system.create_dir(place.rpartition("/")[0], recursive=True)
        system.move(f"{base}/{relative}", place)
    return system.get_file_info(place).size, None


def publish_files(spark: SparkSession, source: str, target: str, pattern: str = "*", recursive: bool = False) -> int:
    """Copy matching files, text or binary, empty ones too, to another store under their names and folders.

    1. The source is listed through its file system, in tasks.
    2. Tasks copy the files, block by block, to a hidden folder of the target, and note length and MD5.
    3. Other tasks read the copies again. If a length or MD5 differs from what was read, or from the listing, or a
       copy is missing, the hidden folder is deleted and :class:`PublishError` raised.
    4. Only then files get their names, and one manifest, which is written aside and renamed, says which
       files the run published: see :func:`published`. A file of a name that was there is replaced.

    A run that fails before the fourth step leaves nothing visible; one that fails in it leaves no
    manifest. A task that runs again replaces what it wrote. Returns the number of files.
    """
    run = uuid.uuid4().hex
    root = re.sub("^[a-z0-9]+:/*", "/", source).rstrip("/") + "/"
    listed = list_files(spark, source, pattern, recursive).select(F.substring_index("path", root, -1).alias("relative"), "length")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hidden = f"{target.rstrip('/')}/_incoming-{run}"
    try:
        copied = stage(_each(listed.select("relative").repartition(parts, "relative"), lambda name: _digest(source, name, hidden)), "publish-copies")
        again = _each(copied.select("relative").repartition(parts, "relative"), lambda name: _digest(hidden, name))
        pairs = copied.withColumnsRenamed({"length": "read", "md5": "read_md5"}).join(again, "relative", "full").join(listed.withColumnRenamed("length", "listed"), "relative", "full")
        fine = (F.col("length") == F.col("read")) & (F.col("length") == F.col("listed")) & (F.col("md5") == F.col("read_md5"))
        checked = stage(pairs.select("relative", "length", "md5", F.coalesce(fine, F.lit(False)).alias("fine")), "publish-checks")
        wrong = [r.relative for r in checked.filter("NOT fine").limit(5).collect()]
        if wrong:
            raise PublishError(f"copies differ: {wrong}")
        moved = _each(checked.select("relative").repartition(parts, "relative"), lambda name: _show(hidden, target, name))
        count = moved.agg(F.count("*")).first()[0]
        aside = f"{target.rstrip('/')}/_manifest-{run}"
        checked.select(F.col("relative").alias("path"), "length", "md5").write.parquet(aside)
        rename(spark, aside, f"{target.rstrip('/')}/_manifests/run={run}")
        for used in (copied, checked):
            unstage(used)
        return count
    finally:
        unstage(listed)
        delete(spark, hidden)


def published(spark: SparkSession, target: str) -> DataFrame:
    """``path, length, md5, run`` of the files that finished runs published; ``path`` is relative to the target."""
    return spark.read.schema("path string, length bigint, md5 string, run string").parquet(f"{target.rstrip('/')}/_manifests")


def checksums(files: DataFrame, root: str) -> DataFrame:
    """``relative, length, md5`` of files below ``root``, read block by block in the tasks."""
    return _each(files, lambda name: _digest(root, name))
