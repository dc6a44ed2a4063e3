"""Listings of folders through their file system, in tasks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from fnmatch import fnmatchcase
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sparkprep.plans.staging import stage

ENTRY = "path string, modificationTime timestamp, length bigint, folder boolean"
ROWS = 10_000
BYTES = 4 << 20


def system_of(path: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a path, local or in a store, and the path within it."""
    local = path.startswith("file:")
    system, base = fs.FileSystem.from_uri("/" + path[5:].lstrip("/") if local else path.replace("s3a:", "s3:", 1))
    return system, base.rstrip("/")


def _prefix(path: str, base: str) -> str:
    """What Spark writes before the path within a file system."""
    return "file:" if path.startswith(("file:", "/")) else path.rstrip("/").removesuffix(base)


def _hidden(name: str) -> bool:
    """What Spark's scans pass over."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _patterns(pattern: str) -> list[str]:
    """A pattern of Spark's scans as patterns without ``{a,b}`` and ``[^…]``."""
    choice = re.search(r"\{([^{}]*)\}", pattern)
    if not choice:
        return [pattern.replace("[^", "[!")]
    before, after = pattern[: choice.start()], pattern[choice.end() :]
    return [p for one in choice[1].split(",") for p in _patterns(before + one + after)]


def list_files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = False) -> DataFrame:
    """``path, modificationTime, length`` of the files whose name matches, those of length 0 as well.

    Spark's own scans leave empty files out. Here tasks list the folders of one level at a time, so
    there are as many rounds as levels. The pattern knows ``*``, ``?``, ``[…]`` and ``{…,…}``. Names that begin
    with ``_`` (and have no ``=``) or ``.`` are hidden, as in Spark's scans.
    """
    patterns = _patterns(pattern)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                system, base = system_of(folder)
                prefix = _prefix(folder, base)
                own = system.get_file_info(base)
                entries = [own] if own.type == fs.FileType.File else system.get_file_info(fs.FileSelector(base))
                shown = [e for e in entries if not _hidden(e.base_name)]
                shown = [e for e in shown if e.type == fs.FileType.Directory or any(fnmatchcase(e.base_name, p) for p in patterns)]
                for begin in range(0, len(shown), ROWS):
                    part = shown[begin : begin + ROWS]
                    times = [datetime.fromtimestamp((e.mtime_ns or 0) / 1e9, timezone.utc) for e in part]
                    arrays = [
                        pa.array([prefix + e.path for e in part], pa.string()),
                        pa.array(times, pa.timestamp("us", "UTC")),
                        pa.array([e.size or 0 for e in part], pa.int64()),
                        pa.array([e.type == fs.FileType.Directory for e in part]),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, ["path", "modificationTime", "length", "folder"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folders, number, found = spark.createDataFrame([(path,)], "path string"), 1, []
    while True:
        entries = stage(folders.repartition(min(parts, number)).mapInArrow(look, ENTRY), "listing")
        found.append(entries.filter("NOT folder").drop("folder"))
        folders = entries.filter("folder").select("path")
        number = folders.count() if recursive else 0
        if not number:
            return reduce(DataFrame.unionByName, found)


def contents(root: str) -> Callable[..., Column]:
    """A function of the paths that :func:`list_files` gives below ``root``: their bytes, read in the tasks."""

    @F.arrow_udf("binary")
    def read(paths: Iterator[pa.Array]) -> Iterator[pa.Array]:
        system, base = system_of(root)
        skip = len(_prefix(root, base))
        for batch in paths:
            held, size = [], 0
            for path in batch.to_pylist():
                with system.open_input_file(path[skip:]) as file:
                    held.append(file.read())
                size += len(held[-1])
                if size >= BYTES:
                    yield pa.array(held, pa.binary())
                    held, size = [], 0
            if held:
                yield pa.array(held, pa.binary())

    return read
