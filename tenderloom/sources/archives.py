"""ZIP archives: a task reads an archive's directory, others its members, each inflated as it is read.

Tasks open archives themselves, at the places they need: local and mounted
paths by the operating system, others (``hdfs``, ``s3`` and so on) by Arrow's file
systems.  Members of more than 4 GB and archives of more than 65,535 members
(ZIP64) are read like others.
"""

from __future__ import annotations

import gzip
import io
import math
import re
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship

LINES_AT_ONCE = 10_000
BYTES_AT_ONCE = 8 << 20
BROKEN = (zipfile.BadZipFile, zlib.error, EOFError)
TASK_BYTES = 64 << 20  # of inflated members


def local_path(path: str) -> str | None:
    """The operating system's name of a path, if it is one."""
    found = re.fullmatch(r"(?:file:(?://[^/]*)?)?(/.*)", path)
    return found and found[1]


def opened(path: str):
    """A readable file with random access."""
    own = local_path(path)
    if own is not None:
        return open(own, "rb")
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


def members_of(spark: SparkSession, path: str | list[str], pattern: str = "*.zip", suffix: str = "") -> DataFrame:
    """Rows (path, file, member, number, size): the archives' directories.  What is no archive gives no rows."""
    ship(spark)
    # contents are not read: of a file only its name is asked for
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path")

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                try:
                    with opened(archive) as f, zipfile.ZipFile(f) as z:
                        found = [(k, m.filename, m.file_size) for k, m in enumerate(z.infolist()) if not m.is_dir() and m.filename.endswith(suffix)]
                except zipfile.BadZipFile:
                    continue
                n = len(found)
                columns = [[archive] * n, [archive.rsplit("/", 1)[-1]] * n, [m for _, m, _ in found], [k for k, _, _ in found], [s for _, _, s in found]]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, [pa.string()] * 3 + [pa.int64()] * 2)], ["path", "file", "member", "number", "size"])

    return files.mapInArrow(listed, "path string, file string, member string, number long, size long")


def member_lines(members: DataFrame) -> DataFrame:
    """file, member, line of the given members, in tasks of about ``TASK_BYTES``; a member that breaks off gives the lines before that."""
    spark = members.sparkSession
    total = members.agg(F.count("*"), F.sum("size")).first()
    tasks = max(1, min(total[0], max(spark.sparkContext.defaultParallelism, math.ceil((total[1] or 0) / TASK_BYTES))))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, archive, file = None, None, None
        for batch in batches:
            for path, number in zip(*(batch.column(c).to_pylist() for c in ("path", "number"))):
                if path != last:
                    if file:
                        file.close()
                    file = opened(path)
                    last, archive = path, zipfile.ZipFile(file)
                yield from member(archive, archive.infolist()[number], path.rsplit("/", 1)[-1])
        if file:
            file.close()

    def member(archive, info, name: str) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        with archive.open(info) as f:
            while True:
                try:
                    raw = f.readline()
                except BROKEN:
                    raw = b""
                if raw:
                    rows.append(raw.decode("utf-8", "replace").rstrip("\r\n"))
                    size += len(raw)
                if rows and (not raw or len(rows) == LINES_AT_ONCE or size > BYTES_AT_ONCE):
                    yield pa.record_batch([pa.array([x] * len(rows), pa.string()) for x in (name, info.filename)] + [pa.array(rows, pa.string())], ["file", "member", "line"])
                    rows, size = [], 0
                if not raw:
                    return

    # a given number of partitions is not merged, however small the rows are
    dealt = members.select("path", "number").repartition(tasks, F.xxhash64("path", "number"))
    return dealt.sortWithinPartitions("path", "number").mapInArrow(lines, "file string, member string, line string")


def write_archives(texts: DataFrame, folder: str) -> int:
    """Write an archive per row (name, member, text) into a folder; returns how many.  A task that is repeated writes the same files.

    An archive is written under another name and renamed once it is whole.
    """
    ship(texts.sparkSession)

    def written(rows: pa.Table) -> pa.Table:
        for name, member, text in zip(*(rows.column(k).to_pylist() for k in ("name", "member", "text"))):
            raw = io.BytesIO()
            with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(zipfile.ZipInfo(member), text or "", zipfile.ZIP_DEFLATED)
            put(f"{folder}/{name}", raw.getvalue())
        return pa.table({"n": pa.array([rows.num_rows], pa.int64())})

    # a batch of rows would hold as many texts as a task has; a group holds one
    rows = texts.select("name", "member", "text").groupBy("name").applyInArrow(written, "n long")
    return rows.agg(F.sum("n")).first()[0] or 0


def write_packed(texts: DataFrame, folder: str, name: str, size: int, whole: Callable[[int, list[str]], str]) -> int:
    """Write the texts (one column) into gzipped files of ``size`` texts, as they lie in their tasks; returns how many files.

    ``whole`` makes a file's text of its number in the task and its texts, and
    ``name`` has a place for that file's key.  No text is shuffled.  A file is
    renamed once it is whole, and a task that is repeated writes the same files,
    if its rows come in the same order.
    """
    ship(texts.sparkSession)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, held = TaskContext.get().partitionId(), 0, []

        def flush() -> None:
            nonlocal n, held
            put(f"{folder}/{name.format(f'{part}_{n}')}", gzip.compress(whole(n, held).encode(), 6, mtime=0))
            n, held = n + 1, []

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(text)
                if len(held) == size:
                    flush()
        if held:
            flush()
        yield pa.record_batch([pa.array([n], pa.int64())], ["n"])

    return texts.mapInArrow(written, "n long").agg(F.sum("n")).first()[0] or 0


def put(path: str, raw: bytes) -> None:
    from pyarrow import fs

    own = local_path(path)
    system, place = (fs.LocalFileSystem(), own) if own is not None else fs.FileSystem.from_uri(path)
    system.create_dir(place.rsplit("/", 1)[0], recursive=True)
    fresh = f"{place}.{uuid.uuid4().hex}"
    with system.open_output_stream(fresh) as f:
        f.write(raw)
    system.move(fresh, place)
