"""What the BAM and BCF sources share: byte ranges as partitions, record starts at range borders, and complete files per task."""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSourceArrowWriter, InputPartition, WriterCommitMessage

from . import files
from .bgzf import Reader, Writer, read_block

if TYPE_CHECKING:  # each of the driver's workers for a source would hold pandas in memory
    import pandas as pd

#: Compressed bytes that a task reads about.
SPLIT_BYTES = 64 << 20
END = 1 << 62
#: A record start is believed if so many records follow each other from it (or all that the file still has).
CHAIN = 6
_MAGIC = b"\x1f\x8b\x08\x04"


@dataclass
class Range(InputPartition):
    """Bytes of one file; the task finds the records that begin there."""

    path: str = ""
    start: int = 0
    end: int = 0


def ranges(path: str, suffix: str, split_bytes: int) -> list[Range]:
    """Cut all files by their sizes; nothing is opened here, so planning costs one listing."""
    out = []
    for name, size in files.listing(path, suffix):
        cuts = [*range(0, max(size, 1), split_bytes), END]
        if len(cuts) > 2 and size - cuts[-2] < split_bytes // 4:
            del cuts[-2]
        out += [Range(name, a, b) for a, b in zip(cuts, cuts[1:])]
    return out or [Range()]


def next_block(file, at: int, size: int) -> int:
    """Offset of the first block at or behind ``at``: its magic number, a readable block, and another one (or the end) behind."""
    step = 1 << 17
    while at < size:
        file.seek(at)
        data = file.read(step)
        p = data.find(_MAGIC)
        while p >= 0:
            try:
                _, after = read_block(file, at + p)
                if after >= size or read_block(file, after):
                    return at + p
            except (ValueError, zlib.error, struct.error):  # no block, whatever its first bytes say
                pass
            p = data.find(_MAGIC, p + 1)
        at += max(1, len(data) - 3)
        if len(data) < step:
            break
    return size


def record_start(path: str, at: int, first: int, length: Callable[[bytes, int], int]) -> int:
    """Virtual position of the first record that begins in a block at or behind byte ``at``.

    ``first`` is the position of the file's first record. ``length(data, i)`` is the size of the record that begins at i, 0
    if the data end before that is known, -1 if none can begin there.
    """
    if at <= first >> 16:
        return first
    with Reader(path) as r:
        size = r.size()
        block = next_block(r.file, at, size)
        while block < size:
            data, after = read_block(r.file, block)
            if not data:
                return END
            ahead, here = data, after
            while len(ahead) < len(data) + (1 << 18) and here < size:
                more, nxt = read_block(r.file, here)
                if nxt == here:
                    break
                ahead, here = ahead + more, nxt
            for i in range(len(data)):
                if _chain(ahead, i, length, here >= size):
                    return block << 16 | i
            block = after
    return END


def _chain(data: bytes, i: int, length: Callable[[bytes, int], int], whole: bool) -> bool:
    for k in range(CHAIN):
        if i == len(data) and whole:
            return k > 0
        n = length(data, i)
        if n < 0:
            return False
        if n == 0 or i + n > len(data):
            return k > 0 and not whole or k == 0 and n > 0 and not whole
        i += n
    return True


def bounds(part: Range, known: Sequence[int], first: int, length: Callable[[bytes, int], int]) -> tuple[int, int]:
    """The virtual positions between which the part's records begin; neighbours find the same position at their border."""

    def place(at: int) -> int:
        if at <= 0:
            return first
        if at >= END:
            return END
        if known:
            i = bisect_left(known, at << 16)
            return known[i] if i < len(known) else END
        return record_start(part.path, at, first, length)

    return place(part.start), place(part.end)


def chunk_parts(part: Range, chunks: Sequence[tuple[int, int]], first: int, length: Callable[[bytes, int], int]) -> Iterator[tuple[int, int]]:
    """Of the chunks that an index names, the stretches whose records begin in the part's bytes."""
    for x, y in chunks:
        low, high = max(x, part.start << 16), min(y, part.end << 16)
        if low < high:
            yield (x if low == x else record_start(part.path, part.start, first, length)), high


@dataclass
class Written(WriterCommitMessage):
    """Files of a task: (temporary, final)."""

    moves: list[tuple[str, str]] = field(default_factory=list)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        names = batch.schema.names
        for values in zip(*(c.to_pylist() for c in batch.columns)):
            yield dict(zip(names, values))


class FileWriter(DataSourceArrowWriter):
    """One complete file per task, under a name of its own job; the files appear when the job commits.

    ``append`` leaves all files that are there, ``overwrite`` removes them after the new ones are complete.
    """

    suffix = index_suffix = ""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.options, self.overwrite, self.job = options["path"], options, overwrite, uuid.uuid4().hex[:12]

    def fill(self, writer: Writer, rows: Iterator[dict]) -> bytes | None:
        """Write header and records; return the index if one is wanted."""
        raise NotImplementedError

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        from pyspark import TaskContext

        task = TaskContext.get()
        base = self.path.rstrip("/")
        name = f"part-{task.partitionId():05d}-{self.job}{self.suffix}"
        temporary = f"{base}/_{name}.{task.taskAttemptId()}"
        with Writer(temporary, int(self.options.get("level", 6))) as w:
            index = self.fill(w, _rows(iterator))
        moves = [(temporary, f"{base}/{name}")]
        if index is not None:
            with files.open_output(f"{temporary}{self.index_suffix}") as out:
                out.write(index)
            moves.insert(0, (f"{temporary}{self.index_suffix}", f"{base}/{name}{self.index_suffix}"))
        return Written(moves)

    def commit(self, messages: list[Written]) -> None:
        old = [p for s in (self.suffix, self.index_suffix) for p, _ in files.listing(self.path, s)] if self.overwrite else []
        for m in messages:
            for temporary, final in m.moves if m else ():
                files.move(temporary, final)
        for path in old:
            files.remove(path)

    def abort(self, messages: list[Written]) -> None:
        for m in messages:
            for temporary, _ in m.moves if m else ():
                files.remove(temporary)


def for_each_file(spark: SparkSession, path: str, suffix: str, work: Callable[[str], int]) -> DataFrame:
    """``path, n_records``: ``work`` done for each file of a folder, one task a file."""
    names = [(p,) for p, _ in files.listing(path, suffix)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(n_records=[work(p) for p in pdf["path"]])

    rows = spark.createDataFrame(names, "path string").repartition(max(1, len(names)), "path")
    return rows.mapInPandas(run, "path string, n_records long")
