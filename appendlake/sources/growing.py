"""Growing CSV files as a streaming source: every batch reads the bytes that came since the last one.

The driver only lists sizes. A batch's plan is a file of ranges, ``(path, start, stop)``, and
the stream's offset is the number of that file, so an offset stays small however many
files there are; the map from path to byte is what the plans up to it add up to. Plans
are written before they are used and never change: after a restart the last one says
where the source stands, and a batch that is run again reads the same bytes.

``stop`` is a size as listed, anywhere inside a record. The task that reads a range finds
its last complete record and leaves a note of that place; the next range of the file
begins there. A note that is lost is found again by scanning the file from its start.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from appendlake.config import MIB
from appendlake.sources import pieces, records
from appendlake.sources.files import open_file_system

SCAN_BYTES = 16 * MIB
SNAPSHOT_EVERY = 100
ROWS = records.with_file_columns(T.StructType([T.StructField("record", T.StringType())]))


def put(path: str, content: bytes) -> None:
    """Write a file that appears whole or not at all."""
    fs, inner = open_file_system(path)
    fs.create_dir(inner.rpartition("/")[0], recursive=True)
    hidden = f"{inner}.{uuid.uuid4().hex}.part"
    with fs.open_output_stream(hidden) as out:
        out.write(content)
    fs.move(hidden, inner)


def get(path: str) -> bytes | None:
    fs, inner = open_file_system(path)
    if fs.get_file_info(inner).type != pafs.FileType.File:
        return None
    with fs.open_input_stream(inner) as source:
        return source.read()


def _note(state: str, path: str, place: int) -> str:
    return f"{state}/ends/{hashlib.md5(path.encode()).hexdigest()}-{place}"


class Plans:
    """The plans of a source: one file per batch, and now and then the whole map from path to byte."""

    def __init__(self, state: str) -> None:
        self.state = state
        self.last, self.known = self._restored()

    def _restored(self) -> tuple[int, dict[str, int]]:
        fs, inner = open_file_system(f"{self.state}/plans")
        found = fs.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
        names = [i.base_name for i in found if i.type == pafs.FileType.File and not i.base_name.endswith(".part")]
        numbers = sorted(int(n.removeprefix("plan-")) for n in names if n.startswith("plan-"))
        maps = sorted(int(n.removeprefix("map-")) for n in names if n.startswith("map-"))
        last = numbers[-1] if numbers else 0
        first = maps[-1] if maps else 0
        known = json.loads(get(f"{self.state}/plans/map-{first:012d}")) if maps else {}
        for number in range(first + 1, last + 1):
            known.update({path: stop for path, _, stop in self.ranges(number)})
        return last, known

    def ranges(self, number: int) -> list[tuple[str, int, int]]:
        content = get(f"{self.state}/plans/plan-{number:012d}")
        if content is None:
            raise FileNotFoundError(f"plan {number} of {self.state} is gone")
        return [tuple(r) for r in json.loads(content)]

    def add(self, ranges: list[tuple[str, int, int]]) -> int:
        self.last += 1
        put(f"{self.state}/plans/plan-{self.last:012d}", json.dumps(ranges).encode())
        self.known.update({path: stop for path, _, stop in ranges})
        if self.last % SNAPSHOT_EVERY == 0:
            put(f"{self.state}/plans/map-{self.last:012d}", json.dumps(self.known).encode())
        return self.last


@dataclass
class FileRange(InputPartition):
    path: str
    start: int
    stop: int


class GrowingCsv(DataSource):
    """``growing_csv``: options ``root`` (a folder of files), ``state`` (a folder all executors
    can reach, kept with the checkpoint), ``batch_bytes`` and ``file_bytes`` (the most that a
    batch takes in all and from one file)."""

    @classmethod
    def name(cls) -> str:
        return "growing_csv"

    def schema(self) -> T.StructType:
        return ROWS

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return GrowingReader(dict(self.options))


class GrowingReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.root, self.state = options["root"].rstrip("/"), options["state"].rstrip("/")
        self.batch_bytes = int(options.get("batch_bytes", 10_000 * MIB))
        self.file_bytes = int(options.get("file_bytes", 128 * MIB))
        self.plans: Plans | None = None

    def initialOffset(self) -> dict:
        return {"plan": 0}

    def latestOffset(self) -> dict:
        """Plan the next batch, if a file has grown. Nothing says how far the query is, so the
        plans do: each call goes on where the last plan, of this process or an earlier one, ended."""
        self.plans = self.plans or Plans(self.state)
        left, ranges = self.batch_bytes, []
        for path, size in self._sizes():
            start = self.plans.known.get(path, 0)
            stop = min(size, start + self.file_bytes, start + left)
            if stop > start:
                ranges.append((path, start, stop))
                left -= stop - start
        return {"plan": self.plans.add(ranges) if ranges else self.plans.last}

    def _sizes(self) -> Iterator[tuple[str, int]]:
        """Files by how far they are behind, so that none waits for ever behind large ones."""
        fs, inner = open_file_system(self.root)
        found = fs.get_file_info(pafs.FileSelector(inner, allow_not_found=True))
        files = [(f"{self.root}/{i.base_name}", i.size) for i in found if i.type == pafs.FileType.File and not i.base_name.startswith(".")]
        known = self.plans.known
        return iter(sorted(files, key=lambda f: (known.get(f[0], 0), f[0])))

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """A task per file: its ranges of several plans, if there are, are one."""
        plans = self.plans or Plans(self.state)
        whole: dict[str, FileRange] = {}
        for number in range(start["plan"] + 1, end["plan"] + 1):
            for path, begin, stop in plans.ranges(number):
                whole.setdefault(path, FileRange(path, begin, stop)).stop = stop
        return list(whole.values())

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        path, stop = partition.path, partition.stop
        start = self._begin(path, partition.start)
        end = pieces.complete_end(path, start, stop, SCAN_BYTES) if stop > start else None
        put(_note(self.state, path, stop), str(end or start).encode())
        if end is None:
            return
        fs, inner = open_file_system(path)
        modified = fs.get_file_info(inner).mtime or dt.datetime.fromtimestamp(0, dt.timezone.utc)
        for found in pieces.piece_records(path, start, end):
            n = len(found)
            columns = [found, pa.repeat(pa.scalar(modified, pa.timestamp("us", "UTC")), n), pa.repeat(pa.scalar(path), n)]
            yield pa.RecordBatch.from_arrays(columns, ROWS.names)

    def _begin(self, path: str, start: int) -> int:
        """The record end at or before ``start``: noted by the range before, or scanned for."""
        if start == 0:
            return 0
        noted = get(_note(self.state, path, start))
        if noted is not None:
            return int(noted)
        return pieces.complete_end(path, 0, start, SCAN_BYTES) or 0

    def commit(self, end: dict) -> None:
        """Batches up to ``end`` will not be run again, so the notes they began with can go.

        A run's last batch is not committed to it; the next run's first commit does both.
        """
        plans = self.plans or Plans(self.state)
        last = end["plan"]
        for path, start, _ in [r for n in range(max(1, last - 1), last + 1) for r in plans.ranges(n)]:
            fs, inner = open_file_system(_note(self.state, path, start))
            if start and fs.get_file_info(inner).type == pafs.FileType.File:
                fs.delete_file(inner)


def read_growing(
    spark: SparkSession, root: str, schema: T.StructType, state: str, keep_corrupt: bool = False, **limits: int
) -> DataFrame:
    """Typed rows of the complete records that the files below ``root`` gain; ``limits`` are options of the source.

    A half-written record waits for its end. A file that shrank waits until it is longer
    than before. ``keep_corrupt`` adds a boolean column that marks rows that do not parse.
    """
    spark.dataSource.register(GrowingCsv)
    stream = spark.readStream.format(GrowingCsv.name()).option("root", root).option("state", state)
    for name, value in limits.items():
        stream = stream.option(name, value)
    return records.parsed(stream.load(), schema, keep_corrupt)
