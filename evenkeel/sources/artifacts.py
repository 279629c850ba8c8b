"""A data source of files with their length and SHA-256, read in blocks.

``spark.read.format("artifacts").load(path)`` has a row for each file below
``path``. Files are dealt to tasks by size, the largest first, and a task reads
its files as streams of a few megabytes, so a file of any size takes the same
memory. With the option ``blockBytes`` there is a row for each block of a file
instead, and blocks of one large file are dealt to many tasks.

The files are opened by Arrow's file systems (local, HDFS, S3, GCS); for a
mount table such as viewfs the driver looks up the store behind it.
"""

from __future__ import annotations

import fnmatch
import hashlib
import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Bytes read at once, bytes that a task should have, and tasks at most.
READ, TASK_BYTES, MOST_TASKS = 4 << 20, 256 << 20, 10_000

FILES = "path string, file_name string, byte_length bigint, observed_sha256 string"
BLOCKS = "path string, file_name string, byte_length bigint, block bigint, start bigint, block_length bigint, block_sha256 string"


@dataclass
class Pieces(InputPartition):
    """What a task reads: (path, length of the file, start, length) of files or blocks."""

    pieces: list[tuple[str, int, int, int]]


def dealt(pieces: Sequence[tuple[str, int, int, int]], tasks: int) -> list[list[tuple[str, int, int, int]]]:
    """Pieces by size, the largest first, each to the task that has least."""
    heap = [(0, i) for i in range(tasks)]
    out: list[list[tuple[str, int, int, int]]] = [[] for _ in range(tasks)]
    for piece in sorted(pieces, key=lambda p: (-p[3], p[0], p[2])):
        load, i = heapq.heappop(heap)
        out[i].append(piece)
        heapq.heappush(heap, (load + piece[3] + 1, i))
    return [x for x in out if x]


def digest(stream, length: int) -> str:
    """SHA-256 of the next ``length`` bytes of a stream."""
    h = hashlib.sha256()
    while length:
        part = stream.read(min(READ, length))
        if not part:
            raise OSError("a file is shorter than its listing")
        h.update(part)
        length -= len(part)
    return h.hexdigest()


class ArtifactReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.root, self.pattern = options["path"], options.get("pathglobfilter", "*")
        self.block, self.tasks = int(options.get("blockbytes", 0)), int(options.get("tasks", 0))

    def partitions(self) -> list[Pieces]:
        from pyarrow import fs as arrow_fs  # starts threads, so not before a worker is forked

        store, root = arrow_fs.FileSystem.from_uri(self.root)
        found = [store.get_file_info(root)]
        if found[0].type == arrow_fs.FileType.Directory:
            found = store.get_file_info(arrow_fs.FileSelector(root, recursive=True))
        elif found[0].type == arrow_fs.FileType.NotFound:
            raise FileNotFoundError(self.root)
        files = [(f.path, f.size) for f in found if f.type == arrow_fs.FileType.File and fnmatch.fnmatch(f.base_name, self.pattern) and not f.base_name.startswith((".", "_"))]
        pieces = [(p, n, at, min(self.block, n - at) if self.block else n) for p, n in files for at in (range(0, max(n, 1), self.block) if self.block else (0,))]
        total = sum(p[3] for p in pieces)
        tasks = self.tasks or min(MOST_TASKS, max(1, -(-total // TASK_BYTES)))
        return [Pieces(x) for x in dealt(pieces, tasks)] or [Pieces([])]

    def read(self, partition: Pieces) -> Iterator[tuple]:
        from pyarrow import fs as arrow_fs

        store, _ = arrow_fs.FileSystem.from_uri(self.root)
        for path, length, start, n in partition.pieces:
            name = path.rsplit("/", 1)[-1]
            if self.block:
                with store.open_input_file(path) as stream:
                    stream.seek(start)
                    yield path, name, length, start // self.block, start, n, digest(stream, n)
            else:
                with store.open_input_stream(path, buffer_size=0) as stream:
                    own = digest(stream, n)
                    if stream.read(1):
                        raise OSError("a file is longer than its listing")
                    yield path, name, length, own


class ArtifactSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "artifacts"

    def schema(self) -> str:
        return BLOCKS if int(self.options.get("blockBytes", 0)) else FILES

    def reader(self, schema) -> ArtifactReader:
        return ArtifactReader({k.lower(): v for k, v in self.options.items()})


def _resolved(spark: SparkSession, path: str) -> str:
    """The path in the store behind it, as a URI."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).resolvePath(p).toUri().toString()
    return "file://" + found.removeprefix("file:") if found.startswith("file:/") and not found.startswith("file://") else found


def scan_files(spark: SparkSession, path: str, pattern: str = "*", block_bytes: int = 0) -> DataFrame:
    """The files below ``path`` (``FILES``), or their blocks (``BLOCKS``); hidden and marker files are left out."""
    spark.dataSource.register(ArtifactSource)
    reader = spark.read.format("artifacts").option("pathGlobFilter", pattern).option("tasks", 0)
    return reader.option("blockBytes", block_bytes).load(_resolved(spark, path))


def scan_artifacts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``file_name, byte_length, observed_sha256`` of every file below ``path``; one read of each."""
    return scan_files(spark, path, pattern).select("file_name", "byte_length", "observed_sha256")


def block_digest(blocks: DataFrame) -> DataFrame:
    """``path, byte_length, blocks, sha256``: a digest of a file's block digests in order, by tasks of all its blocks."""
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "block_sha256"))), lambda x: x["block_sha256"]), "\n")
    return blocks.groupBy("path", "byte_length").agg(F.count("*").alias("blocks"), F.sha2(lines, 256).alias("sha256"))
