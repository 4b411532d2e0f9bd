"""A Spark data source that writes files of given names, all of them or none: a file for each row, or one file of all rows.

Tasks write drafts into a folder of the job; the job's commit moves those of the successful attempts to their places
and deletes the folder, its abort only deletes it. So neither a failed attempt nor a failed job leaves anything behind.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Bytes that are copied at once when pieces become one file.
BLOCK = 8 << 20


@dataclass
class Drafted(WriterCommitMessage):
    """What one task has drafted: its folder, how many rows, and the order of the first of them."""

    folder: str
    rows: int
    first: list


class NamedFilesWriter(DataSourceWriter):
    """Rows are (name, value): a file each; or, with option ``whole``, (section, pos, value): pieces of that file in this order."""

    def __init__(self, options: dict[str, str]):
        self.path, self.job, self.whole = options["path"], options["job"], options.get("whole")
        self.overwrite = options.get("overwrite", "false") == "true"

    def _store(self):
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(self.path)
        return store, folder, f"{folder}/_drafts-{self.job}"

    def write(self, iterator: Iterator[Row]) -> Drafted:
        from pyarrow import fs
        from pyspark import TaskContext

        store, folder, drafts = self._store()
        mine = f"{drafts}/{TaskContext.get().taskAttemptId()}"
        store.create_dir(mine, recursive=True)
        if self.whole:
            rows, first = 0, []
            with store.open_output_stream(f"{mine}/piece") as out:
                for row in iterator:
                    first = first or [row[0], row[1]]
                    out.write(row[2].encode())
                    rows += 1
            return Drafted(mine, rows, first)
        rows = 0
        for row in iterator:
            if self.overwrite or store.get_file_info(f"{folder}/{row[0]}").type == fs.FileType.NotFound:
                with store.open_output_stream(f"{mine}/{row[0]}") as out:
                    out.write((row[1] or "").encode())
                rows += 1
        return Drafted(mine, rows, [])

    def commit(self, messages: list[Drafted | None]) -> None:
        from pyarrow import fs

        store, folder, drafts = self._store()
        done = [m for m in messages if m and m.rows]
        if self.whole:
            with store.open_output_stream(f"{drafts}/whole") as out:
                for m in sorted(done, key=lambda m: m.first):
                    with store.open_input_stream(f"{m.folder}/piece") as piece:
                        while block := piece.read(BLOCK):
                            out.write(block)
            store.move(f"{drafts}/whole", f"{folder}/{self.whole}")
        else:
            for m in done:
                for file in store.get_file_info(fs.FileSelector(m.folder)):
                    store.move(file.path, f"{folder}/{file.base_name}")
        with store.open_output_stream(f"{folder}/_written-{self.job}") as out:
            out.write(json.dumps(sum(m.rows for m in done)).encode())
        self._clean(store, drafts)

    def abort(self, messages: list[Drafted | None]) -> None:
        store, _, drafts = self._store()
        self._clean(store, drafts)

    @staticmethod
    def _clean(store, drafts: str) -> None:
        from pyarrow import fs

        if store.get_file_info(drafts).type != fs.FileType.NotFound:
            store.delete_dir(drafts)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return NamedFilesWriter(dict(self.options))


def _save(rows: DataFrame, path: str, **options: str) -> int:
    from pyarrow import fs

    spark: SparkSession = rows.sparkSession
    spark.dataSource.register(NamedFiles)
    store, folder = fs.FileSystem.from_uri(path)
    store.create_dir(folder, recursive=True)
    job = uuid.uuid4().hex
    rows.write.format("named_files").mode("append").options(path=path, job=job, **options).save()
    told = f"{folder}/_written-{job}"
    with store.open_input_stream(told) as file:
        written = json.loads(file.read())
    store.delete_file(told)
    return written


def write_named(rows: DataFrame, path: str, suffix: str, overwrite: bool = False) -> int:
    """Write ``value`` of each (meeting, value) to ``path``/<meeting><suffix>; returns how many files were written.

    Where a file exists it is left as it is unless ``overwrite``. ``path`` is a URI that the whole cluster reaches.
    """
    named = rows.select(F.concat(F.col("meeting").cast("string"), F.lit(suffix)).alias("name"), F.col("value").cast("string").alias("value"))
    return _save(named, path, overwrite=str(overwrite).lower())


def write_whole(rows: DataFrame, path: str, name: str) -> int:
    """Write one file ``path``/``name`` of all rows' ``value`` in the order of section and pos; returns the number of rows.

    Each task writes its range of the order; the ranges are put together when the job is committed, block by block.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = rows.select("section", "pos", "value").repartitionByRange(n, "section", "pos").sortWithinPartitions("section", "pos")
    return _save(sorted_, path, whole=name)
