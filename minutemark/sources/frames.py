"""A data source of sampled video frames, a partition for each video.

``spark.read.format("video_frames").option("decoder", "module:function").load(folder)``
``path`` is a file or folder, or ``inputs`` a JSON list of them, as URIs or paths that
every executor reaches. ``shard`` "i/n" takes the videos whose place among all is i modulo n.
A video that can't be opened or decoded gives a last row without pixels but with ``error``.
The decoder is called with a path and yields the frame rate first, then frames
as arrays of BGR bytes. The default reads ``.npy`` stacks of frames.
"""

from __future__ import annotations

import importlib
import json
import os
from collections.abc import Iterator

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def npy_frames(path: str) -> Iterator:
    """Frames of a saved array (n, height, width, 3), at the rate of 25 or of ``<path>.fps``."""
    rate = path + ".fps"
    yield float(open(rate).read()) if os.path.exists(rate) else 25.0
    yield from np.load(path, mmap_mode="r")


class Video(InputPartition):
    def __init__(self, path: str):
        self.path = path


class FramesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.inputs = json.loads(options["inputs"]) if "inputs" in options else [options["path"]]
        self.shard = tuple(map(int, options.get("shard", "0/1").split("/")))
        self.suffixes = tuple(options.get("suffixes", ".npy").split(","))
        self.decoder = options.get("decoder", "minutemark.sources.frames:npy_frames")
        self.rate = float(options.get("sampling_rate", 1.0))
        self.done, self.done_suffix = options.get("done"), options.get("done_suffix", "")
        self.start, self.most = float(options.get("start_seconds", 0)), float(options.get("max_seconds", "inf"))

    def partitions(self) -> list[Video]:
        found = sorted({path for given in self.inputs for path in self._videos(given)})
        return [Video(path) for path in found[self.shard[0] :: self.shard[1]]] or [Video("")]

    def _videos(self, given: str) -> list[str]:
        """A file's own path, or those in a folder (not below it), as the executors are to open them."""
        from pyarrow import fs

        remote = "://" in given and not given.startswith("file://")
        store, path = fs.FileSystem.from_uri(given if "://" in given else "file://" + os.path.abspath(given))
        if store.get_file_info(path).type == fs.FileType.File:
            return [given if remote else path]
        names = [f.base_name for f in store.get_file_info(fs.FileSelector(path)) if f.is_file and f.base_name.lower().endswith(self.suffixes)]
        return [f"{(given if remote else path).rstrip('/')}/{n}" for n in names]

    def _finished(self, meeting: str) -> bool:
        """Whether the folder ``done`` has this meeting's output: then the video isn't opened."""
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(self.done)
        return store.get_file_info(f"{folder}/{meeting}{self.done_suffix}").type != fs.FileType.NotFound

    def read(self, partition: Video) -> Iterator[tuple]:
        if not partition.path:
            return
        meeting = os.path.basename(partition.path).rsplit(".", 1)[0]
        if self.done and self._finished(meeting):
            return
        module, name = self.decoder.split(":")
        decode = getattr(importlib.import_module(module), name)
        try:
            for row in self._sampled(decode(partition.path)):
                yield meeting, *row, None
        except Exception as e:  # one bad video is not the job's end
            yield meeting, None, None, None, None, None, f"{type(e).__name__}: {e}"

    def _sampled(self, frames: Iterator) -> Iterator[tuple]:
        fps = next(frames) or 25.0
        step, begin = max(1, round(fps / self.rate)), int(self.start * fps)
        for n, frame in enumerate(frames):
            if n >= begin + self.most * fps:
                break
            if n >= begin and (n - begin) % step == 0:
                image = np.ascontiguousarray(frame, np.uint8)
                yield n, round(n / fps * 1e6), image.shape[0], image.shape[1], image.tobytes()


class VideoFrames(DataSource):
    @classmethod
    def name(cls) -> str:
        return "video_frames"

    def schema(self) -> str:
        return "meeting string, frame_ord long, t_us long, height int, width int, pixels binary, error string"

    def reader(self, schema) -> FramesReader:
        return FramesReader(self.options)


def read_frames(spark: SparkSession, inputs: str | list[str], **options):
    spark.dataSource.register(VideoFrames)
    reader = spark.read.format("video_frames").options(**options)
    return reader.load(inputs) if isinstance(inputs, str) else reader.option("inputs", json.dumps(inputs)).load()
