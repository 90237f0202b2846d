"""A priority queue of messages that moves what exceeds its limit into sorted files of the shared folder.

Used inside one task for time-forward processing: a node's messages are pushed before the node comes up, and
taken out when it does.  Messages for one key are summed as they are taken.  A file is read again batch by
batch and deleted at its end; a task that is lost leaves files that nobody reads, and runs again.
"""

from __future__ import annotations

import heapq
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs

Key = tuple[int, bytes]
RUN_SCHEMA = pa.schema([("order", pa.int64()), ("name", pa.binary()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64())])


class SpillQueue:
    """Sums of three numbers by key (order, name); keys must be taken in ascending order."""

    def __init__(self, folder: str, limit: int = 500_000, batch: int = 8192, max_runs: int = 32):
        self.folder, self.limit, self.batch, self.max_runs = folder, limit, batch, max_runs
        self.heap: list[tuple[Key, int, int, int]] = []
        self.runs: list[tuple[tuple[Key, int, int, int], int, Iterator]] = []  # a heap by the next message of each file
        self.spilled = 0

    def push(self, key: Key, a: int, b: int, c: int) -> None:
        heapq.heappush(self.heap, (key, a, b, c))
        if len(self.heap) > self.limit:
            self._spill()

    def take(self, key: Key) -> tuple[int, int, int]:
        """The sums of all messages for ``key``; (0, 0, 0) without any."""
        a = b = c = 0
        while self.heap and self.heap[0][0] == key:
            _, x, y, z = heapq.heappop(self.heap)
            a, b, c = a + x, b + y, c + z
        while self.runs and self.runs[0][0][0] == key:
            (_, x, y, z), number, rest = self.runs[0]
            a, b, c = a + x, b + y, c + z
            follows = next(rest, None)
            if follows is None:
                heapq.heappop(self.runs)
            else:
                heapq.heapreplace(self.runs, (follows, number, rest))
        return a, b, c

    def _spill(self) -> None:
        messages: Iterator = iter(sorted(self.heap))
        self.heap = []
        if len(self.runs) >= self.max_runs:  # few files stay open: all become one
            messages = heapq.merge(messages, *(self._with_first(first, rest) for first, _, rest in self.runs))
            self.runs = []
        rest = self._read(self._write(messages))
        self.spilled += 1
        heapq.heappush(self.runs, (next(rest), self.spilled, rest))

    @staticmethod
    def _with_first(first: tuple, rest: Iterator) -> Iterator:
        yield first
        yield from rest

    def _write(self, messages: Iterator) -> str:
        path = f"{self.folder}/run-{uuid.uuid4().hex}.arrow"
        system, at = pa.fs.FileSystem.from_uri(path)
        system.create_dir(at.rsplit("/", 1)[0], recursive=True)
        with system.open_output_stream(at) as sink, pa.ipc.new_stream(sink, RUN_SCHEMA) as out:
            part = []
            for m in messages:
                part.append(m)
                if len(part) == self.batch:
                    out.write_batch(self._batch(part))
                    part = []
            if part:
                out.write_batch(self._batch(part))
        return path

    @staticmethod
    def _batch(part: list) -> pa.RecordBatch:
        columns = zip(*((k[0], k[1], a, b, c) for k, a, b, c in part))
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, RUN_SCHEMA)], schema=RUN_SCHEMA)

    @staticmethod
    def _read(path: str) -> Iterator:
        system, at = pa.fs.FileSystem.from_uri(path)
        with system.open_input_stream(at) as source, pa.ipc.open_stream(source) as batches:
            for batch in batches:
                for order, name, a, b, c in zip(*(col.to_pylist() for col in batch.columns)):
                    yield (order, name), a, b, c
        system.delete_file(at)
