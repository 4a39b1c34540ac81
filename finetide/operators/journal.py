"""Answers of a paid service, noted as they come, so that a task that starts again does not ask twice.

A task notes its answers in small files of its own, each written whole, in a folder that all
executors reach. When it starts it reads what earlier attempts at its part have noted; files of
other partitionings, left by a run with other settings, are read as well. A note holds an id and
the answer. Two attempts at once, as under speculation, may still ask the same.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

from finetide.sources.artifacts import opened


@dataclass(frozen=True)
class Journal:
    """Where answers are noted: a folder with its scheme, and after how many answers a file is written.

    An answer is lost with its worker process until then; an error of the model or the service writes
    what there is.
    """

    folder: str
    every: int = 1

    def of_task(self, stage: str, tasks: int) -> TaskJournal:
        from pyspark import TaskContext

        return TaskJournal(f"{self.folder}/{stage}", TaskContext.get().partitionId(), tasks, max(1, self.every))


class TaskJournal:
    """The notes of one task; used as a context, which writes the last of them."""

    def __init__(self, folder: str, part: int, tasks: int, every: int) -> None:
        self.store, base = opened(folder)
        self.folder, self.every, self.new = f"{base}/{part}-of-{tasks}", every, []
        self.known: dict[int, Any] = {}
        for name in self._listed(base):
            of = name.rsplit("/", 1)[-1].rpartition("-of-")
            if of[2] != str(tasks) or of[0] == str(part):
                self._read(name)

    def _listed(self, folder: str) -> list[str]:
        from pyarrow import fs

        try:
            found = self.store.get_file_info(fs.FileSelector(folder, allow_not_found=True))
        except FileNotFoundError:  # another task made the folder while this one looked
            found = self.store.get_file_info(fs.FileSelector(folder))
        return [f.path for f in found if not f.base_name.startswith(".")]

    def _read(self, folder: str) -> None:
        for file in self._listed(folder):
            with self.store.open_input_stream(file) as stream:
                self.known.update((key, value) for key, value in map(json.loads, stream.read().decode().splitlines()))

    def answers(self, ids: list[int], ask: Callable[[list[int]], list[Any]], size: int = 1) -> list[Any]:
        """The answer of each id, known or asked for, ``size`` at a time."""
        open_ids = [i for i in ids if i not in self.known]
        for start in range(0, len(open_ids), size):
            part = open_ids[start : start + size]
            for key, value in zip(part, ask(part), strict=True):
                self.known[key] = value
                self.new.append((key, value))
            if len(self.new) >= self.every:
                self.flush()
        return [self.known[i] for i in ids]

    def flush(self) -> None:
        if not self.new:
            return
        self.store.create_dir(self.folder, recursive=True)
        name = uuid.uuid4().hex
        with self.store.open_output_stream(f"{self.folder}/.{name}") as stream:
            stream.write("".join(json.dumps(note) + "\n" for note in self.new).encode())
        self.store.move(f"{self.folder}/.{name}", f"{self.folder}/{name}.jsonl")
        self.new = []

    def __enter__(self) -> TaskJournal:
        return self

    def __exit__(self, *_: object) -> None:
        self.flush()
