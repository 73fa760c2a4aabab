"""Steps of a descent over pieces of packed rows.

A step needs the sums of the step before it over all pieces. Where all pieces can be scanned at the same
time, one job with a task per share of them makes many steps: each task writes its sums to the shared folder,
reads those of the others, and all work out the same next state. Otherwise, and where that takes longer, every
step is a job of its own whose sums meet on the driver.

Weights of a ``wide`` column lie with their pieces: in memory during a job, in the shared folder between jobs.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JError
from pyarrow import fs
from pyspark import StorageLevel
from pyspark.sql import DataFrame

from headway.operators.grouped import add_grouped
from headway.operators.pieces import Pieces, mapped
from headway.session import own, shared_folder

# Bytes that the tasks of a job may read from each other in a step, and how many may.
EXCHANGED_BYTES = 1 << 28
EXCHANGING_TASKS = 32
# Steps of the job that is timed against a job per step.
TRIED_STEPS = 10
# Seconds without the sums of another task until a task gives up.
PATIENCE = 600.0
# Places of a total behind the slopes: of weights that are none, squared weights and squared slopes of a piece.
BEHIND = 3


class Folder:
    """Small files that tasks leave for each other; a file is there whole or not at all."""

    def __init__(self, uri: str):
        self.store, self.path = fs.FileSystem.from_uri(uri)
        self.store.create_dir(self.path, recursive=True)

    def put(self, name: str, values: np.ndarray) -> None:
        part = f"{self.path}/.{name}.{uuid.uuid4().hex}"
        with self.store.open_output_stream(part) as sink:
            sink.write(values.tobytes())
        self.store.move(part, f"{self.path}/{name}")

    def has(self, name: str) -> bool:
        return self.store.get_file_info(f"{self.path}/{name}").type == fs.FileType.File

    def get(self, name: str) -> np.ndarray:
        with self.store.open_input_stream(f"{self.path}/{name}") as source:
            return np.frombuffer(source.read())

    def awaited(self, name: str) -> np.ndarray:
        began = time.monotonic()
        while not self.has(name):
            waited = time.monotonic() - began
            if waited > PATIENCE:
                raise TimeoutError(f"no {name} in {self.path}")
            time.sleep(min(0.0005 + waited / 100, 0.05))
        return self.get(name)

    def drop(self, name: str) -> None:
        if self.has(name):
            self.store.delete_file(f"{self.path}/{name}")


class Share:
    """The pieces of a task with the weights that lie with them."""

    def __init__(self, paths: list[str], rules, tails: str, step: int):
        self.paths, self.rules = paths, rules
        self.folder = Folder(tails) if tails else None
        self.tails = {p: self._tail(p, step) for p in paths} if tails else {}

    def _tail(self, path: str, step: int) -> np.ndarray:
        """Weights of a piece after a step, behind a zero for rows without one."""
        if step >= 0:
            return self.folder.get(_tail_name(path, step)).copy()
        return np.concatenate([[0.0], *(np.frombuffer(b.column(3)[0].as_buffer()) for b in mapped(path))])

    def sums(self, state) -> np.ndarray:
        """The sums of a step; the weights that lie with the pieces are one step on."""
        weights, rules = np.append(state.weights, 0.0), self.rules
        total = np.zeros(2 + len(state.weights) + BEHIND)
        for path in self.paths:
            tail = self.tails.get(path)
            turned = None if tail is None else np.zeros(len(tail))
            for batch in mapped(path):
                add_grouped(total[: 1 - BEHIND], state.bias, weights, rules.eps, batch, tail, turned)
            if tail is not None:
                slope = turned[1:] / rules.rows + rules.alpha * tail[1:]
                tail[1:] -= rules.rate * slope
                total[-2] += tail[1:] @ tail[1:]
                total[-1] += slope @ slope
        return total

    def save(self, step: int) -> None:
        for path, tail in self.tails.items():
            self.folder.put(_tail_name(path, step), tail)


def _tail_name(path: str, step: int) -> str:
    return f"{path.split('/')[-1]}-{step}"


def _after(rules, state, total: np.ndarray):
    return rules.after(state, total[:-BEHIND], (total[-2], total[-1]))


class Steps:
    """Makes the steps of a descent; ``wide`` rows have weights that lie with the pieces."""

    def __init__(self, pieces: Pieces, rules, size: int, wide: bool = False):
        self.pieces, self.rules, self.context = pieces, rules, pieces.context
        work = f"{shared_folder(pieces.spark)}/headway/steps-{uuid.uuid4().hex}"
        own(work)
        self.work, self.tails = work, f"{work}/tails" if wide else ""
        self.tail_step = -1  # that the weights of the pieces are written of; -1: as packed
        tasks = min(len(pieces.paths), _slots(self.context))
        exchanged = tasks * tasks * 8 * (2 + size + BEHIND)
        self.together = 0 < tasks <= EXCHANGING_TASKS and exchanged <= EXCHANGED_BYTES
        self.shares = pieces.files
        if self.together and tasks < len(pieces.paths):
            dealt = [(k, pieces.paths[k::tasks]) for k in range(tasks)]
            shares = self.context.parallelize(dealt, tasks).flatMap(lambda d: d[1])
            self.shares = shares.persist(StorageLevel.MEMORY_AND_DISK)
        self.compared, self.pace = False, 0.0  # seconds a step of the last job of many

    def advanced(self, state, until: int):
        """The state after steps up to ``until``, or the last one."""
        while state.step < until and not state.done:
            if not self.together:
                state = self._one(state)
            elif self.compared:
                state = self._many(state, until)
            else:  # either way is tried
                state, pace = self._many(state, min(until, state.step + TRIED_STEPS)), self.pace
                if not state.done and state.step < until:
                    began = time.monotonic()
                    state = self._one(state)
                    self.together, self.compared = pace < time.monotonic() - began, True
        return state

    def _one(self, state):
        """One step in a job of its own."""
        rules, tails, written = self.rules, self.tails, self.tail_step

        def added(total: np.ndarray, path: str, now) -> None:
            share = Share([path], rules, tails, written)
            total += share.sums(now)
            if tails:
                share.save(now.step + 1)
                share.folder.drop(_tail_name(path, written - 1))

        # history stays on the driver
        total = self.pieces.piece_sums(2 + len(state.weights) + BEHIND, replace(state, history=[]), added)
        following = _after(rules, state, total)
        self.tail_step = following.step
        return following

    def _many(self, state, until: int):
        """Steps in one job, whose tasks run at the same time and exchange their sums."""
        from pyspark import BarrierTaskContext

        rules, tails, written = self.rules, self.tails, self.tail_step
        place = f"{self.work}/{uuid.uuid4().hex}"
        shared = self.context.broadcast(replace(state, history=[]))

        def descend(paths: Iterator[str]) -> Iterator[tuple]:
            context = BarrierTaskContext.get()
            here, tasks = context.partitionId(), len(context.getTaskInfos())
            share, now = Share(list(paths), rules, tails, written), shared.value
            # a second attempt begins anew in a folder of its own, which the tasks agree upon
            folder = Folder(f"{place}/{context.allGather(uuid.uuid4().hex)[0]}")
            times = []
            while now.step < until and not now.done:
                times.append(-time.monotonic())
                folder.put(f"{now.step}-{here}", share.sums(now))
                total = sum(folder.awaited(f"{now.step}-{k}") for k in range(tasks))
                folder.drop(f"{now.step - 1}-{here}")  # all have read it: they are a step on
                now = _after(rules, now, total)
                times[-1] += time.monotonic()
            if tails:
                share.save(now.step)
            if not here:
                yield now.bias, now.weights.tobytes(), now.step, now.history, now.done, float(np.median(times))

        ((bias, weights, step, history, done, self.pace),) = self.shares.barrier().mapPartitions(descend).collect()
        shared.destroy()
        self.tail_step = step
        return replace(
            state, bias=bias, weights=np.frombuffer(weights), step=step, history=[*state.history, *history], done=done
        )

    def table(self) -> DataFrame:
        """Place and weight of all that lie with the pieces, after the last step."""
        tails, written = self.tails, self.tail_step

        def read(path: str) -> Iterator[pa.RecordBatch]:
            places = np.concatenate([np.frombuffer(b.column(2)[0].as_buffer(), dtype=np.int64) for b in mapped(path)])
            weights = Share([path], None, tails, written).tails[path][1:]
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(weights)], ["place", "weight"])

        return self.pieces.table(read, "place long, weight double")

    def close(self) -> None:
        if self.shares is not self.pieces.files:
            self.shares.unpersist()


def _slots(context) -> int:
    """Tasks that can run at the same time for sure; none if executors come and go."""
    conf = context.getConf()
    if conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        return 0
    try:
        scheduler = context._jsc.sc()
        return scheduler.maxNumConcurrentTasks(scheduler.resourceProfileManager().defaultResourceProfile())
    except (Py4JError, AttributeError):
        return 0
