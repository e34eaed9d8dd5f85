"""How many files each partition of a layer should have: listed sizes, a plan, and rows placed by it.

A write makes one file for each pair of task and partition, so the count follows the tasks that happen to hold
a partition's rows. Here the store's own listing says how large every partition is. Large ones are then spread over
as many tasks as they need files, small ones share a task and have one file each. The driver handles one line for
each partition, never one for each row or file.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable
from dataclasses import dataclass
from math import ceil
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelake import paths

FILE_BYTES = 256 * 1024 * 1024
SHARED_BYTES = 32 * 1024 * 1024  # of small partitions that share a task, which sorts their rows uncompressed
_NULL = "__HIVE_DEFAULT_PARTITION__"  # fixed value: how a directory names a null

Key = tuple[str, ...]


@dataclass(frozen=True)
class Held:
    files: int = 0
    bytes: int = 0

    def wanted(self, target: int) -> int:
        return max(1, ceil(self.bytes / target))


def key_of(directory: str, by: list[str]) -> Key:
    """The values of the columns ``by`` in ``…/a=1/b=2``."""
    values = dict(part.split("=", 1) for part in directory.split("/") if "=" in part)
    return tuple(unquote(values[c]) for c in by)


def listed(spark: SparkSession, base: str, by: list[str], directories: Iterable[str] | None = None) -> dict[Key, Held]:
    """Files and bytes of each partition below ``base``, by default of all; directories of one partition are added up."""
    found: dict[Key, Held] = {}
    for directory in paths.leaves(spark, base, len(by)) if directories is None else directories:
        files, size = paths.usage(spark, f"{base}/{directory}")
        held = found.get(key := key_of(directory, by), Held())
        found[key] = Held(held.files + files, held.bytes + size)
    return found


def untidy(held: dict[Key, Held], target: int = FILE_BYTES, slack: float = 1) -> dict[Key, Held]:
    """The partitions with more than ``slack`` times as many files as their bytes fill, or files over ``2 * target`` on average."""
    return {k: h for k, h in held.items() if h.files > slack * h.wanted(target) or h.bytes > 2 * target * h.files}


def assign(sizes: dict[Key, int], target: int = FILE_BYTES) -> tuple[dict[Key, tuple[int, int]], int]:
    """(first task, number of tasks) of each partition, and how many tasks there are.

    Partitions over ``target`` get tasks of their own. The others are packed into
    shared ones by best fit, the largest first, so that no shared task exceeds it or ``SHARED_BYTES``.
    """
    shared = min(target, SHARED_BYTES)
    where: dict[Key, tuple[int, int]] = {}
    room: list[tuple[int, int]] = []  # (free bytes, task), in order
    tasks = 0
    for key, size in sorted(sizes.items(), key=lambda item: (-item[1], item[0])):
        if size > shared:
            where[key] = (tasks, ceil(size / target))
            tasks += where[key][1]
            continue
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, task = room.pop(at)
        else:
            free, task, tasks = shared, tasks, tasks + 1
        where[key] = (task, 1)
        insort(room, (free - size, task))
    return where, tasks


def placed(rows: DataFrame, by: list[str], held: dict[Key, Held], target: int = FILE_BYTES) -> DataFrame:
    """``rows``, each in a task that the plan for its partition names; write them as ``clustered``.

    Within a partition rows are spread by a hash of all their columns, so a task
    that is run again gets the same rows. Rows of partitions that ``held`` does not know go to the first task.
    """
    where, tasks = assign({k: h.bytes for k, h in held.items()}, target)
    plan = rows.sparkSession.createDataFrame([("/".join(k), *at) for k, at in where.items()], "__part string, __first int, __tasks int")
    part = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit(_NULL)) for c in by])
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.col("__tasks")).cast("int")
    task = F.coalesce(F.col("__first") + spread, F.lit(0))
    # one row for each partition
    planned = rows.withColumn("__part", part).join(F.broadcast(plan), "__part", "left").withColumn("__task", task)
    return planned.repartitionById(max(tasks, 1), "__task").select(*rows.columns)
