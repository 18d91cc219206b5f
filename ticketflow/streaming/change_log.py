"""A change log with a compacted base: reads touch the base and the open batches only.

Micro-batches append to ``deltas``, each attempt of a batch to a folder of its own, and a batch's content
counts once, by its first complete attempt. A compaction folds the base and all closed batches (no batch
below is missing or unfinished) into a new base and moves the epoch pointer, whose name says through
which batch its base reaches. Nothing is replaced or deleted meanwhile, so readers that resolved the old
epoch go on undisturbed; ``vacuum`` later drops what no kept epoch needs. A batch that is
replayed after it was folded is left alone.

``fold`` must merge incrementally: ``fold(a U b) == fold(fold(a) U b)``, as dedup-latest and sums do.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketflow.operators.silver import dedup_latest
from ticketflow.sources.lake import Outrun, names_in, _pointed, delete_path, run_path, set_current

Fold = Callable[[DataFrame], DataFrame]


def latest_versions(key="ticket_id", order: str = "last_activity", tie_breakers: Iterable[str] = ()) -> Fold:
    ties = tuple(tie_breakers)
    return lambda df: dedup_latest(df, key, order, ties)


def summed(keys: Iterable[str], *counts: str) -> Fold:
    keys = tuple(keys)
    return lambda df: df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in counts))


class ChangeLog:
    """A log at ``root`` on the shared file system, merged by ``fold``."""

    def __init__(self, spark: SparkSession, root: str, fold: Fold):
        self.spark, self.root, self.fold = spark, root.rstrip("/"), fold

    def epoch(self) -> tuple[str, int]:
        """(run of the base, last batch in it); ('', -1) before the first compaction."""
        run = _pointed(self.spark, self.root)
        return run, int(run.partition("-")[0]) if run else -1

    def _attempts(self) -> dict[int, str | None]:
        """Folder of each batch: its first complete attempt, or None while none is."""
        out: dict[int, str | None] = {}
        for name in sorted(names_in(self.spark, f"{self.root}/deltas")):
            batch = int(name.partition("-")[0])
            if out.setdefault(batch, None) is None and "_SUCCESS" in names_in(self.spark, f"{self.root}/deltas/{name}"):
                out[batch] = name
        return out

    def append(self, batch: DataFrame, batch_id: int) -> None:
        """Add what ``batch`` folds to, unless the batch is in already."""
        if batch_id <= self.epoch()[1] or self._attempts().get(batch_id):
            return
        self.fold(batch).write.parquet(f"{self.root}/deltas/{batch_id:012d}-{uuid.uuid4().hex[:8]}")

    def _read(self, run: str, batches: list[str]) -> DataFrame:
        paths = [f"{self.root}/deltas/{b}" for b in batches]
        parts = [self.spark.read.parquet(run_path(self.root, run, "base"))] if run else []
        parts += [self.spark.read.parquet(*paths)] if paths else []
        if not parts:
            raise FileNotFoundError(f"no batch at {self.root}")
        return self.fold(parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True))

    def open_batches(self) -> list[str]:
        """Folders of the complete batches beyond the current base."""
        through = self.epoch()[1]
        return [name for batch, name in sorted(self._attempts().items()) if batch > through and name]

    def read(self) -> DataFrame:
        """What all complete batches fold to, as of now."""
        run, through = self.epoch()
        return self._read(run, [name for batch, name in sorted(self._attempts().items()) if batch > through and name])

    def compact(self) -> int:
        """Fold the closed batches into the base; returns the last batch in the base."""
        run, through = self.epoch()
        closed, upto = [], through
        for batch, name in sorted(self._attempts().items()):
            if batch <= through:
                continue
            if name is None or batch != upto + 1:  # unfinished, or one below it has not come
                break
            closed.append(name)
            upto = batch
        if not closed:
            return through
        new = f"{upto}-{uuid.uuid4().hex[:8]}"
        self._read(run, closed).write.parquet(run_path(self.root, new, "base"))
        try:
            set_current(self.spark, self.root, new, onto=run)
        except Outrun:  # another compaction was faster: its base stands
            return self.epoch()[1]
        return upto

    def vacuum(self) -> int:
        """Delete bases of older epochs and the batches in the current base, once no reader is on an older
        epoch any more; returns how many folders went."""
        run, through = self.epoch()
        old = [f"{self.root}/runs/{n}" for n in names_in(self.spark, f"{self.root}/runs") if n != run and int(n.partition("-")[0]) <= through]
        folded = [f"{self.root}/deltas/{n}" for n in names_in(self.spark, f"{self.root}/deltas") if int(n.partition("-")[0]) <= through]
        for path in old + folded:
            delete_path(self.spark, path)
        return len(old) + len(folded)


def run_change_log(spark: SparkSession, source_path: str, schema, log: ChangeLog, checkpoint: str,
                   compact_every: int = 8, max_files_per_trigger: int = 200) -> None:
    """Consume every file now in ``source_path`` into ``log``; every ``compact_every`` batches its closed
    batches are folded into the base."""
    def write(batch: DataFrame, batch_id: int) -> None:
        log.append(batch, batch_id)
        if batch_id % compact_every == compact_every - 1:
            log.compact()

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_path)
    (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())
