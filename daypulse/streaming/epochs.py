"""Runs of a stream: an epoch number per checkpoint, and batch ids that stay apart over runs.

Spark numbers the micro-batches of a checkpoint from 0.  A stream that goes on
with a *new* checkpoint (from stored offsets) therefore starts at batch 0
again, and a folder ``batch_id=0`` of its own would replace the one of the run
before.  Each checkpoint takes an epoch when it first starts: the smallest
number above those that the stream's sinks know.  The epoch is kept in the
checkpoint (a restart from it goes on with it) and, with the run's id, in
``_runs`` below each sink.  A stored batch id is ``epoch * SPAN + batch``: the
order of stored ids is the order of (epoch, batch), and epoch 0 has Spark's
own numbers, so tables written before there were epochs read as its batches.
"""

from __future__ import annotations

import json
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from daypulse.sources.paths import create_text, exists, partition_values, read_text, remove, visible_names

SPAN = 10**12            # batches of one run at most
RUN_FILE = "daypulse-run.json"


@dataclass(frozen=True)
class Run:
    """One life of a stream: the batches of one checkpoint."""

    epoch: int = 0
    run: str = ""
    new: bool = False     # the checkpoint was new: state and offsets of earlier runs are not in it

    def batch(self, batch_id: int) -> int:
        """The id under which the sinks store Spark's batch ``batch_id``."""
        return self.epoch * SPAN + int(batch_id)


def epoch_of(batch_id: str | Column) -> Column:
    """The epoch of a stored batch id (merged folders have negative ids: epoch 0)."""
    col = F.col(batch_id) if isinstance(batch_id, str) else batch_id
    return F.greatest(F.floor(col / F.lit(SPAN)), F.lit(0).cast("bigint"))


def known_epochs(spark: SparkSession, sink: str) -> list[int]:
    """Epochs that wrote below ``sink``; a filled sink without a record counts as epoch 0."""
    names = visible_names(spark, os.path.join(sink, "_runs"), hidden=True)
    found = sorted(int(n.removeprefix("epoch-").removesuffix(".json")) for n in names if n.startswith("epoch-"))
    return found or ([0] if visible_names(spark, sink) else [])


def start_run(spark: SparkSession, checkpoint: str, sinks: list[str]) -> Run:
    """The run of ``checkpoint``: the one it holds, else a new one, entered at every sink.

    The file of an epoch is created only if it is not there, so two streams
    that start at the same time take different numbers.
    """
    own = os.path.join(checkpoint, RUN_FILE)
    if exists(spark, own):
        kept = json.loads(read_text(spark, own))
        return Run(kept["epoch"], kept["run"])
    if exists(spark, os.path.join(checkpoint, "metadata")):  # a checkpoint from before there were epochs
        run = Run(0, uuid.uuid4().hex)
    else:
        known = [e for s in sinks for e in known_epochs(spark, s)]
        run = Run(max(known) + 1 if known else 0, uuid.uuid4().hex, new=True)
    while True:
        text = json.dumps({"epoch": run.epoch, "run": run.run, "checkpoint": checkpoint})
        entered = [create_text(spark, os.path.join(s, "_runs", f"epoch-{run.epoch}.json"), text) for s in sinks]
        if all(entered) or not run.new:
            break
        run = Run(run.epoch + 1, run.run, new=True)
    create_text(spark, own, text)
    return run


def drop_uncommitted(spark: SparkSession, run: Run, progress: str, tables: list[str]) -> list[str]:
    """Remove the batch folders of earlier runs whose offsets were never recorded; the paths removed.

    Offsets are recorded after the data sinks.  A run that died in between left
    rows that the new run reads again from the recorded offsets.  Only for a
    new checkpoint: an old one replays its last batch into the same folder.
    ``tables`` hold ``batch_id=N`` folders directly or one level down.
    """
    if not run.new or not run.epoch or not visible_names(spark, progress):
        return []
    committed = set(partition_values(spark, progress, "batch_id"))
    gone = []
    for table in tables:
        names = visible_names(spark, table)
        folders = [table] if any(n.startswith("batch_id=") for n in names) else [os.path.join(table, n) for n in names]
        for folder in folders:
            for value in partition_values(spark, folder, "batch_id"):
                if value not in committed and 0 <= int(value) < run.epoch * SPAN:
                    gone.append(os.path.join(folder, f"batch_id={value}"))
    for path in gone:
        remove(spark, path)
    return gone
