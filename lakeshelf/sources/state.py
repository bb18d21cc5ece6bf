"""Incremental-load state: high-water marks per table (``table_name``,
``mark`` as text) and the range that a run has started, in the shared folder.

Each move of a mark is one small new file, never changed or deleted, whose
name carries the table and a sequence number; the newest file of a table wins.
A file is created only if its number is free (:mod:`commits`), so of two
writers that saw the same mark one moves it and the other reads again.

``run_step`` records the range (since, until] before it writes data and
finishes exactly that range after a failure, even if the source has moved on
since: data written for it is replaced, not repeated. The record is also the
claim to the range: a second job that finds it held does not run the step.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from typing import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from lakeshelf.sources import commits

SCHEMA = "table_name string, mark string"

# Seeds (fixed values): bronze marks start at the epoch date; gold marks before
# version 0, as the first version of a table here already holds data.
BRONZE_SEED = "1970-01-01"
GOLD_SEED = "-1"

_INTENT = "#started"

#: A claim whose holder has neither finished nor failed counts as dead after
#: this many seconds (a killed job can't give its claim back).
CLAIM_SECONDS = 6 * 3600


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create a small text file; complete under its name or not there."""
    if not commits.create_exclusive(spark, path, text):
        raise OSError(f"{path} exists")


def _newest(spark: SparkSession, root: str) -> dict[str, int]:
    """{key: sequence number} of the newest file of each key."""
    best: dict[str, int] = {}
    for name, _ in commits.names_in(spark, root):
        if name.endswith(".mark") and name[0] != ".":
            key, seq = name[:-5].rsplit("~", 1)
            best[key] = max(best.get(key, -1), int(seq))
    return best


def _file(root: str, key: str, seq: int) -> str:
    return os.path.join(root, f"{key}~{seq:012d}.mark")


def _put_after(spark: SparkSession, root: str, key: str, seq: int, value: str) -> bool:
    """Write the value that follows number ``seq`` of a key, unless another
    writer already has."""
    return commits.create_exclusive(spark, _file(root, key, seq + 1), json.dumps({"value": value, "by": uuid.uuid4().hex[:8]}))


def _put(spark: SparkSession, root: str, key: str, value: str) -> None:
    while not _put_after(spark, root, key, _newest(spark, root).get(key, -1), value):
        pass  # another writer took the number: after its value comes this one


def _get_all(spark: SparkSession, root: str) -> dict[str, tuple[int, str]]:
    """{key: (sequence number, value)}."""
    return {k: (seq, json.loads(commits.read_text(spark, _file(root, k, seq)))["value"]) for k, seq in _newest(spark, root).items()}


def read_marks(spark: SparkSession, root: str) -> dict[str, str]:
    """The current marks as {table_name: mark} (a few control rows, read
    through the file system without a Spark job)."""
    return {k: v for k, (_, v) in _get_all(spark, root).items() if not k.endswith(_INTENT)}


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """The marks as a (table_name, mark) DataFrame."""
    return spark.createDataFrame(sorted(read_marks(spark, root).items()), SCHEMA)


def seed_marks(spark: SparkSession, root: str, names: Iterable[str], value: str) -> None:
    """Create (or reset) marks for ``names`` to ``value``."""
    for n in names:
        _put(spark, root, n, str(value))


def get_mark(spark: SparkSession, root: str, name: str) -> str | None:
    return read_marks(spark, root).get(name)


def set_mark(spark: SparkSession, root: str, name: str, value) -> None:
    _put(spark, root, name, str(value))


def if_newer(last, current) -> bool:
    """Run gate: only when the last processed mark is older than the current."""
    if current is None:
        return False
    if last is None:
        return True
    return last < current


def run_step(spark: SparkSession, root: str, name: str, current, step: Callable[[object, object], None],
             claim_seconds: float = CLAIM_SECONDS) -> bool:
    """Gate on the mark and run ``step(since, until)``, which must write its
    data so that a repeat of the same range replaces it; then move the mark.

    The range is recorded first, by the one writer that gets the next number;
    others return False. If an earlier run recorded a range and failed, or was
    killed more than ``claim_seconds`` ago, exactly that range is finished
    before a newer one starts. Errors propagate. Returns whether any range was
    run."""
    ran = False
    while True:
        state = _get_all(spark, root)
        seq, mark = state.get(name, (-1, None))
        last = _typed(mark, current)
        claim_seq, record = state.get(name + _INTENT, (-1, "null"))
        started = json.loads(record)
        unfinished = bool(started) and started["since"] == mark and if_newer(last, _typed(started["until"], current))
        if unfinished and started["held"] and time.time() - started["at"] < claim_seconds:
            return ran  # another job is at it
        until = _typed(started["until"], current) if unfinished else current
        if not if_newer(last, until):
            return ran
        claim = {"since": mark, "until": str(until), "held": True, "at": time.time()}
        if not _put_after(spark, root, name + _INTENT, claim_seq, json.dumps(claim)):
            return ran
        try:
            step(last, until)
        except BaseException:
            _put_after(spark, root, name + _INTENT, claim_seq + 1, json.dumps({**claim, "held": False}))
            raise
        if not _put_after(spark, root, name, seq, str(until)):
            raise RuntimeError(f"the mark of {name} was moved by another writer")
        ran = True


def _typed(value: str | None, like):
    if value is None or like is None:
        return value
    return type(like)(value)
