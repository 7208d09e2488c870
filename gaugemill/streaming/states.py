"""Failures in a row and first replies of each endpoint, on streams of events.

A group's events wait in state until the watermark has passed them, so late ones take their place in the order
before anything is counted; then streaks and counts go on from what the state has. What is known of a group is dropped where it
has been idle for long. The results are those of ``operators.log`` on the same events as a table.

Groups are dealt by hash into ``PARTS`` parts, each one row of state with its groups' counts and waiting events packed (21 bytes an event), and
a part is counted at once, as arrays: calls are as many as parts, however many groups there are, and no event is asked for by itself.
RocksDB keeps states outside the heap, but any provider will do.
Edge cases: events behind the watermark are dropped by Spark; events of one time are ordered by ``tie``; a group that comes
back after it was dropped starts anew; the last events of a stream are out once a later one moves the watermark; a part
may have some 100 million events between two watermarks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

COUNTED = "{by} string, micros long, tie long, failed boolean, streak long, place long, refuse boolean"
PARTS = 1024
#: A part's state: its groups, what was counted of each so far (KNOWN), and the events that wait (HELD).
STATE = "names array<string>, known binary, held binary"
KNOWN = np.dtype([("streak", "<i8"), ("place", "<i8"), ("failures", "<i8"), ("last", "<i8")])
HELD = np.dtype([("group", "<i4"), ("micros", "<i8"), ("tie", "<i8"), ("failed", "?")])


def counter(by: str, first: int, idle_ms: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """Streaks of failures and whether the first ``first`` events all failed, of the groups of one part."""
    columns = [c.split()[0] for c in COUNTED.format(by=by).split(", ")]

    def count(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        names, known, held = state.get if state.exists else ([], b"", b"")
        number, waiting = {n: i for i, n in enumerate(names)}, [np.frombuffer(held, HELD)]
        for part in parts:
            codes, new = pd.factorize(part[by], use_na_sentinel=False)
            own = [number.setdefault(None if pd.isna(n) else n, len(number)) for n in new]
            rows = np.empty(len(part), HELD)
            rows["group"] = np.array(own, "<i4")[codes]
            for name in HELD.names[1:]:
                rows[name] = part[name].astype(HELD[name])  # an event without time or tie is refused here
            waiting.append(rows)
        names, old = list(number), np.frombuffer(known, KNOWN)
        known = np.zeros(len(names), KNOWN)
        known[: len(old)] = old
        events = np.concatenate(waiting)
        events = events[np.lexsort((events["failed"], events["tie"], events["micros"], events["group"]))]
        ripe = events["micros"] // 1000 < now
        due, rest = events[ripe], events[~ripe]
        if len(due):
            at, group, failed = np.arange(len(due)), due["group"], due["failed"]
            begins = np.concatenate([[True], group[1:] != group[:-1]])
            start = np.maximum.accumulate(np.where(begins, at, 0))
            success = np.maximum.accumulate(np.where(failed, start - 1, at))  # the last one, or just before the group's rows
            streak = at - success + np.where(success < start, known["streak"][group], 0)
            place = known["place"][group] + 1 + at - start
            early = failed & (place <= first)
            upto = np.cumsum(early)
            failures = known["failures"][group] + upto - (upto - early)[start]
            ends = np.concatenate([begins[1:], [True]])
            for name, values in (("streak", streak), ("place", place), ("failures", failures), ("last", due["micros"])):
                known[name][group[ends]] = values[ends]
        # A group is left while events of it wait, or until it has been idle for long.
        waits = np.bincount(rest["group"], minlength=len(names)) > 0
        idle = known["last"] // 1000 + idle_ms
        left = waits | (known["place"] > 0) & (idle >= now)
        if left.any():
            rest["group"] = (np.cumsum(left) - 1)[rest["group"]]
            state.update(([n for n, stays in zip(names, left) if stays], known[left].tobytes(), rest.tobytes()))
            state.setTimeoutTimestamp(max(1, min([int(t.min()) for t in (rest["micros"] // 1000, idle[left & ~waits]) if len(t)])))
        elif state.exists:
            state.remove()
        if len(due):
            out = np.array(names, object)[group], due["micros"], due["tie"], failed, streak, place, (place >= first) & (failures >= first)
            yield pd.DataFrame(dict(zip(columns, out)))

    return count


def failures(events: DataFrame, by: str, ts: str, tie: str, failed: Column, first: int = 20, late: str = "10 minutes", idle_ms: int = 86_400_000) -> DataFrame:
    """Of every event, in order: (by, micros, tie, failed, streak, place, refuse).

    ``streak`` counts the failures in a row that end here, ``place`` the group's events so far (from 1), and ``refuse`` is true
    from the ``first``-th event on if all of the first ``first`` failed.
    """
    rows = events.withWatermark(ts, late).select(F.col(by).cast("string").alias(by), F.col(ts), F.unix_micros(F.col(ts).cast("timestamp")).alias("micros"), F.col(tie).cast("long").alias("tie"), F.coalesce(failed, F.lit(False)).alias("failed"))
    return rows.withColumn("__part", F.pmod(F.xxhash64(by), F.lit(PARTS))).groupBy("__part").applyInPandasWithState(counter(by, first, idle_ms), COUNTED.format(by=f"`{by}`"), STATE, "append", GroupStateTimeout.EventTimeTimeout)
