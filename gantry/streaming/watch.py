"""Alarms of a stream: keys that fall silent while work is pending or not, and their recovery."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "last long, pending long, silent boolean"
ALARM = "key string, state string, at timestamp_ntz, last timestamp_ntz, pending long"
RESUMED, STALLED = "recovered", "stalled"


def _moment(us: int) -> pd.Timestamp:
    return pd.Timestamp(us, unit="us")


def stall_alarms(stream: DataFrame, key: str, at: str, seconds: int, opened: str | None = None, delay: str = "1 second") -> DataFrame:
    """One row when a key has been silent for more than ``seconds``, and one when it comes back (2.11/7, D93).

    A key's timer stands at its last row plus ``seconds``, in event time: the rows of other keys move the watermark (behind by ``delay``) past it, so silence itself raises the row.
    ``opened`` counts items begun (positive) and ended (negative): an alarm says how many are pending. What is emitted follows from the rows and the last watermark, however they are cut
    into batches; alarm and timer lie in the state, so a restart from the checkpoint repeats none. Rows that come later than the watermark are dropped by Spark, earlier than the key's last
    row they change the count alone.
    """
    limit = seconds * 1_000_000

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, pending, silent = state.get if state.exists else (None, 0, False)
        out = []
        if state.hasTimedOut:
            out.append((STALLED, last + limit, last, pending))
            silent = True
        else:
            rows = pd.concat(list(batches)).sort_values("_us", kind="stable")
            for us, n in zip(rows["_us"].tolist(), rows["_n"].tolist()):
                if last is not None and (silent or us - last > limit):
                    if not silent:
                        out.append((STALLED, last + limit, last, pending))
                    out.append((RESUMED, us, last, pending))
                    silent = False
                pending += n
                last = us if last is None else max(last, us)
        state.update((last, pending, silent))
        if not silent:
            # a timer has to lie after the watermark; one that doesn't is due as soon as the watermark moves
            state.setTimeoutTimestamp(max((last + limit) // 1000, state.getCurrentWatermarkMs() + 1))
        if out:
            names = ("state", "at", "last", "pending")
            made = pd.DataFrame(out, columns=names).assign(key=str(k[0]), at=[_moment(x[1]) for x in out], last=[_moment(x[2]) for x in out])
            yield made[["key", *names]]

    rows = stream.withWatermark(at, delay).select(F.col(key).cast("string").alias("_key"), F.col(at), F.unix_micros(F.col(at)).alias("_us"), (F.coalesce(F.col(opened), F.lit(0)) if opened else F.lit(0)).cast("long").alias("_n"))
    return rows.groupBy("_key").applyInPandasWithState(step, ALARM, STATE, "append", GroupStateTimeout.EventTimeTimeout)
