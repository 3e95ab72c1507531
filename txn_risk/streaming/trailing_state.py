"""The 24-hour count per card as keyed streaming state.

A stream cannot rank or range over its past without state, and no built-in aggregate counts a
trailing window per row, so this is the library's one Python crossing.

The state of a card is its distinct seconds with a count each, within the horizon plus the allowed
lateness: at most one entry per second however busy the card. A card's rows of one micro-batch are
handled together, so the trigger's input limit also bounds a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from txn_risk.schemas import DAY_SECONDS

_STATE = "seconds array<bigint>, counts array<bigint>"


def with_trailing_count(
    stream: DataFrame, key: str = "cc_num", at: str = "unix_time", out: str = "txn_freq_24h",
    horizon: int = DAY_SECONDS, lateness: int = DAY_SECONDS,
) -> DataFrame:
    """Add ``out``: the key's events in ``[at - horizon, at - 1]`` seen so far.

    Events count by their own time, whatever order they come in; events of the same second do not
    count each other. A late event is counted against the seconds still held and raises later
    rows, but rows already sent out are not revised. No event is dropped: one later than
    ``lateness`` finds only part of its past. ``at`` must not be null.

    An idle card keeps its last seconds: a time-out by the wall clock would forget cards during a stop,
    and count their backlog from nothing; one by event time would discard late events. So the state
    grows with the number of cards, by at most the seconds of horizon plus lateness each.
    """

    # Nested, and using only numpy and pandas, so that it is shipped by value: workers need not
    # have this package installed.
    def count(
        _key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        batch = list(frames)
        new = np.concatenate([f[at].to_numpy(dtype=np.int64) for f in batch])
        seconds, counts = new, np.ones(len(new), dtype=np.int64)
        if state.exists:
            old_seconds, old_counts = state.get
            seconds = np.concatenate([np.asarray(old_seconds, dtype=np.int64), seconds])
            counts = np.concatenate([np.asarray(old_counts, dtype=np.int64), counts])
        seconds, at_second = np.unique(seconds, return_inverse=True)
        summed = np.zeros(len(seconds), dtype=np.int64)
        np.add.at(summed, at_second, counts)
        before = np.concatenate([[0], np.cumsum(summed)])
        for frame in batch:
            times = frame[at].to_numpy(dtype=np.int64)
            upto = before[np.searchsorted(seconds, times, side="left")]
            gone = before[np.searchsorted(seconds, times - horizon, side="left")]
            yield frame.assign(**{out: upto - gone})
        held = seconds >= seconds[-1] - horizon - lateness
        state.update((seconds[held].tolist(), summed[held].tolist()))

    schema = T.StructType(stream.schema.fields + [T.StructField(out, T.LongType(), True)])
    return stream.groupBy(key).applyInPandasWithState(
        count, schema, _STATE, "append",
        GroupStateTimeout.NoTimeout,
    )
