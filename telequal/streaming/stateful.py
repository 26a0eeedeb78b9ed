"""Streaming jobs with state of their own: keep-last deduplication and the rolling baseline of every entity.

Rows are held back until the watermark has passed them, then leave in event order, so results do not hang on the order of
arrival within the allowed lateness and equal those of the batch operators.  State per key is one row, or the values of one
window and the rows still held back; checkpoints carry it over restarts.
"""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from telequal.operators.features import sigma_breach
from telequal.schemas import BASELINE_MIN_ROWS, BASELINE_ROWS, SIGMAS


def _packed(rows: pd.DataFrame) -> bytes:
    table, out = pa.Table.from_pandas(rows, preserve_index=False), io.BytesIO()
    with pa.ipc.new_stream(out, table.schema) as writer:
        writer.write_table(table)
    return out.getvalue()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_all().to_pandas()


def _micros(ts: pd.Series) -> np.ndarray:
    return ts.astype("datetime64[us]").astype("int64").to_numpy()


def _schema(df: DataFrame, *more: str) -> str:
    return ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields] + list(more))


def stream_keep_last(
    stream: DataFrame, entity: str, ts: str, order: Sequence[str], late: str = "2 hours"
) -> DataFrame:
    """One row per (entity, ts): the last by ``order``, once the watermark has passed ``ts``; the batch form is ``keep_last``.

    Nulls come first in ``order``.  A copy that arrives after its row has left is late, and dropped as such.
    """
    names = list(stream.columns)

    def keep(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (data,) = state.get
            state.remove()
            yield _unpacked(data)
            return
        kept = [_unpacked(state.get[0])] if state.exists else []
        rows = pd.concat([*kept, *parts], ignore_index=True)
        last = rows.sort_values(list(order), kind="stable", na_position="first").tail(1)
        state.update((_packed(last[names]),))
        state.setTimeoutTimestamp(int(_micros(last[ts])[0]) // 1000 + 1)

    held = stream.withWatermark(ts, late).groupBy(entity, ts)
    return held.applyInPandasWithState(keep, _schema(stream), "row binary", "append", GroupStateTimeout.EventTimeTimeout)


def stream_rolling_baseline(
    stream: DataFrame,
    entity: str,
    order: Sequence[str],
    col: str,
    late: str = "2 hours",
    forget: str = "90 days",
    rows: int = BASELINE_ROWS,
    least: int = BASELINE_MIN_ROWS,
) -> DataFrame:
    """``stream`` with ``base_mean`` and ``base_std``, as the batch form ``rolling_baseline`` gives them.

    The first column of ``order`` is the event time.  An entity keeps its last ``rows - 1`` values; it is forgotten, and
    begins anew, after ``forget`` of event time without a reading.
    """
    ts = order[0]
    names = list(stream.columns)
    silence = pd.Timedelta(forget) // pd.Timedelta(milliseconds=1)

    def scored(ready: pd.DataFrame, ring: np.ndarray) -> tuple[pd.DataFrame, np.ndarray]:
        own = ready[col].to_numpy(np.float64)
        values = np.concatenate((ring, own))
        mean, std = own.copy(), np.ones(len(own))
        for i in range(len(own)):
            seen = values[max(0, len(ring) + i + 1 - rows) : len(ring) + i + 1]
            seen = seen[~np.isnan(seen)]
            if len(seen) >= least:
                mean[i] = seen.mean()
                std[i] = seen.std(ddof=1) if len(seen) > 1 else 1.0
        return ready.assign(base_mean=mean, base_std=std), values[max(0, len(values) - rows + 1) :]

    def work(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ring, last, held = np.zeros(0), 0, []
        if state.exists:
            values, last, data = state.get
            ring, held = np.frombuffer(values), [_unpacked(data)]
        if not state.hasTimedOut:
            held += list(parts)
        waiting = pd.concat(held, ignore_index=True)[names]
        passed = state.getCurrentWatermarkMs() * 1000
        at = _micros(waiting[ts])
        ready = waiting[at <= passed].sort_values(list(order), kind="stable", na_position="first")
        waiting = waiting[at > passed]
        if len(ready):
            last = max(last, int(at[at <= passed].max()) // 1000)
            out, ring = scored(ready, ring)
            yield out
        if not len(waiting) and passed >= (last + silence) * 1000:
            state.remove()
            return
        state.update((ring.tobytes(), last, _packed(waiting)))
        state.setTimeoutTimestamp(int(at[at > passed].min()) // 1000 + 1 if len(waiting) else last + silence + 1)

    return (
        stream.withWatermark(ts, late)
        .groupBy(entity)
        .applyInPandasWithState(
            work,
            _schema(stream, "base_mean double", "base_std double"),
            "ring binary, last bigint, waiting binary",
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
    )


def stream_sigma_breach(
    stream: DataFrame, entity: str, order: Sequence[str], col: str, late: str = "2 hours", sigmas: float = SIGMAS
) -> DataFrame:
    """Every reading judged against the rolling baseline of its own entity, which moves on with the stream."""
    return sigma_breach(stream_rolling_baseline(stream, entity, order, col, late), col, sigmas=sigmas)
