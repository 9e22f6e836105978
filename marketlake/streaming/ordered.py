"""Folds over keys in order: one step function, run over a stream with keyed state or over a table.

A stream may bring a key's rows out of order.  Rows wait in the key's state until the watermark has passed
them, and are then taken in order of time and sequence; a timer on the first waiting row wakes keys that hear nothing more.
So the result is that of the table, however the rows were cut into micro-batches, and a restart goes on from the
checkpoint.  A step keeps what it needs in a bounded state of its own.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

#: (own state, row as a dict) -> (own state, rows that come out as tuples).
Step = Callable[[Any, dict], tuple[Any, list[tuple]]]


def fold_stream(stream: DataFrame, keys: list[str], step: Step, schema: str, delay: str, at: str = "at_us", order: str = "seq") -> DataFrame:
    """Rows that ``step`` gives for a stream, in append mode; ``at``: micros of the row, ``delay``: how late rows may come."""
    columns = stream.columns
    place = [columns.index(c) for c in (at, order)]
    timed = stream.withColumn("_ts", F.timestamp_micros(at)).withWatermark("_ts", delay)

    def each(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        waiting, own = pickle.loads(state.get[0]) if state.exists else ([], None)
        if not state.hasTimedOut:
            for part in parts:
                waiting += [tuple(None if pd.isna(v) else v for v in r) for r in part[columns].astype(object).itertuples(index=False)]
        passed = state.getCurrentWatermarkMs()
        waiting.sort(key=lambda r: (int(r[place[0]]), int(r[place[1]])))
        ready = 0
        while ready < len(waiting) and waiting[ready][place[0]] // 1000 < passed:
            ready += 1
        out: list[tuple] = []
        for row in waiting[:ready]:
            own, made = step(own, dict(zip(columns, row)))
            out += made
        waiting = waiting[ready:]
        state.update((pickle.dumps((waiting, own)),))
        if waiting:
            state.setTimeoutTimestamp(int(max(waiting[0][place[0]] // 1000 + 1, passed + 1)))
        if out:
            yield frame(out, names)

    names = _names(schema)
    return timed.groupBy(*keys).applyInPandasWithState(each, schema, "held binary", "append", GroupStateTimeout.EventTimeTimeout)


def fold_table(rows: DataFrame, keys: list[str], step: Step, schema: str, at: str = "at_us", order: str = "seq") -> DataFrame:
    """The same for a table: a key's rows pass through one task in order, and only its own state is held."""
    columns, names = rows.columns, _names(schema)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, own = None, None
        for part in parts:
            out: list[tuple] = []
            for r in part.astype(object).itertuples(index=False):
                row = {c: None if pd.isna(v) else v for c, v in zip(columns, r)}
                key = tuple(row[k] for k in keys)
                if key != now:
                    now, own = key, None
                own, made = step(own, row)
                out += made
            if out:
                yield frame(out, names)

    return rows.repartition(*keys).sortWithinPartitions(*keys, at, order).mapInPandas(run, schema)


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(",")]


def frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame({n: pd.Series([r[k] for r in rows], dtype=object) for k, n in enumerate(names)})


GAP = "venue string, ticker string, series string, from_us long, to_us long, cause string"


def gap_step(own: dict | None, row: dict) -> tuple[dict, list[tuple]]:
    """Coverage of one (venue, ticker, series): rows are ``message``, ``loss`` (until ``to_us``, ``cause``) or ``asked`` again.

    A loss is one gap from the later of the last covered moment and the last gap's end; without a covered moment there is
    none.  When the pair is asked again while its last gap is open and nothing was covered since, the tail up to then is a gap
    of the same cause.  Silence is never a gap.
    """
    own = own or {"covered": None, "end": None, "cause": None, "open": False}
    head, at = (row["venue"], row["ticker"], row["series"]), row["at_us"]
    if row["what"] == "message":
        own["covered"] = at if own["covered"] is None else max(own["covered"], at)
        return own, []
    covered, end = own["covered"], own["end"]
    if row["what"] == "loss":
        if covered is None:
            return own, []
        start = covered if end is None else max(covered, end)
        if start >= row["to_us"]:
            return own, []
        return own | {"end": row["to_us"], "cause": row["cause"], "open": True}, [(*head, start, row["to_us"], row["cause"])]
    tail = end is not None and own["open"] and not (covered is not None and covered >= end) and end < at
    out = [(*head, end, at, own["cause"])] if tail else []
    return own | {"open": False, "end": at if tail else end}, out


def controls(pairs: DataFrame, events: DataFrame) -> DataFrame:
    """Control events of a venue (``venue, at_us, seq, what, to_us, cause``) as one row for each of its declared pairs."""
    return events.join(pairs.select("venue", "ticker", "series"), "venue").select("venue", "ticker", "series", "at_us", "seq", "what", "to_us", "cause")


REORG = "venue string, seq long, from_block long, to_block long, old_hash string, new_hash string"


def reorg_step(depth: int) -> Step:
    """A block against the trail of the last ``depth`` heights of its venue (``height, hash, parent``).

    A parent other than the hash held below is a reorganisation from there to the tip; the trail then forgets those heights.  With no hash held
    below, nothing is claimed.
    """

    def step(trail: dict[int, str] | None, row: dict) -> tuple[dict[int, str], list[tuple]]:
        trail = dict(trail or {})
        below, out = row["height"] - 1, []
        held = trail.get(below)
        if held is not None and held.lower() != (row["parent"] or "").lower():
            out = [(row["venue"], row["seq"], below, max(max(trail), below), held, row["parent"])]
            trail = {h: x for h, x in trail.items() if h < below}
        trail[row["height"]] = row["hash"]
        floor = max(trail) - depth
        return {h: x for h, x in trail.items() if h >= floor}, out

    return step
