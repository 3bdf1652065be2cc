"""Per-key state of the rules that follow a key in arrival order.

Each function gets the rows of one key in a micro-batch, puts them in arrival
order (a shuffle does not keep it), and handles them as whole columns.  State
is a pair of numbers plus the time of its last write; state not written for
the rule's time to live is forgotten, as is a key that stays silent that long.

Rows may bring the clock along, as ``clock_ms``; without it the clock of the
micro-batch counts.  With it a run that catches up forgets what the live run
would have forgotten, and so do the operators on tables.

A key costs Python time for every column of its rows, so columns that no rule
looks at travel as one text (``_packed``).  It also costs a millisecond or more
by itself, however few its rows.  With ``buckets`` keys are therefore put into
that many groups; the rows of all keys of a group are handled at once, and their
state is kept together, as one text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vigilpay import config

FAILURE_TTL_MS = config.FAILURE_TTL_US // 1000
USER_MEAN_TTL_MS = config.USER_MEAN_TTL_US // 1000
MERCHANT_MEAN_TTL_MS = config.MERCHANT_MEAN_TTL_US // 1000
#: A key's last emitted alert is kept this long beyond the cool-down, for alerts that come late.
COOLDOWN_KEPT_MS = 24 * config.HOUR_US // 1000
#: Groups of keys of the job's queries.  A checkpoint cannot be used with another number.
BUCKETS = 512


def _load(state: GroupState, now: int, ttl_ms: int) -> tuple[int, int]:
    """The two numbers, or zeros when absent or too old."""
    if not state.exists:
        return 0, 0
    first, second, written = state.get
    return (int(first), int(second)) if now - written <= ttl_ms else (0, 0)


def _store(state: GroupState, first: int, second: int, now: int, ttl_ms: int) -> None:
    state.update((int(first), str(second), int(now)))
    state.setTimeoutDuration(ttl_ms)


def _clock(batch: pd.DataFrame, state: GroupState) -> np.ndarray:
    if "clock_ms" in batch:
        return batch["clock_ms"].to_numpy(dtype=np.int64)
    return np.full(len(batch), state.getCurrentProcessingTimeMs(), np.int64)


def _forgotten(clock: np.ndarray, ttl_ms: int) -> np.ndarray:
    """Places before which the row before is longer ago than the time to live."""
    return np.flatnonzero(np.diff(clock) > ttl_ms) + 1


def _in_order(frames: Iterator[pd.DataFrame], *order: str) -> pd.DataFrame:
    parts = list(frames)
    batch = parts[0] if len(parts) == 1 else pd.concat(parts)
    return batch if len(batch) == 1 else batch.sort_values(list(order), kind="stable")


def _read(state: GroupState) -> dict:
    """What is held for the keys of a bucket, by key."""
    return {key: tuple(rest) for key, *rest in json.loads(state.get[0])} if state.exists else {}


def _write(state: GroupState, held: dict, now: int, ttl_ms: int) -> None:
    """Keep what was written, as the last number tells, no longer before ``now`` than the time to live."""
    left = [(key, *rest) for key, rest in held.items() if now - rest[-1] <= ttl_ms]
    if left:
        state.update((json.dumps(left),))
        state.setTimeoutDuration(ttl_ms)
    elif state.exists:
        state.remove()


def _by_key(frames: Iterator[pd.DataFrame], key: str, *order: str) -> tuple[pd.DataFrame, list, np.ndarray]:
    """Rows of a bucket by key and in order, the keys, and where each begins."""
    parts = list(frames)
    batch = parts[0] if len(parts) == 1 else pd.concat(parts)
    codes, keys = pd.factorize(batch[key], use_na_sentinel=False)
    batch = batch.assign(_code=codes).sort_values(["_code", *order], kind="stable")
    sizes = np.bincount(codes, minlength=len(keys))
    return batch, [k if isinstance(k, str) else None for k in keys], np.cumsum(sizes) - sizes


def _brought(held: dict, keys: list, clock: np.ndarray, starts: np.ndarray, ttl_ms: int) -> tuple[list, list]:
    """The two numbers of each key, or zeros when absent or too old."""
    found = [held.get(k, (0, 0, now)) for k, now in zip(keys, clock[starts].tolist())]
    found = [f if now - f[2] <= ttl_ms else (0, 0, now) for f, now in zip(found, clock[starts].tolist())]
    return [f[0] for f in found], [f[1] for f in found]


_ONE = np.zeros(1, np.int64)


def _spread(values, starts: np.ndarray, n: int) -> np.ndarray:
    """The value of each key at all of its rows."""
    return np.repeat(np.asarray(values), np.diff(np.append(starts, n)))


def fold_failures(failed: np.ndarray, clock: np.ndarray, run_before, ttl_ms: int, starts: np.ndarray = _ONE) -> np.ndarray:
    """Failures in a row up to each row, given the run the key came with.

    With ``starts``, rows of several keys, one after the other, that begin
    there; ``run_before`` has a number for each.
    """
    place = np.arange(1, len(failed) + 1)
    ended = np.where(failed, 0, place)
    for cuts in (_forgotten(clock, ttl_ms), starts):
        ended[cuts] = np.maximum(ended[cuts], cuts)
    ended = np.maximum.accumulate(ended)
    before = _spread(np.atleast_1d(run_before), starts, len(failed))
    return place - ended + np.where(ended == _spread(starts, starts, len(failed)), before, 0)


def fold_history(
    values: np.ndarray, clock: np.ndarray, count: int, total: int, ttl_ms: int
) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Count and total of the earlier values at each place, and of all up to the end.

    Totals are Python integers, which do not wrap.
    """
    counts, totals, ends, sums = fold_histories(values.astype(object), clock, [count], [total], ttl_ms, _ONE)
    return counts, totals, ends[0], sums[0]


def fold_histories(
    values: np.ndarray, clock: np.ndarray, counts: list, totals: list, ttl_ms: int, starts: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``fold_history`` of several keys, whose values follow each other and begin at ``starts``."""
    n = len(values)
    if values.dtype != object and np.abs(values.astype(float)).sum() + max(map(abs, totals)) >= 2.0**62:
        values = values.astype(object)  # Python integers, which do not wrap
    begins = np.union1d(starts, _forgotten(clock, ttl_ms))
    own = np.isin(begins, starts)  # the others are begun anew after a pause
    brought_n, brought = np.zeros(len(begins), np.int64), np.zeros(len(begins), values.dtype)
    brought_n[own], brought[own] = counts, totals
    before = np.cumsum(values) - values
    counts = np.arange(n) - _spread(begins, begins, n) + _spread(brought_n, begins, n)
    totals = before - _spread(before[begins], begins, n) + _spread(brought, begins, n)
    ends = np.append(starts[1:], n) - 1
    return counts, totals, counts[ends] + 1, totals[ends] + values[ends]


def _packed(
    rows: DataFrame, *needed: str, only: Column | None = None
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Rows whose columns other than ``needed`` are one text, and what puts them back.

    Texts, whole numbers and flags come back from JSON as they were; columns of
    other types stay as they are.  Rows that are not ``only`` do not come back
    and have no text.
    """
    kept_by_json = (T.StringType, T.BooleanType, T.IntegralType)
    others = [f for f in rows.schema.fields if f.name not in needed and isinstance(f.dataType, kept_by_json)]
    if len(others) < 2:
        return rows, lambda done: done
    inside = [f.name for f in others]
    left = [c for c in rows.columns if c not in inside]

    def unpacked(done: DataFrame) -> DataFrame:
        added = [c for c in done.columns if c not in left and c != "_rest"]
        # as a generator the text is parsed once per row
        whole = done.select(*left, *added, F.inline_outer(F.array(F.from_json("_rest", T.StructType(others)))))
        return whole.select(*rows.columns, *added)

    rest = F.to_json(F.struct(*inside))
    return rows.select(*left, (rest if only is None else F.when(only, rest)).alias("_rest")), unpacked


def _kept(rows: DataFrame, key: str, fold, output: T.StructType, state: str, buckets: int) -> DataFrame:
    if buckets:
        # another hash than that by which Spark puts the buckets into partitions
        rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(buckets)))
        key, state = "_bucket", "held string"
    return rows.groupBy(key).applyInPandasWithState(fold, output, state, "append", GroupStateTimeout.ProcessingTimeTimeout)


def _with_state(
    rows: DataFrame, key: str, fold, fold_all, added: T.StructType, *needed: str, buckets: int = 0, only: Column | None = None
) -> DataFrame:
    """``fold``: the function of one key; ``fold_all``: that of a bucket, also given the columns to return.

    ``needed``: the columns that they look at besides the key.  No row that is not ``only`` is returned.
    """
    rows, unpacked = _packed(rows, key, "clock_ms", *needed, only=only)
    output = T.StructType(rows.schema.fields + added.fields)

    def run(_bucket, frames: Iterator[pd.DataFrame], state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        yield from (part for part in fold_all(frames, state, output.names) if len(part))

    # the second number as text: totals of money go beyond 64 bits
    return unpacked(_kept(rows, key, run if buckets else fold, output, "first bigint, second string, written bigint", buckets))


def failure_runs(
    rows: DataFrame, threshold: int, ttl_ms: int = FAILURE_TTL_MS, buckets: int = 0
) -> DataFrame:
    """Failed rows whose run reaches ``threshold``, with ``failed_run``.

    ``rows`` has ``user_id``, ``arrival_seq`` and a flag ``failed``, with
    ``buckets`` also ``clock_ms``.
    """

    def fold(key, frames: Iterator[pd.DataFrame], state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        batch = _in_order(frames, "arrival_seq")
        clock = _clock(batch, state)
        failed = batch["failed"].to_numpy(dtype=bool)
        runs = fold_failures(failed, clock, _load(state, clock[0], ttl_ms)[0], ttl_ms)
        if runs[-1]:
            _store(state, runs[-1], 0, clock[-1], ttl_ms)
        elif state.exists:
            state.remove()
        batch["failed_run"] = runs
        yield batch[batch["failed"] & (runs >= threshold)]

    def fold_all(frames: Iterator[pd.DataFrame], state: GroupState, columns: list[str]):
        batch, keys, starts = _by_key(frames, "user_id", "arrival_seq")
        clock, held = _clock(batch, state), _read(state)
        failed = batch["failed"].to_numpy(dtype=bool)
        runs = fold_failures(failed, clock, _brought(held, keys, clock, starts, ttl_ms)[0], ttl_ms, starts)
        ends = np.append(starts[1:], len(batch)) - 1
        held |= {k: (n, 0, at) for k, n, at in zip(keys, runs[ends].tolist(), clock[ends].tolist())}
        _write(state, {k: v for k, v in held.items() if v[0]}, int(clock.min()), ttl_ms)
        hit = failed & (runs >= threshold)
        yield batch[hit].assign(failed_run=runs[hit])[columns]

    added = T.StructType().add("failed_run", "long")
    only = F.col("failed") if buckets else None
    return _with_state(rows, "user_id", fold, fold_all, added, "arrival_seq", "failed", buckets=buckets, only=only)


def amount_history(
    rows: DataFrame, key: str, order: str, min_count: int, ttl_ms: int, buckets: int = 0, above: float = 0.0
) -> DataFrame:
    """Rows with enough history, with ``history_count`` and ``history_cents`` before them.

    ``rows`` has the key, the order column and ``cents``, with ``buckets`` also
    ``clock_ms``.  With ``above`` rows that are plainly not above so many times
    the mean are left out; whether the others are is not decided here.
    """

    def fold(_key, frames: Iterator[pd.DataFrame], state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        batch = _in_order(frames, order)
        clock = _clock(batch, state)
        cents = batch["cents"].to_numpy(dtype=np.int64)
        counts, totals, count, total = fold_history(cents, clock, *_load(state, clock[0], ttl_ms), ttl_ms)
        _store(state, count, total, clock[-1], ttl_ms)
        batch["history_count"], batch["history_cents"] = counts, [str(t) for t in totals]
        yield batch[counts >= min_count]

    def fold_all(frames: Iterator[pd.DataFrame], state: GroupState, columns: list[str]):
        batch, keys, starts = _by_key(frames, key, order)
        clock, held = _clock(batch, state), _read(state)
        cents = batch["cents"].to_numpy(dtype=np.int64)
        brought = _brought(held, keys, clock, starts, ttl_ms)
        counts, totals, count, total = fold_histories(cents, clock, *brought, ttl_ms, starts)
        ends = np.append(starts[1:], len(batch)) - 1
        held |= {k: rest for k, *rest in zip(keys, count.tolist(), total.tolist(), clock[ends].tolist())}
        _write(state, held, int(clock.min()), ttl_ms)
        hit = counts >= min_count
        if above:
            # in floating point, so rows near the bound are left in
            hit &= cents.astype(float) * counts >= totals.astype(float) * above * (1 - 1e-9)
        yield batch[hit].assign(history_count=counts[hit], history_cents=[str(t) for t in totals[hit].tolist()])[columns]

    added = T.StructType().add("history_count", "long").add("history_cents", "string")
    return _with_state(rows, key, fold, fold_all, added, order, "cents", buckets=buckets)


def _emitted(at: np.ndarray, last: int | None, period_us: int) -> tuple[list[int], int]:
    """Places of the rows of a key that are emitted, and the time of the last one."""
    if last is None:
        emitted, last = [0], int(at[0])
    else:
        # older by a period or more than what was emitted last: the first of them counts
        emitted = [0] if at[0] <= last - period_us else []
    while (place := int(np.searchsorted(at, last + period_us, side="left"))) < len(at):
        emitted.append(place)
        last = int(at[place])
    return emitted, last


def cooled(rows: DataFrame, period_us: int, buckets: int = 0) -> DataFrame:
    """Rows that are not within ``period_us`` of an emitted row of the same ``key``.

    ``rows`` has ``key``, ``at`` (microseconds) and ``alert_id``.  Rows of a
    micro-batch are taken in order of time; a row that comes after a later one
    was emitted, and is nearer to it than the period, is passed over too.
    """
    kept_ms = period_us // 1000 + COOLDOWN_KEPT_MS

    def fold(key, frames: Iterator[pd.DataFrame], state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        batch = _in_order(frames, "at", "alert_id")
        at = batch["at"].to_numpy(dtype=np.int64)
        emitted, last = _emitted(at, state.get[0] if state.exists else None, period_us)
        state.update((last,))
        state.setTimeoutDuration(kept_ms)
        yield batch.iloc[emitted]

    columns = rows.schema.names

    def fold_all(_bucket, frames: Iterator[pd.DataFrame], state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        batch, keys, starts = _by_key(frames, "key", "at", "alert_id")
        at, now = batch["at"].to_numpy(dtype=np.int64), state.getCurrentProcessingTimeMs()
        held = {k: v for k, v in _read(state).items() if now - v[1] <= kept_ms}
        taken = []
        for k, own in zip(keys, np.split(np.arange(len(at)), starts[1:])):
            emitted, last = _emitted(at[own], held[k][0] if k in held else None, period_us)
            held[k] = (last, now)
            taken.append(own[emitted])
        _write(state, held, now, kept_ms)
        found = batch.iloc[np.concatenate(taken)][columns]
        if len(found):
            yield found

    return _kept(rows, "key", fold_all if buckets else fold, rows.schema, "last bigint", buckets)


def cents(amount: str = "amount"):
    return (F.col(amount) * 100).cast("bigint")


def money(cents_column: str):
    return (F.col(cents_column).cast("decimal(28,0)") / 100).cast("decimal(30,2)")
