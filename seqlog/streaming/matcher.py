"""Sequence matching on a stream, in event-time order, with bounded state."""

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from seqlog.operators.pattern import Sequence, bucketed, flagged, sequence_inputs

LATE = "late_rows"


class SequenceMatcher(StatefulProcessor):
    """Per key and time bucket: hold rows until the watermark passes them, then match in time order.

    State is the rows still ahead of the watermark plus the last n-1 processed ones, and is dropped
    when the watermark leaves the bucket and its look-ahead. Rows at or behind the watermark on
    arrival take no part and are counted instead.
    """

    def __init__(
        self, sequence: Sequence, inputs: list[str], state: T.StructType, output: list[str]
    ):
        self.sequence = sequence
        self.inputs = inputs
        self.output = output
        self.state = state
        self.places = {name: i for i, name in enumerate(state.names)}

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.ahead = handle.getListState("ahead", self.state)
        self.tail = handle.getListState("tail", self.state)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        accepted, late = [], 0
        for row in rows:
            if row["_ms"] <= mark:
                late += row["_home"]
            else:
                accepted.append(tuple(row[name] for name in self.state.names))
        if accepted:
            self.ahead.appendList(accepted)
            at = self.places["_ms"]
            self._wake(min(row[at] for row in accepted))
        if late:
            yield self._out(key, {}, late)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        at = self.places["_ms"]
        held = [tuple(row) for row in self.ahead.get()]
        ready = [row for row in held if row[at] <= mark]
        waiting = [row for row in held if row[at] > mark]
        tail = [tuple(row) for row in self.tail.get()]
        order = [self.places[n] for n in self.state.names if n == "_ms" or n.startswith("_tie")]
        line = tail + sorted(ready, key=lambda row: tuple(row[i] for i in order))
        for found in self._matches(line):
            yield self._out(key, found, None)
        self._keep(self.ahead, waiting)
        bucket_end = (key[-1] + 1) * self.sequence.bucket_ms + self.sequence.within_ms
        closed = mark >= bucket_end
        self._keep(self.tail, [] if closed else line[-(len(self.sequence.steps) - 1) :])
        if waiting:
            self._wake(min(row[at] for row in waiting))
        elif not closed:
            self._wake(bucket_end)

    def close(self) -> None:
        pass

    def _wake(self, ms: int) -> None:
        self.handle.registerTimer(ms)

    @staticmethod
    def _keep(state, rows: list[tuple]) -> None:
        if rows:
            state.put(rows)
        else:
            state.clear()

    def _matches(self, line: list[tuple]) -> Iterator[dict]:
        """Every window of adjacent rows; the tail holds n-1 rows, so each ends in a new one."""
        sequence, places = self.sequence, self.places
        names, width = sequence.names, len(sequence.steps)
        ms, flags, home = places["_ms"], places["_flags"], places["_home"]
        for first in range(len(line) - width + 1):
            window = line[first : first + width]
            span = window[-1][ms] - window[0][ms]
            in_time = span <= sequence.within_ms if sequence.inclusive else span < sequence.within_ms
            if not (window[0][home] and in_time):
                continue
            if not all(window[i][flags] >> i & 1 for i in range(width)):
                continue
            equal = all(
                len({window[names.index(s)][places[f"_same{i}"]] for s in sequence.over}) == 1
                and window[names.index(sequence.over[0])][places[f"_same{i}"]] is not None
                for i in range(len(sequence.same))
            )
            if equal:
                yield {
                    name: window[names.index(step)][places[f"_in{self.inputs.index(column)}"]]
                    for name, (step, column) in sequence.measures.items()
                }

    def _out(self, key, found: dict, late: int | None) -> Row:
        measures = [found.get(name) for name in self.sequence.measures]
        return Row(*self.output)(*key[: len(self.output) - len(measures) - 1], *measures, late)


def match_sequence_stream(
    events: DataFrame | list[DataFrame],
    sequence: Sequence,
    keys: list[str],
    time_ms: str = "epoch_ms",
    ties: list[str] = ("stream", "seq_num"),
    lateness: str = "5 seconds",
) -> DataFrame:
    """Streaming twin of match_sequence: key columns, measures, and `late_rows`.

    A match appears once the watermark has passed its last row. Rows with `late_rows` set report
    how many events of a key came too late; the other rows have it null and are the matches.

    Several frames keep a watermark each and the slowest one counts, so a group of streams that lags
    behind the others does not become late; a group without new events then holds the others back.
    """
    groups, inputs = events if isinstance(events, list) else [events], sequence_inputs(sequence)
    parts = []
    for group in groups:
        rows = bucketed(flagged(group, sequence, list(keys), time_ms, list(ties)), sequence)
        timed = rows.withColumn("_time", F.timestamp_millis("_ms"))
        parts.append(timed.withWatermark("_time", lateness))
    timed = reduce(DataFrame.unionByName, parts)
    types = rows.schema
    state = T.StructType([f for f in types.fields if f.name not in (*keys, "_bucket")])
    output = T.StructType(
        [T.StructField(k, types[k].dataType) for k in keys]
        + [
            T.StructField(name, types[f"_in{inputs.index(column)}"].dataType)
            for name, (_, column) in sequence.measures.items()
        ]
        + [T.StructField(LATE, T.LongType())]
    )
    return timed.groupBy(*keys, "_bucket").transformWithState(
        SequenceMatcher(sequence, inputs, state, output.names), output, "append", "EventTime"
    )


def matches_only(found: DataFrame) -> DataFrame:
    """The matches, with the late events counted as a query metric named `lateness`."""
    watched = found.observe("lateness", F.coalesce(F.sum(LATE), F.lit(0)).alias(LATE))
    return watched.where(F.col(LATE).isNull()).drop(LATE)
