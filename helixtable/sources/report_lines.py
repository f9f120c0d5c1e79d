"""Lines of domain reports with the session, query and table that they stand in.

Lines are read in the order of their file splits ("blocks"), and each task carries the context down its own lines as arrays, so
that no line is shuffled or sorted. What a block takes from earlier blocks of its file comes from a row for each
block, made by a pass over the files that have several; like the list of splits itself, these few rows go through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from helixtable.ship import ship

OPEN, CLOSED = 1, 0


class Context:
    """What is known before a line: whether DATA was seen, the line before, the last SESSION and QUERY line, and whether a table is open."""

    def __init__(self, seen: bool = False, before: str | None = None, session: str | None = None, query: str | None = None, table: int | None = None, after: str | None = None):
        self.seen, self.before, self.session, self.query, self.table, self.after = seen, before, session, query, table, after

    def _last(self, lines: pa.Array, at: np.ndarray, state: str | None) -> pa.Array:
        """The line at the last marked place up to each line, else state."""
        last = np.maximum.accumulate(np.where(at, np.arange(len(at)), -1))
        return pc.coalesce(lines.take(pa.array(last, mask=last < 0)), pa.scalar(state, pa.string()))

    def carry(self, lines: pa.Array, following: str | None) -> tuple[np.ndarray, dict[str, pa.Array]]:
        """The lines that are of use and their labels; the context moves behind the lines. following: the next line of the file."""
        flags = lambda a: a.to_numpy(zero_copy_only=False)
        data, domains = flags(pc.equal(lines, "DATA")), flags(pc.equal(lines, "DOMAINS"))
        ends, asks = flags(pc.starts_with(lines, "ENDDOMAINS")), flags(pc.starts_with(lines, "QUERY"))
        started = self.seen | (np.cumsum(data) - data > 0)
        behind = np.append((self.before or "").startswith("QUERY"), asks[:-1])
        event = np.where(started & ends, CLOSED, np.where(started & domains & behind, OPEN, -1))
        last = np.append(-1, np.maximum.accumulate(np.where(event >= 0, np.arange(len(event)), -1)))
        table = np.where(last >= 0, event[last], -1 if self.table is None else self.table)
        session, query = flags(pc.starts_with(lines, "SESSION")) & started, asks & started
        inside = started & (table[:-1] == OPEN) & ~ends
        labels = {
            "in_table": pa.array(inside),
            "alone": pa.array(query & ~np.append(domains[1:], following == "DOMAINS")),
            "is_query": pa.array(query),
            "session": self._last(lines, session, self.session),
            "query": self._last(lines, query, self.query),
        }
        self.seen, self.before = bool(self.seen or data.any()), lines[-1].as_py()
        self.session, self.query = labels["session"][-1].as_py(), labels["query"][-1].as_py()
        self.table = None if table[-1] < 0 else int(table[-1])
        return np.flatnonzero(inside | query | session), labels


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, str | None]]:
    """The batches in parts of one block each, with the block's key, and the next line where it is of the same block."""
    parts = (b.slice(i, j - i) for b in batches if b.num_rows for i, j in _bounds(b))
    part = next(parts, None)
    while part is not None:
        then, key = next(parts, None), part.column("key")[0].as_py()
        yield part, key, then.column("line")[0].as_py() if then is not None and then.column("key")[0].as_py() == key else None
        part = then


def _bounds(b: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    keys = b.column("key").to_numpy(zero_copy_only=False)
    edges = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    return zip(edges, edges[1:])


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each block: its first and last line, whether it holds DATA, and its last session, query and table, if DATA was seen before (1) or not (0)."""
    now, rows, states = None, [], ()

    def row() -> dict:
        zero, one = states
        return {"key": now, "first": first, "final": one.before, "data": zero.seen, **{f"{n}{i}": getattr(s, n) for i, s in enumerate(states) for n in ("session", "query", "table")}}

    for part, key, following in _stretches(batches):
        if key != now:
            if states:
                rows.append(row())
            now, states, first = key, (Context(), Context(seen=True)), part.column("line")[0].as_py()
        for s in states:
            s.carry(part.column("line"), following)
    if states:
        rows.append(row())
    schema = pa.schema([("key", pa.int64()), ("first", pa.string()), ("final", pa.string()), ("data", pa.bool_()), *[(f"{n}{i}", t) for i in (0, 1) for n, t in (("session", pa.string()), ("query", pa.string()), ("table", pa.int32()))]])
    yield pa.RecordBatch.from_pylist(rows, schema)


def _contexts(lines: DataFrame) -> dict[int, tuple]:
    """By key, what blocks of files of several blocks start with."""
    several = lines.groupBy("file").agg(F.min("block").alias("lo"), F.max("block").alias("hi")).where("lo < hi").select("file")
    several = [r.file for r in several.collect()]  # as many as the driver has split already
    if not several:
        return {}
    some = lines.where(F.col("file").isin(several))
    found = some.select("key", "line").mapInArrow(_summaries, "key long, first string, final string, data boolean, session0 string, query0 string, table0 int, session1 string, query1 string, table1 int")
    places = some.groupBy("key", "file").agg(F.min("block").alias("block"))
    order = Window.partitionBy("file").orderBy("block")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    df = found.join(places, "key").withColumns({"seen": F.coalesce(F.bool_or("data").over(earlier), F.lit(False)), "before": F.lag("final").over(order), "after": F.lead("first").over(order)})
    # a block that begins with DOMAINS opens a table where the block before ends with a query
    opens = F.when(F.col("seen") & (F.col("first") == "DOMAINS") & F.col("before").startswith("QUERY"), OPEN)
    own = {n: F.when(F.col("seen"), F.col(f"{n}1")).otherwise(F.col(f"{n}0")) for n in ("session", "query", "table")}
    df = df.withColumns({**own, "table": F.coalesce(own["table"], opens)})
    carried = [F.last(n, ignorenulls=True).over(earlier).alias(n) for n in ("session", "query", "table")]
    return {r.key: tuple(r)[1:] for r in df.select("key", "seen", "before", *carried, "after").collect()}


def labelled(lines: DataFrame) -> DataFrame:
    """species, line, in_table, alone (a query that no DOMAINS line follows), is_query, session and query of the lines of use of lines(species, file, block, line).

    lines: as read, in the order of the files; a DOMAINS line opens a table only as the very next line of a QUERY. Lines before DATA are of no use.
    """
    ship(lines.sparkSession)
    keyed = lines.withColumn("key", F.xxhash64("file", "block"))
    known = lines.sparkSession.sparkContext.broadcast(_contexts(keyed))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, Context()
        for b, key, following in _stretches(batches):
            if key != now:
                now, state = key, Context(*known.value.get(key, ()))
            used, labels = state.carry(b.column("line"), state.after if following is None else following)
            columns = {"species": b.column("species"), "line": b.column("line"), **labels}
            yield pa.RecordBatch.from_arrays([c.take(pa.array(used)) for c in columns.values()], names=list(columns))

    return keyed.select("key", "species", "line").mapInArrow(part, "species string, line string, in_table boolean, alone boolean, is_query boolean, session string, query string")
