"""Complete paging of a list whose order and length change while it is read (L-05).

Pages arrive in rounds. A page brings the total that the source announces and some ids. The state of a key (one search) is what it has collected, and
one step takes it from a page to the next: a total that differs from the last one, or more ids than the total, drops what was collected, as a row
that has gone could otherwise stand in for one that is missing. A list is COMPLETE when as many ids as announced are together; it is given up after
`stall` rounds in a row without a new id (a round that dropped its ids counts as one) and when `budget` pages are spent, and is then never a result.

The same step runs over a table, in order within each key (rows stream through a task that holds one key's ids at a time), and over a stream with
state per key. Ids of a state are at most `most`: a larger total ends with TOO_MANY, as the source is not to be read in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MORE, COMPLETE, STALLED, BUDGET, TOO_MANY = "MORE", "COMPLETE", "STALLED", "BUDGET", "TOO_MANY"


@dataclass
class Collected:
    """What is known of one list."""

    total: int | None = None
    seen: set = field(default_factory=set)
    round: int | None = None
    pages: int = 0
    new: int = 0
    restarts: int = 0
    restarted: bool = False
    stall: int = 0
    state: str = MORE

    def end_round(self, stall: int) -> None:
        """The round that is open brings its result to the count of rounds without progress."""
        if self.round is None or self.state != MORE:
            return
        self.stall = 0 if self.new and not self.restarted else self.stall + 1
        if self.stall >= stall:
            self.state = STALLED

    def page(self, number: int, total: int, ids: list, stall: int, budget: int, most: int) -> None:
        """One page of round `number`."""
        if self.state != MORE:
            return
        if number != self.round:
            self.end_round(stall)
            if self.state != MORE:
                return
            self.round, self.new, self.restarted = number, 0, False
        self.pages += 1
        if self.total is not None and total != self.total:
            self._drop()
        self.total = total
        if total > most:
            self.state = TOO_MANY
            return
        fresh = [i for i in dict.fromkeys(ids) if i is not None and i not in self.seen]
        if len(self.seen) + len(fresh) > total:
            self._drop()
            self.total = None
        else:
            self.seen.update(fresh)
            self.new += len(fresh)
            if len(self.seen) == total:
                self.state = COMPLETE
                return
        if self.pages >= budget:
            self.state = BUDGET

    def _drop(self) -> None:
        self.seen, self.new, self.restarted = set(), 0, True
        self.restarts += 1

    def said(self) -> tuple:
        return self.round, self.pages, self.total, len(self.seen), self.restarts, self.state


COLUMNS = "round long, pages long, total long, seen long, restarts long, state string"


def paged(arrivals: DataFrame, key: str, stall: int = 3, budget: int = 60, most: int = 10_000) -> DataFrame:
    """arrivals: (key, round, page, total, ids), ids an array of strings. One row for each key: how its list ended (MORE: it may still complete).

    Rows of a key are sorted in the shuffle and folded as they pass, so no group is held; the ids that are held are at most `most`. A null total is
    a page that could not be read: it costs a page and changes nothing else.
    """
    field_ = arrivals.schema[key]
    names = [field_.name, *[c.split()[0] for c in COLUMNS.split(", ")]]
    types = [pa.int64()] * 5 + [pa.string()]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done, kind = None, None, [], None
        for batch in batches:
            kind = batch.schema.field(0).type
            columns = [c.to_pylist() for c in batch.columns]
            for of, number, total, ids in zip(*columns, strict=True):
                if state is None or of != now:
                    if state is not None:
                        state.end_round(stall)
                        done.append((now, *state.said()))
                    now, state = of, Collected()
                if total is None:
                    state.pages += state.state == MORE
                else:
                    state.page(number, total, ids or [], stall, budget, most)
            if len(done) >= 4096:
                yield _rows(done, kind, names, types)
                done = []
        if state is not None:
            state.end_round(stall)
            done.append((now, *state.said()))
        if done:
            yield _rows(done, kind, names, types)

    ordered = arrivals.where(F.col(key).isNotNull()).select(key, "round", "page", "total", F.col("ids").cast("array<string>").alias("ids"))
    ordered = ordered.repartition(F.col(key)).sortWithinPartitions(key, "round", "page").select(key, F.col("round").cast("long"), F.col("total").cast("long"), "ids")
    return ordered.mapInArrow(fold, f"`{field_.name}` {field_.dataType.simpleString()}, {COLUMNS}")


def _rows(done: list[tuple], kind: pa.DataType, names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*done, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(columns[0], kind), *[pa.array(c, t) for c, t in zip(columns[1:], types, strict=True)]], names)


_STATE = "total long, seen array<string>, round long, pages long, new long, restarts long, restarted boolean, stall long, state string"


def paged_stream(arrivals: DataFrame, key: str, stall: int = 3, budget: int = 60, most: int = 10_000) -> DataFrame:
    """The same fold over a stream of arrivals, with the state of each key kept between batches; a row for each key that a batch has pages of.

    A batch's pages are taken in the order of round and page; a page of an earlier round than those taken before counts as a round of its own.
    """
    from pyspark.sql.streaming.state import GroupStateTimeout

    kind = arrivals.schema[key].dataType.simpleString()

    def step(of: tuple, batches: Iterator[pd.DataFrame], kept) -> Iterator[pd.DataFrame]:
        now = Collected()
        if kept.exists:
            total, seen, number, pages, new, restarts, restarted, still, state = kept.get
            now = Collected(total, set(seen), number, pages, new, restarts, restarted, still, state)
        pages = pd.concat(list(batches)).sort_values(["round", "page"], kind="stable")
        for number, total, ids in zip(pages["round"], pages["total"], pages["ids"], strict=True):
            if pd.isna(total):
                now.pages += now.state == MORE
            else:
                now.page(int(number), int(total), list(ids) if ids is not None else [], stall, budget, most)
        kept.update((now.total, sorted(now.seen), now.round, now.pages, now.new, now.restarts, now.restarted, now.stall, now.state))
        yield pd.DataFrame([(of[0], *now.said())], columns=[key, *[c.split()[0] for c in COLUMNS.split(", ")]])

    rows = arrivals.where(F.col(key).isNotNull()).select(key, F.col("round").cast("long"), F.col("page").cast("long"), F.col("total").cast("long"), F.col("ids").cast("array<string>"))
    return rows.groupBy(key).applyInPandasWithState(step, f"`{key}` {kind}, {COLUMNS}", _STATE, "update", GroupStateTimeout.NoTimeout)
