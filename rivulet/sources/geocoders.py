"""Asking services for rows until one answers: by service, within each by expression, only what is left goes on.

Each stage is a job: the distinct queries of what has no answer yet go to the service in batches, on as many tasks as it
allows, each of which keeps its share of the service's rate. A stage's answers are stored before the next begins, so no
query is sent again because an executor is lost or a frame is read twice; a task that is run again sends its own again.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial, reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rivulet.durable import stored
from rivulet.sources.resilient import resilient

#: Answers to a batch of queries, in their order; None where there is none.
Ask = Callable[[list[str]], Sequence[dict | None]]


@dataclass(frozen=True)
class Service:
    """A service's name, how it is asked, queries in a request, requests a second over all tasks (None: as fast as it
    answers), tasks that ask at once, and how often and after how many seconds a failing request is sent again."""

    name: str
    ask: Ask
    batch: int = 1
    per_second: float | None = None
    tasks: int = 1
    tries: int = 3
    pause: float = 10.0


def one_by_one(ask: Callable[[str], dict | None]) -> Ask:
    """A service that takes single queries."""
    return lambda queries: [ask(q) for q in queries]


class Pace:
    """Holds a caller to so many calls a second."""

    def __init__(self, per_second: float | None, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.gap = 1 / per_second if per_second else 0.0
        self.clock, self.sleep, self.next = clock, sleep, clock()

    def wait(self) -> None:
        now = self.clock()
        if self.gap and now < self.next:
            self.sleep(self.next - now)
        self.next = max(now, self.next) + self.gap


def _asked(batches: Iterator[pd.DataFrame], service: Service, names: Sequence[str], valid: str) -> Iterator[pd.DataFrame]:
    """One frame of answers for a frame of queries, however few a request takes: a frame for each request costs more than asking."""
    pace = Pace(service.per_second / service.tasks if service.per_second else None)
    for b in batches:
        asked, found = b["query"].tolist(), []
        for i in range(0, len(asked), service.batch):
            part = asked[i : i + service.batch]
            pace.wait()
            said = resilient(lambda part=part: list(service.ask(part)), service.tries, service.pause) or [None] * len(part)
            found += [(q, *(x.get(n) for n in names)) for q, x in zip(part, said) if x and x.get(valid) is not None]
        yield pd.DataFrame(found, columns=["query", *names])


def answers(queries: DataFrame, service: Service, fields: StructType, valid: str) -> DataFrame:
    """query and fields of the distinct queries (query) that the service answers with a valid field. A batch that fails
    has no answers."""
    schema = StructType([*queries.select("query").schema.fields, *fields.fields])
    run = partial(_asked, service=service, names=fields.names, valid=valid)
    return queries.select("query").distinct().repartition(service.tasks).mapInPandas(run, schema)


def cascade(rows: DataFrame, keys: Sequence[str], expressions: Sequence[str], services: Sequence[Service], fields: StructType, valid: str) -> DataFrame:
    """keys, service, query and fields of the rows (distinct by keys) that get an answer: the first service that has one for
    any of the expressions (columns of text, in order; null: not asked) counts."""
    if not services or not expressions:
        raise ValueError("there is nobody to ask, or nothing to ask for")
    left = stored(rows.select(*keys, *expressions), "asking-left")
    found = []
    for service in services:
        for e in expressions:
            todo = left.where(F.col(e).isNotNull())
            got = stored(answers(todo.select(F.col(e).alias("query")), service, fields, valid), "asking-answers")
            hit = todo.join(got.withColumnRenamed("query", "_q"), F.col(e) == F.col("_q"))
            found.append(hit.select(*keys, F.lit(service.name).alias("service"), F.col("_q").alias("query"), *fields.names))
            left = stored(left.join(got.select(F.col("query").alias(e)), e, "left_anti").select(*left.columns), "asking-left")
    return reduce(lambda a, b: a.unionByName(b), found)
