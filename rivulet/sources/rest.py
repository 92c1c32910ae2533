"""A paginated REST table as a Spark data source, one partition per page or, beyond so many, per run of pages; and its writing verbs.

    spark.dataSource.register(PagedSource)
    spark.read.format("paged_rest").option("url", ...).option("api_key", ...).schema("id string, ...").load()

The service answers {name: [rows], meta: {total: n}}. Pages are read by tasks, each tried again on failure, so pages
go as parallel as there are tasks. A transport can be named by option (module:function) to stand in for HTTP.

As a stream (spark.readStream.format("paged_rest")) each micro-batch has what is new: rows beyond those read so far, for
tables that only grow, or, with the option changed (a column), rows changed after the last time seen. How far the
stream is, Spark keeps in the query's checkpoint folder, so a restart goes on there.
"""

from __future__ import annotations

import importlib
import json
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from rivulet.sources.resilient import resilient

PAGE, TIMEOUT = 100, 3600
#: Partitions of a read at most: more pages than that go in runs, as a task costs more than a page (in a stream each starts Python anew).
RUNS = 64
#: (method, url, api key, body) -> (status, answer)
Transport = Callable[[str, str, str, object], tuple[int, object]]


def http(method: str, url: str, key: str, body: object = None) -> tuple[int, object]:
    """The transport over HTTP."""
    data = json.dumps(body).encode() if body is not None else None
    request = urllib.request.Request(url, data, {"Api-Token": key, "Content-Type": "application/json"}, method=method)
    with urllib.request.urlopen(request, timeout=TIMEOUT) as answer:
        text = answer.read()
        return answer.status, json.loads(text) if text else None


def transport_of(name: str | None) -> Transport:
    if not name:
        return http
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def paged_url(url: str, **arguments: object) -> str:
    return url + ("&" if "?" in url else "?") + urllib.parse.urlencode(arguments)


def total(url: str, key: str, transport: Transport = http) -> int:
    """Rows that the table has, by asking for one."""
    _, answer = transport("GET", paged_url(url, limit=1), key, None)
    return int(answer["meta"]["total"])


def offsets(length: int, offset: int = 0, most: int | None = None, page: int = PAGE) -> list[tuple[int, int]]:
    """(offset, limit) of each page."""
    end = length if most is None else min(length, offset + most)
    return [(k, min(page, end - k)) for k in range(offset, end, page)]


def runs(length: int, offset: int = 0, most: int | None = None) -> list[tuple[int, int]]:
    """(offset, limit) of each partition: a page, or as many whole pages as leave `RUNS` partitions."""
    pages = len(range(offset, length if most is None else min(length, offset + most), PAGE))
    return offsets(length, offset, most, PAGE * max(1, -(-pages // RUNS)))


class Page(InputPartition):
    """Rows that are read page by page."""

    def __init__(self, offset: int, limit: int) -> None:
        self.offset, self.limit = offset, limit


class PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.schema, self.options = schema, options
        self.url, self.key = options["url"], options.get("api_key", "")
        self.name = options.get("name") or urllib.parse.urlparse(self.url).path.rstrip("/").rsplit("/", 1)[-1]

    def partitions(self) -> Sequence[InputPartition]:
        transport = transport_of(self.options.get("transport"))
        most = self.options.get("max_len")
        pages = runs(total(self.url, self.key, transport), int(self.options.get("offset", 0)), int(most) if most else None)
        return [Page(*p) for p in pages]

    def read(self, partition: Page) -> Iterator[tuple]:
        yield from map(self.text, self.paged(self.url, partition))

    def paged(self, url: str, partition: Page | Span) -> Iterator[dict]:
        """The rows of a partition's pages."""
        for offset, limit in offsets(partition.offset + partition.limit, partition.offset):
            yield from self.rows(paged_url(url, limit=limit, offset=offset))

    def text(self, row: dict) -> tuple:
        return tuple(_text(row.get(f)) for f in self.schema.names)

    def rows(self, url: str) -> list[dict]:
        """A page's rows; raises if there is no answer after all tries."""
        transport = transport_of(self.options.get("transport"))
        answer = resilient(lambda: transport("GET", url, self.key, None)[1], int(self.options.get("tries", 10)), float(self.options.get("pause", 10)))
        if answer is None:
            raise RuntimeError(f"no answer for {url}")
        return answer.get(self.name) or []


def _text(x: object) -> str | None:
    return None if x is None else x if isinstance(x, str) else json.dumps(x)


class Span(InputPartition):
    """Pages of the rows changed after one time and not after another."""

    def __init__(self, offset: int, limit: int, after: str, until: str) -> None:
        self.offset, self.limit, self.after, self.until = offset, limit, after, until


class GrowingReader(DataSourceStreamReader):
    """Rows in the order in which the service numbers them: an offset is how many there are."""

    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.pages = PagedReader(schema, options)
        self.transport = transport_of(options.get("transport"))

    def initialOffset(self) -> dict:
        return {"rows": int(self.pages.options.get("offset", 0))}

    def latestOffset(self) -> dict:
        return {"rows": total(self.pages.url, self.pages.key, self.transport)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        return [Page(*p) for p in runs(end["rows"], start["rows"])]

    def read(self, partition: Page) -> Iterator[tuple]:
        return self.pages.read(partition)

    def commit(self, end: dict) -> None:
        """Nothing is held for a batch."""


class ChangedReader(GrowingReader):
    """Rows by the time of their last change (text that sorts by time): an offset is the latest time seen. A row that changes again before it
    is read comes with the batch of its new time."""

    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        super().__init__(schema, options)
        self.column = options["changed"]

    def initialOffset(self) -> dict:
        return {"until": self.pages.options.get("since", "1900-01-01")}

    def latestOffset(self) -> dict:
        _, answer = self.transport("GET", paged_url(self.pages.url, limit=1, **{f"orders[{self.column}]": "DESC"}), self.pages.key, None)
        rows = answer.get(self.pages.name) or []
        return {"until": max([r[self.column] for r in rows if r.get(self.column)], default=self.initialOffset()["until"])}

    def _after(self, time: str) -> str:
        return paged_url(self.pages.url, **{"filters[updated_after]": time})

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        if start["until"] == end["until"]:
            return []
        length = total(self._after(start["until"]), self.pages.key, self.transport)
        return [Span(*p, start["until"], end["until"]) for p in runs(length)]

    def read(self, partition: Span) -> Iterator[tuple]:
        for row in self.pages.paged(self._after(partition.after), partition):
            if row.get(self.column) and partition.after < row[self.column] <= partition.until:
                yield self.pages.text(row)


class PagedSource(DataSource):
    """Columns are strings; give them as the schema. Options: url, api_key, name, offset, max_len, tries, pause, transport; of a
    stream also changed and since."""

    @classmethod
    def name(cls) -> str:
        return "paged_rest"

    def schema(self) -> str:
        return self.options.get("columns", "id string")

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedReader(schema, dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        options = dict(self.options)
        return (ChangedReader if options.get("changed") else GrowingReader)(schema, options)


class Client:
    """Writing verbs. With dry_run nothing is sent and the request is returned."""

    def __init__(self, url: str, key: str, transport: Transport = http, dry_run: bool = False) -> None:
        self.url, self.key, self.transport, self.dry_run = url.rstrip("/"), key, transport, dry_run

    def execute(self, path: str, body: object = None, codes: Iterable[int] = (200, 201), method: str = "POST") -> object:
        """The answer; raises if its status isn't among the codes."""
        if self.dry_run:
            return {"method": method, "url": f"{self.url}/{path}", "body": body}
        status, answer = self.transport(method, f"{self.url}/{path}", self.key, body)
        if status not in set(codes):
            raise RuntimeError(f"{method} {path}: status {status}")
        return answer

    def named(self, kind: str, names: Sequence[str], label: str = "name") -> tuple[dict[str, str], list[str]]:
        """Ids of the things with these names, and the names that there are none of."""
        found: dict[str, str] = {}
        for offset, limit in offsets(total(f"{self.url}/{kind}", self.key, self.transport)):
            _, answer = self.transport("GET", paged_url(f"{self.url}/{kind}", limit=limit, offset=offset), self.key, None)
            found |= {x[label]: x["id"] for x in answer[kind] if x[label] in names}
        return found, [n for n in names if n not in found]

    def each(self, kind: str, names: Sequence[str], method: str, bodies: Sequence[object] | None = None, label: str = "name") -> list[object]:
        """Sends a verb for each named thing; unknown names are warned of and skipped."""
        import warnings

        ids, unknown = self.named(kind, names, label)
        if unknown:
            warnings.warn(f"no such {kind}: {', '.join(unknown)}", stacklevel=2)
        return [self.execute(f"{kind}/{ids[n]}", bodies[i] if bodies else None, (200, 201), method) for i, n in enumerate(names) if n in ids]

    def delete_tags(self, names: Sequence[str]) -> list[object]:
        return self.each("tags", names, "DELETE", label="tag")

    def rename_tags(self, old: Sequence[str], new: Sequence[str]) -> list[object]:
        return self.each("tags", old, "PUT", [{"tag": {"tag": n}} for n in new], label="tag")

    def delete_segments(self, names: Sequence[str]) -> list[object]:
        return self.each("segments", names, "DELETE")

    def update_email(self, contact: str, email: str) -> object:
        return self.execute(f"contacts/{contact}", {"contact": {"email": email}}, (200,), "PUT")

    def add_tag(self, contact: str, tag: str) -> object:
        ids, _ = self.named("tags", [tag], "tag")
        return self.execute("contactTags", {"contactTag": {"contact": contact, "tag": ids.get(tag)}}, (200, 201))


def resolve_orphans(client: Client, rows: Iterable[dict], decide: Callable[[dict], str], allowed: str | None = None, tag: str = "Orphan Account") -> list[object]:
    """Acts on each orphan (a small list) as decide says: update or tag. Addresses that `allowed` (a pattern) doesn't
    match are dry runs."""
    import re

    out = []
    for row in rows:
        real = allowed is None or re.search(allowed, str(row["address"]))
        c = client if real else Client(client.url, client.key, client.transport, True)
        what = decide(row)
        if what == "update":
            out.append(c.update_email(str(row["id"]), str(row["to"])))
        elif what == "tag":
            out.append(c.add_tag(str(row["id"]), tag))
    return out
