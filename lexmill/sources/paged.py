"""A paged REST source: one partition a page, or one partition in all where pages hang on a cursor.

    spark.dataSource.register(PagedSource)
    spark.read.format("paged_rest").schema(...).option("url", ...).load()

Options: url (with ``{page}`` and ``{limit}``, or ``{cursor}``), mode (``pages`` or ``cursor``), limit (100), most_pages
(10, for cursors), data (field with the rows), total (dotted field with the number of pages), next (dotted field with
the cursor). Rows keep the schema's fields; a value that isn't of its field's type is null.
"""

from __future__ import annotations

import json
from urllib.parse import quote
from urllib.request import urlopen

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class _Page(InputPartition):
    def __init__(self, number: int):
        super().__init__(number)
        self.number = number


def _field(payload, dotted: str):
    for name in dotted.split("."):
        payload = payload.get(name) if isinstance(payload, dict) else None
    return payload


class _Reader(DataSourceReader):
    def __init__(self, schema, options: dict):
        self.names = [(f.name, f.dataType.simpleString()) for f in schema.fields]
        self.options = {"mode": "pages", "limit": "100", "most_pages": "10", "data": "data", "total": "meta.total_pages", "next": "meta.next_cursor"} | {k: v for k, v in options.items()}

    def _get(self, **values) -> dict:
        url = self.options["url"]
        for name, value in (values | {"limit": self.options["limit"]}).items():
            url = url.replace("{" + name + "}", quote(str(value)))
        with urlopen(url, timeout=60) as answer:  # a lost task asks for its page again
            return json.load(answer)

    def partitions(self) -> list[InputPartition]:
        if self.options["mode"] == "cursor":
            return [_Page(0)]
        total = _field(self._get(page=1), self.options["total"])
        return [_Page(n) for n in range(1, max(1, int(total or 1)) + 1)]

    def read(self, partition: _Page):
        if self.options["mode"] == "pages":
            yield from self._rows(self._get(page=partition.number))
            return
        cursor = ""
        for _ in range(int(self.options["most_pages"])):
            payload = self._get(cursor=cursor)
            yield from self._rows(payload)
            cursor = _field(payload, self.options["next"])
            if not cursor:
                return

    def _rows(self, payload: dict):
        casts = {"string": lambda v: v if isinstance(v, str) else json.dumps(v), "bigint": int, "int": int, "double": float, "boolean": bool}
        for row in _field(payload, self.options["data"]) or []:
            out = []
            for name, kind in self.names:
                try:
                    out.append(None if row.get(name) is None else casts.get(kind, lambda v: v)(row[name]))
                except (TypeError, ValueError):
                    out.append(None)
            yield tuple(out)


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_rest"

    def schema(self) -> str:
        return "id string, name string, value double, observation_id string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(schema, dict(self.options))
