"""A Spark data source over a paged record service, such as an ERP's export interface.

A client gives ``count()``, ``fields()`` (name to SQL type) and ``read(names, offset, limit)``.  Pages are partitions; fields that the service
refuses are dropped while the schema is settled, before any page is planned.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGE = 500


@dataclass
class Page(InputPartition):
    offset: int
    limit: int

    def __init__(self, offset: int, limit: int) -> None:
        super().__init__((offset, limit))
        self.offset, self.limit = offset, limit


def _client(options: dict):
    module, _, name = options["client"].partition(":")
    return getattr(importlib.import_module(module), name)(options)


def accepted_fields(client, wanted: list[str]) -> tuple[list[str], list[str]]:
    """Fields that the service knows, in the wanted order, and those it does not."""
    known = client.fields()
    return [f for f in wanted if f in known], [f for f in wanted if f not in known]


class PagedSource(DataSource):
    """Options: client (``module:factory``), fields (comma-separated, optional), page (rows of a page)."""

    @classmethod
    def name(cls) -> str:
        return "paged_records"

    def _fields(self) -> list[str]:
        client = _client(self.options)
        wanted = [x.strip() for x in self.options.get("fields", "").split(",") if x.strip()] or list(client.fields())
        return accepted_fields(client, wanted)[0]

    def schema(self) -> str:
        kinds = _client(self.options).fields()
        return ", ".join(f"`{f}` {kinds[f]}" for f in self._fields())

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(dict(self.options), [f.name for f in schema.fields])


class PagedReader(DataSourceReader):
    def __init__(self, options: dict, fields: list[str]) -> None:
        self.options, self.fields = options, fields
        self.page = int(options.get("page", PAGE))

    def partitions(self) -> list[Page]:
        return [Page(at, self.page) for at in range(0, _client(self.options).count(), self.page)]

    def read(self, part: Page) -> Iterator[tuple]:
        for record in _client(self.options).read(self.fields, part.offset, part.limit):
            yield tuple(record.get(f) for f in self.fields)


def many2one(c: Column, name: str) -> list[Column]:
    """``<name>_id`` and ``<name>_name`` of a struct (id, name); blank for null."""
    return [F.coalesce(c["id"].cast("string"), F.lit("")).alias(f"{name}_id"), F.coalesce(c["name"], F.lit("")).alias(f"{name}_name")]


def many2many(rows, key: str, ids: str, names):
    """(key, ids, names): an array of ids as joined texts in its order, names through a table (id, name); unknown names are blank."""
    flat = rows.select(key, F.posexplode(ids).alias("at", "id")).join(names.select("id", "name"), "id", "left")
    pairs = F.array_sort(F.collect_list(F.struct("at", F.col("id").cast("string").alias("i"), F.coalesce("name", F.lit("")).alias("n"))))
    out = flat.groupBy(key).agg(pairs.alias("p"))
    return out.select(key, F.array_join(F.transform("p", lambda x: x["i"]), "|").alias("ids"), F.array_join(F.transform("p", lambda x: x["n"]), "|").alias("names"))
