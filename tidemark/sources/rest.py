"""A batch source that reads JSON lists from an HTTP service, a page for each task.

    spark.dataSource.register(RestSource)
    spark.read.format("rest").schema("job_id bigint, name string").option("url", "http://host/jobs?page={page}")
        .option("pages", 3).option("field", "jobs").load()

Options: url, where `{page}` stands for the page's number; pages (1 by default); field, the name under which an answer
holds its list, if it isn't the list itself; token, sent as a bearer token; timeout in seconds. An item that lacks a
column gives NULL there; nested values of text columns come as JSON. A status other than 200 fails the task, which Spark runs again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructType


class RestSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "rest"

    def schema(self) -> str:
        raise ValueError("the rest source needs a schema")

    def reader(self, schema: StructType) -> RestReader:
        return RestReader(schema, dict(self.options))


class RestReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]):
        self._schema, self._options = schema, options
        if not options.get("url", "").startswith(("http://", "https://")):
            raise ValueError("the rest source needs an http url")

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(page) for page in range(int(self._options.get("pages", 1)))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from urllib.request import Request, urlopen

        token = self._options.get("token")
        request = Request(self._options["url"].replace("{page}", str(partition.value)), headers={"Authorization": f"Bearer {token}"} if token else {})
        with urlopen(request, timeout=float(self._options.get("timeout", 30))) as answer:
            body = json.load(answer)
        items = body.get(self._options["field"], []) if self._options.get("field") else body
        for item in items:
            yield tuple(_cell(item.get(f.name), isinstance(f.dataType, StringType)) for f in self._schema.fields)


def _cell(value, as_text: bool):
    return json.dumps(value, ensure_ascii=False, sort_keys=True) if as_text and isinstance(value, (dict, list, int, float)) else value
