"""SRC1: paged JSON sources as a Spark data source."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    DataSourceStreamReader,
    InputPartition,
)
from pyspark.sql.types import StringType, StructField, StructType

# Fixed value: rows asked for per page.
PAGE_SIZE = 50_000
# Pages asked for at the same time, unless the option says otherwise.
STRIPES = 4
# Pages of one batch of an extraction, unless the option says otherwise.
PAGES_PER_BATCH = 40


def _as_batch(names: list[str], rows: list[dict]) -> pa.RecordBatch:
    """A page's records as text columns; a field a record lacks is NULL."""
    text = [[None if r.get(n) is None else str(r[n]) for r in rows] for n in names]
    schema = pa.schema([(n, pa.string()) for n in names])
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in text], schema=schema)


class PageStripe(InputPartition):
    """Pages ``first``, ``first + step``, ``first + 2 * step``, ..."""

    def __init__(self, first: int, step: int):
        super().__init__(first)
        self.first = first
        self.step = step


class PagedReader(DataSourceReader):
    def __init__(self, source: PagedSource):
        self.source = source
        self.page_size = int(source.options.get("pageSize", PAGE_SIZE))
        self.stripes = int(source.options.get("stripes", STRIPES))

    def partitions(self) -> list[PageStripe]:
        return [PageStripe(i, self.stripes) for i in range(self.stripes)]

    def read(self, partition: PageStripe) -> Iterator[pa.RecordBatch]:
        """One batch a page."""
        page = partition.first
        while True:
            rows = self.source.fetch_page(page * self.page_size, self.page_size)
            yield _as_batch(self.source.columns(), rows)
            if len(rows) < self.page_size:
                return
            page += partition.step


class PageRange(InputPartition):
    """Rows ``first`` to ``first + rows``, one page."""

    def __init__(self, first: int, rows: int):
        super().__init__(first)
        self.first = first
        self.rows = rows


class PagedStreamReader(DataSourceStreamReader):
    """A paged source as a stream whose offset is the number of rows read.

    A batch is at most ``pagesPerBatch`` pages, one task each. Where it ends is found
    with requests for single rows: one if a whole batch is there, else a bisection.
    After a restart Spark plans the last batch again before it asks for a new one, which
    tells a new reader where the extraction stands.
    """

    def __init__(self, source: PagedSource):
        self.source = source
        self.page_size = int(source.options.get("pageSize", PAGE_SIZE))
        self.pages = int(source.options.get("pagesPerBatch", PAGES_PER_BATCH))
        self.planned = 0

    def initialOffset(self) -> dict:
        return {"row": 0}

    def latestOffset(self) -> dict:
        low, high = self.planned, self.planned + self.pages * self.page_size - 1
        if self.source.fetch_page(high, 1):
            return {"row": high + 1}
        while low < high:
            middle = (low + high) // 2
            if self.source.fetch_page(middle, 1):
                low = middle + 1
            else:
                high = middle
        return {"row": low}

    def partitions(self, start: dict, end: dict) -> list[PageRange]:
        self.planned = max(self.planned, end["row"])
        firsts = range(start["row"], end["row"], self.page_size)
        return [PageRange(i, min(self.page_size, end["row"] - i)) for i in firsts]

    def read(self, partition: PageRange) -> Iterator[pa.RecordBatch]:
        rows = self.source.fetch_page(partition.first, partition.rows)
        if len(rows) != partition.rows:
            raise ValueError(
                f"{len(rows)} of {partition.rows} rows from {partition.first} on: the source changed"
            )
        yield _as_batch(self.source.columns(), rows)


class PagedSource(DataSource):
    """Subclass and give ``fetch_page``; rows come out as text columns.

    Options: ``columns`` (comma separated), ``pageSize``, ``stripes``, ``pagesPerBatch``.
    Each stripe of a read takes every n-th page and stops at its first short or empty
    page, so the total need not be known and a task never holds more than one page.
    ``fetch_page`` must page over one fixed order and raise on errors: a failed request
    fails the read.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def columns(self) -> list[str]:
        return self.options["columns"].split(",")

    def schema(self) -> StructType:
        return StructType([StructField(c, StringType()) for c in self.columns()])

    def reader(self, schema: StructType) -> PagedReader:
        return PagedReader(self)

    def streamReader(self, schema: StructType) -> PagedStreamReader:
        return PagedStreamReader(self)

    def fetch_page(self, offset: int, limit: int) -> list[dict]:
        raise NotImplementedError


def read_paged(
    spark: SparkSession, source: type[PagedSource], columns: list[str], **options
) -> DataFrame:
    """All rows of a paged source."""
    spark.dataSource.register(source)
    return (
        spark.read.format(source.name())
        .options(columns=",".join(columns), **options)
        .load()
    )


def extract_pages(
    spark: SparkSession,
    source: type[PagedSource],
    columns: list[str],
    folder: str,
    checkpoint: str,
    **options,
) -> DataFrame:
    """All rows of a paged source, written to ``folder`` batch by batch.

    A call that broke off is repeated with the same folder and checkpoint: it goes on
    after the last whole batch, and the files of the broken one do not count. A call
    after the last one adds the rows that the source has gained at its end. Another
    extraction, as of a source that was published anew, takes a new folder and checkpoint.
    """
    spark.dataSource.register(source)
    pages = (
        spark.readStream.format(source.name())
        .options(columns=",".join(columns), **options)
        .load()
    )
    query = (
        pages.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .start()
    )
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return spark.read.schema(pages.schema).parquet(folder)


def read_landed_pages(
    spark: SparkSession, path: str, columns: list[str], pretty: bool = False
) -> DataFrame:
    """Pages landed as JSON files: an array of records or one record on each line.

    ``pretty`` reads files whose single array or record goes over several lines.
    """
    schema = StructType([StructField(c, StringType()) for c in columns])
    return spark.read.schema(schema).option("multiLine", pretty).json(path)
