"""Numbered folders of a streaming sink, which count once they are complete.

A folder is complete when the writer has put its ``_SUCCESS`` file there.  A batch that
runs again writes its own number again, from the state of an earlier number, so nothing
is lost or repeated, whenever it was interrupted.

``Spans`` keeps rows that never change: one folder per batch, merged in tiers (``keep``
folders of a tier become one of the next), so their number grows with the logarithm of
the batches only.  A span inside a longer one is left over from a merge and not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _folder(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of the complete folders below ``path``."""
    p, fs = _folder(spark, path)
    if not fs.exists(p):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]
    done = [n for n in found if n.startswith(prefix) and fs.exists(_folder(spark, f"{path}/{n}/_SUCCESS")[0])]
    return [n[len(prefix):] for n in done]


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _folder(spark, path)
    fs.delete(p, True)


class Versions:
    """The last versions of a table that every batch replaces."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | None = None, keep: int = 3):
        self.spark, self.path, self.schema, self.keep = spark, path, schema, keep

    def numbers(self) -> list[int]:
        return sorted(int(n) for n in names(self.spark, self.path, "batch="))

    def before(self, epoch: int) -> DataFrame | None:
        """The version that batch ``epoch`` continues."""
        earlier = [n for n in self.numbers() if n < epoch]
        return self.read(earlier[-1]) if earlier else None

    def read(self, number: int) -> DataFrame:
        reader = self.spark.read
        return (reader.schema(self.schema) if self.schema else reader).parquet(f"{self.path}/batch={number}")

    def last(self) -> tuple[int, DataFrame] | None:
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else None

    def write(self, rows: DataFrame, epoch: int) -> None:
        """Version ``epoch``; of the earlier ones the last ``keep - 1`` stay, for readers and for a replay."""
        rows.write.mode("overwrite").parquet(f"{self.path}/batch={epoch}")
        earlier = [n for n in self.numbers() if n < epoch]
        for n in earlier[:len(earlier) - self.keep + 1]:
            remove(self.spark, f"{self.path}/batch={n}")


class Spans:
    """Rows written once, in folders ``span=<first batch>_<last batch>_<tier>``."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keep: int = 16):
        self.spark, self.path, self.schema, self.keep = spark, path, schema, keep

    def live(self) -> list[tuple[int, int, int]]:
        """The complete spans that lie in no other, in order."""
        found = sorted((tuple(map(int, n.split("_"))) for n in names(self.spark, self.path, "span=")),
                       key=lambda s: (s[0], -s[1], -s[2]))
        out = []
        for s in found:
            if not out or s[1] > out[-1][1]:
                out.append(s)
        return out

    def _at(self, span: tuple[int, int, int]) -> str:
        return f"{self.path}/span={span[0]}_{span[1]}_{span[2]}"

    def read(self, upto: int) -> DataFrame:
        """All rows of the batches up to ``upto``."""
        paths = [self._at(s) for s in self.live() if s[1] <= upto]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def write(self, rows: DataFrame, epoch: int) -> None:
        remove(self.spark, self._at((epoch, epoch, 0)))
        if not rows.isEmpty():
            rows.write.mode("overwrite").parquet(self._at((epoch, epoch, 0)))

    def compact(self, below: int) -> None:
        """Merge full tiers of the batches before ``below``, which no replay writes again."""
        spans = [s for s in self.live() if s[1] < below]
        for tier in sorted({s[2] for s in spans}):
            group = [s for s in spans if s[2] == tier]
            if len(group) >= self.keep:
                merged = (group[0][0], group[-1][1], tier + 1)
                rows = self.spark.read.schema(self.schema).parquet(*[self._at(s) for s in group])
                rows.coalesce(max(1, rows.rdd.getNumPartitions() // self.keep)).write.mode("overwrite").parquet(self._at(merged))
                spans = [s for s in spans if s not in group] + [merged]
        live = set(self.live())
        for n in names(self.spark, self.path, "span="):
            span = tuple(map(int, n.split("_")))
            if span not in live and span[1] < below:
                remove(self.spark, self._at(span))
