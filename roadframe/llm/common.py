"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadframe.session import scratch_path

#: Rows in an Arrow batch: texts can be long, so batches stay small.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's Arrow batch size to at most ``rows``."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back (cuts lineage, survives lost executors)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` without columns that an operator is about to add (compared without case, as Spark resolves them)."""
    taken = {n.lower() for n in names}
    return df.select([F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body's lambdas use it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def add_columns(df: DataFrame, fields: list[T.StructField], make: Callable[[], Callable[[pa.RecordBatch], list]], rows: int = BATCH_ROWS) -> DataFrame:
    """Append columns computed batch by batch. ``make`` runs once in each task and returns the batch function.

    Columns of ``df`` with the same names are replaced. ``rows``: most rows handed to the batch function at a time
    (fewer where its results are much longer than its input).
    """
    bounded_batches(df.sparkSession)
    base = without(df, [f.name for f in fields])
    names = [*base.columns, *(f.name for f in fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for whole in batches:
            for at in range(0, whole.num_rows, rows):
                b = whole.slice(at, rows)
                yield pa.RecordBatch.from_arrays([*b.columns, *fn(b)], names=names)
        pa.default_memory_pool().release_unused()  # the worker lives on, beside the next stage's

    return base.mapInArrow(run, T.StructType([*base.schema.fields, *fields]))


def column(b: pa.RecordBatch, name: str) -> pa.Array:
    return b.column(b.schema.get_field_index(name))


#: Characters beyond those whose lower case, one letter, every Unicode version gives alike (U+0130 becomes a letter and a mark).
BEYOND_LATIN = re.compile("[^\x00-\u012f\u0131-\u017f]")


class Remembered:
    """Packed ids of words, at most twice ``size`` of them: when ``size`` new ones are held, the older half goes unless met again.

    ``stops``: characters that always are a word of their own after letters, so a word that ends in one is put
    together from its parts.
    """

    def __init__(self, size: int, stops: str = ""):
        self.size, self.stops, self.new, self.old = size, stops, {}, {}

    def prepare(self, texts: list[list[str]], encode: Callable[[list[str]], list[bytes]]) -> None:
        """Learn the words of several texts at once, so that ``joined`` finds them."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        self._learn(set().union(*texts).difference(self.new), encode)

    def joined(self, words: list[str], encode: Callable[[list[str]], list[bytes]]) -> bytes:
        """The words' ids in turn; ``encode`` gives those of words not remembered."""
        try:
            return b"".join(map(self.new.__getitem__, words))
        except KeyError:
            if len(self.new) > self.size:
                self.old, self.new = self.new, {}
            self._learn(set(words).difference(self.new), encode)
            return b"".join(map(self.new.__getitem__, words))

    def _learn(self, words: set[str], encode: Callable[[list[str]], list[bytes]]) -> None:
        unseen, parted = set(), []

        def need(w: str) -> None:
            if w not in self.new:
                if (ids := self.old.get(w)) is None:
                    unseen.add(w)
                else:
                    self.new[w] = ids

        for w in words:
            if w not in self.old and w[-1] in self.stops and w[:-1].isalpha() and not BEYOND_LATIN.search(w):
                parted.append(w)
                need(w[:-1])
                need(w[-1])
            else:
                need(w)
        order = list(unseen)
        self.new.update(zip(order, encode(order) if order else [], strict=True))
        self.new.update((w, self.new[w[:-1]] + self.new[w[-1]]) for w in parted)


def own_words(split: Callable[[str], list], stops: str = ",.") -> str:
    """Those of ``stops`` that a tokenizer's word splitter cuts off after letters."""
    return "".join(x for x in stops if len(split("ab" + x)) == 2)
