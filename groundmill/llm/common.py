"""What several operators share: scratch tables, connected components, blocks of Arrow rows."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from groundmill.plans.graph import connected_components, free, split_join, stored

__all__ = ["connected_components", "free", "gathered", "join_labels", "map_arrow", "ship", "slices", "sorted_groups", "split_join", "stored", "word_count"]

#: Words are what lies between these characters: space, tab, line feed, vertical tab, form feed, return.
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD_GAP_CHARS = " \t\n\x0b\f\r"


def word_count(text: Column) -> Column:
    """Number of words; null and blank texts have none."""
    inner = F.btrim(text, F.lit(WORD_GAP_CHARS))
    return F.when(text.isNull() | (inner == ""), F.lit(0)).otherwise(F.size(F.split(inner, WORD_GAP))).cast("long")


def slices(batches: Iterable[pa.RecordBatch], columns: list[str], most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the named binary columns hold about ``most`` bytes at once, whatever the text sizes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        weight = sum(np.diff(np.frombuffer(batch[c].cast(pa.large_binary()).buffers()[1], np.int64, batch.num_rows + 1, 8 * batch[c].offset)) for c in columns)
        block = np.cumsum(weight) // most
        cuts = [0, *(np.nonzero(np.diff(block))[0] + 1), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(start, end - start)


def gathered(batches: Iterable[pa.RecordBatch], column: str, least: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches joined until ``column`` holds ``least`` bytes, so that work on a block's distinct values is shared widely."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch[column].nbytes
        if size >= least:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def sorted_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole groups, from batches that come sorted by ``key``; small groups share a table."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch[key].to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(keys, keys[-1]))
        if held and last > 0 or held and held[-1][key][-1].as_py() != keys[0]:
            if held[-1][key][-1].as_py() != keys[0]:
                yield pa.Table.from_batches(held)
                held = []
        if last > 0:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def join_labels(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of ``size`` nodes reaches over the edges a-b."""
    label = np.arange(size)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once an application; their Python need not have it on its path."""
    if spark.sparkContext.applicationId not in _shipped:
        top = Path(__file__).resolve().parents[1]
        with zipfile.ZipFile(Path(tempfile.mkdtemp(prefix="groundmill-")) / f"{top.name}.zip", "w") as bundle:
            for source in sorted(top.rglob("*.py")):
                bundle.write(source, source.relative_to(top.parent))
        spark.sparkContext.addPyFile(bundle.filename)
        _shipped.add(spark.sparkContext.applicationId)


def map_arrow(df: DataFrame, body: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` over few rows at a time, since texts can be long."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return df.mapInArrow(body, schema)
