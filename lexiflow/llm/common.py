"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, workers_import

#: White space of every word rule here: space and the controls 9 to 13.  ``bytes.split()`` without an
#: argument cuts at exactly these.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean_text(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id written as text, modulo ``n``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(n))


def slices(batch: pa.RecordBatch, text_index: int, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of text or list values (at least one row).

    Bounds what a Python worker holds beside the batch itself, however long the texts are.
    """
    if batch.num_rows == 0:
        return
    column = batch.column(text_index)
    sizes = pc.list_value_length(column) if pa.types.is_list(column.type) else pc.binary_length(column)
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64))])
    start = 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, ends[start] + limit, "right")) - 1)
        yield batch.slice(start, stop - start)
        start = stop


class WordHashes(dict):
    """word (bytes) -> 64-bit hash, kept for reuse and emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """splitmix64 finaliser over an array of uint64, varied by ``seed``."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def map_texts(df: DataFrame, keys: list[str], text_col: str, schema: str,
              make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """Run ``make()`` once a task and its result over text-bounded slices of (keys..., text).

    The function gets record batches of the key columns followed by the text (null texts as empty
    strings) and returns a batch of ``schema``.
    """
    at = len(keys)
    workers_import(df.sparkSession)

    def run(batches):
        work = make()
        for batch in batches:
            for part in slices(batch, at):
                yield work(part)

    return df.select(*keys, clean_text(text_col).alias("_text")).mapInArrow(run, schema)


class Bitmap:
    """A bit map of fixed size over rows of integer columns: surely has what was put in, and mostly nothing
    else.  It only spares work; an exact join must follow."""

    BITS = 1 << 26

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def of(df: DataFrame, *cols: str) -> Bitmap:
        """From the rows of ``df``; tasks make one map each slice, and maps of BITS bits are merged by ``or``
        word by word, so 8 MB at most reach the driver."""
        def run(batches):
            for batch in batches:
                slots = np.unique(Bitmap.slots(*[c.to_numpy() for c in batch.columns]))
                words, start = np.unique(slots >> 6, return_index=True)
                bits = np.left_shift(np.int64(1), slots & 63)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words), pa.array(np.bitwise_or.reduceat(bits, start) if len(bits) else bits)],
                    ["w", "bits"])

        workers_import(df.sparkSession)
        got = df.select(*cols).mapInArrow(run, "w long, bits long").groupBy("w").agg(
            F.bit_or("bits").alias("bits")).toArrow()
        out = np.zeros(Bitmap.BITS // 64, np.int64)
        out[got["w"].to_numpy()] = got["bits"].to_numpy()
        return Bitmap(out)

    @staticmethod
    def slots(*columns: np.ndarray) -> np.ndarray:
        """Two bit positions of each row, one after the other."""
        out = []
        for seed in (901, 902):
            key = np.zeros(len(columns[0]), np.uint64)
            for c in columns:
                key = mix(key ^ np.ascontiguousarray(c, np.int64).view(np.uint64), seed)
            out.append((key >> np.uint64(38)).astype(np.int64))
        return np.concatenate(out)

    def has(self, *columns: np.ndarray) -> np.ndarray:
        slots = self.slots(*columns)
        hit = (self.bits[slots >> 6] >> (slots & 63)) & 1
        return (hit[:len(hit) // 2] & hit[len(hit) // 2:]).astype(bool)
