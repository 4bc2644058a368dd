"""Helpers shared by the operators: tables, staged intermediates, word hashes."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from netsift.session import checkpoint_dir

#: ``[\x20\x09-\x0D]``, the white space that separates words.
BLANKS = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share, one parent per application."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Later steps restart from these files when an executor is lost, and each
    side of a join gets an exchange of its own, so Spark can split hot keys.
    """
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staged(spark: SparkSession) -> None:
    """Delete everything this application has staged; its lazy results can't be read after."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def small_enough(df: DataFrame, row_bytes: int, limit: int = 64 << 20) -> bool:
    """Whether ``df`` (fixed-width rows of ``row_bytes``) fits a broadcast of ``limit`` bytes."""
    return df.limit(limit // row_bytes + 1).count() * row_bytes <= limit


def checked(df: DataFrame, row_bytes: int = 32) -> DataFrame:
    """``df`` (staged, fixed-width rows) marked for broadcast if it is small enough, else as it is."""
    return F.broadcast(df) if small_enough(df, row_bytes) else df


def pieces(batches, rows: int = 500):
    """The rows of the batches, a few at a time, so that what is made from long texts stays small."""
    for d in batches:
        for i in range(0, len(d), rows):
            yield d.iloc[i : i + rows]


def groups_of(batches, keys: list[str]):
    """Whole groups of neighbouring rows with equal ``keys`` (nulls are equal) from sorted batches."""
    import pandas as pd

    rest = None
    for batch in batches:
        rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if len(rows) == 0:
            continue
        new = np.zeros(len(rows), bool)
        for k in keys:
            before = rows[k].shift(1)
            new |= (rows[k].ne(before) & ~(rows[k].isna() & before.isna())).to_numpy(bool)
        starts = [0, *(np.flatnonzero(new[1:]) + 1)]
        for a, b in zip(starts, starts[1:]):
            yield rows.iloc[a:b].reset_index(drop=True)
        rest = rows.iloc[starts[-1] :].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest


class WordHashes(dict):
    """64-bit hash of each word (bytes), kept for up to ``KEPT`` words (some 200 bytes each)."""

    KEPT = 200_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.KEPT:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values (a sort; numpy's unique hashes, which is slower here)."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


class ByteWords:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a byte string, from prefix sums of a polynomial."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.blank = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
        self.size = 0
        self.grow(1 << 14)

    def grow(self, n: int) -> None:
        if n > self.size:
            self.size = max(n, 2 * self.size)
            powers = lambda base: np.cumprod(np.r_[np.uint64(1), np.full(self.size, base, np.uint64)])
            self.power, self.inverse = powers(self.BASE), powers(pow(self.BASE, -1, 1 << 64))

    def of(self, data: bytes) -> np.ndarray:
        b = np.frombuffer(data, np.uint8)
        n = len(b)
        if n == 0:
            return np.zeros(0, np.uint64)
        self.grow(n)
        blank = self.blank[b]
        edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        edge = np.r_[[0] * (not blank[0]), edge, [n] * (not blank[-1])].astype(np.int64)
        start, end = edge[0::2], edge[1::2]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * self.power[:n], out=sums[1:])
        return mixed((sums[end] - sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every window of ``k`` word hashes; fewer words make one shingle, none make none."""
    n = len(words)
    if n == 0:
        return words
    k = min(k, n)
    h = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        h = h * np.uint64(0x100000001B3) + words[i : n - k + 1 + i]
    return mixed(h + np.uint64(k))
