"""Shared helpers: text columns as flat byte buffers, gathering by ranges, and tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_WRITTEN: list[str] = []  # folders in use, for clear()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir. Where that is unset, a local run takes a temporary folder; a cluster, whose executors would not see it, refuses."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith(("local[", "local-")) and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is unset: intermediate tables need a folder that all executors share")
        root = getattr(shared_folder, "own", None) or tempfile.mkdtemp(prefix="spark-shared-")
        shared_folder.own = root
    path = f"{root.rstrip('/')}/{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    return path


def clear(spark: SparkSession) -> int:
    """Deletes the folders that operators of this process have made so far, once their results have been written or read; returns how many."""
    jvm, conf, n = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), 0
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n


def stored(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """df written to the shared folder and read again: its lineage ends there, and every executor can read it."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes the folders of tables that stored() has returned, once nothing that is still to be computed reads them."""
    for df in tables:
        spark = df.sparkSession
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(conf).delete(path, True)


def flat(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column one after the other, and the offsets of its rows; nulls are empty."""
    if isinstance(strings, pa.ChunkedArray):
        strings = strings.combine_chunks()
    strings = strings.cast(pa.large_binary())
    if strings.null_count:
        strings = strings.fill_null(b"")
    _, offsets, data = strings.buffers()
    at = np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1] if len(strings) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def pieces(batch: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """A batch cut by rows so that each piece has about `most` bytes of text; a longer text is a piece of its own."""
    _, at = flat(batch.column(batch.schema.get_field_index(column)))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(at, at[start] + most, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes starts[i] .. starts[i]+lengths[i]-1 of all i, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def word_bounds(raw: np.ndarray, at: np.ndarray, separator: np.ndarray = SEPARATOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in a flat buffer, and for each row the number of the first word at or after its start."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~separator[raw]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    cuts = at[1:-1]
    if len(cuts) and len(starts):  # a word must not run on into the next row
        k = np.searchsorted(starts, cuts, "left") - 1
        cut = np.unique(cuts[(k >= 0) & (ends[np.maximum(k, 0)] > cuts)])
        if len(cut):
            starts = np.sort(np.concatenate([starts, cut]))
            ends = np.sort(np.concatenate([ends, cut]))
    return starts, ends, np.searchsorted(starts, at, "left")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(29))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(32))


def tabled(seed: int) -> np.ndarray:
    """256 random 64-bit values, the same for the same seed."""
    return np.random.default_rng(seed).integers(0, 1 << 64, 256, U64)


def coded(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Each slice of a flat buffer as a code, and the distinct slices (large_binary) that the codes stand for."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    gapless = len(starts) == 0 or (np.array_equal(starts[1:], ends[:-1]) and starts[0] == 0 and ends[-1] == len(raw))
    data = raw if gapless else raw[ranges(starts, lengths)]
    slices = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    found = slices.dictionary_encode()
    return found.indices.to_numpy(), found.dictionary


def gathered(codes: np.ndarray, lists_at: np.ndarray, lists: np.ndarray) -> np.ndarray:
    """The lists of all codes one after the other, where list c is lists[lists_at[c]:lists_at[c + 1]]."""
    return lists[ranges(lists_at[codes], lists_at[codes + 1] - lists_at[codes])]


def list_column(at: np.ndarray, values: np.ndarray) -> pa.Array:
    """An Arrow array<int> column with row i = values[at[i]:at[i + 1]]."""
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values, pa.int32()))


def list_values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of an array<int> column."""
    values = column.flatten().to_numpy()
    lengths = np.array(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    return np.concatenate([[0], np.cumsum(lengths)]), values

