"""What the operators of this folder share: intermediate tables and text as flat bytes."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Text bytes that a task works on at once; a longer single text is taken whole.
CHUNK_BYTES = 1 << 20

#: The word separators of the plain tokenizer (space, tab to carriage return).
BLANKS = b"\x20\x09\x0a\x0b\x0c\x0d"


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application: they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="stagewise-code-")) / "stagewise.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted((root / "stagewise").rglob("*.py")):
            packed.write(file, file.relative_to(root))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; one of this machine only where none is set, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="stagewise-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors."""
    ship_code(df.sparkSession)
    path = f"{shared_folder(df.sparkSession)}/stagewise/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many leading underscores as keep them apart from the columns of ``df``."""
    out = []
    for name in names:
        while name in df.columns or name in out:
            name = f"_{name}"
        out.append(name)
    return out


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and where each begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    begins = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1]
    begins = begins.astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[begins[0] : begins[-1]], begins - begins[0]


def in_chunks(
    batches: Iterator[pa.RecordBatch], text: str, most: int = CHUNK_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` text bytes, so that memory stays bounded."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        first = 0
        while first < batch.num_rows:
            base = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, base + most, "right")))
            yield batch.slice(first, last - first)
            first = last


def byte_class(members: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BLANK = byte_class(BLANKS)

with np.errstate(over="ignore"):
    _BASE = np.uint64(0x9E3779B97F4A7C15)
    _BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """Hashes of any slice of a sequence from two prefix sums (polynomial, modulo 2**64)."""

    def __init__(self, values: np.ndarray):
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * _cached("up", _BASE, len(values)), out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        back = _cached("down", _BACK, len(self.sums))
        body = (self.sums[end] - self.sums[begin]) * back[begin]
        return mix(body + (end - begin).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


_POWERS: dict[str, np.ndarray] = {}


def _cached(name: str, base: np.uint64, n: int) -> np.ndarray:
    if n > 4 * CHUNK_BYTES:
        return _powers(base, n)
    known = _POWERS.get(name)
    if known is None or len(known) < n:
        known = _POWERS[name] = _powers(base, max(n, CHUNK_BYTES))
    return known[:n]


def byte_values(data: np.ndarray) -> np.ndarray:
    return _BYTE_VALUE[data]


class Words:
    """Words of many texts: where they begin and end in ``data``, their hashes, and the
    first word of each text (``first`` has one entry more than there are texts)."""

    def __init__(self, data: np.ndarray, begins: np.ndarray, separator: np.ndarray, lower=True):
        self.data = LOWER[data] if lower else data
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~separator[self.data]
        edge = inside[1:] != inside[:-1]
        # A text that begins inside a run of letters begins a word there.
        cuts = begins[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        cuts = np.unique(cuts[inside[cuts] & inside[cuts + 1]])
        starts = np.flatnonzero(edge & inside[1:])
        ends = np.flatnonzero(edge & inside[:-1])
        if len(cuts):
            starts = np.sort(np.concatenate([starts, cuts]))
            ends = np.sort(np.concatenate([ends, cuts]))
        self.begin, self.end = starts, ends
        self.first = np.searchsorted(starts, begins)
        self.count = np.diff(self.first)
        self._hash: np.ndarray | None = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = Rolling(byte_values(self.data)).of(self.begin, self.end)
        return self._hash

    @property
    def text(self) -> np.ndarray:
        """The number of the text that each word is in."""
        return np.repeat(np.arange(len(self.count)), self.count)

    def strings(self, which: np.ndarray) -> pa.Array:
        """The words of these numbers as strings."""
        begin, size = self.begin[which], self.end[which] - self.begin[which]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)
        places = np.concatenate([[0], ends]).astype(np.int32)
        return pa.StringArray.from_buffers(
            len(which), pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(self.data[at]))
        )
