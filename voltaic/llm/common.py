"""Shared helpers: scratch tables in the shared folder, Arrow text maps, word splitting, package shipping."""
from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.session import ensure_checkpoint_dir

#: Text bytes a Python worker handles at a time; bounds its memory whatever the row count of an Arrow batch.
SLICE_BYTES = 2 << 20

#: Spark and Arrow type of an appended column.
LONG = (T.LongType(), pa.int64())
INT = (T.IntegerType(), pa.int32())
DOUBLE = (T.DoubleType(), pa.float64())
STRING = (T.StringType(), pa.string())
BINARY = (T.BinaryType(), pa.binary())
LONGS = (T.ArrayType(T.LongType()), pa.list_(pa.int64()))
STRINGS = (T.ArrayType(T.StringType()), pa.list_(pa.string()))

_SHIPPED: set[str] = set()


#: Bytes of an Arrow batch between the JVM and a Python worker at most; each side holds one whole.
BATCH_BYTES = 8 << 20
_BATCH_KEY, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def ship(spark: SparkSession) -> None:
    """Make this package importable in every Python worker (once per application).

    Where the session has Spark's own limit on the bytes of an Arrow batch (64
    MB), it is lowered to ``BATCH_BYTES``: batches of long texts would fill the
    executors. A limit set by the user stays.
    """
    if spark.conf.get(_BATCH_KEY) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_KEY, str(BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(prefix="voltaic-pkg-"), "voltaic_pkg.zip")
    with open(path, "wb") as f:
        f.write(buffer.getvalue())
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


class Scratch:
    """Parquet tables in the shared checkpoint folder.

    ``store`` cuts lineage: a lost executor costs only the tasks of the running
    stage. ``drop`` removes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
        self._n = 0
        self._paths: dict[int, str] = {}

    def folder(self, name: str) -> str:
        """URI of a folder below this scratch folder."""
        self._n += 1
        return f"{self.base}/{self._n:03d}-{name}"

    def store(self, df: DataFrame, name: str) -> DataFrame:
        path = self.folder(name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table in tables:
            path = self._paths.pop(id(table), None)
            if path:
                jvm = self.spark.sparkContext._jvm
                target = jvm.org.apache.hadoop.fs.Path(path)
                target.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_bucket(id_col: str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(modulus)


def in_sample(share: float, *key: Column | str) -> Column:
    """Whether a row belongs to a sample of about ``share`` of all rows, by 62 bits of the hash of ``key``.

    So fine a measure keeps a sample of a few thousand rows whole out of any number of rows.
    """
    span = 1 << 62
    return F.pmod(F.xxhash64(*key), F.lit(span)) < F.lit(int(share * span))


def slices(batch: pa.RecordBatch, index: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy row slices of at most ``most`` text bytes, or of a single longer row."""
    import numpy as np
    import pyarrow.compute as pc

    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(index)), 0).to_numpy(zero_copy_only=False))
    start, before = 0, 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(sizes, before + most, side="right")))
        yield batch.slice(start, stop - start)
        start, before = stop, int(sizes[stop - 1])


#: What a Python worker keeps between tasks, of one operator at a time.
_KEPT: dict = {}


def worker_state(owner: str, key, make: Callable[[], object] | None = None):
    """What ``make()`` gives, kept by this worker for later tasks of the same ``owner`` and ``key``.

    A task of another owner drops it, so caches do not outlive the stage that
    fills them. Without ``make`` only the dropping is done.
    """
    if _KEPT and _KEPT["owner"] != owner:
        _KEPT.clear()
        pa.default_memory_pool().release_unused()
    if make is None:
        return None
    if _KEPT.get("key") != key:
        _KEPT.clear()
        _KEPT.update(owner=owner, key=key, value=make())
    return _KEPT["value"]


def map_text(
    df: DataFrame,
    text_col: str,
    columns: dict[str, tuple],
    setup: Callable[[], Callable[[list], list]],
    keep_text: bool = True,
    where: Callable[..., list] | None = None,
) -> DataFrame:
    """Append ``columns`` computed from ``text_col``, slice by slice, without a shuffle.

    ``setup()`` runs once per task and returns a function from a list of texts
    (``None`` for null) to one list of values per appended column. Input columns
    named like an appended one are replaced. ``where`` takes these lists and says
    of each row whether it stays; rows that go never leave the worker.
    """
    ship(df.sparkSession)
    base = df.drop(*[c for c in df.columns if c.lower() in {n.lower() for n in columns}])
    if text_col not in base.columns:
        raise ValueError(f"no text column {text_col!r} apart from the appended columns")
    index = base.columns.index(text_col)
    kept = [i for i, c in enumerate(base.columns) if keep_text or i != index]
    fields = [base.schema.fields[i] for i in kept]
    schema = T.StructType(fields + [T.StructField(n, t[0]) for n, t in columns.items()])
    types, names = [t[1] for t in columns.values()], schema.names

    owner = getattr(setup, "func", setup).__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state(owner, None)
        fn = setup()
        for batch in batches:
            for part in slices(batch, index):
                made = fn(part.column(index).to_pylist())
                arrays = [part.column(i) for i in kept]
                arrays += [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(made, types, strict=True)]
                out = pa.RecordBatch.from_arrays(arrays, names=names)
                yield out if where is None else out.filter(pa.array(where(*made), pa.bool_()))

    return base.mapInArrow(run, schema)


def _word_table() -> bytes:
    """Byte map: A-Z lower-cased; bytes outside 0-9, a-z and 0x80-0xFF become spaces."""
    out = bytearray(b" " * 256)
    for b in range(256):
        if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80:
            out[b] = b
        elif 0x41 <= b <= 0x5A:
            out[b] = b + 32
    return bytes(out)


_WORD_TABLE = _word_table()


def words(text: str | None) -> list[bytes]:
    """Words of a text: runs of digits, ASCII letters (lower-cased) and non-ASCII characters, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_TABLE).split() if text else []
