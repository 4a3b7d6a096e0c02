"""Token-id files: flat unsigned integers plus 64-bit document offsets.

``write_token_files`` range-partitions documents by id, sorts each partition
and lets every task write three flat files of its own:

    <part>.bin   the ids of its documents, one after another (u2 or u4, little-endian)
    <part>.off   int64 start of each document in the .bin file, and the end
    <part>.doc   int64 document ids (a null id is stored as -2**63)

A manifest (one row per part) records which attempt's files count; exclusive
prefix sums over it give each part's document and token base. A task that is
lost and run again writes files under new names, so nothing is overwritten.
Readers memory-map the files where the folder is mounted and read them through
the file system otherwise.

Null texts are empty documents, null ids sort first, rows with the same id
are ordered by text; an empty table gives an empty manifest; other columns
are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laborlens.llm.common import filesystem, partitions, prepare, read_bytes, write_bytes
from laborlens.llm.wordcodec import word_codec

NULL_ID = -(1 << 63)
MANIFEST = "part int, name string, width int, n_docs long, n_tokens long"
ROWS_PER_STEP = 512


def _writer(path: str, tokenizer: str, end_id: int | None):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = word_codec(tokenizer)
        end = b"" if end_id is None else np.asarray([end_id], dtype=codec.dtype).tobytes()
        part = TaskContext.get().partitionId()
        fsys, root = filesystem(path)
        name = f"part-{part:06d}-{uuid.uuid4().hex[:8]}"
        sink, sizes, ids = None, [], []
        for batch in batches:
            if sink is None and batch.num_rows:
                fsys.create_dir(root, recursive=True)
                sink = fsys.open_output_stream(f"{root}/{name}.bin")
            for at in range(0, batch.num_rows, ROWS_PER_STEP):
                rows = batch.slice(at, ROWS_PER_STEP)
                out = [x + end for x in codec.encode(rows.column(1).to_pylist())]
                sink.write(b"".join(out))
                sizes.append(np.fromiter(map(len, out), dtype=np.int64, count=len(out)))
                ids.append(rows.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False))
        if sink is None:
            return
        sink.close()
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes) // codec.dtype.itemsize)]).astype("<i8")
        write_bytes(fsys, f"{root}/{name}.off", offsets.tobytes())
        write_bytes(fsys, f"{root}/{name}.doc", np.concatenate(ids).astype("<i8").tobytes())
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([part], pa.int32()), "name": [name],
            "width": pa.array([codec.dtype.itemsize], pa.int32()),
            "n_docs": pa.array([len(offsets) - 1], pa.int64()),
            "n_tokens": pa.array([int(offsets[-1])], pa.int64())})
    return write


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 1,
                      id_col: str = "doc_id", text_col: str = "text", files: int | None = None) -> None:
    """Encode every whole text and write the token files below ``path`` in ascending id order."""
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    dealt = rows.repartitionByRange(files or partitions(spark), "id").sortWithinPartitions("id", "text")
    dealt.mapInArrow(_writer(path, tokenizer, end_id), MANIFEST).write.mode("overwrite").parquet(f"{path}/manifest")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, with the documents and tokens before it (one row per file is all that meets here)."""
    m = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return m.withColumns({c: F.coalesce(F.sum(n).over(before), F.lit(0))
                          for c, n in (("doc_base", "n_docs"), ("token_base", "n_tokens"))})


def _map(fsys, path: str, dtype: str):
    """The file as an array: memory-mapped where it is a local (mounted) file."""
    if fsys.type_name == "local":
        return np.memmap(path, dtype=dtype, mode="r") if fsys.get_file_info(path).size else np.empty(0, dtype)
    return np.frombuffer(read_bytes(fsys, path), dtype=dtype)


def _reader(path: str):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fsys, root = filesystem(path)
        for batch in batches:
            for r in batch.to_pylist():
                ids = _map(fsys, f"{root}/{r['name']}.bin", f"<u{r['width']}")
                off = np.asarray(_map(fsys, f"{root}/{r['name']}.off", "<i8"))
                doc = np.asarray(_map(fsys, f"{root}/{r['name']}.doc", "<i8"))
                at = 0
                while at < len(doc):
                    # as many documents as hold about a million ids
                    to = max(at + 1, int(np.searchsorted(off, off[at] + 1_000_000, side="right")) - 1)
                    to = min(to, len(doc))
                    block = np.asarray(ids[off[at]:off[to]]).astype("<u4")
                    cut = (off[at:to + 1] - off[at]).tolist()
                    yield pa.RecordBatch.from_arrays([
                        pa.array(doc[at:to], pa.int64(), mask=doc[at:to] == NULL_ID),
                        pa.array(off[at:to] + r["token_base"], pa.int64()),
                        pa.array(np.diff(off[at:to + 1]), pa.int64()),
                        pa.array([block[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                    ], names=["doc_id", "start", "n_tokens", "ids"])
                    at = to
    return read


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of the files: doc_id, start, n_tokens, ids (little-endian u4 binary)."""
    prepare(spark)
    m = manifest(spark, path).select("part", "name", "width", "token_base")
    return m.repartition(partitions(spark), "part").mapInArrow(
        _reader(path), "doc_id long, start long, n_tokens long, ids binary")


class TokenFiles:
    """Random access for a trainer that mounts the folder: ``files[i]`` is the
    i-th document's ids (a memory-mapped slice), ``tokens(a, b)`` any window of the stream."""

    def __init__(self, spark: SparkSession, path: str):
        self.fsys, self.root = filesystem(path)
        self.parts = manifest(spark, path).orderBy("part").collect()  # one row per file
        self.doc_base = np.asarray([p.doc_base for p in self.parts], dtype=np.int64)
        self.token_base = np.asarray([p.token_base for p in self.parts], dtype=np.int64)
        self.n_docs = int(self.doc_base[-1] + self.parts[-1].n_docs) if self.parts else 0
        self.n_tokens = int(self.token_base[-1] + self.parts[-1].n_tokens) if self.parts else 0

    def _bin(self, k: int):
        return _map(self.fsys, f"{self.root}/{self.parts[k].name}.bin", f"<u{self.parts[k].width}")

    def __getitem__(self, i: int) -> np.ndarray:
        if not 0 <= i < self.n_docs:
            raise IndexError(i)
        k = int(np.searchsorted(self.doc_base, i, side="right")) - 1
        off = _map(self.fsys, f"{self.root}/{self.parts[k].name}.off", "<i8")
        j = i - int(self.doc_base[k])
        return self._bin(k)[off[j]:off[j + 1]]

    def tokens(self, a: int, b: int) -> np.ndarray:
        out = []
        for k, p in enumerate(self.parts):
            lo, hi = max(a, p.token_base), min(b, p.token_base + p.n_tokens)
            if lo < hi:
                out.append(self._bin(k)[lo - p.token_base:hi - p.token_base])
        return np.concatenate(out) if out else np.empty(0, "<u2")
