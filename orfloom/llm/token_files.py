"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

Each task writes one run of documents, in ascending id, as three raw little-
endian files: ``.bin`` the token ids (16 bits where the vocabulary fits, else
32), ``.idx`` the 64-bit offsets of its documents (and the end), ``.doc`` the
64-bit document ids.  A manifest with one row per task says how many documents at
its start have a null id (those come first) and carries the task's base,
the prefix sum of the ids before it, so ``base + idx[i]`` is the global start of
a document.  A reader memory-maps the files.
"""

from __future__ import annotations

import json
import uuid
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orfloom.llm.storage import bounded_batches, scratch, stored
from orfloom.llm.tokens import _encoded, vocabulary

MANIFEST = "part long, path string, dtype string, n_docs long, n_null long, n_ids long"
DIGESTS = "doc_id long, start long, n_tokens long, ids_crc32 long"
TOKENS = "doc_id long, start long, ids array<long>"


def id_type(vocabulary_path: str) -> str:
    """``<u2`` where every id fits in 16 bits, else ``<u4``."""
    with open(vocabulary_path, encoding="utf-8") as f:
        spec = json.load(f)
    top = max([*spec["model"]["vocab"].values(), *(x["id"] for x in spec.get("added_tokens", []))])
    return "<u2" if top < 1 << 16 else "<u4"


class _Files:
    """The three files of one task; they get their last name only when whole."""

    def __init__(self, folder: str, name: str, dtype: str):
        self.fs, self.root = pafs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.path, self.dtype = f"{self.root}/{name}", dtype
        self.open = {k: self.fs.open_output_stream(f"{self.path}.{k}.part") for k in ("bin", "idx", "doc")}
        self.n_docs = self.n_null = self.n_ids = 0
        self.open["idx"].write(np.zeros(1, "<u8").tobytes())

    def add(self, docs: pa.Array, sizes: np.ndarray, ids: np.ndarray) -> None:
        self.n_null += docs.null_count
        doc_ids = docs.fill_null(0).to_numpy(zero_copy_only=False)
        self.open["bin"].write(ids.astype(self.dtype).tobytes())
        self.open["idx"].write((np.cumsum(sizes) + self.n_ids).astype("<u8").tobytes())
        self.open["doc"].write(doc_ids.astype("<i8").tobytes())
        self.n_docs += len(doc_ids)
        self.n_ids += len(ids)

    def close(self) -> None:
        for k, f in self.open.items():
            f.close()
            self.fs.move(f"{self.path}.{k}.part", f"{self.path}.{k}")


def write_token_files(
    df: DataFrame, vocabulary_path: str, folder: str | None = None, doc_id: str = "doc_id", text: str = "text", end_id: int = 0, partitions: int | None = None
) -> DataFrame:
    """Writes every text's ids and ``end_id`` in ascending ``doc_id``; returns the manifest with ``base``.

    A null or empty text gives the end id alone.  Rows with a null id come
    first; the manifest counts them.  Rows of one id keep together, in the order
    of their texts.  A text of any length is one document.  Other columns of ``df`` play no part.  An empty
    table gives an empty manifest.  A task that is run again writes files of
    its own; only those of the attempt that ended are in the manifest.
    """
    spark = df.sparkSession
    bounded_batches(spark)
    folder = folder or scratch(spark, "token-files")
    dtype = id_type(vocabulary_path)
    rows = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    rows = rows.repartitionByRange(partitions, "doc_id") if partitions else rows.repartitionByRange("doc_id")

    def write(batches):
        files, part, first = None, TaskContext.get().partitionId(), True
        vocab = vocabulary(vocabulary_path)
        for batch in batches:
            docs = batch.column(0)
            if first and len(docs):
                files, first = _Files(folder, f"part-{part:06d}-{uuid.uuid4().hex[:12]}", dtype), False
            for lo, hi, counts, ids in _encoded(batch.column(1), vocab, True):
                ends = np.cumsum(counts)
                files.add(docs.slice(lo, hi - lo), counts + 1, np.insert(ids, ends, end_id))
        if files:
            files.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "path": files.path, "dtype": dtype, "n_docs": files.n_docs, "n_null": files.n_null, "n_ids": files.n_ids}],
                schema=pa.schema([("part", pa.int64()), ("path", pa.string()), ("dtype", pa.string()), *((n, pa.int64()) for n in ("n_docs", "n_null", "n_ids"))]),
            )

    manifest = stored(rows.sortWithinPartitions("doc_id", "text").mapInArrow(write, MANIFEST), "token-manifest")
    before = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))  # a row for each task
    return manifest.withColumns({"base": F.coalesce(before, F.lit(0).cast("long")), "folder": F.lit(folder)})


def _mapped(folder: str, path: str, kind: str, dtype: str) -> np.ndarray:
    fs, _ = pafs.FileSystem.from_uri(folder)
    if fs.get_file_info(f"{path}.{kind}").size == 0:
        return np.zeros(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(f"{path}.{kind}", dtype=dtype, mode="r")
    with fs.open_input_file(f"{path}.{kind}") as f:
        return np.frombuffer(f.read(), dtype=dtype)


def read_token_files(manifest: DataFrame, digests: bool = False, rows_at_once: int = 2048) -> DataFrame:
    """Documents of the files, from memory maps: ids, or with ``digests`` their count and CRC-32 (of 32-bit ids)."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids, where, docs = (_mapped(row["folder"], row["path"], k, t) for k, t in (("bin", row["dtype"]), ("idx", "<u8"), ("doc", "<i8")))
                where = where.astype(np.int64)
                for lo in range(0, len(docs), rows_at_once):
                    hi = min(lo + rows_at_once, len(docs))
                    ends, flat = where[lo : hi + 1], ids[where[lo] : where[hi]].astype("<u4")
                    start = pa.array(ends[:-1] + row["base"])
                    names = pa.array(docs[lo:hi], mask=np.arange(lo, hi) < row["n_null"])
                    if digests:
                        view, at = memoryview(flat.tobytes()), (ends - ends[0]) * 4
                        crc = [zlib.crc32(view[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [names, start, pa.array(np.diff(ends)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
                        )
                    else:
                        lists = pa.ListArray.from_arrays(pa.array((ends - ends[0]).astype(np.int32)), pa.array(flat.astype(np.int64)))
                        yield pa.RecordBatch.from_arrays([names, start, lists], names=["doc_id", "start", "ids"])

    spread = manifest.repartition(int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return spread.mapInArrow(read, DIGESTS if digests else TOKENS)
