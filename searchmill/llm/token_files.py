"""Token ids in flat binary files with 64-bit document offsets.

A data set is a folder of parts in ascending doc_id order. Part `x` has two files:

- `x.bin`: the ids of its documents, one after the other, as little-endian unsigned integers of
  16 bits if the vocabulary allows, else 32;
- `x.idx`: little-endian 64-bit integers: bytes per id, number of documents, number of those
  without doc_id (they come first), then the offset (in ids) of each document and the end, then
  the doc_ids.

Both can be memory-mapped. A table beside them lists the parts with their numbers of ids and
their bases: the prefix sums of these numbers, so a document's place in the data set is its
part's base plus its offset.

Documents are shuffled once, by ranges of doc_id, and each task streams its range to files of
its own name; the list only names files of tasks that ended well, so a repeated task or a lost
executor leaves at most a file that nobody reads. Null text: no ids but the end id. Null
doc_ids come first. Rows with the same doc_id are ordered by their text's hash, and all kept. A very
long text is encoded alone, in chunks. Extra columns are ignored, an empty table gives no files.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from searchmill.llm.tables import fresh_folder, parts, total_bytes, written
from searchmill.llm.tokens import END_ID, Encoder
from searchmill.llm.windows import in_pieces

PART_BYTES = 24 << 20
PARTS = "part int, file string, n_docs long, n_ids long"


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _writer(folder: str, tokenizer: str, end_id: int):
    def run(batches):
        from searchmill.llm.token_files import vocabulary_path

        encoder = Encoder.of(vocabulary_path(tokenizer))
        width = np.dtype("<u2" if encoder.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        name, out, total, n_null, part = uuid.uuid4().hex, None, 0, 0, -1
        offsets, doc_ids = [np.zeros(1, np.int64)], []
        system, path = _open(folder)
        for batch in in_pieces(batches, 2):
            if out is None:
                system.create_dir(path, recursive=True)
                out = system.open_output_stream(f"{path}/{name}.bin")
                part = batch.column(0)[0].as_py()
            ids, ends = encoder.encode(batch.column(2))
            ends_with = ends + np.arange(1, len(ends) + 1)
            whole = np.full(int(ends_with[-1]), end_id, width)
            mask = np.ones(len(whole), bool)
            mask[ends_with - 1] = False
            whole[mask] = ids
            out.write(whole.tobytes())
            offsets.append(total + ends_with)
            total += len(whole)
            n_null += batch.column(1).null_count
            doc_ids.append(batch.column(1).fill_null(0).to_numpy())
        if out is None:
            return
        out.close()
        doc_ids = np.concatenate(doc_ids)
        head = np.array([width.itemsize, len(doc_ids), n_null], "<i8")
        with system.open_output_stream(f"{path}/{name}.idx") as index:
            for x in (head, np.concatenate(offsets), doc_ids):
                index.write(x.astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([name]), pa.array([len(doc_ids)]), pa.array([total])],
            ["part", "file", "n_docs", "n_ids"],
        )

    return run


def vocabulary_path(name: str) -> str:
    """Place of a public tokenizer's file on this machine; a path stays as it is."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def write_token_files(
    docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int = END_ID
) -> tuple[str, DataFrame]:
    """Writes (doc_id, text) to a folder that all executors share; returns it and the list of
    parts (part, file, n_docs, n_ids, base)."""
    spark = docs.sparkSession
    folder = folder or fresh_folder(spark, "token-files")
    n_parts = parts(total_bytes(docs), PART_BYTES)
    body = F.coalesce(F.col("text"), F.lit(""))
    ordered = (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("text"))
        .repartitionByRange(n_parts, F.asc_nulls_first("doc_id"))
        .sortWithinPartitions(F.asc_nulls_first("doc_id"), F.xxhash64("text"))
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )
    # Written, so that each part is encoded and named once.
    listed = written(ordered.mapInArrow(_writer(folder, tokenizer, end_id), PARTS), "token-parts")
    # One row a part, so a window without keys is as small as the list.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return folder, listed.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _mapped(system, path: str, dtype) -> np.ndarray:
    """A file as an array: memory-mapped on a local or mounted file system, else read."""
    from pyarrow import fs

    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype)


def _reader(folder: str):
    def run(batches):
        system, path = _open(folder)
        for batch in batches:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                index = _mapped(system, f"{path}/{name}.idx", "<i8")
                width, n, n_null = (int(x) for x in index[:3])
                ids = _mapped(system, f"{path}/{name}.bin", f"<u{width}")
                offset, doc_id = index[3 : 4 + n], index[4 + n :]
                if len(doc_id) != n or int(offset[-1]) != len(ids):
                    raise ValueError(f"{name}: index and ids don't fit together")
                at = 0
                while at < n:  # about a million ids at a time
                    to = max(int(np.searchsorted(offset, offset[at] + (1 << 20), "right")) - 1, at + 1)
                    some = ids[offset[at] : offset[to]].astype("<u4")
                    ends = (offset[at : to + 1] - offset[at]) * 4
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_id[at:to], pa.int64(), mask=np.arange(at, to) < n_null),
                            pa.array(base + offset[at:to], pa.int64()),
                            pa.array(np.diff(offset[at : to + 1]), pa.int64()),
                            pa.Array.from_buffers(
                                pa.large_binary(),
                                to - at,
                                [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(some.tobytes())],
                            ).cast(pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )
                    at = to

    return run


def read_token_files(spark: SparkSession, folder: str, listed: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of each document; ids as little-endian 32-bit integers."""
    files = listed.select("file", "base").repartition(F.col("file"))
    return files.mapInArrow(_reader(folder), "doc_id long, start long, n_tokens long, ids binary")


def digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    folder, listed = write_token_files(docs, tokenizer)
    read = read_token_files(docs.sparkSession, folder, listed)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
