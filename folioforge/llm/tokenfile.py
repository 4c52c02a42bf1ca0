"""Token files: canonical, length-limited Huffman codes of token ids in independent blocks.

A token file is a folder of two Parquet tables, so that any store Spark reaches can hold it:

* ``codebook`` (id, length): code lengths; canonical codes follow from them.
* ``segments``: whole documents in ascending order, a row per segment with the documents'
  ids and token counts, the code bits (big-endian 32-bit words) and ``marks``, the bit offset
  of every block of 256 tokens.  Any block can be decoded on its own from its mark.

Code lengths come from the counts of all ids of the corpus, at most one per vocabulary entry.
A null text is an empty one and holds the end id alone.  Documents are ordered by id, nulls
first, repeated ids by their place in the input; an empty table gives empty tables.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, tokens

BLOCK = 256
SEGMENT_TOKENS = 1 << 18
LIMIT = 18
#: Bits of a code length in the decoding table.
SIZE_BITS = 5
SIZE_MASK = (1 << SIZE_BITS) - 1
#: Ids whose bits are written together, few enough for a core's own cache.
AT_ONCE = 1 << 13
END_ID = 0

IDS = "doc_id long, place long, ids binary, counts binary"
SEGMENTS = (
    "part int, segment int, first long, n_tokens long, doc_ids array<long>, "
    "doc_tokens array<long>, bits binary, marks binary"
)


# --- codes ---------------------------------------------------------------------------------


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Best code lengths of at most ``limit`` bits (package merge); 0 where the count is 0."""
    lengths = np.zeros(len(counts), np.int64)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    leaves = used[np.argsort(counts[used], kind="stable")]
    weights = counts[leaves].astype(np.float64)
    is_leaf: list[np.ndarray] = []
    packages = np.empty(0)
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        order = np.argsort(merged, kind="stable")
        is_leaf.append(order < len(weights))
        merged = merged[order]
        packages = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    take = 2 * len(leaves) - 2
    for flags in reversed(is_leaf):
        own = int(flags[:take].sum())
        lengths[leaves[:own]] += 1
        take = 2 * (take - own)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    code, last = 0, 0
    for i in sorted(np.flatnonzero(lengths), key=lambda i: (lengths[i], i)):
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Id and code length, the latter in the last ``SIZE_BITS``, for every possible next ``limit`` bits."""
    if len(lengths) > 1 << (32 - SIZE_BITS):
        raise ValueError(f"{len(lengths)} ids do not fit the table")
    codes = canonical_codes(lengths)
    table = np.ones(1 << limit, np.uint32)
    for i in np.flatnonzero(lengths):
        size = int(lengths[i])
        begin = int(codes[i]) << (limit - size)
        table[begin : begin + (1 << (limit - size))] = int(i) << SIZE_BITS | size
    return table


def encode_bits(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """The code bits and the marks of one segment, written ``AT_ONCE`` ids at a time."""
    if not len(ids):
        return b"", b""
    size = lengths[ids]
    end = np.cumsum(size)
    out = np.zeros(int(end[-1] >> 5) + 2, np.uint64)
    for i in range(0, len(ids), AT_ONCE):
        some = slice(i, i + AT_ONCE)
        start = end[some] - size[some]
        word = start >> 5
        value = codes[ids[some]] << (64 - (start & 31) - size[some]).astype(np.uint64)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        at = word[first]
        out[at] += np.add.reduceat(value >> np.uint64(32), first)
        out[at + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    return out.astype(">u4").tobytes(), (end - size)[::BLOCK].astype("<u8").tobytes()


def decode_bits(
    bits: bytes, marks: bytes, n: int, table: np.ndarray, limit: int = LIMIT
) -> np.ndarray:
    """The ids of a segment: one table step of all its blocks at a time."""
    if not n:
        return np.empty(0, np.uint32)
    words = np.frombuffer(bits, ">u4").astype(np.uint64)
    pairs = (words << np.uint64(32)) | np.append(words[1:], np.uint64(0))
    at = np.frombuffer(marks, "<u8").astype(np.int64)
    out = np.empty((min(BLOCK, n), len(at)), np.uint32)
    for k in range(len(out)):
        # The last block may end early; what it decodes beyond its end is cut off below.
        window = pairs.take(at >> 5, mode="clip")
        key = (window >> (64 - limit - (at & 31)).astype(np.uint64)) & np.uint64((1 << limit) - 1)
        found = table.take(key.view(np.int64))
        out[k] = found
        at += found & SIZE_MASK
    return (out.T >> SIZE_BITS).reshape(-1)[:n]


# --- jobs ----------------------------------------------------------------------------------


def token_ids(docs: DataFrame, shared: Broadcast, kind: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, place, ids, counts): ids of type ``kind`` of each text, then the end id.

    The last row of a task has no place and holds ``counts``, how often each id occurs in it.
    """
    spark = docs.sparkSession
    common.python_batches(spark)
    end = np.array([end_id], kind).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = tokens.encoder(shared)
        place = TaskContext.get().partitionId() << 40
        counts = np.zeros(1, np.int64)
        for batch in batches:
            found = worker.encode(common.texts(batch))
            more = np.bincount(np.concatenate([*found, np.full(len(found), end_id, "<u4")]))
            if len(more) > len(counts):
                counts = np.append(counts, np.zeros(len(more) - len(counts), np.int64))
            counts[: len(more)] += more
            yield pa.RecordBatch.from_arrays(
                [
                    common.column(batch, "doc_id").cast(pa.int64()),
                    pa.array(range(place, place + len(found)), pa.int64()),
                    pa.array([ids.astype(kind).tobytes() + end for ids in found], pa.binary()),
                    pa.array([None] * len(found), pa.binary()),
                ],
                ["doc_id", "place", "ids", "counts"],
            )
            place += len(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], t) for t in (pa.int64(), pa.int64(), pa.binary())]
            + [pa.array([counts.tobytes()], pa.binary())], ["doc_id", "place", "ids", "counts"])

    return common.documents(docs).mapInArrow(encode, IDS)


def id_counts(ids: DataFrame) -> np.ndarray:
    """How often each id occurs; a row per task and id moves, one per id reaches the driver."""

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0).to_pylist():
                total = np.frombuffer(data, np.int64)
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    per_task = ids.where("place is null").select("counts").mapInArrow(unfold, "id long, n long")
    rows = per_task.groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max((r.id for r in rows), default=0) + 1, np.int64)
    for row in rows:
        counts[row.id] = row.n
    return counts


def write_token_file(
    docs: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID
) -> None:
    """Encode every document and write the folder ``path``."""
    spark = docs.sparkSession
    vocabulary_data = tokens.share_vocabulary(spark, vocabulary)
    kind = vocabulary_data.value.id_type
    ids = common.materialize(token_ids(docs, vocabulary_data, kind, end_id), "token-ids")
    lengths = code_lengths(id_counts(ids))
    codes = canonical_codes(lengths)
    book = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    spark.createDataFrame(book, "id long, length int").coalesce(1).write.parquet(f"{path}/codebook")
    shared = spark.sparkContext.broadcast((codes, lengths))

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, first = TaskContext.get().partitionId(), 0, 0
        codes, lengths = shared.value
        names: list[int | None] = []
        held: list[np.ndarray] = []
        size = 0

        def close() -> pa.RecordBatch:
            bits, marks = encode_bits(np.concatenate(held), codes, lengths)
            row = [part, number, first, size, names, [len(x) for x in held], bits, marks]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()),
                     pa.list_(pa.int64()), pa.binary(), pa.binary()]
            arrays = [pa.array([value], kind) for value, kind in zip(row, types)]
            return pa.RecordBatch.from_arrays(
                arrays, ["part", "segment", "first", "n_tokens", "doc_ids", "doc_tokens", "bits",
                         "marks"])

        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                names.append(name)
                held.append(np.frombuffer(data, kind))
                size += len(held[-1])
                if size >= SEGMENT_TOKENS:
                    yield close()
                    first, number, size, names, held = first + size, number + 1, 0, [], []
        if held:
            yield close()

    order = [F.col("doc_id").asc_nulls_first(), F.col("place")]
    (
        ids.where("place is not null").repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "ids")
        .mapInArrow(segments, SEGMENTS)
        .write.option("compression", "uncompressed")
        .parquet(f"{path}/segments")
    )


def read_token_file(spark: SparkSession, path: str, keep_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files.

    ``start`` counts the ids of all documents before it.  ``keep_ids`` adds the ids.
    """
    common.python_batches(spark)
    book = spark.read.parquet(f"{path}/codebook").collect()  # at most the vocabulary
    lengths = np.zeros(max((r.id for r in book), default=0) + 1, np.int64)
    for row in book:
        lengths[row.id] = row.length
    shared = spark.sparkContext.broadcast(decode_table(lengths))
    segments = spark.read.parquet(f"{path}/segments")
    # One row per writing task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        F.col("part").alias("of_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_bits(row["bits"], row["marks"], row["n_tokens"], table)
                ends = np.cumsum(row["doc_tokens"])
                raw = [ids[e - n : e].tobytes() for e, n in zip(ends, row["doc_tokens"])]
                starts = row["first"] + ends - np.array(row["doc_tokens"])
                columns = {
                    "part": pa.array([row["part"]] * len(raw), pa.int32()),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": pa.array(starts, pa.int64()),
                    "n_tokens": pa.array(row["doc_tokens"], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(x) for x in raw], pa.int64()),
                    "ids": pa.array(raw if keep_ids else [None] * len(raw), pa.binary()),
                }
                yield pa.RecordBatch.from_pydict(columns)

    schema = "part int, doc_id long, start long, n_tokens long, ids_crc32 long, ids binary"
    found = segments.mapInArrow(decode, schema)
    joined = found.join(F.broadcast(shifts), F.col("part") == F.col("of_part"))
    result = joined.withColumn("start", F.col("start") + F.col("shift"))
    return result.select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if keep_ids else []))
