"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints of 64 bits link if they differ in at most ``radius`` bits.  Each of the
2^(radius+1) - 1 tables keeps the bits whose random label has an odd inner product with the
table's number: ``radius`` differing bits leave at least one table in which all kept bits
agree, so every link meets in some bucket.  Equal fingerprints are one node from the start.

Buckets of up to ``BUCKET`` nodes are compared within; those of denser ones are linked exactly
by the balls of half the radius around them: two fingerprints are within the radius just if
their balls share a point, so nodes are tied to the smallest one of each point.

A null or wordless text has fingerprint zero and links like any other.  Repeated ids and rows
are kept; ``component_id`` is the smallest id of the component, null if it holds no id.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, components

SEED = 42
SHINGLE = 4
RADIUS = 4
BUCKET = 2048
NODES_PER_TASK = 16_384
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words_of(text: str) -> list[bytes]:
    """Runs of anything but blanks and the controls 9 to 13, with A-Z in lower case."""
    return text.encode().translate(LOWER).split()


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words, of the whole sequence if it is shorter."""
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = [0, *(ends[: len(words) - size] + 1).tolist()]
    return np.array(
        [digest(joined[i:j], SEED) for i, j in zip(begins, ends[size - 1 :].tolist())], np.uint64
    )


def majority(hashes: np.ndarray) -> int:
    """A bit is set if it is set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, bits): ``bits`` is the fingerprint as a signed 64-bit integer."""
    return _signed(docs, F.lit(0).cast("long"), shingle).select("doc_id", "bits")


def _signed(docs: DataFrame, key: Column, shingle: int) -> DataFrame:
    """(doc_id, key, bits) with a long ``key`` of every document."""
    common.python_batches(docs.sparkSession, common.SMALL_BATCH_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in common.texts(batch):
                found.append(majority(shingle_hashes(words_of(text), shingle)))
            bits = np.array(found, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [common.column(batch, "doc_id").cast(pa.int64()), common.column(batch, "key"),
                 pa.array(bits)], ["doc_id", "key", "bits"])

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("key"))
    return texts.mapInArrow(run, "doc_id long, key long, bits long")


def covering_masks(radius: int, seed: int = 7) -> list[int]:
    """The tables' masks as signed 64-bit integers."""
    draw = random.Random(seed)
    labels = [draw.randrange(1, 1 << (radius + 1)) for _ in range(64)]
    masks = []
    for table in range(1, 1 << (radius + 1)):
        mask = sum(1 << i for i, label in enumerate(labels) if (label & table).bit_count() % 2)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def _buckets(nodes: DataFrame, radius: int) -> DataFrame:
    keys: list[Column] = [
        F.struct(F.lit(t).cast("short").alias("t"),
                 F.col("bits").bitwiseAND(F.lit(mask).cast("long")).alias("key"))
        for t, mask in enumerate(covering_masks(radius))
    ]
    return nodes.select("bits", F.inline(F.array(*keys)))


def _within(radius: int):
    """All links within each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = [], []
            for bucket in batch.column(0).to_pylist():
                bits = np.sort(np.array(bucket, np.int64).view(np.uint64))
                for i in range(len(bits) - 1):
                    near = np.bitwise_count(bits[i + 1 :] ^ bits[i]) <= radius
                    if near.any():
                        other = bits[i + 1 :][near]
                        u.append(np.full(len(other), bits[i]).view(np.int64))
                        v.append(other.view(np.int64))
            u, v = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (u, v))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return run


def links(nodes: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """(u, v) that tie together all different fingerprints ``bits`` within ``radius``.

    Every link within a bucket of at most ``bucket`` nodes is returned itself.
    """
    if radius % 2:
        raise ValueError("the radius must be even: balls of half the radius are used")
    nodes = common.materialize(nodes.select("bits").distinct(), "nodes")
    # Every node becomes a row per table: dealt out by their number, not by their few bytes.
    tasks = nodes.count() // NODES_PER_TASK + 1
    rows = _buckets(nodes.repartition(tasks, "bits"), radius)
    # Counts are combined per task; only overfull buckets remain, at most tables/bucket per node.
    dense = common.materialize(
        rows.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > bucket)
        .select("t", "key"), "dense-buckets")
    sparse = (
        rows.join(dense, ["t", "key"], "left_anti").groupBy("t", "key")
        .agg(F.collect_list("bits").alias("bucket")).where(F.size("bucket") > 1).select("bucket")
    )
    found = sparse.mapInArrow(_within(radius), "u long, v long")
    if dense.isEmpty():
        return found.distinct()
    crowd = rows.join(dense, ["t", "key"], "left_semi").select("bits").distinct()
    flips = [sum(1 << i for i in chosen) for n in range(radius // 2 + 1)
             for chosen in combinations(range(64), n)]
    flips = [f - (1 << 64) if f >> 63 else f for f in flips]
    points = crowd.select(
        "bits", F.explode(F.transform(F.array(*map(F.lit, flips)).cast("array<long>"),
                                      lambda f: F.col("bits").bitwiseXOR(f))).alias("point"))
    lowest = points.groupBy("point").agg(F.min("bits").alias("low"), F.count("*").alias("n"))
    stars = points.join(lowest.where("n > 1"), "point").where("bits != low").select(
        F.col("low").alias("u"), F.col("bits").alias("v"))
    return found.union(stars).distinct()


def components_of(prints: DataFrame, edges: DataFrame) -> DataFrame:
    """(doc_id, bits, component_id) from fingerprints and the links between them."""
    root = components.roots(edges)
    nodes = prints.groupBy("bits").agg(F.min("doc_id").alias("first_id"))
    # Both written, so that the join stands alone in its stage and a large component is split.
    placed = common.materialize(nodes.join(root, nodes.bits == root.node, "left").select(
        "bits", "first_id", F.coalesce("root", "bits").alias("root")), "placed")
    lowest = common.materialize(
        placed.groupBy("root").agg(F.min("first_id").alias("component_id")), "lowest")
    label = placed.join(lowest, "root").select(F.col("bits").alias("of_bits"), "component_id")
    # A fingerprint shared by very many documents is split by adaptive execution.
    return prints.join(label, prints.bits == label.of_bits).select("doc_id", "bits", "component_id")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    prints = common.materialize(fingerprints(docs, shingle), "fingerprints")
    found = components_of(prints, links(prints, radius))
    text = F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint")
    return found.select("doc_id", text, "component_id")


def one_per_group(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents, all their columns: of each component the smallest id stays.

    Null ids come last; of rows with the same id and text one stays.  Columns of any name go
    along unchanged.
    """
    key = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    prints = common.materialize(_signed(docs, key, shingle), "fingerprints")
    root = components.roots(links(prints, radius))
    nodes = prints.groupBy("bits").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("m"))
    first = nodes.join(root, nodes.bits == root.node, "left").groupBy(
        F.coalesce("root", "bits").alias("of")).agg(F.min("m").alias("m"))
    of, text = common.unused(docs, "of_id", "of_text")
    chosen = common.materialize(
        first.select(F.col("m.doc_id").alias(of), F.col("m.key").alias(text)), "chosen")
    keyed = docs.select("*", F.col("doc_id").cast("long").alias(f"{of}_"), key.alias(f"{text}_"))
    kept = keyed.join(
        chosen, F.col(f"{of}_").eqNullSafe(F.col(of)) & (F.col(f"{text}_") == F.col(text)), "left_semi")
    several = prints.groupBy("doc_id", "key").agg(F.count("*").alias("n")).where("n > 1")
    if not several.isEmpty():
        # Combined in the tasks first, so many copies of one row are no heavy group.
        kept = kept.dropDuplicates([f"{of}_", f"{text}_"])
    return kept.select(docs.columns)
