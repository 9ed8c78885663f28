"""Near-duplicates by SimHash fingerprints, with pivot distance tables in the search for links.

Fingerprints: every word shingle is hashed with XXH64; a bit is set if it is set in over half of the
hashes. Links join fingerprints that differ in few bits. Classes are the connected components.

Search: equal fingerprints are one node. The bits are cut into ranges; fingerprints that differ in at
most d bits agree in full in all but d of the ranges, so they meet in a bucket of some combination of
ranges. Within a bucket, each fingerprint has its distances to fixed reference fingerprints (pivots). By
the triangle inequality, a pair whose distances to any pivot differ by more than d is no link; what is
left is verified bit by bit. Rows are sorted by the distance to the first pivot, so a row is compared
only with those that follow it closely. Buckets that many fingerprints share are cut into tiles, and a
tile gives a spanning forest of its links, not all of them.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import Scratch, ship, without_rows
from barlake.llm.components import components

SEED = 42
#: Reference fingerprints: hashes of the numbers 0 to 31.
PIVOTS = [xxhash.xxh64_intdigest(str(i).encode(), SEED) for i in range(32)]
#: Fingerprints of a bucket that one tile holds of either side, on average.
TILE = 2048
_MASK = (1 << 64) - 1


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


# Fingerprints

def fingerprint(text: bytes, words: int, chunk: int = 1 << 16) -> int:
    """Fingerprint of a text as a signed 64-bit number, 0 if it has no word.

    The shingles are hashed ``chunk`` at a time, so a long text needs no more memory than its words.
    """
    tokens = text.lower().split()  # bytes: lowers A-Z only, splits at the six ASCII spaces
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    k = min(words, len(tokens))
    first, last = (ends - sizes)[: len(tokens) - k + 1], ends[k - 1:]
    counts = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, len(first), chunk):
        spans = zip(first[at:at + chunk].tolist(), last[at:at + chunk].tolist())
        values = np.array([hashed(joined[a:b], SEED) for a, b in spans], "<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(first), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """``docs(doc_id, text)`` with their ``fingerprint``. Null texts have no words."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(text.as_py(), words) for text in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["doc_id", "fingerprint"])

    return rows.mapInArrow(work, f"doc_id {kind}, fingerprint bigint")


# Links

def bit_ranges(count: int) -> list[int]:
    """Masks of ``count`` ranges of the 64 bits, as equal as can be."""
    cuts = [64 * i // count for i in range(count + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def bucket_masks(rows: int, differing: int) -> list[int]:
    """Masks whose bits two fingerprints share in at least one case if they differ in ``differing`` bits.

    Of m ranges, at least m - d agree; the masks are the unions of m - d ranges. More ranges mean longer
    masks and so smaller buckets, but more of them: ``rows`` decides, by the number of rows plus pairs.
    """
    def cost(agreeing: int) -> float:
        ranges = differing + agreeing
        bits = 64 * agreeing / ranges
        return math.comb(ranges, agreeing) * (rows * 100 + rows * rows / 2 ** bits)

    agreeing = min(range(1, 5), key=cost)
    ranges = bit_ranges(differing + agreeing)
    return [sum(some) for some in itertools.combinations(ranges, agreeing)]


def _find(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    roots = parent[nodes]
    while True:
        above = parent[roots]
        if (above == roots).all():
            return roots
        roots = above


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union-find over arrays: the larger root goes below the smaller one until all pairs agree."""
    while True:
        a, b = _find(parent, a), _find(parent, b)
        apart = a != b
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        parent[np.maximum(a, b)] = np.minimum(a, b)


def link_rows(group: np.ndarray, prints: np.ndarray, differing: int) -> np.ndarray:
    """For each row the smallest row it is connected with in its group. Rows are sorted by group and
    distance to the first pivot; links differ in at most ``differing`` bits."""
    table = [np.bitwise_count(prints ^ np.uint64(p)).astype(np.int8) for p in PIVOTS]
    parent = np.arange(len(prints))
    active, step = np.arange(len(prints)), 0
    while len(active):
        step += 1
        active = active[active < len(prints) - step]
        near = (group[active + step] == group[active]) & (table[0][active + step] - table[0][active] <= differing)
        active = active[near]
        a, b = active, active + step
        for distances in table[1:]:
            if not len(a):
                break
            close = np.abs(distances[a] - distances[b]) <= differing
            a, b = a[close], b[close]
        alike = np.bitwise_count(prints[a] ^ prints[b]) <= differing
        if alike.any():
            _unite(parent, a[alike], b[alike])
    return _find(parent, np.arange(len(prints)))


def _link_tiles(differing: int, at_once: int = 1 << 15):
    """Edges of sorted tiles. Tiles are handed on in batches; one that is cut off waits for its rest."""
    keys = ["mask", "bucket", "tile"]

    def edges(table: pa.Table) -> pa.RecordBatch:
        columns = [table[c].to_numpy() for c in keys]
        group = np.cumsum(np.r_[False, np.any([c[1:] != c[:-1] for c in columns], axis=0)])
        root = link_rows(group, table["fingerprint"].to_numpy().view(np.uint64), differing)
        joined = np.flatnonzero(root != np.arange(len(root)))
        nodes = table["node"].to_numpy()
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes[joined]), pa.array(nodes[root[joined]])], ["a", "b"]
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            kept.append(batch)
            if sum(b.num_rows for b in kept) < at_once:
                continue
            table = pa.Table.from_batches(kept).combine_chunks()
            last = [table[c][-1].as_py() for c in keys]
            same = np.all([table[c].to_numpy() == v for c, v in zip(keys, last)], axis=0)
            cut = int(np.argmax(same))  # where the last tile begins
            if cut:
                yield edges(table.slice(0, cut).combine_chunks())
            kept = table.slice(cut).combine_chunks().to_batches()
        if kept and sum(b.num_rows for b in kept):
            yield edges(pa.Table.from_batches(kept).combine_chunks())

    return work


def links(nodes: DataFrame, differing: int, scratch: Scratch) -> DataFrame:
    """Edges ``(a, b)`` between the ``node`` numbers of ``nodes(node, fingerprint)`` that connect what links
    connect. ``nodes`` is a stored table with distinct fingerprints."""
    masks = bucket_masks(nodes.count(), differing)
    keys = F.array(*(
        F.struct(F.lit(i).alias("mask"), F.col("fingerprint").bitwiseAND(F.lit(signed(m))).alias("bucket"))
        for i, m in enumerate(masks)
    ))
    dealt = nodes.select("node", "fingerprint", F.inline(keys))

    # Buckets beyond a tile are cut by a hash; every two parts meet in a tile of their own.
    sizes = dealt.groupBy("mask", "bucket").count().where(F.col("count") > TILE)
    sizes = scratch.save(sizes.withColumn("parts", F.ceil(F.col("count") / TILE).cast("int")).drop("count"), "large")
    if sizes.isEmpty():
        tiled = dealt.withColumn("tile", F.lit(0).cast("bigint"))
    else:
        parts = F.coalesce(F.col("parts"), F.lit(1))
        own = F.pmod(F.xxhash64("node"), parts).cast("int")
        others = F.filter(F.sequence(F.lit(0), parts - 1), lambda j: j != F.col("_part"))
        pairs = F.transform(others, lambda j: F.least(j, "_part").cast("bigint") * parts + F.greatest(j, "_part"))
        tiled = dealt.join(sizes, ["mask", "bucket"], "left").withColumn("_part", own)
        tiled = tiled.withColumn("tile", F.explode(F.when(parts > 1, pairs).otherwise(F.array(F.lit(0).cast("bigint")))))
    distance = F.bit_count(F.col("fingerprint").bitwiseXOR(F.lit(signed(PIVOTS[0])))).alias("d0")
    tiled = tiled.select("mask", "bucket", "tile", distance, "node", "fingerprint")
    tiled = tiled.repartition("mask", "bucket", "tile").sortWithinPartitions("mask", "bucket", "tile", "d0")
    return tiled.mapInArrow(_link_tiles(differing), "a bigint, b bigint")


# Classes

def near_duplicates(docs: DataFrame, words: int = 4, differing: int = 4) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id``, its ``fingerprint`` and ``component_id``, the
    smallest doc_id of its class.

    A-Z are lower-cased; words are split at ASCII space. Links differ in at most ``differing`` bits of 64.

    A null or wordless text has the fingerprint 0 and links like any other. Rows with a null doc_id have
    a class too; it is null only if all its ids are. Repeated rows fall into one class. An empty table
    gives no rows; other columns are ignored.

    The texts are read once; fingerprints are stored, and everything after that moves narrow rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    marked = scratch.save(fingerprints(docs, words), "fingerprints")
    # Documents of one fingerprint are one node, named by a number of its own.
    nodes = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id"))
    nodes = scratch.save(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    edges = scratch.save(links(nodes, differing, scratch), "edges")
    classes = scratch.save(components(edges, scratch), "classes")
    joined = nodes.select("node", "least_id").join(classes, "node")
    least = joined.groupBy("root").agg(F.min("least_id").alias("class_id"))
    named = classes.join(least, "root").select("node", "class_id")
    labels = nodes.join(named, "node", "left").select(
        "fingerprint", F.coalesce("class_id", "least_id").alias("component_id")
    )
    return marked.join(labels, "fingerprint").select("doc_id", "fingerprint", "component_id")


def representatives(docs: DataFrame, words: int = 4, differing: int = 4) -> DataFrame:
    """The rows of ``docs`` whose doc_id is its class's smallest (``near_duplicates``); all columns stay.
    Rows that repeat that id in the class are all kept, and so are rows without an id; a repeated id with a
    text of another class is another document."""
    found = near_duplicates(docs, words, differing)
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id")))
    return without_rows(
        docs, gone.withColumnRenamed("fingerprint", "key"), lambda text: fingerprint(text, words), "bigint"
    )
