"""Exact duplicates through Patricia tries whose terminal nodes own groups of equal texts.

Every text enters a trie where it is read, so copies leave a task once; what these tries own is dealt
out by length and content hash. A partition inserts its full byte strings into one compressed radix
trie, so texts are equal because their bytes are, not because hashes are. A terminal node keeps the
smallest (or largest) identifier and the number of rows. When a partition's trie outgrows its memory,
its largest subtree goes to a file of the task and is built again, alone, at the end.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barlake.llm.common import Scratch, ship, without_rows

#: Bytes that a trie holds, its nodes included, before it hands on or spills.
MEMORY = 48 << 20
#: Bytes of a node beside its label: objects of node, children, label, owner and id.
NODE = 400


class Owner:
    """What a terminal node keeps: identifier, rows that carry it, rows in all."""

    __slots__ = ("id", "ties", "rows")

    def __init__(self, id, ties: int, rows: int):
        self.id, self.ties, self.rows = id, ties, rows

    def add(self, other: Owner, keep: str) -> None:
        self.rows += other.rows
        if other.id == self.id:
            self.ties += other.ties
        elif self.id is None or (other.id is not None and (other.id > self.id) == (keep == "max")):
            self.id, self.ties = other.id, other.ties


class _Node:
    __slots__ = ("label", "children", "owner")

    def __init__(self, label: bytes, owner: Owner | None = None):
        self.label, self.owner = label, owner
        self.children: dict[int, _Node] = {}


def _common(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``, by halving."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if a[low:mid] == b[at + low:at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


class OwnerTrie:
    """Compressed radix trie from byte strings to owners, with spill by subtree."""

    def __init__(self, keep: str = "min", memory: int = MEMORY):
        if keep not in ("min", "max"):
            raise ValueError("keep is min or max")
        self.keep, self.memory = keep, memory
        self.root, self.held = _Node(b""), 0
        self.spilled: list[tuple[bytes, object]] = []

    def insert(self, text: bytes, owner: Owner) -> None:
        for prefix, file in self.spilled:
            if text.startswith(prefix):
                pickle.dump((text, owner.id, owner.ties, owner.rows), file)
                return
        self._insert(text, owner)
        if self.held > self.memory:
            self._spill()

    def flush(self) -> Iterator[tuple[bytes, Owner]]:
        """Owners of a trie that has not spilled; it is empty afterwards."""
        root, self.root, self.held = self.root, _Node(b""), 0
        yield from self._walk(root, b"")

    def add(self, text: bytes, owner: Owner) -> bool:
        """Insert without a spill; true if the trie has outgrown its memory and should be flushed."""
        self._insert(text, owner)
        return self.held > self.memory

    def _insert(self, text: bytes, owner: Owner) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                node.children[text[at]] = _Node(text[at:], owner)
                self.held += len(text) - at + NODE
                return
            if text.startswith(child.label, at):
                node, at = child, at + len(child.label)
                continue
            shared = _common(child.label, text, at)
            fork = _Node(child.label[:shared])
            child.label = child.label[shared:]
            fork.children[child.label[0]] = child
            node.children[fork.label[0]] = fork
            self.held += NODE
            node, at = fork, at + shared
        if node.owner is None:
            node.owner = owner
        else:
            node.owner.add(owner, self.keep)

    @staticmethod
    def _walk(node: _Node, prefix: bytes) -> Iterator[tuple[bytes, Owner]]:
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            if node.owner is not None:
                yield prefix, node.owner
            stack.extend((child, prefix + child.label) for child in node.children.values())

    @staticmethod
    def _bytes(node: _Node) -> int:
        total, stack = 0, [node]
        while stack:
            node = stack.pop()
            total += len(node.label) + NODE
            stack.extend(node.children.values())
        return total

    def _spill(self) -> None:
        """Write out the largest subtree below the first fork; a trie without a fork stays."""
        node, prefix = self.root, b""
        while len(node.children) == 1 and node.owner is None:
            (node,) = node.children.values()
            prefix += node.label
        if not node.children or (len(node.children) == 1 and node.owner is None):
            return
        first, child = max(node.children.items(), key=lambda item: self._bytes(item[1]))
        size = self._bytes(child)
        file = tempfile.TemporaryFile()  # gone with the task
        for text, owner in self._walk(child, prefix + child.label):
            pickle.dump((text, owner.id, owner.ties, owner.rows), file)
        del node.children[first]
        self.held -= size
        self.spilled.append((prefix + bytes([first]), file))

    def owners(self) -> Iterator[tuple[bytes, Owner]]:
        """Every distinct text and its owner: those in memory, then one spilled subtree at a time."""
        yield from self._walk(self.root, b"")
        self.root, self.held = _Node(b""), 0
        for _, file in self.spilled:
            with file:
                file.seek(0)
                below = OwnerTrie(self.keep, self.memory)
                while True:
                    try:
                        text, id, ties, rows = pickle.load(file)
                    except EOFError:
                        break
                    below.insert(text, Owner(id, ties, rows))
                yield from below.owners()


def _digest(text: bytes) -> str:
    return hashlib.sha256(text.lower()).hexdigest()


def _short_digest(text: bytes) -> bytes:
    return hashlib.sha256(text.lower()).digest()[:16]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests = [], []
        for text in batch.column(1):
            raw = text.as_py().lower()  # bytes: A-Z alone
            sizes.append(len(raw))
            digests.append(hashlib.sha256(raw).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "n_bytes", "text_sha256"],
        )


_ROWS = "n_bytes bigint, text_sha256 string, text binary, id bigint, ties bigint, rows bigint"


def _batches(rows: Iterator[tuple], limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([
        ("n_bytes", pa.int64()), ("text_sha256", pa.string()), ("text", pa.binary()), ("id", pa.int64()),
        ("ties", pa.int64()), ("rows", pa.int64()),
    ])
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2]) + 100
        if size > limit:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _named(owners: Iterator[tuple[bytes, Owner]], texts: bool) -> Iterator[tuple]:
    for text, owner in owners:
        digest = hashlib.sha256(text).hexdigest()
        yield len(text), digest, text if texts else b"", owner.id, owner.ties, owner.rows


def exact_groups(docs: DataFrame, keep: str = "min", memory: int = MEMORY) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: the group of texts that equal it after lower-casing A-Z.

    Columns: ``doc_id``, ``keep_id`` (the group's smallest or largest id), ``group_size``, ``kept`` (true
    for one row of each group, one that carries ``keep_id``) and ``text_sha256`` of the normalised text.
    A null text is empty. Null ids are no candidates for ``keep_id``; it is null if a group has no other.
    Repeated rows are rows of their group, of which at most one is kept. Other columns are ignored; an
    empty table gives no rows. Ids are integers.

    1. One pass takes length and hash of every text; these narrow rows are stored.
    2. Every text is inserted into a trie where it is read. A trie that is full hands on what it owns and
       starts anew, so a text that a third of all rows share leaves a task once per full trie.
    3. What these tries own is dealt out by length and hash and inserted again; each distinct text ends in
       one terminal node.
    4. Owners are joined to the narrow rows, one owner per group on one side.

    The plan is the same at every size. Two texts with the same length and SHA-256 that differ stop the job.
    """
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark, "trie-dedup")
    raw = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
    )
    rows = raw.mapInArrow(_digests, "doc_id bigint, n_bytes bigint, text_sha256 string")
    rows = scratch.save(rows.withColumn("_row", F.monotonically_increasing_id()), "rows")

    owners = _owners(raw, keep, memory)
    owners = scratch.save(owners, "owners")

    # keep_id may stand in several rows of its group; then the first of them is kept.
    keys = ["n_bytes", "text_sha256"]
    result = rows.join(owners.withColumnRenamed("id", "keep_id"), keys)
    carries = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    tied = owners.where("ties > 1")
    if tied.isEmpty():
        result = result.withColumn("kept", carries)
    else:
        firsts = rows.join(tied.select(*keys, "id"), keys).where(F.col("doc_id").eqNullSafe(F.col("id")))
        firsts = firsts.groupBy(*keys).agg(F.min("_row").alias("_first"))
        result = result.join(firsts, keys, "left")
        result = result.withColumn("kept", carries & F.coalesce(F.col("_row") == F.col("_first"), F.lit(True)))
    return result.select("doc_id", "keep_id", F.col("rows").alias("group_size"), "kept", "text_sha256")


def _owners(raw: DataFrame, keep: str, memory: int) -> DataFrame:
    """``(n_bytes, text_sha256, id, ties, rows)`` of the distinct texts, through two levels of tries."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = OwnerTrie(keep, memory)
        for batch in batches:
            for id, text in zip(batch.column(0), batch.column(1)):
                if trie.add(text.as_py().lower(), Owner(id.as_py(), 1, 1)):
                    yield from _batches(_named(trie.flush(), texts=True))
        yield from _batches(_named(trie.flush(), texts=True))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = OwnerTrie(keep, memory)
        for batch in batches:
            for text, *owner in zip(*(batch.column(name) for name in ("text", "id", "ties", "rows"))):
                trie.insert(text.as_py(), Owner(*(value.as_py() for value in owner)))
        yield from _batches(_named(trie.owners(), texts=False))

    dealt = raw.mapInArrow(local, _ROWS).repartition("n_bytes", "text_sha256")
    owners = dealt.mapInArrow(merged, _ROWS).drop("text")
    # One terminal node per length and hash, or the keys would not tell the texts apart.
    nodes = F.count("*").over(W.partitionBy("n_bytes", "text_sha256"))
    clash = F.raise_error(F.lit("two different texts have the same length and SHA-256"))
    single = F.when(F.col("_nodes") > 1, clash.cast("bigint")).otherwise(F.col("rows"))
    return owners.withColumn("_nodes", nodes).withColumn("rows", single).drop("_nodes")


def kept_documents(docs: DataFrame, keep: str = "min") -> DataFrame:
    """The rows of ``docs`` that stay, one per group of equal texts, with all their columns. Rows with
    the same id and equal texts are one document; the same id with another text is another document. Rows
    with a null id stay."""
    groups = exact_groups(docs, keep)
    gone = groups.where(~F.col("kept") & ~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    key = F.unhex(F.substr("text_sha256", F.lit(1), F.lit(32))).alias("key")
    return without_rows(docs, gone.select("doc_id", key), _short_digest, "binary")
