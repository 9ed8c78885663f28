"""Spelling variants: words one edit apart, grouped by the far more frequent form.

Two different words are one edit apart if the length of their common prefix plus that of their common
suffix reaches the length of the longer one, M, less one. Search by blocks: M is cut into a few ranges. The
edit lies in one of them, so the words agree in all that stands before the range and, counted from the
end, in all behind it. Words that agree in that for some M and range form a block. A block's words are rows
of two matrices of code points, one padded behind, one in front; the matrices are compared with themselves
shifted by 1, 2, ... rows, which gives prefix and suffix lengths of all pairs of the block. A pair counts
in the block of the range in which its common prefix ends, and so exactly once. Blocks that many words
share are cut into tiles; of a tile, only one row per word leaves its task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import Scratch, ship

#: Ranges that a word's length is cut into, and code points of a block that one tile holds of either side.
RANGES, TILE = 4, 1 << 16
#: Cells of the matrices that are compared at once.
CELLS = 1 << 22
#: Distinct words that a task counts before it hands them on.
COUNTED = 400_000


def altered(run: bytes, before: int, every: int) -> bytes:
    """``run`` (Latin-1), without one of its code points if its hash is divisible by ``every``. ``before`` is the
    hash of what stands ahead of it."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), before)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def count_words(docs: DataFrame, shortest: int, every: int) -> DataFrame:
    """``(word, n)`` of the runs of letters of ``docs(doc_id, text)``, counted in each task and over all."""
    ship(docs.sparkSession)
    pattern = rb"[A-Za-z\xC0-\xFF]{%d,}" % shortest  # a longest run, as no shorter one is wanted

    def handed(counts: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = re.compile(pattern)
        counts: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not text.is_valid:
                    continue
                # One byte per code point; others than Latin-1 become question marks, which are no letters.
                raw = text.as_py().encode("latin-1", "replace").lower()
                before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in Counter(runs.findall(raw)).items():
                    word = altered(run, before, every)
                    if len(word) >= shortest:
                        counts[word] += n
                if len(counts) >= COUNTED:
                    yield handed(counts)
                    counts = Counter()
        if counts:
            yield handed(counts)

    found = docs.select("doc_id", F.col("text").cast("string")).mapInArrow(work, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def cuts(length: int, ranges: int = RANGES) -> list[int]:
    return [length * i // ranges for i in range(ranges + 1)]


def _matrices(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, and code points padded behind and in front; the latter is read from the end."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    width = int(size.max()) + 1  # a column of padding, so that different rows differ within the matrix
    ahead = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    behind = np.frombuffer(b"".join(w[::-1].ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    return size, ahead, behind


def near_pairs(
    group: np.ndarray, longest: np.ndarray, place: np.ndarray, part: np.ndarray, apart: np.ndarray, words: list[bytes],
    ranges: int = RANGES,
) -> tuple[np.ndarray, np.ndarray]:
    """Rows of near words that count in their group. Rows of a group stand together; ``longest`` and ``place``
    are the group's M and range. Where ``apart`` is set, only words of different parts are compared."""
    size, ahead, behind = _matrices(words)
    table = np.array([cuts(m, ranges) for m in range(int(longest.max()) + 1)])
    begin, end = table[longest, place], table[longest, place + 1]
    found_a, found_b = [], []
    active, step = np.arange(len(words)), 0
    while True:
        step += 1
        active = active[active < len(words) - step]
        active = active[group[active] == group[active + step]]
        if not len(active):
            break
        pairs = max(1, CELLS // ahead.shape[1])
        for at in range(0, len(active), pairs):
            a = active[at:at + pairs]
            b = a + step
            asked = (size[a] == longest[a]) | (size[b] == longest[a])  # else they meet at a lower M
            asked &= ~apart[a] | (part[a] != part[b])
            a, b = a[asked], b[asked]
            prefix = (ahead[a] != ahead[b]).argmax(axis=1)
            here = (begin[a] <= prefix) & (prefix < end[a])
            a, b, prefix = a[here], b[here], prefix[here]
            suffix = (behind[a] != behind[b]).argmax(axis=1)
            near = prefix + suffix >= longest[a] - 1
            found_a.append(a[near])
            found_b.append(b[near])
    none = [np.empty(0, np.int64)]
    return np.concatenate(found_a or none), np.concatenate(found_b or none)


def _spans(starts: np.ndarray, longest: np.ndarray) -> Iterator[tuple[int, int]]:
    """Groups that begin at ``starts`` in spans whose matrices are bounded, so that one very long word does not
    widen the rows of all others. A single group may exceed that; tiles bound it."""
    begin = 0
    stops = np.r_[starts[1:], len(longest)]
    for start, stop in zip(starts.tolist(), stops.tolist()):
        if start > begin and (stop - begin) * (int(longest[begin:stop].max()) + 1) > 4 * CELLS:
            yield begin, start
            begin = start
    yield begin, len(longest)


_TILE_KEYS = ["longest", "place", "stem", "tile"]
_NEAR = "word string, n_near bigint, form string, form_n bigint"


def _near_words(ranges: int, at_once: int = 1 << 15):
    """Sorted tiles to one row per word that has a near one: their number and the best of them."""
    def nearest(table: pa.Table) -> pa.RecordBatch:
        keys = [table[c].to_numpy() for c in ("longest", "place", "tile")]
        stems = table["stem"].to_pylist()
        new = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        new |= np.fromiter((x != y for x, y in zip(stems, stems[1:])), bool, len(stems) - 1)
        words, n = table["code"].to_pylist(), table["n"].to_numpy()
        columns = [np.cumsum(np.r_[False, new]), *(k.astype(np.int64) for k in keys[:2]), table["part"].to_numpy()]
        columns.append(table["apart"].to_numpy(zero_copy_only=False))
        pairs = [np.empty((2, 0), np.int64)]
        for start, stop in _spans(np.flatnonzero(np.r_[True, new]), keys[0]):
            found = near_pairs(*(c[start:stop] for c in columns), words[start:stop], ranges)
            pairs.append(np.array(found) + start)
        a, b = np.concatenate(pairs, axis=1)
        one, other = np.r_[a, b], np.r_[b, a]
        rank = np.empty(len(words), np.int64)
        rank[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
        order = np.lexsort((rank[other], -n[other], one))
        one, other = one[order], other[order]
        first = np.flatnonzero(np.r_[True, one[1:] != one[:-1]]) if len(one) else np.empty(0, np.int64)
        counts = np.diff(np.r_[first, len(one)])
        shown = table["word"].take(pa.array(one[first])), table["word"].take(pa.array(other[first]))
        return pa.RecordBatch.from_arrays([
            shown[0].combine_chunks(), pa.array(counts), shown[1].combine_chunks(), pa.array(n[other[first]]),
        ], ["word", "n_near", "form", "form_n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for batch in batches:
            kept.append(batch)
            if sum(b.num_rows for b in kept) < at_once:
                continue
            table = pa.Table.from_batches(kept).combine_chunks()
            last = [table[c][-1].as_py() for c in _TILE_KEYS]
            rows = table.num_rows - 1
            while rows and [table[c][rows - 1].as_py() for c in _TILE_KEYS] == last:  # where the last tile begins
                rows -= 1
            if rows:
                yield nearest(table.slice(0, rows).combine_chunks())
            kept = table.slice(rows).combine_chunks().to_batches()
        if kept and sum(b.num_rows for b in kept):
            yield nearest(pa.Table.from_batches(kept).combine_chunks())

    return work


def near_words(words: DataFrame, scratch: Scratch, ranges: int = RANGES) -> DataFrame:
    """``(word, n_near, form, form_n)`` for the words of ``words(word, n)`` that have a near one: how many, and the
    most frequent of them (ties: the first in code-point order) with its n. ``words`` is a stored table."""
    ship(words.sparkSession)
    size = F.length("word")
    deals = []
    for more in (0, 1):  # as the longer word of a pair, or as the shorter one
        for place in range(ranges):
            longest = size + more
            begin, end = ((longest * i / ranges).cast("int") for i in (place, place + 1))
            left, right = F.substring("word", F.lit(1), begin), longest - end
            stem = F.concat(left, F.lit("\0"), F.substring("word", size - right + 1, right))
            deals.append(F.struct(longest.alias("longest"), F.lit(place).alias("place"), stem.alias("stem")))
    code = F.encode("word", "ISO-8859-1").alias("code")
    dealt = words.select("word", "n", code, F.inline(F.array(*deals)))

    # Blocks beyond a tile are cut by a hash; every two parts meet in a tile of their own.
    keys = ["longest", "place", "stem"]
    parts = F.least(F.ceil(F.col("count") * F.col("longest") / TILE), F.col("count")).cast("int")
    sizes = dealt.groupBy(*keys).count().withColumn("parts", parts).where("parts > 1").drop("count")
    sizes = scratch.save(sizes, "large")
    if sizes.isEmpty():
        tiled = dealt.withColumns({"part": F.lit(0), "tile": F.lit(0).cast("bigint"), "apart": F.lit(False)})
    else:
        parts = F.coalesce("parts", F.lit(1))
        tiled = dealt.join(sizes, keys, "left").withColumn("part", F.pmod(F.xxhash64("word"), parts).cast("int"))
        others = F.sequence(F.lit(0), parts - 1)
        tiled = tiled.withColumn("_other", F.explode(others))
        low, high = F.least("part", "_other").cast("bigint"), F.greatest("part", "_other").cast("bigint")
        tiled = tiled.withColumns({"tile": low * parts + high, "apart": F.col("part") != F.col("_other")})
        # A tile of two parts compares across them; its rows come from either.
        tiled = tiled.drop("_other", "parts")
    tiled = tiled.select(*_TILE_KEYS, "part", "apart", "n", "word", "code")
    tiled = tiled.repartition(*_TILE_KEYS).sortWithinPartitions(*_TILE_KEYS)
    found = tiled.mapInArrow(_near_words(ranges), _NEAR)
    best = F.min_by(F.struct("form", "form_n"), F.struct(-F.col("form_n"), "form"))
    found = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_best"))
    return found.select("word", "n_near", "_best.form", "_best.form_n")


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``(word, root)`` for ``forms(word, form)``: the last form on the way from form to form. Forms have more and
    more occurrences, so there are no circles. Each round doubles the steps that are taken at once."""
    current = scratch.save(forms.select("word", F.col("form").alias("root")), "root-0")
    step = 0
    while True:
        ahead = current.select(F.col("word").alias("root"), F.col("root").alias("_further"))
        moved = current.join(ahead, "root", "left")
        moved = moved.select("word", F.coalesce("_further", "root").alias("root"), F.col("_further").isNotNull().alias("_moved"))
        step += 1
        following = scratch.save(moved, f"root-{step}")
        ended = following.where("_moved").isEmpty()
        scratch.drop(f"root-{step - 1}")
        current = following.drop("_moved")
        if ended:
            return current


def variants(docs: DataFrame, shortest: int = 7, least: int = 2, factor: int = 10, every: int = 31) -> DataFrame:
    """One row per word of ``docs(doc_id, text)``: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are longest runs of ``A-Za-z`` and U+00C0 to U+00FF, A-Z lower-cased. If the CRC-32 of
    ``<doc_id>:<run>`` is divisible by ``every``, the run loses one code point. Words have at least ``shortest`` code
    points and ``least`` occurrences ``n`` over all texts. Two words are near if one code point that is inserted,
    deleted or replaced makes them equal; ``n_near`` counts near words. ``form`` is the near word of
    largest n (ties: the first in code-point order), if its n is at least ``factor`` (above 1) times the word's,
    else null; ``form_n`` is its n. ``root`` is the last word on the way from form to form, the word itself if it
    has no form.

    Null texts have no words; a null doc_id counts as empty text before the colon; repeated rows count again; an
    empty table gives no rows; other columns are ignored. Texts are read whole, whatever their length.
    """
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.save(count_words(docs, shortest, every).where(F.col("n") >= least), "words")
    near = scratch.save(near_words(words, scratch), "near")
    joined = words.join(near, "word", "left")
    taken = F.col("form_n") >= F.col("n") * factor
    formed = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, F.col("form")).alias("form"), F.when(taken, F.col("form_n")).alias("form_n"),
    )
    formed = scratch.save(formed, "formed")
    ends = roots(formed.where("form IS NOT NULL"), scratch)
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
