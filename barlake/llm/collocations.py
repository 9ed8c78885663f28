"""Phrase collocation mining: word n-grams counted without loss in counting quotient filters.

1. Numbers: words are counted; those that are frequent enough to be part of a phrase get a number. A bitmap
   of fixed size that holds their hashes goes to all tasks: a word that it lacks is rare.
2. Shards: a task numbers the words it meets and counts their pairs in filters (``quotient_filter``); pairs
   with a rare word cannot become phrases. A filter is closed when it holds a fixed number of n-grams, a shard
   when it has a fixed number of words or filters, so their memory does not depend on the input.
3. Merge: each shard is joined with the numbers of its own words. Its n-grams are read back from its filters
   (the permutation is invertible), put into common numbers and into a filter again, which is cut into
   ranges of quotients. All shards' filters of a range are merged in one task. Ranges hold about as many
   n-grams each, whatever the phrases are, and a phrase that a third of all rows share arrives once from
   each filter.
4. Triples: steps 2 and 3 once more. A second bitmap holds the frequent pairs: a triple with a pair that it
   lacks is rare, and is not counted.
5. Scores, nested phrases and ranks are joins and windows over the phrases that are frequent enough.
"""

from __future__ import annotations

import itertools
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barlake.llm import quotient_filter as qf
from barlake.llm.common import Scratch, numbered, ship

#: Bits of a word's number within a shard; three of them make a packed n-gram.
BITS = 21


class Limits(NamedTuple):
    """What bounds the memory of tasks. The result does not depend on it."""

    words: int = 1 << 18  # distinct words met at which a shard ends
    filters: int = 8  # filters at which a shard ends
    filter: int = 1 << 18  # distinct n-grams at which a filter is closed
    buffer: int = 1 << 17  # words that are taken at once
    counted: int = 1 << 18  # distinct words that a task counts before it hands them on
    range: int = 1 << 20  # most n-grams, on average, of a range of quotients: what one task merges
    slice: int = 1 << 20  # bytes of a text that are split at once: fewer words than a shard has numbers left
    map_bits: int = 26  # bits of a map of frequent words or pairs: 8 MB. With more of them it spares less work


_U = np.uint64
_LOW = _U((1 << BITS) - 1)
_BREAK = b"\xff"  # no byte of UTF-8
_MARKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BREAK * 10)
_PARTS = "shard bigint, lang string, word binary, id int, size bigint, cells binary"
_ARROW = pa.schema([
    ("shard", pa.int64()), ("lang", pa.string()), ("word", pa.binary()), ("id", pa.int32()),
    ("size", pa.int64()), ("cells", pa.binary()),
])
_SEED = 42  # of Spark's xxhash64


def word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\0" + word, _SEED)


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of two words that stand together, from their hashes."""
    return qf.scatter(qf.scatter(first) + second)


def places(h, map_bits: int) -> tuple:
    """The two bits of a map that stand for a hash (a number or an array of them)."""
    kind = int if isinstance(h, int) else _U
    return h >> kind(64 - map_bits), h & kind((1 << map_bits) - 1)


class _Numbers(dict):
    """Numbers of a language's words, given out as words are met; 0 for marks and rare words."""

    def __init__(self, shard: _Shard, lang: str):
        super().__init__({_BREAK: 0})
        self.shard, self.lang = shard, lang

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self.shard.number_of(self.lang, word)
        return number


class _Shard:
    """Words and n-grams of a part of a task's rows: pairs, or with a map of frequent pairs triples."""

    def __init__(self, number: int, words: bytes, pairs: bytes | None, limits: Limits):
        self.number, self.frequent, self.pairs, self.limits = number, words, pairs, limits
        self.words: list[tuple[str, bytes] | None] = [None]  # numbers begin at 1; 0 parts the pieces
        self.hashes = [0]
        self.of: dict[str, _Numbers] = {}
        self.met = self.closed = 0
        self.used = np.zeros(1, bool)
        self.entries = _nothing()

    def numbers(self, lang: str) -> _Numbers:
        if lang not in self.of:
            self.of[lang] = _Numbers(self, lang)
        return self.of[lang]

    def number_of(self, lang: str, word: bytes) -> int:
        self.met += 1
        h = word_hash(lang, word)
        if not all(self.frequent[p >> 3] >> (p & 7) & 1 for p in places(h, self.limits.map_bits)):
            return 0
        self.words.append((lang, word))
        self.hashes.append(h)
        return len(self.words) - 1

    def add(self, ahead: list[int], ids: list[int]) -> None:
        """Count the n-grams that end in the words ``ids``; ``ahead`` are the two words before."""
        x = np.array(ahead + ids, np.int64)
        if self.pairs is None:
            x = x[max(len(ahead) - 1, 0):]
            parts = x[:-1], x[1:]
            counted = (parts[0] > 0) & (parts[1] > 0)
        else:
            first, second = x[:-1], x[1:]
            often = (first > 0) & (second > 0)
            hashes, bits = np.array(self.hashes, np.uint64), np.frombuffer(self.pairs, np.uint8)
            for place in places(pair_hash(hashes[first], hashes[second]), self.limits.map_bits):
                often &= (bits[(place >> _U(3)).astype(np.int64)] >> (place & _U(7)).astype(np.uint8) & 1).astype(bool)
            parts = x[:-2], x[1:-1], x[2:]
            counted = often[:-1] & often[1:]
        parts = [part[counted] for part in parts]
        self.used = np.r_[self.used, np.zeros(len(self.words) - len(self.used), bool)]
        packed = np.zeros(len(parts[0]), np.uint64)
        for place, part in enumerate(parts):
            self.used[part] = True
            packed |= part.astype(np.uint64) << _U((2 - place) * BITS)
        self.entries = qf.merge([self.entries, qf.count(qf.scatter(packed))])

    @property
    def full(self) -> bool:
        return self.met >= self.limits.words or self.closed >= self.limits.filters

    def cells(self) -> Iterator[pa.RecordBatch]:
        """The filter as a row; the next n-grams go into a new one."""
        if len(self.entries):
            row = self.number, None, None, None, len(self.entries), qf.encode(self.entries)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _ARROW.types)], schema=_ARROW)
            self.entries, self.closed = _nothing(), self.closed + 1

    def rows(self) -> Iterator[pa.RecordBatch]:
        """What is left of the shard: its last filter, and the words of its n-grams."""
        yield from self.cells()
        used = np.flatnonzero(self.used)
        for at in range(0, len(used), 50_000):
            ids = used[at:at + 50_000]
            part = [self.words[i] for i in ids.tolist()]
            n, none = len(part), [None] * len(part)
            yield pa.RecordBatch.from_arrays([
                pa.array([self.number] * n, pa.int64()), pa.array([p[0] for p in part], pa.string()),
                pa.array([p[1] for p in part], pa.binary()), pa.array(ids.astype(np.int32)),
                pa.array(none, pa.int64()), pa.array(none, pa.binary()),
            ], schema=_ARROW)


def _nothing() -> qf.Entries:
    return qf.Entries(np.empty(0, np.uint64), None, np.empty(0, np.int64))


def slices(text: bytes, size: int) -> Iterator[bytes]:
    """``text`` in parts of about ``size`` bytes, each with a space, a tab or a mark at its end."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(c, at, at + size) for c in (b" ", b"\t", _BREAK))
        if cut < at:  # one word is longer than a part
            found = [p for c in (b" ", b"\t", _BREAK) if (p := text.find(c, at + size)) >= 0]
            if not found:
                break
            cut = min(found)
        yield text[at:cut + 1]
        at = cut + 1
    yield text[at:]


def _counted(limits: Limits):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``(lang, word, n)`` of the texts of a task."""
        def handed() -> Iterator[pa.RecordBatch]:
            for lang, words in counts.items():
                columns = [lang] * len(words), words.keys(), words.values()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.binary(), pa.int64()))], ["lang", "word", "n"]
                )

        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                for part in slices(text.as_py().lower().translate(_MARKS), limits.slice):
                    counts.setdefault(lang, Counter()).update(part.replace(_BREAK, b" ").split())
                    if sum(map(len, counts.values())) >= limits.counted:
                        yield from handed()
                        counts = {}
        yield from handed()

    return work


def _shards(words_map, pairs_map, limits: Limits):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Words and filters of the texts of a task."""
        numbers = itertools.count(TaskContext.get().partitionId() << 32)

        def begin() -> _Shard:
            return _Shard(next(numbers), words_map.value, None if pairs_map is None else pairs_map.value, limits)

        shard = begin()
        ids: list[int] = []
        ahead: list[int] = []
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                marked = text.as_py().lower().translate(_MARKS)  # bytes: lowers A-Z only
                for part in slices(marked, limits.slice):
                    # Spaces and tabs are all that split() finds here. A mark parts the pieces.
                    words = part.replace(_BREAK, b" \xff ").split()
                    ids.extend(map(shard.numbers(lang).__getitem__, words))
                    if len(ids) >= limits.buffer or shard.met >= limits.words:
                        shard.add(ahead, ids)
                        ahead, ids = (ahead + ids)[-2:], []
                        if len(shard.entries) >= limits.filter:
                            yield from shard.cells()
                        if shard.full:
                            yield from shard.rows()
                            tail = [shard.words[i] for i in ahead]
                            shard = begin()
                            ahead = [shard.numbers(word[0])[word[1]] if word else 0 for word in tail]
                ids.append(0)
        shard.add(ahead, ids)
        yield from shard.rows()

    return work


def bit_map(bits: DataFrame, map_bits: int) -> bytes:
    """A map of fixed size with the ``bits(bit)`` set. Parts of it are gathered, 4 KB each."""
    counted = bits.select((F.col("bit") + 1).alias("bit"))  # Spark's bitmaps count from 1
    parts = counted.groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits")
    )
    found = bytearray(1 << (map_bits - 3))
    for row in parts.toLocalIterator():
        at = (row["part"] - 1) * 4096
        found[at:at + 4096] = row["bits"]
    return bytes(found)


def _word_hash() -> Column:
    return F.xxhash64(F.concat(F.encode("lang", "UTF-8"), F.lit(b"\0"), F.col("word")))


def word_map(words: DataFrame, map_bits: int) -> bytes:
    """The map of the words of ``words(lang, word)``."""
    h = _word_hash()
    bits = F.array(F.shiftrightunsigned(h, 64 - map_bits), h.bitwiseAND(F.lit((1 << map_bits) - 1)))
    return bit_map(words.select(F.explode(bits).alias("bit")), map_bits)


def pair_map(pairs: DataFrame, words: DataFrame, map_bits: int) -> bytes:
    """The map of the pairs of ``pairs(first, second)``, numbers of ``words(number, lang, word)``."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
            bits = np.concatenate(places(pair_hash(first, second), map_bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(bits)], ["bit"])

    hashed = words.select("number", _word_hash().alias("h"))
    both = pairs.select("first", "second").join(hashed.toDF("first", "h1"), "first").join(hashed.toDF("second", "h2"), "second")
    return bit_map(both.select("h1", "h2").mapInArrow(work, "bit bigint"), map_bits)


_PIECES = "block bigint, cells binary"


def _in_common_numbers(blocks: int):
    def cut(entries: qf.Entries, into: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """A filter in common numbers, cut into ranges; n-grams with a rare word are left out."""
        packed = qf.gather(entries.high)
        ids = [into[(packed >> _U(shift) & _LOW).astype(np.int64)] for shift in (2 * BITS, BITS, 0)]
        usable = (ids[0] > 0) & (ids[1] > 0) & ((packed & _LOW == 0) | (ids[2] > 0))
        first, second, third = (i[usable] for i in ids)
        high, low = qf.scatter_wide((first << _U(32)) | second, third.astype(np.uint32))
        order = np.lexsort((low, high))
        entries = qf.Entries(high[order], low[order], entries.counts[usable][order])
        block = (entries.high >> _U(32)) * _U(blocks) >> _U(32)
        starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]]) if len(block) else np.empty(0, np.int64)
        for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(block)]):
            yield int(block[start]), qf.encode(entries.slice(start, stop))

    def work(filters: pa.Table, numbers: pa.Table) -> pa.Table:
        """The filters of a shard."""
        into = np.zeros(1 << BITS, np.uint64)
        into[numbers["id"].to_numpy()] = numbers["number"].to_numpy().astype(np.uint64)
        found = [piece for cells in filters["cells"] for piece in cut(qf.decode(cells.as_py()), into)]
        return pa.table({
            "block": pa.array([p[0] for p in found], pa.int64()), "cells": pa.array([p[1] for p in found], pa.binary()),
        })

    return work


_GRAMS = "first bigint, second bigint, third bigint, a bigint"


def _merged(least: int, at_once: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """N-grams of a range that occur at least ``least`` times, from all shards' filters of the range."""
        held: qf.Entries | None = None
        waiting: list[qf.Entries] = []
        for batch in batches:
            waiting += [qf.decode(cells.as_py()) for cells in batch.column("cells")]
            if sum(map(len, waiting)) >= at_once:
                held, waiting = qf.merge([*([held] if held is not None else []), *waiting]), []
        if held is not None or waiting:
            held = qf.merge([*([held] if held is not None else []), *waiting])
            often = held.counts >= least
            high, low = qf.gather_wide(held.high[often], held.low[often])
            yield pa.RecordBatch.from_arrays([
                pa.array((high >> _U(32)).astype(np.int64)), pa.array((high & _U(0xFFFFFFFF)).astype(np.int64)),
                pa.array(low.astype(np.int64)), pa.array(held.counts[often]),
            ], ["first", "second", "third", "a"])

    return work


def count_phrases(
    docs: DataFrame, least: int, scratch: Scratch, limits: Limits = Limits(),
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``(pairs, triples, words, totals)`` of ``docs(text, lang)``, stored.

    ``pairs`` and ``triples(first, second, third, a)`` are the phrases of two (``third`` is 0) and three words with
    at least ``least`` occurrences, as numbers of ``words(number, lang, word, f)``, whose words occur as often at least.
    ``totals(lang, n)`` counts all words.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
    )
    counted = texts.mapInArrow(_counted(limits), "lang string, word binary, n bigint")
    counted = scratch.save(counted.groupBy("lang", "word").agg(F.sum("n").alias("f")), "counted")
    totals = scratch.save(counted.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    words = numbered(counted.where(F.col("f") >= least), "number", scratch, "words")
    scratch.drop("counted")
    top = words.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    if top >= 1 << 32:
        raise ValueError("more than 2^32 frequent words: their numbers do not fit a packed phrase")

    words_map = spark.sparkContext.broadcast(word_map(words, limits.map_bits))
    pairs = _merged_shards(texts, words, words_map, None, least, scratch, limits)
    pairs_map = spark.sparkContext.broadcast(pair_map(pairs, words, limits.map_bits))
    triples = _merged_shards(texts, words, words_map, pairs_map, least, scratch, limits)
    return pairs, triples, words, totals


def _merged_shards(
    texts: DataFrame, words: DataFrame, words_map, pairs_map, least: int, scratch: Scratch, limits: Limits,
) -> DataFrame:
    """Pairs, or with a map of pairs triples, that occur at least ``least`` times."""
    name = "pairs" if pairs_map is None else "triples"
    parts = scratch.save(texts.mapInArrow(_shards(words_map, pairs_map, limits), _PARTS), f"{name}-shards")
    met, filters = parts.where("word IS NOT NULL"), parts.where("cells IS NOT NULL")
    entries = filters.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    blocks = max(1, -(-entries // limits.range))
    common = met.join(words.select("lang", "word", "number"), ["lang", "word"])
    common = common.select(F.col("shard").alias("of_shard"), "id", "number")
    cut = filters.select("shard", "cells").groupBy("shard").cogroup(common.groupBy("of_shard"))
    pieces = cut.applyInArrow(_in_common_numbers(blocks), _PIECES)
    grams = pieces.groupBy("block").applyInArrow(_streamed(_merged(least, limits.buffer)), _GRAMS)
    grams = scratch.save(grams, name)
    scratch.drop(f"{name}-shards")
    return grams


def _streamed(work):
    """With the annotations by which Spark tells that a group is handed over batch by batch."""
    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)

    grouped.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return grouped


def collocations(
    docs: DataFrame, least: int = 10, share: int = 50, top: int = 2000, limits: Limits = Limits(),
) -> DataFrame:
    """The ``top`` collocations of each language of ``docs(text, lang)``.

    A-Z are lower-cased; texts are split at ``. , ; : ! ?`` and line ends into pieces, pieces at space and
    tab into words. Phrases are two or three words of a piece with at least ``least`` occurrences ``a``,
    overlaps included. A phrase is cut where its score is lowest (ties: after fewer words): the score
    is floor(1000000 a a / (l r)), with the occurrences l and r of the parts. Phrases that lie in a longer one
    with at least ``share`` percent of their occurrences are left out.

    Columns: ``lang``, ``rank`` (from 1: score, then ``a``, descending, then phrase in byte order), ``phrase``
    (words joined by a space), ``a``, ``l``, ``r``, ``n`` (words of the language), ``score``.

    A null language is ``und``, together with texts labelled so; a null text is empty; repeated rows count
    again; an empty table gives no rows; other columns are ignored. A text of any length is taken in slices.
    """
    scratch = Scratch(docs.sparkSession, "collocations")
    pairs, triples, words, totals = count_phrases(docs, least, scratch, limits)

    inside = triples.select("first", "second", "a").union(triples.select("second", "third", "a"))
    longer = inside.toDF("first", "second", "a").groupBy("first", "second").agg(F.max("a").alias("longer"))
    alone = pairs.drop("third").join(longer, ["first", "second"], "left")
    alone = alone.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share))

    def word(number: str, place: int) -> DataFrame:
        return words.select(
            F.col("number").alias(number), F.col("word").alias(f"w{place}"), F.col("f").alias(f"f{place}"),
            *([F.col("lang")] if place == 1 else []),
        )

    def score(left: str, right: str) -> Column:
        # Whole numbers of up to 38 digits: exact for counts below 10^15.
        square = "CAST(1000000 AS DECIMAL(7, 0)) * (CAST(a AS DECIMAL(15, 0)) * CAST(a AS DECIMAL(15, 0)))"
        return F.expr(f"{square} div (CAST({left} AS DECIMAL(15, 0)) * CAST({right} AS DECIMAL(15, 0)))")

    def phrase(*places: str) -> Column:
        texts = [F.col(p).cast("string") for p in places]
        return F.concat_ws(" ", *texts).alias("phrase")

    two = alone.join(word("first", 1), "first").join(word("second", 2), "second").select(
        "lang", phrase("w1", "w2"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), score("f1", "f2").alias("score")
    )
    begin = pairs.select("first", "second", F.col("a").alias("f12"))
    end = pairs.select(F.col("first").alias("second"), F.col("second").alias("third"), F.col("a").alias("f23"))
    three = triples.join(begin, ["first", "second"]).join(end, ["second", "third"])
    three = three.join(word("first", 1), "first").join(word("second", 2), "second").join(word("third", 3), "third")
    three = three.withColumns({"_early": score("f1", "f23"), "_late": score("f12", "f3")})
    early = F.col("_early") <= F.col("_late")
    three = three.select(
        "lang", phrase("w1", "w2", "w3"), "a", F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
        F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("_early", "_late").alias("score"),
    )
    order = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = two.union(three).withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
