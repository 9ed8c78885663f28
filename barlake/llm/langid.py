"""Language identification by n-gram filters with one bit per language.

Training takes the most frequent character trigrams of each language and puts them into one bit-sliced
Bloom filter: a slot holds a mask with a bit for every language, and a trigram sets its languages' bits
in several slots. The AND of a trigram's slots gives all languages that contain it, in one look. A text
is read once: per language, the number of its trigrams whose mask has the language's bit, corrected for
the rate at which the filter says yes without reason, decides.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barlake.llm.common import ship

UNDETERMINED = "und"
# Multipliers of the slot hashes: odd numbers, from the fractional parts of square roots.
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xBB67AE8584CAA73B, 0x3C6EF372FE94F82B], np.uint64)


@functools.lru_cache(1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def trigrams(text: str) -> tuple[np.ndarray, int]:
    """Trigrams of a text as 64-bit numbers, and its number of letters.

    Letters count in lower case; everything between them is one space, also at both ends.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    letter = _letters()[codes]
    count = int(letter.sum())
    if not count:
        return np.empty(0, np.uint64), 0
    codes = np.where(letter, codes, 32).astype(np.uint64)
    codes = np.concatenate(([np.uint64(32)], codes, [np.uint64(32)]))
    space = codes == 32
    codes = codes[~(space & np.r_[False, space[:-1]])]
    return codes[:-2] | codes[1:-1] << np.uint64(21) | codes[2:] << np.uint64(42), count


@dataclass
class LanguageFilter:
    """``slots[i]`` is the mask of slot i in as many 64-bit words as the languages need."""

    languages: list[str]
    slots: np.ndarray
    rates: np.ndarray  # per language, how often the filter says yes to a trigram it has not seen
    default: str  # for letters without a known trigram

    @classmethod
    def build(cls, grams: dict[str, list[int]], default: str, bits_per_gram: int = 12) -> LanguageFilter:
        """From the trigrams (signed 64-bit numbers) of each language."""
        languages = sorted(grams)
        words = max(1, -(-len(languages) // 64))
        most = len({g for own in grams.values() for g in own})
        size = 1 << max(10, int(np.ceil(np.log2(max(1, most * bits_per_gram)))))
        slots = np.zeros((size, words), np.uint64)
        for i, language in enumerate(languages):
            values = np.array(grams[language], np.int64).view(np.uint64)
            bit = np.uint64(1 << (i % 64))
            for places in cls._places(values, size):
                slots[places, i // 64] |= bit
        set_bits = [
            np.count_nonzero(slots[:, i // 64] & np.uint64(1 << (i % 64))) / size for i in range(len(languages))
        ]
        return cls(languages, slots, np.array(set_bits) ** len(_FACTORS), default)

    @staticmethod
    def _places(values: np.ndarray, size: int) -> Iterator[np.ndarray]:
        shift = np.uint64(64 - (size.bit_length() - 1))
        for factor in _FACTORS:
            mixed = values * factor
            yield (((mixed ^ (mixed >> np.uint64(32))) * factor) >> shift).astype(np.int64)

    def counts(self, values: np.ndarray) -> np.ndarray:
        """Per language, the estimated number of trigrams that it contains."""
        mask = None
        for places in self._places(values, len(self.slots)):
            found = self.slots[places]
            mask = found if mask is None else mask & found
        hits = np.array([
            np.count_nonzero(mask[:, i // 64] & np.uint64(1 << (i % 64))) for i in range(len(self.languages))
        ])
        return np.clip((hits - self.rates * len(values)) / (1 - np.minimum(self.rates, 0.999)), 0, len(values))

    def predict(self, text: str | None, chunk: int = 1 << 20) -> tuple[str, float]:
        """Language and the share of the text's trigrams that it contains; ties to the smaller code.

        A long text is looked up ``chunk`` trigrams at a time.
        """
        values, letters = trigrams(text or "")
        if not letters or not self.languages:
            return UNDETERMINED, 0.0
        total = sum(self.counts(values[i:i + chunk]) for i in range(0, len(values), chunk))
        best = int(np.argmax(total))
        if total[best] <= 0:
            return self.default, 0.0
        return self.languages[best], float(total[best] / len(values))


def held_out(doc_id: Column) -> Column:
    """Documents kept from training: crc32 of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trigram counts per language of what a task reads, some texts at a time."""
    def flush(held: dict[str, list[np.ndarray]]) -> pa.RecordBatch:
        columns: tuple[list, list, list] = ([], [], [])
        for lang, parts in held.items():
            grams, n = np.unique(np.concatenate(parts), return_counts=True)
            columns[0].append(np.full(len(grams), lang, object))
            columns[1].append(grams.view(np.int64))
            columns[2].append(n)
        arrays = [np.concatenate(c) if c else np.empty(0) for c in columns]
        return pa.RecordBatch.from_arrays(
            [pa.array(arrays[0], pa.string()), pa.array(arrays[1], pa.int64()), pa.array(arrays[2], pa.int64())],
            ["lang", "gram", "n"],
        )

    held: dict[str, list[np.ndarray]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            grams, letters = trigrams(text.as_py().decode("utf-8", "replace"))
            if letters:
                held.setdefault(lang, []).append(grams)
                size += len(grams)
            if size > 4_000_000:
                yield flush(held)
                held, size = {}, 0
    if held:
        yield flush(held)


def fit(
    docs: DataFrame, per_language: int = 4000, grams_per_language: int = 800, languages: int = 256, seed: int = 42,
) -> LanguageFilter:
    """Learn from ``docs(doc_id, text, lang)``, without held-out documents and null languages.

    The classifier is fit on a sample of labelled rows: of each language about ``per_language``
    documents, picked by a hash of their id; they are read in full. Its filter holds the
    ``grams_per_language`` most frequent trigrams of each of the ``languages`` most frequent languages,
    so what the driver gathers has a fixed bound.
    """
    ship(docs.sparkSession)
    usable = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    amounts = usable.groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(languages)
    amounts = {r["lang"]: r["count"] for r in amounts.collect()}
    if not amounts:
        return LanguageFilter([], np.zeros((2, 1), np.uint64), np.zeros(0), UNDETERMINED)
    parts = 1_000_000
    quota = F.create_map(*(
        F.lit(x) for lang, n in amounts.items() for x in (lang, -(-per_language * parts // n))
    ))
    sample = usable.where(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(parts)) < quota[F.col("lang")])
    sample = sample.where("text IS NOT NULL").select("lang", F.col("text").cast("binary").alias("text"))
    counted = sample.mapInArrow(_counted, "lang string, gram bigint, n bigint")
    counted = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = W.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= grams_per_language)
    found = top.groupBy("lang").agg(F.sort_array(F.collect_list("gram")).alias("grams")).collect()
    default = min(amounts, key=lambda lang: (-amounts[lang], lang))
    return LanguageFilter.build({r["lang"]: r["grams"] for r in found}, default)


def predict(docs: DataFrame, model: LanguageFilter) -> DataFrame:
    """``docs(doc_id, text)`` with ``lang_pred`` and ``score`` (0 to 1). Whole texts, no shuffle.

    ``und`` with score 0 for texts that are null or have no letter, or if nothing could be learned. A text
    with letters but no known trigram gets the most frequent language with score 0. Repeated rows each
    get their own result; other columns are ignored.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)  # some hundred KB, whatever the input
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                sent.value.predict(None if (raw := text.as_py()) is None else raw.decode("utf-8", "replace"))
                for text in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return rows.mapInArrow(work, f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame, **settings) -> DataFrame:
    """Fit on the documents that are not held out, then predict all: ``doc_id``, ``held_out``,
    ``lang_pred``, ``score``."""
    found = predict(docs, fit(docs, **settings))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def understood(docs: DataFrame, least: float = 0.05, **settings) -> DataFrame:
    """The rows of ``docs`` whose language could be told: letters there, and at least ``least`` of their
    trigrams known. All columns stay.

    If nothing could be learned (no row with a label, or all of them held out), every text with letters
    stays. A text in a script that no label covers goes, like any text of which next to nothing is known.
    """
    ship(docs.sparkSession)
    model = fit(docs, **settings)
    learned = bool(model.languages)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def verdict(texts: pd.Series) -> pd.Series:
        if not learned:
            return pd.Series([trigrams(text or "")[1] > 0 for text in texts], dtype=bool)
        found = (sent.value.predict(text) for text in texts)
        return pd.Series([lang != UNDETERMINED and score >= least for lang, score in found], dtype=bool)

    return docs.where(F.pandas_udf(verdict, "boolean")(F.col("text")))
