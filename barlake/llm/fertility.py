"""Quality by what public vocabularies make of a text: characters per token, byte fallback, token entropy.

A text in a language that a vocabulary knows falls into long tokens, hardly ever into bytes, and uses many
different ones. Lists of symbols, capitals, mangled encodings and repeated phrases do not. What is usual
depends on the language, so the bands that a text has to stay in are taken from the corpus: the quartiles
of each measure over all documents of a language (of a script, where the language is not known) and a class
of length, and a number of quartile distances around them.
"""

from __future__ import annotations

import base64
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barlake.llm.common import Scratch, free_name, ship

#: Code points of a text that are encoded at once; longer texts are cut behind a space or line end.
SLICE = 1 << 20
#: Width of the bins in which a measure's quartiles are found.
BIN = 0.002
#: The least distance of quartiles that counts, by measure.
LEAST = {"chars": 0.05, "bytes": 0.004, "entropy": 0.1}
#: Documents that a band needs; a language and length with fewer rejects none by its band.
NEEDED = 50

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


# Vocabularies

class Vocabulary:
    """Encodes texts and knows which of its ids are bytes rather than characters."""

    def __init__(self, name: str, data: bytes, pattern: str | None):
        if name.endswith(".model"):
            import sentencepiece

            library = sentencepiece.SentencePieceProcessor(model_proto=data)
            self.encode = library.encode
            self.is_byte = np.array([library.is_byte(i) for i in range(library.vocab_size())])
        elif name.endswith(".tiktoken"):
            import tiktoken

            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}
            self.encode = tiktoken.Encoding(
                name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
            ).encode_ordinary
            self.is_byte = np.zeros(max(ranks.values()) + 1, bool)
            for token, rank in ranks.items():
                self.is_byte[rank] = not _whole(token)
        else:
            from tokenizers import Tokenizer

            library = Tokenizer.from_str(data.decode())
            library.encode_special_tokens = True
            self.encode = lambda text: library.encode(text, add_special_tokens=False).ids
            known = json.loads(data)["model"]["vocab"]
            self.is_byte = np.zeros(max(known.values()) + 1, bool)
            for token, number in known.items():
                self.is_byte[number] = bool(re.fullmatch(r"<0x[0-9A-F]{2}>", token))

    def measure(self, text: str) -> tuple[int, int, float]:
        """Tokens, byte tokens among them, and entropy of the tokens in bits."""
        parts = [text] if len(text) <= SLICE else slices(text)
        ids = np.concatenate([np.array(self.encode(part), np.int32) for part in parts])
        n = len(ids)
        if not n:
            return 0, 0, 0.0
        ids.sort()
        first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        counts = np.diff(np.r_[first, n])
        # The sum of -p log2 p over the tokens, where p is a count over n.
        entropy = np.log2(n) - float((counts * np.log2(counts)).sum()) / n
        return n, int(counts[self.is_byte[ids[first]]].sum()), abs(float(entropy))


def _whole(token: bytes) -> bool:
    try:
        token.decode()
        return True
    except UnicodeDecodeError:
        return False


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """``text`` in parts of at most ``size`` code points, cut behind a space or line end where there is one."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(c, at, at + size) for c in " \n")
        stop = cut + 1 if cut >= at else at + size
        yield text[at:stop]
        at = stop
    yield text[at:]


@lru_cache(maxsize=8)
def _loaded(name: str, data: bytes, pattern: str | None) -> Vocabulary:
    return Vocabulary(name, data, pattern)


# What is counted in a text

@lru_cache(maxsize=1 << 16)
def _script_of(letter: str) -> str | None:
    return unicodedata.name(letter, "UNKNOWN").split(" ")[0].title() if letter.isalpha() else None


def script(text: str) -> str:
    """Script of most letters, by the first word of their Unicode names; None if there is no letter."""
    if text.isascii():
        return "Latin" if re.search("[A-Za-z]", text) else "None"
    found: Counter = Counter()
    chars = set(text)
    # Few different letters are counted one by one; of many, as in Chinese, all at once.
    for char, n in Counter(text).items() if len(chars) > 1000 else ((c, text.count(c)) for c in chars):
        if name := _script_of(char):
            found[name] += n
    return min(found, key=lambda s: (-found[s], s)) if found else "None"


def basics(text: str) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, words in repeated windows of five words."""
    words = text.encode("utf-8", "replace").split()  # bytes: at the six ASCII spaces
    chars = len(text) - sum(map(text.count, _SPACES))
    symbols = sum(map(text.count, _SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: Sequence[bytes], size: int = 5) -> int:
    """Words that lie in a window of ``size`` words which occurs twice or more.

    Equal windows have equal hashes, so hashes tell most texts to have none. Windows with the same hash are
    compared word by word; should different ones meet, all windows are told apart by their numbers.
    """
    n = len(words) - size + 1
    if n < 2:
        return 0
    hashed = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    mixed = np.zeros(n, np.uint64)
    for step in range(size):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashed[step:step + n]
    place = np.sort(mixed)
    if not (place[1:] == place[:-1]).any():
        return 0
    order = np.argsort(mixed)
    same = np.flatnonzero(mixed[order[1:]] == mixed[order[:-1]])
    numbers: dict[bytes, int] = {}
    single = np.array([numbers.setdefault(w, len(numbers)) for w in words])
    a, b = order[same], order[same + 1]
    again = np.zeros(n, bool)
    if all((single[a + step] == single[b + step]).all() for step in range(size)):
        again[a] = again[b] = True
    else:
        again = _numbered_windows(single, size)
    marks = np.zeros(len(words) + 1, np.int64)
    marks[:n] += again
    marks[size:size + n] -= again
    return int((np.cumsum(marks) > 0).sum())


def _numbered_windows(single: np.ndarray, size: int) -> np.ndarray:
    """Which windows occur twice or more: pairs of numbers are numbered, then pairs of these and a number."""
    window = single
    for step in range(1, size):
        following = single[step:]
        window = np.unique(window[:len(following)] * (len(single) + 1) + following, return_inverse=True)[1]
    return np.bincount(window)[window] > 1


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, vocabularies: Sequence[str], pattern: str | None = None, batch: int = 64) -> DataFrame:
    """``docs(doc_id, text, lang)`` with ``script``, the counts of ``BASE``, and for each vocabulary its ``tokens_i``,
    ``chars_i`` (code points per token), ``bytes_i`` (share of byte tokens) and ``entropy_i`` (bits).

    ``vocabularies`` are paths of public vocabularies (.model, .tiktoken or .json); a .tiktoken file also needs
    the ``pattern`` that cuts texts. The driver reads the files (some MB at most) and sends them to the
    workers. Whole texts, in slices; null texts and texts without a token have null measures.
    """
    spark = docs.sparkSession
    ship(spark)
    files = []
    for path in vocabularies:
        with open(path, "rb") as file:
            files.append((path.rsplit("/", 1)[-1], file.read(), pattern))
    sent = spark.sparkContext.broadcast(files)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [f"{m}_{i}" for i in range(len(files)) for m in ("tokens", "chars", "bytes", "entropy")]
    schema = f"doc_id {kind}, lang string, script string, " + ", ".join(f"{n} bigint" for n in BASE)
    schema += "".join(f", {n} {'bigint' if n.startswith('tokens') else 'double'}" for n in names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = [_loaded(*file) for file in sent.value]
        for whole in batches:
            for start in range(0, whole.num_rows, batch):
                part, rows = whole.slice(start, batch), []
                for value in part.column(2):
                    text = value.as_py() or ""
                    row: list = [script(text), *basics(text)]
                    for vocabulary in known:
                        n, fallen, entropy = vocabulary.measure(text)
                        row += [n, len(text) / n, fallen / n, entropy] if n else [0, None, None, None]
                    rows.append(row)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], header)

    types = [pa.string(), *[pa.int64()] * len(BASE), *[pa.int64(), *[pa.float64()] * 3] * len(files)]
    header = ["doc_id", "lang", "script", *BASE, *names]
    return docs.select("doc_id", "lang", F.col("text").cast("string")).mapInArrow(work, schema)


# Bands

def _group(measured: DataFrame) -> tuple[Column, Column]:
    """Language, or script where it is null, and class of length: each class four times as long as the last."""
    tongue = F.coalesce("lang", F.concat(F.lit("script:"), F.col("script")))
    return tongue.alias("tongue"), F.floor(F.log2(F.greatest("tokens_0", F.lit(1))) / 2).cast("int").alias("length_class")


def fit_bands(measured: DataFrame, count: int, width: float = 5.0, needed: int = NEEDED) -> DataFrame:
    """``(tongue, length_class, i, measure, low, high)`` from all rows of ``measured`` with ``count`` vocabularies.

    ``low`` and ``high`` lie ``width`` quartile distances outside the quartiles. Quartiles come from counts of
    bins, which add up in any order, so reruns agree; what is shuffled is one row per task and bin, whatever
    share of the rows a language has. Groups of fewer than ``needed`` documents have no band.
    """
    values = F.array(*(
        F.struct(F.lit(i).alias("i"), F.lit(m).alias("measure"), F.col(f"{m}_{i}").alias("value"))
        for i in range(count) for m in LEAST
    ))
    rows = measured.where("tokens_0 > 0").select(*_group(measured), F.inline(values)).where("value IS NOT NULL")
    key = ["tongue", "length_class", "i", "measure"]
    bins = rows.groupBy(*key, F.floor(F.col("value") / BIN).alias("bin")).agg(F.count("*").alias("n"))
    along = W.partitionBy(*key).orderBy("bin")
    bins = bins.withColumns({"upto": F.sum("n").over(along), "of": F.sum("n").over(W.partitionBy(*key))})
    middle = (F.col("bin") + 0.5) * BIN

    def quartile(part: float) -> Column:
        return F.min(F.when(F.col("upto") >= F.col("of") * part, middle))

    found = bins.groupBy(*key).agg(F.max("of").alias("of"), quartile(0.25).alias("q1"), quartile(0.75).alias("q3"))
    least = F.create_map(*(F.lit(x) for pair in LEAST.items() for x in pair))[F.col("measure")]
    reach = F.greatest(F.col("q3") - F.col("q1"), least) * width
    return found.where(F.col("of") >= needed).select(
        *key, (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high")
    )


def judge(
    docs: DataFrame, vocabularies: Sequence[str], pattern: str | None = None, width: float = 5.0, needed: int = NEEDED,
) -> DataFrame:
    """One row per row of ``docs(doc_id, text, lang)``: ``doc_id``, the counts of ``BASE``, ``base_failed`` (fewer than ten
    words, or over a fifth of them in repeated windows), ``kept``, ``rejected_by`` (measures outside their band, by
    vocabulary) and the measures of ``measure``.

    ``kept`` is false if ``base_failed``, or if some vocabulary has too few or too many characters per token, too
    large a share of byte tokens, or too small or too large an entropy for the language and length (``fit_bands``). A
    small share of bytes is no fault. A null text has no words and so fails; a null language is judged among
    texts of its script that have none either; repeated rows are judged, and count for the bands, each; an empty
    table gives no rows; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "fertility")
    measured = scratch.save(measure(docs, vocabularies, pattern), "measured")
    bands = fit_bands(measured, len(vocabularies), width, needed)
    named = F.concat_ws("_", "measure", F.col("i").cast("string"))
    band = F.map_from_entries(F.collect_list(F.struct(named, F.struct("low", "high"))))
    bands = scratch.save(bands.groupBy("tongue", "length_class").agg(band.alias("bands")), "bands")

    tongue, length = _group(measured)
    rows = measured.withColumns({"tongue": tongue, "length_class": length})
    rows = rows.join(bands, ["tongue", "length_class"], "left")
    outside = []
    for i in range(len(vocabularies)):
        for name in (f"{m}_{i}" for m in LEAST):
            limits, value = F.col("bands")[name], F.col(name)
            over, under = value > limits["high"], value < limits["low"]
            outside.append(F.when(over if name.startswith("bytes") else over | under, F.lit(name)))
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    rejected = F.concat_ws(",", *outside)
    measures = [c for c in measured.columns if c not in ("doc_id", "lang", *BASE)]
    return rows.select(
        "doc_id", *BASE, failed.alias("base_failed"), (~failed & (rejected == "")).alias("kept"),
        rejected.alias("rejected_by"), *measures,
    )


def kept_documents(docs: DataFrame, vocabularies: Sequence[str], pattern: str | None = None, **settings) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns. Rows of one id with different texts or
    languages are judged each by itself; for that, rows are told apart by a number of their own."""
    number = free_name(docs.columns, "_number")
    stored = Scratch(docs.sparkSession, "fertility-docs").save(docs.withColumn(number, F.monotonically_increasing_id()), "docs")
    asked = stored.select(F.col(number).alias("doc_id"), "text", "lang")
    kept = judge(asked, vocabularies, pattern, **settings).where("kept").select(F.col("doc_id").alias(number))
    return stored.join(kept, number, "left_semi").select(docs.columns)
