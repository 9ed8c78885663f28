"""Licence scans: passages of a text against licence templates, by Dice coefficient of word bigrams.

Text is normalised: lower case, words of letters and digits only. Units of comparison are the whole
text, its paragraphs and its lines, and windows of words wherever they begin and end. A unit with a bigrams
and a template with b reach a coefficient of at least t only if t / (2 - t) <= a / b <= (2 - t) / t; sorted
template sizes leave a slice to compare. For the same reason, a unit that matches holds t / (2 - t) * b of the
template's bigrams within (2 - t) / t * b positions: a text without such a cluster has no match of any kind, and
windows are tried only where there is one.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import ship
from barlake.llm.license_texts import TEMPLATES

_WORD = re.compile(r"[^\W_]+")
_LINE = re.compile(r"[^\r\n]+")
#: Lines without a letter or digit part paragraphs: blank ones, and comment marks alone.
_PARAGRAPH = re.compile(r"\n(?:[^\w\n]|_)*\n")
_UNITS = ("text", "paragraph", "line", "window")
#: Bigrams of the smallest template that windows are compared with, and of the smallest that a window may be
#: shorter than: a piece of a short one can end before the word that tells the licence.
LEAST_WINDOW, LONG = 3, 16
#: Windows times hits that are compared at once.
CELLS = 1 << 20

FOUND = "license string, dice double, unit string, first_char bigint, last_char bigint, passage string"


def bigrams(words: Sequence[str]) -> Counter:
    return Counter(zip(words, words[1:]))


class Scanner:
    """Templates by size. Texts with fewer than two words have no bigram and match nothing."""

    def __init__(self, templates: Mapping[str, Sequence[str]], least: float):
        rows = []
        for name, texts in templates.items():
            for text in texts:
                grams = bigrams(_WORD.findall(text.lower()))
                if grams:
                    rows.append((grams.total(), name, grams))
        rows.sort(key=lambda r: (r[0], r[1]))
        self.sizes = [r[0] for r in rows]
        self.names = [r[1] for r in rows]
        self.grams = [r[2] for r in rows]
        self.known: dict[tuple[str, str], list[int]] = {}  # the templates of each bigram
        for i, grams in enumerate(self.grams):
            for gram in grams:
                self.known.setdefault(gram, []).append(i)
        self.least = least
        self.bound = least / (2 - least)

    def compare(self, words: Sequence[str]) -> tuple[float, str] | None:
        """Best coefficient and its template, ties to the smaller name; None below the threshold."""
        size = len(words) - 1
        low = bisect_left(self.sizes, size * self.bound - 1e-9)
        high = bisect_right(self.sizes, size / self.bound + 1e-9)
        if size < 1 or low >= high:
            return None
        own = Counter(gram for gram in zip(words, words[1:]) if gram in self.known)
        most, best = own.total(), None
        for i in range(low, high):
            if 2 * most < self.least * (size + self.sizes[i]):
                break  # sizes grow
            shared = sum(min(n, own[gram]) for gram, n in self.grams[i].items() if gram in own)
            dice = 2 * shared / (size + self.sizes[i])
            if dice >= self.least and (best is None or (-dice, self.names[i]) < (-best[0], best[1])):
                best = (dice, self.names[i])
        return best

    def clusters(self, words: Sequence[str]) -> Iterator[tuple[int, list[tuple[int, tuple[str, str]]]]]:
        """``(template, hits)``: runs of positions and bigrams among which a match has to lie."""
        hits: dict[int, list[tuple[int, tuple[str, str]]]] = {}
        for at, gram in enumerate(zip(words, words[1:])):
            for i in self.known.get(gram, ()):
                hits.setdefault(i, []).append((at, gram))
        for i, found in hits.items():
            need, widest = self.sizes[i] * self.bound - 1e-9, self.sizes[i] / self.bound + 1e-9
            if len(found) < need:
                continue
            grams, inside, shared, left = self.grams[i], Counter(), 0, 0
            start, end = 0, -1  # of the run that is being gathered, as places in found
            for right, (at, gram) in enumerate(found):
                inside[gram] += 1
                shared += inside[gram] <= grams[gram]
                while at - found[left][0] + 1 > widest:
                    old = found[left][1]
                    shared -= inside[old] <= grams[old]
                    inside[old] -= 1
                    left += 1
                if shared >= need:
                    if left > end and end >= 0:
                        yield i, found[start:end + 1]
                    start, end = (left if left > end else start), right
            if end >= 0:
                yield i, found[start:end + 1]

    def windows(self, template: int, hits: Sequence[tuple[int, tuple[str, str]]], bigrams: int) -> tuple[np.ndarray, ...]:
        """``(dice, first, last)``: for each hit the best window of the text's ``bigrams`` that begins with it and
        matches, as places of its first and last bigram.

        A hit counts in a window unless the template's number of its bigram is used up, that is, if as many
        hits earlier the same bigram stands before the window's start.
        """
        size, grams = self.sizes[template], self.grams[template]
        at = np.array([place for place, _ in hits])
        used_up, seen = np.empty(len(hits), np.int64), {}
        for j, (_, gram) in enumerate(hits):
            own = seen.setdefault(gram, [])
            used_up[j] = own[-grams[gram]] if len(own) >= grams[gram] else -1
            own.append(j)
        ends = np.searchsorted(at, at + int(size / self.bound + 1e-9) - 1, "right")
        most = int((ends - np.arange(len(hits))).max())
        found = []
        for start in range(0, len(hits), max(1, CELLS // most)):
            k = np.arange(start, min(len(hits), start + max(1, CELLS // most)))
            j = k[:, None] + np.arange(most)
            inside = j < ends[k, None]
            j = np.minimum(j, len(hits) - 1)
            shared = np.cumsum(inside & (used_up[j] < k[:, None]), axis=1)
            wide = at[j] - at[k, None] + 1
            if size < LONG:
                wide = np.maximum(wide, size)
            dice = np.where(inside, 2 * shared / (wide + size), -1.0)
            best = np.argmax(dice, axis=1)
            rows = np.flatnonzero(dice[np.arange(len(k)), best] >= self.least)
            best, wide = best[rows], wide[rows, best[rows]]
            first = at[k[rows]]
            last = np.maximum(at[j[rows, best]], np.minimum(first + wide, bigrams) - 1)
            first = np.minimum(first, last - wide + 1)
            found.append((dice[rows, best], first, last))
        dice, first, last = (np.concatenate(parts) for parts in zip(*found))
        return dice[first >= 0], first[first >= 0], last[first >= 0]

    def apart(self, template: int, hits: Sequence[tuple[int, tuple[str, str]]], places: Sequence[tuple[int, int]]) -> Iterator[tuple[float, int, int]]:
        """``(dice, first_char, last_char)`` of windows that do not overlap, the best first, the largest of equals."""
        dice, first, last = self.windows(template, hits, len(places) - 1)
        if not len(dice):
            return
        spans = np.array([(places[i][0], places[j + 1][1]) for i, j in zip(first.tolist(), last.tolist())])
        base = int(first.min())
        taken = bytearray(int(last.max()) + 2 - base)  # words
        for i in np.lexsort((spans[:, 0], spans[:, 0] - spans[:, 1], -dice)).tolist():
            a, b = int(first[i]) - base, int(last[i]) + 2 - base
            if taken.find(1, a, b) < 0:
                taken[a:b] = b"\1" * (b - a)
                yield float(dice[i]), int(spans[i, 0]), int(spans[i, 1])

    def scan(self, text: str) -> Iterator[tuple[str, float, str, int, int]]:
        """``(license, dice, unit, first, last)`` of the units that match, in their order. Units lie
        within each other; of those that match and do, the best one stays, the largest of equals. Windows of
        one template are set apart among themselves first, so time grows with the text also if a notice
        stands in it thousands of times."""
        lowered = text.lower()
        if len(lowered) != len(text):  # a letter whose lower case is longer
            lowered = "".join(c.lower()[0] for c in text)
        words = _WORD.findall(lowered)
        clusters = list(self.clusters(words))
        if not clusters:
            return
        matches = []
        if any(self.sizes[i] >= LEAST_WINDOW for i, _ in clusters):
            places = [m.span() for m in _WORD.finditer(lowered)]
            for i, hits in clusters:
                if self.sizes[i] >= LEAST_WINDOW:
                    matches += ((self.names[i], dice, "window", *span) for dice, *span in self.apart(i, hits, places))
        spans = [("text", 0, len(text))]
        start = 0
        for gap in _PARAGRAPH.finditer(text):
            spans.append(("paragraph", start, gap.start()))
            start = gap.end()
        spans.append(("paragraph", start, len(text)))
        spans += [("line", m.start(), m.end()) for m in _LINE.finditer(text)]
        longest = self.sizes[-1] / self.bound + 1 if self.sizes else 0
        for unit, first, last in spans:
            words = _WORD.findall(lowered[first:last]) if last > first else []
            if not 2 <= len(words) <= longest + 1:
                continue
            found = self.compare(words)
            body = text[first:last]
            lead = len(body) - len(body.lstrip())
            if found:
                matches.append((found[1], found[0], unit, first + lead, first + len(body.rstrip())))
        matches.sort(key=lambda m: (-m[1], m[3] - m[4], _UNITS.index(m[2]), m[3], m[0]))
        kept: list[tuple[int, int, str, float, str]] = []  # disjoint, by their first character
        for name, dice, unit, first, last in matches:
            at = bisect_left(kept, (first,))
            if (at == 0 or kept[at - 1][1] <= first) and (at == len(kept) or last <= kept[at][0]):
                kept.insert(at, (first, last, name, dice, unit))
        for first, last, name, dice, unit in kept:
            yield name, dice, unit, first, last


def scan_licenses(
    docs: DataFrame, templates: Mapping[str, Sequence[str]] = TEMPLATES, least: float = 0.8,
) -> DataFrame:
    """One row per passage of ``docs(doc_id, text)`` whose best template reaches ``least``. Passages of a
    text do not overlap.

    Columns: ``doc_id``, ``license``, ``dice``, ``unit`` (text, paragraph, line or window), the half-open
    character span, and the passage. Null and empty texts have none; repeated rows each have their own;
    other columns are ignored. Templates are a policy of bounded size and travel with the code. There
    is no shuffle.
    """
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).where("text IS NOT NULL")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least)
        for batch in batches:
            ids, found = [], []
            for i, raw in enumerate(batch.column(1)):
                text = raw.as_py().decode("utf-8", "replace")
                for license, dice, unit, first, last in scanner.scan(text):
                    ids.append(i)
                    found.append((license, dice, unit, first, last, text[first:last]))
            columns = list(zip(*found)) if found else [()] * 6
            types = (pa.string(), pa.float64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ids, pa.int64()))] + [pa.array(c, t) for c, t in zip(columns, types)],
                ["doc_id", "license", "dice", "unit", "first_char", "last_char", "passage"],
            )

    return rows.mapInArrow(work, f"doc_id {kind}, {FOUND}")
