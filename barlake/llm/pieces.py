"""SentencePiece encoding and decoding with merge-type (BPE) vocabularies.

A text is cut into symbols; an agenda holds every adjacent pair whose concatenation is a piece, best
score first, leftmost among equals. Merging the best pair puts the new neighbours on the agenda, until
none is left. Symbols outside the vocabulary become bytes or the unknown piece.

Most texts repeat their words. No piece has a space mark behind another character, and some characters
are in no longer piece, so no merge crosses the places where a run of space marks begins or such a
character stands: texts are cut there, and within words between characters that are side by side in no
piece. What is left is merged once per worker and kept for a while.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlake.llm.common import ship

# Fixed values of the format: the space mark, piece types, what unknown pieces decode to.
SPACE_MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


class Vocabulary:
    """Pieces of a model file's bytes. Models with other algorithms or own normalisation are refused."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        rules = proto.normalizer_spec
        kinds = {p.type for p in proto.pieces}
        if proto.trainer_spec.model_type != BPE or USER_DEFINED in kinds:
            raise ValueError("only merge-type vocabularies without user-defined pieces")
        if rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.escape_whitespaces:
            raise ValueError("only models with identity normalisation that keep spaces")
        if proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only models with space marks ahead of words")
        self.model, self.prefix = model, SPACE_MARK if rules.add_dummy_prefix else ""
        self.texts = [p.piece for p in proto.pieces]
        self.types = [p.type for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type in (NORMAL, UNUSED)}
        self.unused = {i for i, p in enumerate(proto.pieces) if p.type == UNUSED}
        self.unknown = next(i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN)
        self.byte_ids = {int(p.piece[1:-1], 16): i for i, p in enumerate(proto.pieces) if p.type == BYTE}
        self.unknown_text = proto.trainer_spec.unk_surface or " ⁇ "
        if not proto.trainer_spec.byte_fallback:
            self.byte_ids = {}

        longer = [p for p in self.ids if len(p) > 1]
        self._number_pairs(longer, {p.piece: p.score for p in proto.pieces})
        # Pairs of characters side by side in some piece, by hash: a pair missing here is in no piece.
        self.adjacent = np.zeros(1 << 20, bool)
        for piece in longer:
            codes = np.frombuffer(piece.encode("utf-32-le"), "<u4")
            self.adjacent[self._pair_hash(codes)] = True
        self.merging = set("".join(longer)) - {SPACE_MARK}
        inside = any(SPACE_MARK in p[1:] and p.strip(SPACE_MARK) for p in longer)
        chars = "".join(re.escape(c) for c in sorted(self.merging))
        words = f"{SPACE_MARK}*[{chars}]+|" if chars else ""
        self.chunks = re.compile("(?s:.+)" if inside else f"{words}{SPACE_MARK}+|(?s:.)")

    def _number_pairs(self, longer: list[str], scores: dict[str, float]) -> None:
        """Number the symbols that can merge, and list for every pair of them the order of its merge
        (best score first, the same for equal scores) and the number of the result.

        Symbols are numbered by their piece; characters that are only parts of pieces come after them.
        """
        self.symbols = dict(self.ids)
        for piece in longer:
            for char in piece:
                self.symbols.setdefault(char, len(self.texts) + len(self.symbols))
        turn = {score: i for i, score in enumerate(sorted({scores[p] for p in longer}, reverse=True))}
        self.pairs: dict[int, tuple[int, int]] = {}
        for piece in longer:
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    self.pairs[left << 20 | right] = (turn[scores[piece]], self.ids[piece])

    @staticmethod
    def _pair_hash(codes: np.ndarray) -> np.ndarray:
        return (codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77)) >> np.uint32(12)

    def parts(self, chunks: list[str]) -> tuple[list[str], np.ndarray]:
        """The chunks cut between characters that stand side by side in no piece, since no merge crosses
        there; and for each chunk the number of parts up to its end. All chunks are cut in one go."""
        joined = "".join(chunks)
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        cut = np.append(~self.adjacent[self._pair_hash(codes)], True)[: len(codes)]
        ends = np.cumsum([len(c) for c in chunks], dtype=np.int64)
        cut[ends - 1] = True
        bounds = np.flatnonzero(cut) + 1
        stops = bounds.tolist()
        parts = [joined[a:b] for a, b in zip([0, *stops[:-1]], stops)]
        return parts, np.searchsorted(bounds, ends) + 1

    def merge(self, chunk: str) -> list[int]:
        """Ids of a chunk in which spaces are space marks.

        An entry of the agenda is one number: the order of the pair's merge, then its place, then its
        length, so the smallest entry is the best pair, leftmost among equals. A pair one of whose symbols
        has been merged since has another length and is passed over.
        """
        n, pairs, unused = len(chunk), self.pairs, self.unused
        symbols = [self.symbols.get(c, -1) for c in chunk]
        sizes, after, before = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
        after[-1] = -1
        shift = n.bit_length()
        twice, mask = 2 * shift, (1 << shift) - 1
        made_of: dict[int, tuple[int, int]] = {}
        agenda = []
        for place in range(n - 1):
            pair = pairs.get(symbols[place] << 20 | symbols[place + 1])
            if pair:
                agenda.append(pair[0] << twice | place << shift | 2)
                if pair[1] in unused:
                    made_of[pair[1]] = symbols[place], symbols[place + 1]
        heapq.heapify(agenda)
        pop, push = heapq.heappop, heapq.heappush
        while agenda:
            entry = pop(agenda)
            left = entry >> shift & mask
            right = after[left]
            if right < 0 or not sizes[left] or sizes[left] + sizes[right] != entry & mask:
                continue
            merged = pairs[symbols[left] << 20 | symbols[right]][1]
            symbols[left] = merged
            sizes[left] += sizes[right]
            sizes[right] = 0
            following = after[left] = after[right]
            if following >= 0:
                before[following] = left
                pair = pairs.get(merged << 20 | symbols[following])
                if pair:
                    push(agenda, pair[0] << twice | left << shift | sizes[left] + sizes[following])
                    if pair[1] in unused:
                        made_of[pair[1]] = merged, symbols[following]
            ahead = before[left]
            if ahead >= 0:
                pair = pairs.get(symbols[ahead] << 20 | merged)
                if pair:
                    push(agenda, pair[0] << twice | ahead << shift | sizes[ahead] + sizes[left])
                    if pair[1] in unused:
                        made_of[pair[1]] = symbols[ahead], merged

        out: list[int] = []
        place, known = 0, len(self.texts)
        while place >= 0:
            symbol = symbols[place]
            if symbol in made_of:
                self._parts(symbol, made_of, out)
            elif 0 <= symbol < known:
                out.append(symbol)
            elif self.byte_ids:
                out.extend(self.byte_ids[b] for b in chunk[place].encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)  # a run of unknown symbols is one piece
            place = after[place]
        return out

    def _parts(self, symbol: int, made_of: dict[int, tuple[int, int]], out: list[int]) -> None:
        """An unused piece gives way to what it was merged from."""
        if symbol in made_of:
            for part in made_of[symbol]:
                self._parts(part, made_of, out)
        else:
            out.append(symbol)


class Memory(dict):
    """A dictionary of bounded size: when ``limit`` entries are new, those not asked for lately go."""

    def __init__(self, limit: int):
        self.limit, self.old = limit, {}

    def find(self, keys: set[str]) -> set[str]:
        """Bring entries back that are about to go; returns the keys that are unknown."""
        missing = keys.difference(self)
        back = missing.intersection(self.old)
        for key in back:
            self[key] = self.old[key]
        return missing - back

    def trim(self) -> None:
        if len(self) > self.limit:
            self.old = dict(self)
            self.clear()


class Codec:
    """Encoder and decoder for Arrow batches, with a bounded memory of chunks and their parts."""

    def __init__(self, model: bytes, remembered: int = 150_000, longest: int = 64):
        self.vocabulary = Vocabulary(model)
        self.longest = longest
        self.known, self.known_parts = Memory(remembered), Memory(remembered)
        self._library = None
        pieces = []
        for text, kind in zip(self.vocabulary.texts, self.vocabulary.types):
            if kind == BYTE:
                pieces.append(bytes([int(text[1:-1], 16)]))
            elif kind == CONTROL:
                pieces.append(b"")
            elif kind == UNKNOWN:
                pieces.append(self.vocabulary.unknown_text.encode())
            else:
                pieces.append(text.replace(SPACE_MARK, " ").encode())
        self.pieces = pa.array(pieces, pa.binary())
        self.is_byte = np.array([k == BYTE for k in self.vocabulary.types])
        marked = [t.startswith(SPACE_MARK) and k in (NORMAL, UNUSED) for t, k in zip(self.vocabulary.texts, self.vocabulary.types)]
        self.is_marked = np.array(marked)
        self.is_control = np.array([k == CONTROL for k in self.vocabulary.types])

    # Encoding

    def encode(self, texts: Iterable[str], check: str = "chunks") -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers.

        ``check``: ``chunks`` compares whatever is newly merged with the library, ``texts`` every whole
        text, ``none`` nothing. A difference raises.
        """
        texts = list(texts)
        vocabulary, known = self.vocabulary, self.known
        cut = [
            vocabulary.chunks.findall(vocabulary.prefix + text.replace(" ", SPACE_MARK)) if text else []
            for text in texts
        ]
        new = list(known.find(set().union(*cut)))
        if new:
            known.update(zip(new, self._merged(new, check == "chunks")))
        out = [b"".join([known[c] for c in chunks]) for chunks in cut]
        if not vocabulary.byte_ids:
            out = [self._joined_unknown(ids) for ids in out]
        for chunk in [c for c in new if len(c) > self.longest]:
            del known[chunk]
        known.trim()
        if check == "texts":
            self._compare_texts(texts, out)
        return out

    def _merged(self, chunks: list[str], check: bool) -> list[bytes]:
        memory = self.known_parts
        parts, ends = self.vocabulary.parts(chunks)
        fresh = {part: self.vocabulary.merge(part) for part in memory.find(set(parts))}
        if check:
            self._compare_parts(fresh)
        memory.update((part, array("i", ids).tobytes()) for part, ids in fresh.items())
        out, start = [], 0
        for end in ends.tolist():
            one = end == start + 1
            out.append(memory[parts[start]] if one else b"".join([memory[p] for p in parts[start:end]]))
            start = end
        for part in [p for p in fresh if len(p) > self.longest]:
            del memory[part]
        memory.trim()
        return out

    def _joined_unknown(self, row: bytes) -> bytes:
        ids = np.frombuffer(row, "<i4")
        again = np.r_[False, (ids[1:] == ids[:-1]) & (ids[1:] == self.vocabulary.unknown)][: len(ids)]
        return ids[~again].tobytes()

    @property
    def library(self):
        if self._library is None:
            import sentencepiece

            self._library = sentencepiece.SentencePieceProcessor(model_proto=self.vocabulary.model)
        return self._library

    def _compare_parts(self, fresh: dict[str, list[int]]) -> None:
        """Each part behind a character that never merges, through the library in one call."""
        lead = next((c for c in "\n\t\0" if c not in self.vocabulary.merging), None)
        if lead is None or not self.vocabulary.byte_ids:
            raise ValueError("this vocabulary can be compared by whole texts only")
        ahead = len(self.library.encode(lead))
        theirs = self.library.encode([lead + p.replace(SPACE_MARK, " ") for p in fresh], num_threads=1)
        for (part, ids), other in zip(fresh.items(), theirs):
            if other[ahead:] != ids:
                raise ValueError(f"the library encodes {part!r} differently")

    def _compare_texts(self, texts: list[str], ours: list[bytes]) -> None:
        for text, mine, theirs in zip(texts, ours, self.library.encode(texts, num_threads=1)):
            if np.array(theirs, "<i4").tobytes() != mine:
                raise ValueError(f"the library encodes {text[:80]!r} differently")

    # Decoding

    def decode(self, rows: list[bytes]) -> list[str]:
        """Texts of rows of 32-bit ids. All rows are looked up in one call: the data buffer of the
        result is the texts, one behind the other."""
        ids = np.frombuffer(b"".join(rows), "<i4")
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.pieces)):
            raise ValueError("id outside the vocabulary")
        if not len(ids):
            return [""] * len(rows)
        found = pc.take(self.pieces, pa.array(ids))
        offsets = np.frombuffer(found.buffers()[1], "<i4", len(ids) + 1, found.offset * 4)
        data = memoryview(found.buffers()[2] or b"")
        out, at = [], 0
        for row in rows:
            n = len(row) // 4
            text = bytes(data[offsets[at]:offsets[at + n]])
            out.append(self._text(ids[at:at + n], text))
            at += n
        return out

    def _text(self, ids: np.ndarray, raw: bytes) -> str:
        skip = 0
        if self.vocabulary.prefix and len(ids):
            spoken = np.flatnonzero(~self.is_control[ids[:64]])
            if not len(spoken):
                spoken = np.flatnonzero(~self.is_control[ids])
            skip = int(len(spoken) and self.is_marked[ids[spoken[0]]])
        try:
            return raw[skip:].decode()
        except UnicodeDecodeError:
            return _lossy(raw[skip:])


def _lossy(raw: bytes) -> str:
    """Each byte that is not part of a valid character becomes U+FFFD."""
    out, at = [], 0
    while at < len(raw):
        try:
            out.append(raw[at:].decode())
            break
        except UnicodeDecodeError as error:
            out.append(raw[at:at + error.start].decode())
            out.append("�")
            at += error.start + 1
    return "".join(out)


_codecs: dict[tuple, Codec] = {}


def codec(model: bytes, remembered: int = 150_000) -> Codec:
    """The worker's codec for a model; kept between tasks."""
    key = (len(model), hash(model), remembered)
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(model, remembered)
    return _codecs[key]


def round_trip(
    docs: DataFrame, model_path: str, check: str = "chunks", batch: int = 256, remembered: int = 150_000,
) -> DataFrame:
    """``docs(doc_id, text)`` with ``ids`` (array of int) and ``decoded`` (the text these ids decode to).

    No begin or end ids. A null text is empty: no ids, an empty text. Bytes that are not UTF-8 are read
    as U+FFFD. Other columns are ignored, repeated rows stay. The model file (some hundred KB) is read
    by the driver and sent to the workers; texts stay within their partitions, ``batch`` at a time. A worker
    remembers ``remembered`` chunks twice over, some 100 MB for each 250,000; the result is the same.
    """
    spark = docs.sparkSession
    ship(spark)
    with open(model_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model.value, remembered)
        for whole in batches:
            for start in range(0, whole.num_rows, batch):
                part = whole.slice(start, batch)
                texts = [t.decode("utf-8", "replace") for t in part.column(1).to_pylist()]
                ids = own.encode(texts, check)
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype="int32")
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                lists = pa.ListArray.from_arrays(pa.array(ends), values)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), lists, pa.array(own.decode(ids), pa.string())], ["doc_id", "ids", "decoded"]
                )

    return rows.mapInArrow(work, f"doc_id {kind}, ids array<int>, decoded string")
