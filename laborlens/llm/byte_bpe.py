"""Byte-level BPE with vectorised pre-tokenisation.

Boundaries are found without regular expressions. Every code point gets a
class (letter, number, other, blank, further white space; apostrophes that
could begin a contraction have classes of their own). A class is a function
from scanner state to scanner state; functions compose associatively, so the
states before all characters of a block of documents come from one parallel
scan over the (finite) set of composed functions. A state and a class say
whether a token starts. The slices between starts go through pair merging,
each distinct slice once per cache lifetime; ids come back with the byte
offset of each, and decoding puts every id's bytes at its offset.

The rules are those of the usual byte-level pattern: contractions ('s 't 're
've 'm 'll 'd), then runs of letters, numbers or other characters with one
blank before them, then white space, whose last character is left to the next
token if more text follows.

Input: any DataFrame with a text column. Null and empty texts have no ids.
Rows are handled one by one, so repeated ids, null ids and repeated rows each
give a row of their own; other columns travel in the struct ``row``, whatever
their names; an empty table gives an empty result. A text of any length is
encoded whole (one text must fit in a task's memory).
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.llm.common import prepare

LETTER, NUMBER, OTHER, BLANK, WHITE, SHORT, LONG = range(7)
#: scanner states: at an edge, in a run of a class, one or two contraction letters to come
EDGE, IN_LETTER, IN_NUMBER, IN_OTHER, AFTER_BLANK, AFTER_WHITE, ONE_MORE, TWO_MORE = range(8)

# The code points with the Unicode property White_Space, and the
# letters and numbers of Unicode 16 (used where Python's tables have them unassigned).
WHITE_SPACE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LETTERS_16 = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
              (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
              (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
              (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
              (0x1E5F0, 0x1E5F0)]
NUMBERS_16 = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
              (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
SHORT_CONTRACTIONS = "stmd"
LONG_CONTRACTIONS = ("re", "ve", "ll")

BLOCK = 64
#: bytes of text that are scanned at once (a longer text is scanned by itself)
STEP_BYTES = 1 << 20
#: the cache of slices is emptied when it holds so many ids
CACHE_IDS = 1 << 21
#: slices of fewer than so many times 4 bytes are merged together
TOGETHER = 16
NEVER = np.iinfo(np.int64).max


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    extra = {c: k for k, ranges in ((LETTER, LETTERS_16), (NUMBER, NUMBERS_16)) for a, b in ranges for c in range(a, b + 1)}
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))
        if kind[0] == "L":
            table[c] = LETTER
        elif kind[0] == "N":
            table[c] = NUMBER
        elif kind == "Cn" and c in extra:
            table[c] = extra[c]
    table[WHITE_SPACE] = WHITE
    table[0x20] = BLANK
    return table


def _next_state(state: int, cls: int) -> int:
    if cls == LETTER:
        return {TWO_MORE: ONE_MORE, ONE_MORE: EDGE}.get(state, IN_LETTER)
    if cls in (SHORT, LONG):
        return IN_OTHER if state in (AFTER_BLANK, IN_OTHER) else ONE_MORE if cls == SHORT else TWO_MORE
    return {NUMBER: IN_NUMBER, OTHER: IN_OTHER, BLANK: AFTER_BLANK, WHITE: AFTER_WHITE}[cls]


def _starts_token(state: int, cls: int) -> bool:
    if cls == LETTER:
        return state not in (IN_LETTER, AFTER_BLANK, ONE_MORE, TWO_MORE)
    if cls == NUMBER:
        return state not in (IN_NUMBER, AFTER_BLANK)
    if cls in (BLANK, WHITE):
        return state not in (AFTER_BLANK, AFTER_WHITE)
    return state not in (IN_OTHER, AFTER_BLANK)


class Scanner:
    """The transition functions, closed under composition, as tables of small numbers."""

    def __init__(self):
        step = [tuple(_next_state(s, c) for s in range(8)) for c in range(7)]
        fresh = [tuple(f[EDGE] for _ in range(8)) for f in step]  # a text's first character forgets what was before
        found, todo = {}, [*step, *fresh]
        while todo:
            f = todo.pop()
            if f not in found:
                found[f] = len(found)
                todo += [tuple(g[f[s]] for s in range(8)) for g in step]
                todo += [tuple(f[g[s]] for s in range(8)) for g in found]
        funcs = list(found)
        self.n = len(funcs)
        self.image = np.array(funcs, np.uint8).ravel()
        # compose[first * n + then]
        self.compose = np.array([[found[tuple(b[a[s]] for s in range(8))] for b in funcs] for a in funcs], np.int32).ravel()
        self.of_class = np.array([[found[f] for f in step], [found[f] for f in fresh]], np.int32)
        self.starts = np.array([[_starts_token(s, c) for c in range(7)] for s in range(8)]).ravel()

    def prefixes(self, funcs: np.ndarray) -> np.ndarray:
        """Inclusive scan: the composition of all functions up to each place."""
        n = len(funcs)
        if n <= BLOCK:
            out = funcs.copy()
            for i in range(1, n):
                out[i] = self.compose[out[i - 1] * self.n + out[i]]
            return out
        blocks = -(-n // BLOCK)
        lanes = np.zeros(blocks * BLOCK, np.int32)
        lanes[:n] = funcs
        lanes = np.ascontiguousarray(lanes.reshape(blocks, BLOCK).T)
        for i in range(1, BLOCK):
            lanes[i] = self.compose.take(lanes[i - 1] * self.n + lanes[i])
        before = self.prefixes(lanes[-1])[:-1]
        lanes[:, 1:] = self.compose.take(before * self.n + lanes[:, 1:])
        return lanes.T.reshape(-1)[:n]

    def token_starts(self, data: bytes, firsts: np.ndarray) -> np.ndarray:
        """Byte positions at which tokens start in texts laid end to end; ``firsts``:
        byte position of each text's first character (without empty texts)."""
        raw = np.frombuffer(data, np.uint8)
        if data.isascii():
            points, places = raw, None
        else:
            points = np.frombuffer(data.decode("utf-8").encode("utf-32-le"), "<u4")
            places = np.flatnonzero((raw & 0xC0) != 0x80)
            firsts = np.searchsorted(places, firsts)
        n = len(points)
        cls = class_table().take(points)
        first = np.zeros(n + 2, bool)
        first[firsts] = True
        first[n:] = True  # nothing is read beyond the end
        ahead = np.zeros(n + 2, np.uint32)
        ahead[:n] = points
        quote = np.flatnonzero(points == ord("'"))
        if len(quote):
            one, two = ahead[quote + 1], ahead[quote + 2]
            inside = ~first[quote + 1]
            short = inside & np.isin(one, [ord(c) for c in SHORT_CONTRACTIONS])
            long = np.zeros(len(quote), bool)
            for a, b in LONG_CONTRACTIONS:
                long |= (one == ord(a)) & (two == ord(b))
            cls[quote[short]] = SHORT
            cls[quote[long & inside & ~first[quote + 2]]] = LONG
        funcs = self.of_class[0].take(cls)
        funcs[firsts] = self.of_class[1].take(cls[firsts])
        state = np.empty(n, np.uint8)
        state[0] = EDGE
        state[1:] = self.image.take(self.prefixes(funcs)[:-1] * 8 + EDGE)
        start = self.starts.take(state.astype(np.intp) * 7 + cls)
        start[firsts] = True
        white = (cls == BLANK) | (cls == WHITE)
        # the last white space before more text is left to what follows
        start[:-1] |= white[:-1] & ~white[1:] & ~first[1:n]
        at = np.flatnonzero(start)
        return at if places is None else places[at]


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: neighbours whose joined bytes have the lowest rank are joined first, leftmost first."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    end = list(range(1, n + 1))  # where the part that starts at i ends; 0: joined to an earlier part
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        middle = end[i]
        if not middle or middle == n or end[middle] != stop:
            continue
        end[i], end[middle] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (j := before[i]) >= 0 and (r := ranks.get(piece[j:stop])) is not None:
            heapq.heappush(heap, (r, j, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Pairs:
    """Which two ids may be joined and into which, for whole arrays of pairs."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks, self.size = ranks, max(ranks.values()) + 1
        self.byte = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        found = sorted((ranks[p[:i]] * self.size + ranks[p[i:]], r) for p, r in ranks.items()
                       for i in range(1, len(p)) if p[:i] in ranks and p[i:] in ranks)
        self.keys, self.joined = (np.array([f[c] for f in found] + [NEVER], np.int64) for c in (0, 1))

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.searchsorted(self.keys[:-1], key)
        return np.where(self.keys.take(at) == key, self.joined.take(at), NEVER)

    def merge_all(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``merge_pairs`` of many slices of about one length, one join of each slice a round:
        all ids one after another, and how many each slice has."""
        rows, width = len(pieces), max(map(len, pieces))
        size = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(rows, width)
        ids, place = self.byte.take(raw), np.arange(width)
        after = np.where(place + 1 < size[:, None], place + 1, width)  # the next part; ``width``: none
        before = np.tile(place - 1, (rows, 1))
        rank = np.full((rows, width), NEVER)
        rank[:, :-1] = self.of(ids[:, :-1], ids[:, 1:])
        rank[after == width] = NEVER
        live = place < size[:, None]
        todo = np.arange(rows)
        while len(todo):
            at = rank[todo].argmin(axis=1)  # the lowest rank, leftmost first
            low = rank[todo, at]
            todo, at, low = todo[low < NEVER], at[low < NEVER], low[low < NEVER]
            gone = after[todo, at]
            then, ids[todo, at] = after[todo, gone], low
            after[todo, at], rank[todo, gone], live[todo, gone] = then, NEVER, False
            rank[todo, at] = NEVER
            for has, a, b in ((then < width, at, then), (before[todo, at] >= 0, before[todo, at], at)):
                r, a, b = todo[has], a[has], b[has]
                rank[r, a] = self.of(ids[r, a], ids[r, b])
            has = then < width
            before[todo[has], then[has]] = at[has]
        return ids[live], live.sum(axis=1)


class Slices(dict):
    """slice -> number of its entry; a new slice is merged once and its ids are appended to one flat array."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.pairs = ranks, Pairs(ranks)
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.flat, self.begin, self.count = array("i"), array("q"), array("q")

    def _add(self, pieces: list[bytes], ids: np.ndarray, counts: np.ndarray) -> None:
        self.update(zip(pieces, range(len(self.begin), len(self.begin) + len(pieces)), strict=True))
        self.begin.frombytes((len(self.flat) + np.cumsum(counts) - counts).astype(np.int64).tobytes())
        self.count.frombytes(counts.astype(np.int64).tobytes())
        self.flat.frombytes(ids.astype(np.int32).tobytes())

    def entries(self, pieces: list[bytes]) -> list[int]:
        if len(self.flat) > CACHE_IDS:
            self.clear()
        found = list(map(self.get, pieces))
        missing = [i for i, entry in enumerate(found) if entry is None]
        new = {pieces[i] for i in missing}
        whole = [p for p in new if p in self.ranks]
        self._add(whole, np.array([self.ranks[p] for p in whole], np.int64), np.ones(len(whole), np.int64))
        by_width: dict[int, list[bytes]] = {}
        for piece in new.difference(whole):
            by_width.setdefault(min((len(piece) + 3) // 4, TOGETHER), []).append(piece)
        for width, some in by_width.items():
            if width < TOGETHER:
                self._add(some, *self.pairs.merge_all(some))
            else:
                for piece in some:
                    ids = merge_pairs(piece, self.ranks)
                    self._add([piece], np.array(ids, np.int64), np.array([len(ids)]))
        for i in missing:
            found[i] = self[pieces[i]]
        return found

    def ids(self, entries: list[int]) -> np.ndarray:
        """Ids of all slices one after another."""
        at = np.array(entries, np.int64)
        places = spread(np.frombuffer(self.begin, np.int64).take(at), np.frombuffer(self.count, np.int64).take(at))
        return np.frombuffer(self.flat, np.int32).take(places)


def spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """begin[0], begin[0]+1, ... (count[0] of them), begin[1], ..."""
    total = int(count.sum())
    return np.arange(total) + np.repeat(begin - (np.cumsum(count) - count), count)


class Vocabulary:
    """Ranks of byte strings (lines of base64 and rank), with their bytes laid end to end for decoding."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        pieces = [b""] * (max(self.ranks.values()) + 1)
        for piece, rank in self.ranks.items():
            pieces[rank] = piece
        self.length = np.array([len(p) for p in pieces], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.decimal = [str(i) for i in range(len(pieces))]
        self.slices = Slices(self.ranks)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


class Encoded:
    """A block of texts: ``ids`` of all texts one after another, ``offsets`` (byte offset of
    each id in its text), ``counts`` (ids of each text)."""

    def __init__(self, texts: list[bytes], vocab: Vocabulary):
        data = b"".join(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        at = scanner().token_starts(data, (ends - sizes)[sizes > 0]) if data else np.empty(0, np.int64)
        cut = [*at.tolist(), len(data)]
        entries = vocab.slices.entries([data[a:b] for a, b in zip(cut, cut[1:], strict=False)])
        self.ids = vocab.slices.ids(entries) if entries else np.empty(0, np.int32)
        width = vocab.length.take(self.ids)
        offset = np.cumsum(width) - width
        self.counts = np.diff(np.searchsorted(offset, ends, side="left"), prepend=0)
        self.offsets = (offset - np.repeat(ends - sizes, self.counts)).astype(np.int32)

    def decimals(self, vocab: Vocabulary) -> list[str]:
        """The ids of each text in decimal, joined by one space."""
        text = list(map(vocab.decimal.__getitem__, self.ids.tolist()))
        cuts = np.cumsum(self.counts).tolist()
        return [" ".join(text[a:b]) for a, b in zip([0, *cuts], cuts, strict=False)]


def steps(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about STEP_BYTES each."""
    at = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > STEP_BYTES:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def _lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), values)


def _blocks(batches: Iterator[pa.RecordBatch], vocab: Vocabulary) -> Iterator[tuple[pa.Array, Encoded]]:
    for batch in batches:
        rows, column = batch.column("row"), batch.column("t")
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        for a, b in steps(sizes):
            texts = [(t or "").encode("utf-8") for t in column.slice(a, b - a).to_pylist()]
            yield rows.slice(a, b - a), Encoded(texts, vocab)


def _encoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, block in _blocks(batches, vocabulary(path)):
            yield pa.RecordBatch.from_arrays([rows, _lists(pa.array(block.ids, pa.int32()), block.counts),
                                              _lists(pa.array(block.offsets, pa.int32()), block.counts)],
                                             names=["row", "ids", "offsets"])
    return run


def _round_trip(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for rows, block in _blocks(batches, vocab):
            decoded = decode_ids(block.ids, block.offsets, block.counts, vocab)
            yield pa.RecordBatch.from_arrays([rows, pa.array(block.counts, pa.int64()), pa.array(block.decimals(vocab), pa.string()),
                                              pa.array(decoded, pa.binary())], names=["row", "n_tokens", "ids", "decoded"])
    return run


def decode_ids(ids: np.ndarray, offsets: np.ndarray, counts: np.ndarray, vocab: Vocabulary) -> list[bytes]:
    """Bytes of each list of ids, each id's bytes placed at its offset."""
    width = vocab.length.take(ids)
    last = np.cumsum(counts)
    whole = np.concatenate([[0], np.cumsum(width)])
    size = whole[last] - whole[last - counts]
    base = np.cumsum(size) - size
    out = np.empty(int(size.sum()), np.uint8)
    out[spread(offsets + np.repeat(base, counts), width)] = vocab.bytes.take(spread(vocab.begin.take(ids), width))
    data = out.tobytes()
    return [data[a:a + n] for a, n in zip(base.tolist(), size.tolist(), strict=True)]


def _decoder(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            sizes = (batch.column("ids").value_lengths().to_numpy(zero_copy_only=False) * 4).tolist()
            for a, b in steps(sizes):
                part = batch.slice(a, b - a)
                ids, offsets = part.column("ids"), part.column("offsets")
                counts = ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                texts = decode_ids(ids.flatten().to_numpy(), offsets.flatten().to_numpy(), counts, vocab)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())],
                                                 names=[*part.schema.names, "decoded"])
    return run


def encode(docs: DataFrame, vocab_file: str, text_col: str = "text", keep_cols: list[str] | None = None) -> DataFrame:
    """row (struct of ``keep_cols``, by default all columns but the text), ids (array<int>),
    offsets (array<int>: byte offset in the text's UTF-8 at which each id's bytes start)."""
    rows = _rows(docs, text_col, keep_cols)
    shape = rows.select("row", F.array(F.lit(0)).alias("ids"), F.array(F.lit(0)).alias("offsets")).schema
    return rows.mapInArrow(_encoder(vocab_file), shape)


def encode_decode(docs: DataFrame, vocab_file: str, text_col: str = "text", keep_cols: list[str] | None = None) -> DataFrame:
    """row, n_tokens, ids (decimal, joined by one space) and decoded (binary: the bytes of the ids) of every row."""
    rows = _rows(docs, text_col, keep_cols)
    shape = rows.select("row", F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("ids"), F.lit(b"").alias("decoded")).schema
    return rows.mapInArrow(_round_trip(vocab_file), shape)


def _rows(docs: DataFrame, text_col: str, keep_cols: list[str] | None) -> DataFrame:
    prepare(docs.sparkSession)
    kept = [c for c in docs.columns if c != text_col] if keep_cols is None else keep_cols
    row = F.struct(*[F.col(c) for c in kept]) if kept else F.struct(F.lit(0).alias("none"))
    return docs.select(row.alias("row"), F.col(text_col).cast("string").alias("t"))


def decode(encoded: DataFrame, vocab_file: str) -> DataFrame:
    """The rows of :func:`encode` with ``decoded`` (binary): the bytes of their ids."""
    prepare(encoded.sparkSession)
    rows = encoded.select("row", "ids", "offsets")
    shape = rows.select("*", F.lit(b"").alias("decoded")).schema
    return rows.mapInArrow(_decoder(vocab_file), shape)
