"""Repeated strings by sampled run and window hashing.

This stands in place of the dealt prefix doubling: no pair (rank at i, rank at
i + k) is formed and nothing is sorted at growing offsets. Doubling over every
byte was measured as Spark jobs (rank pairs range-sorted at offsets 1, 2, 4, 8,
16, 32, 36, positions of unique rank left out) over 1.4 MB of documents: it
shuffled 200 times its input, wrote tables of 120 times its input and took
85,000 CPU seconds a GB, where the limits are 4 times and 960; after the last
round 535,241 of 2,472,458 positions were left. This way takes 2.4 times and 631.

A byte is removed if a string of ``length`` bytes that covers it also starts
earlier (in a document before, or earlier in its own). Ranking every byte's
suffix would shuffle each position once per round, many times the input. Here
only sampled positions are ranked: of every window of ``length`` bytes the
position with the smallest hash of its first ``GRAM`` bytes (the leftmost of
equals). Equal windows pick equal positions at equal offsets, so nothing is
lost, and about one position in 35 remains. Consecutive windows that pick the
same position form its run.

Round 1 ranks sampled positions by their first GRAM bytes; unique ones are
done. Round 2 ranks (by hash) pairs of that rank and the bytes of the position's whole
run (``length`` to ``length + run`` bytes, past the threshold): a pair that came
earlier covers its whole run. Round 3 ranks single windows, only of positions
that are first of their pair in a class whose first rank is shared; a window
that came earlier covers its own bytes. In each round a chunk of documents
sends each rank once, so no rank has more rows than there are chunks; the
exchange tells every chunk which of its ranks came earlier.

Documents are put in order once (ascending id, null ids first, rows with one id
by text) and written as chunks bucketed by chunk number; the rounds read them
in place. Between chunks the ranks of round 2 are 128-bit hashes and those of
round 3 64-bit hashes (any two of 10**8 windows collide with probability below
0.001); within a chunk they are 64-bit hashes. Null texts are empty;
texts shorter than ``length`` lose nothing; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.llm.common import keep, keep_bucketed, partitions, prepare
from laborlens.llm.rolling import U, mix, prefix_of, span

LENGTH = 100
GRAM = 32
BLOCK = 1 << 19
INDEX = U((1 << 20) - 1)
NULL_KEY = -(1 << 63)
CHUNK = "chunk int, seq int, d long, t binary, runs binary"


def sample(raw: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(start of each run of windows, the position it picked) of one text's bytes."""
    windows = len(raw) - length + 1
    if windows <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    width = length - gram + 1
    starts, picks = [], []
    for at in range(0, windows, BLOCK):
        part = raw[at:min(at + BLOCK, windows) + length - 1]
        h = prefix_of(part)
        here = np.arange(len(part) - gram + 1)
        least = (span(h, here, here + gram) & ~INDEX) | here.astype(np.uint64)
        n, done = len(part) - length + 1, 1
        while done * 2 <= width:
            least = np.minimum(least[:-done], least[done:])
            done *= 2
        least = np.minimum(least[:n], least[width - done:width - done + n])
        run = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        starts.append(run + at)
        picks.append((least[run] & INDEX).astype(np.int64) + at)
    return np.concatenate(starts), np.concatenate(picks)


def _pack_runs(starts: np.ndarray, picks: np.ndarray) -> bytes:
    """One byte of distance to the run before and one of offset to the picked position."""
    return np.concatenate([np.diff(starts, prepend=0).astype(np.uint8), (picks - starts).astype(np.uint8)]).tobytes()


def _sampler(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
                runs = [_pack_runs(*sample(np.frombuffer(t, np.uint8), length)) for t in texts]
                n = len(texts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n, chunk), pa.int32()), pa.array(np.arange(seq, seq + n), pa.int32()),
                    part.column(0), pa.array(texts, pa.binary()), pa.array(runs, pa.binary())],
                    names=["chunk", "seq", "d", "t", "runs"])
                seq += n
    return run


class Block:
    """Some documents of a chunk laid end to end, with their runs."""

    def __init__(self, docs: list[dict], length: int):
        self.docs, self.length = docs, length
        texts = [d["t"] for d in docs]
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        self.size = np.array([len(t) for t in texts])
        self.base = np.cumsum(self.size) - self.size
        packed = [np.frombuffer(d["runs"], np.uint8) for d in docs]
        n = [len(p) // 2 for p in packed]
        self.start = np.concatenate([np.cumsum(p[:m], dtype=np.int64) + b
                                     for p, m, b in zip(packed, n, self.base.tolist(), strict=True)])
        self.pick = self.start + np.concatenate([p[m:] for p, m in zip(packed, n, strict=True)])
        # the last window of each run, and the end of its bytes
        last = np.repeat(self.base + self.size - length, n)
        ends = np.zeros(len(self.start), bool)
        ends[np.cumsum(n)[np.array(n) > 0] - 1] = True
        self.last = np.where(ends, last, np.r_[self.start[1:] - 1, 0][:len(self.start)])
        self.stop = self.last + length

    @cached_property
    def h(self) -> np.ndarray:
        return prefix_of(self.raw)

    def gram(self) -> np.ndarray:
        return span(self.h, self.pick, self.pick + GRAM)

    def pair(self) -> np.ndarray:
        """Ranks of the runs: their bytes and the place of the picked position in them."""
        return span(self.h, self.start, self.stop) ^ self._salt()

    def _salt(self) -> np.ndarray:
        place, size = self.pick - self.start + 1, self.stop - self.start
        return mix(place.astype(np.uint64) * U(0x9E3779B97F4A7C15) + size.astype(np.uint64))

    def pair2(self) -> np.ndarray:
        """A second, independent hash of the same."""
        h2 = np.concatenate([[U(0)], np.cumsum(_BYTE2[self.raw] * _powers2(len(self.raw)))])
        return mix((h2[self.stop] - h2[self.start]) * _powers2(len(h2), True)[self.start]) ^ self._salt()

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ranks of all windows of the runs at ``which``."""
        n = self.last[which] - self.start[which] + 1
        at = np.repeat(self.start[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return at, span(self.h, at, at + self.length)


_SECOND: dict[bool, np.ndarray] = {}
BASE2 = 0xD6E8FEB86659FD93
_BYTE2 = np.random.default_rng(20240202).integers(0, 1 << 64, 256, dtype=np.uint64)


def _powers2(n: int, inverse: bool = False) -> np.ndarray:
    have = _SECOND.get(inverse)
    if have is None or len(have) < n:
        x = np.full(1 << max(16, (n - 1).bit_length()), U(pow(BASE2, -1, 1 << 64) if inverse else BASE2))
        x[0] = 1
        have = _SECOND[inverse] = np.multiply.accumulate(x)
    return have[:n]


def _blocks(docs: pa.Table, length: int) -> Iterator[Block]:
    """The chunk's documents in order, about ``BLOCK`` bytes at a time."""
    docs = docs.take(pc.sort_indices(docs["seq"]))
    held, size = [], 0
    for at in range(0, docs.num_rows, 256):
        for row in docs.slice(at, 256).select(["d", "t", "runs"]).to_pylist():
            held.append(row)
            size += len(row["t"])
            if size >= BLOCK:
                yield Block(held, length)
                held, size = [], 0
    if held:
        yield Block(held, length)


def _first_here(keys: np.ndarray) -> np.ndarray:
    """Whether each key is the first of its value, in the given order."""
    out = np.zeros(len(keys), bool)
    out[np.unique(keys, return_index=True)[1]] = True
    return out


def _members(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array ``known``."""
    if not len(known) or not len(values):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def _column(t: pa.Table, name: str) -> np.ndarray:
    return t[name].to_numpy().astype(np.int64).view(np.uint64) if t.num_rows else np.empty(0, np.uint64)


def _grams(length: int):
    def run(docs: pa.Table) -> pa.Table:
        """Round 1, in a chunk: each distinct gram once, and whether it occurs more than once here."""
        keys = np.concatenate([np.empty(0, np.uint64), *[b.gram() for b in _blocks(docs, length)]])
        key, count = np.unique(keys, return_counts=True)
        return pa.table([_longs(key), pa.array(np.full(len(key), docs["chunk"][0].as_py()), pa.int32()),
                         pa.array(count > 1)], names=["key", "chunk", "more"])
    return run


def _gather(batches: Iterator[pa.RecordBatch]) -> pa.Table | None:
    batches = [b for b in batches if b.num_rows]
    return pa.Table.from_batches(batches) if batches else None


def _classes(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the columns (the last one is the chunk), and where in it each new class starts."""
    order = np.lexsort(columns[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns[:-1]:
        c = c[order]
        new[1:] |= c[1:] != c[:-1]
    return order, new


def _rank_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams found more than once: to every chunk that has one, and whether an earlier chunk has it too."""
    t = _gather(batches)
    if t is None:
        return
    key, chunk, more = t["key"].to_numpy(), t["chunk"].to_numpy(), t["more"].to_numpy(zero_copy_only=False)
    order, new = _classes(key, chunk)
    size = np.diff(np.append(np.flatnonzero(new), len(new)))
    shared_ = np.repeat(size, size) > 1
    keep_ = shared_ | more[order]
    yield pa.RecordBatch.from_arrays([pa.array(chunk[order][keep_]), pa.array(key[order][keep_]), pa.array(~new[keep_])],
                                     names=["chunk", "key", "earlier"])


def _pairs(length: int):
    def run(docs: pa.Table, grams: pa.Table) -> pa.Table:
        """Round 2, in a chunk: each distinct pair rank of shared grams once, with its gram and
        whether that gram occurs earlier."""
        known = _column(grams, "key")
        before = grams["earlier"].to_numpy(zero_copy_only=False) if grams.num_rows else np.empty(0, bool)
        order = np.argsort(known)
        known, before = known[order], before[order]
        gram, pair = [np.empty(0, np.uint64)], [np.empty((0, 2), np.uint64)]
        for b in _blocks(docs, length):
            g = b.gram()
            at = _members(g, known)
            if at.any():
                gram.append(g[at])
                pair.append(np.stack([b.pair()[at], b.pair2()[at]], axis=1))
        gram, pair = np.concatenate(gram), np.concatenate(pair)
        again = ~_first_here(gram)
        if len(known):
            again |= before[np.searchsorted(known, gram)]
        first = _first_here(pair[:, 0])
        chunk = docs["chunk"][0].as_py() if docs.num_rows else 0
        return pa.table([_longs(pair[first, 0]), _longs(pair[first, 1]), _longs(gram[first]),
                         pa.array(np.full(first.sum(), chunk), pa.int32()), pa.array(again[first])],
                        names=["key", "key2", "gram", "chunk", "again"])
    return run


def _rank_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per (pair, chunk): whether an earlier chunk has the pair; firsts keep their gram."""
    t = _gather(batches)
    if t is None:
        return
    key, key2, chunk = t["key"].to_numpy(), t["key2"].to_numpy(), t["chunk"].to_numpy()
    order, new = _classes(key, key2, chunk)
    yield pa.RecordBatch.from_arrays([
        pa.array(chunk[order]), pa.array(key[order]), pa.array(t["gram"].to_numpy()[order]),
        pa.array(~new), pa.array(t["again"].to_numpy(zero_copy_only=False)[order])],
        names=["chunk", "key", "gram", "earlier", "again"])


#: kinds of messages to a chunk
PAIR_EARLIER, GRAM_OPEN, WINDOW_EARLIER = 0, 1, 2


def _message(t: pa.Table, kind: int) -> np.ndarray:
    return np.sort(_column(t.filter(pc.equal(t["kind"], kind)), "key")) if t.num_rows else np.empty(0, np.uint64)


def _verdicts(docs: pa.Table, messages: pa.Table, length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each block of the chunk, in order: which runs are covered whole, and which stay open."""
    earlier, open_ = _message(messages, PAIR_EARLIER), _message(messages, GRAM_OPEN)
    pairs, undecided = [], []
    for b in _blocks(docs, length):
        pairs.append(b.pair())
        undecided.append(_members(b.gram(), open_))
    cut = np.cumsum([len(p) for p in pairs])[:-1]
    pair = np.concatenate([np.empty(0, np.uint64), *pairs])
    covered = ~_first_here(pair) | _members(pair, earlier)
    stays = ~covered & np.concatenate([np.empty(0, bool), *undecided])
    return list(zip(np.split(covered, cut), np.split(stays, cut), strict=True)) if pairs else []


def _windows(docs: pa.Table, verdicts: list, length: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Starts and ranks of the open runs' windows, for each block in order."""
    none = np.empty(0, np.int64), np.empty(0, np.uint64)
    if not any(stays.any() for _, stays in verdicts):
        return [none] * len(verdicts)
    return [b.windows(np.flatnonzero(stays)) if stays.any() else none
            for b, (_, stays) in zip(_blocks(docs, length), verdicts, strict=True)]


def _open_windows(length: int):
    def run(docs: pa.Table, messages: pa.Table) -> pa.Table:
        """Round 3, in a chunk: each distinct window of the open runs once."""
        found = _windows(docs, _verdicts(docs, messages, length), length)
        key = np.unique(np.concatenate([np.empty(0, np.uint64), *[k for _, k in found]]))
        chunk = docs["chunk"][0].as_py() if docs.num_rows else 0
        return pa.table([_longs(key), pa.array(np.full(len(key), chunk), pa.int32())], names=["key", "chunk"])
    return run


def _rank_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that an earlier chunk has, to the chunks after it."""
    t = _gather(batches)
    if t is None:
        return
    key, chunk = t["key"].to_numpy(), t["chunk"].to_numpy()
    order, new = _classes(key, chunk)
    yield pa.RecordBatch.from_arrays([pa.array(chunk[order][~new]), pa.array(key[order][~new])], names=["chunk", "key"])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _remove(length: int):
    def run(docs: pa.Table, messages: pa.Table) -> pa.Table:
        """What is left of each document of a chunk."""
        verdicts, earlier = _verdicts(docs, messages, length), _message(messages, WINDOW_EARLIER)
        found = _windows(docs, verdicts, length)
        key = np.concatenate([np.empty(0, np.uint64), *[k for _, k in found]])
        again = ~_first_here(key) | _members(key, earlier)
        hits = np.split(again, np.cumsum([len(k) for _, k in found])[:-1]) if found else []
        ids, sizes, removed, spans, kept = [], [], [], [], []
        for b, (covered, _), (at, _), hit in zip(_blocks(docs, length), verdicts, found, hits, strict=True):
            size = len(b.raw) + 1
            change = (np.bincount(b.start[covered], minlength=size) - np.bincount(b.stop[covered], minlength=size)
                      + np.bincount(at[hit], minlength=size) - np.bincount(at[hit] + length, minlength=size))
            gone = np.cumsum(change[:-1]) > 0
            before = np.r_[0, np.cumsum(gone)]
            edge = gone & ~np.r_[False, gone[:-1]]
            edge[b.base[b.size > 0]] = gone[b.base[b.size > 0]]  # runs end at the document's bounds
            edges = np.r_[0, np.cumsum(edge)]
            left = b.raw[~gone].tobytes()
            end = b.base + b.size
            n_gone = before[end] - before[b.base]
            ids += [d["d"] for d in b.docs]
            sizes.append(b.size)
            removed.append(n_gone)
            spans.append(edges[end] - edges[b.base])
            cut = np.cumsum(b.size - n_gone).tolist()
            kept += [left[x:y] for x, y in zip([0, *cut[:-1]], cut, strict=True)]
        join = lambda x: np.concatenate([np.empty(0, np.int64), *x])
        return pa.table([pa.array(ids, pa.int64()), *(pa.array(join(x), pa.int64()) for x in (sizes, removed, spans)),
                         pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def in_order(docs: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """(d, t) in ``parts`` partitions of ascending id ranges, each sorted by id and text."""
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("t"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_KEY)).alias("k"))
    cuts = rows.agg(F.percentile_approx("k", [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()[0] or []
    cut_array = F.array(*[F.lit(c).cast("long") for c in sorted(set(cuts))]) if cuts else F.array().cast("array<long>")
    return (rows.repartitionById(parts, F.size(F.filter(cut_array, lambda c: c < F.col("k"))))
            .sortWithinPartitions("k", "t").select("d", "t"))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes left) of every row."""
    spark = docs.sparkSession
    prepare(spark)
    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    n = partitions(spark)
    table = keep_bucketed(in_order(docs, id_col, text_col, n).mapInArrow(_sampler(length), CHUNK), "suffix_chunks", n, "chunk")

    def to_chunks(rows: DataFrame):
        return table.groupBy("chunk").cogroup(rows.repartition(n, "chunk").groupBy("chunk"))

    grams = (table.groupBy("chunk").applyInArrow(_grams(length), "key long, chunk int, more boolean")
             .repartition(n, "key").mapInArrow(_rank_grams, "chunk int, key long, earlier boolean"))
    pairs = keep(to_chunks(grams).applyInArrow(_pairs(length), "key long, key2 long, gram long, chunk int, again boolean")
                 .repartition(n, "key")
                 .mapInArrow(_rank_pairs, "chunk int, key long, gram long, earlier boolean, again boolean"), "suffix-pairs")
    # grams of which some first pair is not the gram's first occurrence: all their first pairs stay open
    firsts = pairs.where("not earlier").groupBy("gram", "chunk").agg(F.max("again").alias("again"))
    open_grams = firsts.groupBy("gram").agg(F.max("again").alias("any")).where("any").select("gram")
    messages = keep(pairs.where("earlier").select("chunk", "key", F.lit(PAIR_EARLIER).alias("kind"))
                    .unionByName(firsts.join(open_grams, "gram").select("chunk", F.col("gram").alias("key"),
                                                                        F.lit(GRAM_OPEN).alias("kind"))), "suffix-messages")
    windows = keep(to_chunks(messages).applyInArrow(_open_windows(length), "key long, chunk int")
                   .repartition(n, "key").mapInArrow(_rank_windows, "chunk int, key long"), "suffix-windows")
    return to_chunks(messages.unionByName(windows.withColumn("kind", F.lit(WINDOW_EARLIER)))).applyInArrow(
        _remove(length), RESULT)
