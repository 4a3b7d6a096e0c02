"""BPE encoding and decoding through a distinct-word table.

1. Split: tasks cut whole texts into units (white space and the word after
   it), which the byte-level pre-tokenization never joins, and number the
   distinct units of a chunk of documents. A chunk's documents stay in place as
   lists of unit numbers (a table bucketed by chunk); only the distinct units
   of each chunk travel.
2. Encode: units meet by their hash and each distinct one is encoded once by
   the tokenizers library.
3. Join back: the ids go to their chunks, where a document's ids are its
   units' ids, position by position.
4. Decode: ids are joined with the id-to-piece table (one row per id of the
   vocabulary); a text is the bytes of its pieces.

Null texts are empty; empty texts have no ids and decode to the empty text; ids
and rows may be null or repeated (a row is never joined by its id); an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborlens.llm.common import keep_bucketed, partitions, prepare

#: bytes of text whose units are numbered together
CHUNK_BYTES = 32 << 20
DOCS_PER_BLOCK = 512
WORDS_PER_CALL = 2048

_UNIT = re.compile(rb"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")
#: white space beyond ASCII: a unit that ends in it goes on with the next one
_WIDE = r"[\x85\xa0  -     　]"
_WIDE_SPACE = re.compile(_WIDE)
_WIDE_END = re.compile(_WIDE + r"\Z")


def units(text: str) -> list[bytes]:
    """Pieces of the text that the tokenizer treats independently; joined they are the text."""
    found = _UNIT.findall(text.encode("utf-8"))
    if text.isascii() or not _WIDE_SPACE.search(text):
        return found
    out: list[bytes] = []
    grow = False
    for u in found:
        if grow:
            out[-1] += u
        else:
            out.append(u)
        grow = bool(_WIDE_END.search(u.decode("utf-8")))
    return out


class Numbering(dict):
    """Numbers keys in the order of their first lookup."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes (the high bytes of small numbers pack to nothing), compressed."""
    import zstandard
    head = np.array([len(arrays), *[x for a in arrays for x in (a.itemsize, len(a))]], dtype="<i8").tobytes()
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(b"".join([head, *planes]))


def _unpack(blob: bytes) -> list[np.ndarray]:
    import zstandard
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    head = np.frombuffer(raw, "<i8", 1 + 2 * n)[1:].reshape(n, 2).tolist()
    at, out = 8 * (1 + 2 * n), []
    for width, length in head:
        planes = np.frombuffer(raw, np.uint8, width * length, at).reshape(width, length)
        out.append(np.ascontiguousarray(planes.T).view(f"<u{width}").ravel() if length else np.empty(0, f"<u{width}"))
        at += width * length
    return out


def _bytes(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(parts), dtype=np.uint8)


def _lens(parts) -> np.ndarray:
    return np.fromiter(map(len, parts), dtype="<u4", count=len(parts))


CHUNKS = "chunk long, part int, blob binary"
DOCUMENTS = -1  # part number of a chunk's document blocks


def _splitter(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, seq = TaskContext.get().partitionId() << 24, 0
        number, held = Numbering(), 0

        def rows(part: list[int], blobs: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([base + seq] * len(part), pa.int64()), pa.array(part, pa.int32()),
                                               pa.array(blobs, pa.binary())], names=["chunk", "part", "blob"])

        def table() -> pa.RecordBatch:
            words = list(number)
            where = np.fromiter((zlib.crc32(w) for w in words), dtype=np.int64, count=len(words)) % parts
            order = np.argsort(where, kind="stable")
            cuts = np.searchsorted(where[order], np.arange(parts + 1))
            part, blobs = [], []
            for p in range(parts):
                at = order[cuts[p]:cuts[p + 1]]
                if len(at):
                    own = [words[i] for i in at.tolist()]
                    part.append(p)
                    blobs.append(_pack(at.astype("<u4"), _lens(own), _bytes(own)))
            return rows(part, blobs)

        for batch in batches:
            for at in range(0, batch.num_rows, DOCS_PER_BLOCK):
                step = batch.slice(at, DOCS_PER_BLOCK)
                texts = [t or "" for t in step.column(1).to_pylist()]
                found = [np.array(list(map(number.__getitem__, units(t))), dtype="<u4") for t in texts]
                ids = step.column(0)
                yield rows([DOCUMENTS], [_pack(
                    ids.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").view("<u8"),
                    ids.is_null().to_numpy(zero_copy_only=False).astype(np.uint8),
                    _lens(found), np.concatenate([*found, np.empty(0, "<u4")]))])
                held += sum(map(len, texts))
                if held >= CHUNK_BYTES:
                    yield table()
                    number, held, seq = Numbering(), 0, seq + 1
        if number:
            yield table()
    return run


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@functools.lru_cache(maxsize=2)
def pieces(path: str) -> pa.Array:
    """The id-to-piece table of a byte-level vocabulary: bytes of every id, dense in the id."""
    # the byte-level alphabet: printable Latin-1 stands for itself, the rest follows from 256 up
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in plain}
    of |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    ids = dict(spec["model"]["vocab"]) | {t["content"]: t["id"] for t in spec["added_tokens"]}
    out = [b""] * (1 + max(ids.values()))
    for token, i in ids.items():
        out[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode("utf-8")
    return pa.array(out, pa.binary())


def _encoder(path: str):
    def run(group: pa.Table) -> pa.Table:
        """All chunks' units of one part: each distinct one is encoded once."""
        t = tokenizer(path)
        number, uses = Numbering(), []
        for blob in group["blob"].to_pylist():
            at, lens, raw = _unpack(blob)
            raw, end = raw.tobytes(), np.cumsum(lens.astype(np.int64))
            words = [raw[b - n:b] for b, n in zip(end.tolist(), lens.tolist(), strict=True)]
            uses.append((at, np.array(list(map(number.__getitem__, words)), dtype=np.int64)))
        distinct = list(number)
        lens, ids = [], []
        for i in range(0, len(distinct), WORDS_PER_CALL):
            found = t.encode_batch_fast([w.decode("utf-8") for w in distinct[i:i + WORDS_PER_CALL]], add_special_tokens=False)
            own = [e.ids for e in found]
            lens.append(_lens(own))
            ids.append(np.array([x for o in own for x in o], dtype="<u4"))
        lens = np.concatenate(lens) if lens else np.empty(0, "<u4")
        ids = np.concatenate(ids) if ids else np.empty(0, "<u4")
        start = np.cumsum(lens.astype(np.int64)) - lens
        blobs = []
        for at, words in uses:
            n = lens[words].astype(np.int64)
            flat = np.repeat(start[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            blobs.append(_pack(at, lens[words], ids[flat]))
        return pa.table([group["chunk"], group["part"], pa.array(blobs, pa.binary())], names=["chunk", "part", "blob"])
    return run


def _slices(values: pa.Array, ids: np.ndarray, cut: np.ndarray) -> list[bytes]:
    """Concatenated ``values`` of the ids of each word; ``cut`` are the words' bounds among ``ids``."""
    taken = values.take(pa.array(ids))
    offsets = np.frombuffer(taken.buffers()[1], dtype=np.int32, count=len(ids) + 1, offset=4 * taken.offset)
    raw = taken.buffers()[2].to_pybytes() if len(ids) and taken.buffers()[2] is not None else b""
    at = offsets[cut].tolist()
    return [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _joiner(path: str):
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.string())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        """One chunk: documents as unit numbers, and the ids of its units."""
        table = [_unpack(b) for b in right["blob"].to_pylist()]
        at = np.concatenate([x[0] for x in table] or [np.empty(0, "<u4")]).astype(np.int64)
        lens = np.concatenate([x[1] for x in table] or [np.empty(0, "<u4")]).astype(np.int64)
        ids = np.concatenate([x[2] for x in table] or [np.empty(0, "<u4")])
        cut = np.concatenate([[0], np.cumsum(lens)])
        piece = pieces(path)
        decimal = pa.array([f"{i},".encode() for i in range(len(piece))], pa.binary())
        # per unit, in the order of its number: count of ids, their decimals, their pieces
        order = np.argsort(at)
        count = lens[order]
        order = order.tolist()
        shown, spelled = _slices(decimal, ids, cut), _slices(piece, ids, cut)
        shown, spelled = [shown[i] for i in order], [spelled[i] for i in order]
        out = []
        for blob in left["blob"].to_pylist():
            doc, null, n_units, flat = _unpack(blob)
            ends = np.cumsum(n_units.astype(np.int64))
            total = np.concatenate([[0], np.cumsum(count[flat])])
            n_tokens = total[ends] - total[ends - n_units]
            flat, texts, lists = flat.tolist(), [], []
            for b, n in zip(ends.tolist(), n_units.tolist(), strict=True):
                own = flat[b - n:b]
                lists.append(b"".join(map(shown.__getitem__, own))[:-1].decode("ascii"))
                texts.append(b"".join(map(spelled.__getitem__, own)).decode("utf-8", "replace"))
            out.append(pa.RecordBatch.from_arrays([
                pa.array(doc.view("<i8"), pa.int64(), mask=null.astype(bool)), pa.array(n_tokens, pa.int64()),
                pa.array(lists, pa.string()), pa.array(texts, pa.string())], schema=schema))
        return pa.Table.from_batches(out, schema=schema)
    return run


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids (decimal, joined by commas) and decoded of every row."""
    spark = docs.sparkSession
    prepare(spark)
    n = partitions(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("t"))
    table = keep_bucketed(rows.mapInArrow(_splitter(n), CHUNKS), "bpe_chunks", n, "chunk")
    encoded = table.where(F.col("part") != DOCUMENTS).groupBy("part").applyInArrow(_encoder(path), CHUNKS)
    back = encoded.select("chunk", "blob").repartition(n, "chunk")
    return (table.where(F.col("part") == DOCUMENTS).select("chunk", "blob").groupBy("chunk")
            .cogroup(back.groupBy("chunk"))
            .applyInArrow(_joiner(path), "doc_id long, n_tokens long, ids string, decoded string"))
