"""Whole-text encoding with a tokenizers file, one library call per new word.

The tokenizer's pre-tokenization never joins characters across ASCII white
space, so a text's ids are the concatenation of its words' ids. Words are
looked up in a bounded per-process table; only new ones reach the library.
Words made of Latin letters, digits and plain punctuation are cut into the
tokenizer's own pieces first (letters run, one digit, other run), which many
words share; every other word goes through the full tokenizer as it is.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np

#: entries kept per process in each of the two tables; more are encoded anew
TABLE_LIMIT = 400_000
PIECES_PER_CALL = 256

_SIMPLE = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ0-9!\"#$%&()*+,\-./:;=?@\[\]^_`{}~]+\Z")
_PIECE = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


class WordCodec:
    """Ids of whole texts for a lower-casing word-end BPE tokenizers file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.full = Tokenizer.from_file(path)
        self.full.no_truncation()
        self.full.no_padding()
        size = 1 + max([t["id"] for t in spec["added_tokens"]] + list(spec["model"]["vocab"].values()))
        self.dtype = np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")
        suffix = spec["model"].get("end_of_word_suffix")
        self.ends = np.zeros(size, dtype=bool)
        if suffix:
            for token, i in spec["model"]["vocab"].items():
                self.ends[i] = token.endswith(suffix)
        # the same model behind a white-space splitter: pieces in, ids out
        spec["normalizer"], spec["added_tokens"], spec["truncation"], spec["padding"] = None, [], None, None
        spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [
            {"type": "WhitespaceSplit"},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
        self.pieces_known = bool(suffix) and _is_word_piece_rule(path)
        self.bare = Tokenizer.from_str(json.dumps(spec))
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _encode_pieces(self, missing: list[str]) -> dict[str, bytes]:
        joined = [" ".join(missing[i:i + PIECES_PER_CALL]) for i in range(0, len(missing), PIECES_PER_CALL)]
        out: dict[str, bytes] = {}
        for k, e in enumerate(self.bare.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.asarray(e.ids, dtype=self.dtype)
            cuts = np.flatnonzero(self.ends[ids]) + 1
            group = missing[k * PIECES_PER_CALL:(k + 1) * PIECES_PER_CALL]
            if len(cuts) != len(group):
                raise ValueError("a piece did not end in a word-end token")
            w, raw, start = self.dtype.itemsize, ids.tobytes(), 0
            for piece, cut in zip(group, cuts.tolist(), strict=True):
                out[piece] = raw[start * w:cut * w]
                start = cut
        return out

    def _learn(self, new: list[bytes]) -> dict[bytes, bytes]:
        simple: list[tuple[bytes, list[str]]] = []
        other: list[bytes] = []
        for w in new:
            s = w.decode("utf-8")
            if self.pieces_known and _SIMPLE.match(s):
                simple.append((w, _PIECE.findall(s.lower())))
            else:
                other.append(w)
        table = self.pieces
        missing = list({p for _, ps in simple for p in ps if p not in table})
        extra: dict[str, bytes] = self._encode_pieces(missing) if missing else {}
        room = TABLE_LIMIT - len(table)
        for p in missing[:max(0, room)]:
            table[p] = extra[p]
        out = {w: b"".join([table[p] if p in table else extra[p] for p in ps]) for w, ps in simple}
        if other:
            found = self.full.encode_batch_fast([w.decode("utf-8") for w in other], add_special_tokens=False)
            for w, e in zip(other, found, strict=True):
                out[w] = np.asarray(e.ids, dtype=self.dtype).tobytes()
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian ids (``dtype``) of each text; null counts as empty."""
        split = [(t or "").encode("utf-8").split() for t in texts]
        known = self.words
        new = list({w for ws in split for w in ws if w not in known})
        if new:
            learned = self._learn(new)
            room = TABLE_LIMIT - len(known)
            if room >= len(new):
                known.update(learned)
            else:
                for w in new[:max(0, room)]:
                    known[w] = learned[w]
                return [b"".join([known[w] if w in known else learned[w] for w in ws]) for ws in split]
        return [b"".join([known[w] for w in ws]) for ws in split]


def _is_word_piece_rule(path: str) -> bool:
    """Whether the file lower-cases and cuts words as ``_PIECE`` does (else words go whole)."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    norm = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    rule = pre.get("pattern", {}).get("Regex", "")
    return norm == ["NFC", "Replace", "Lowercase"] and rule.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


@functools.lru_cache(maxsize=2)
def word_codec(path: str) -> WordCodec:
    """One codec per worker process and file."""
    return WordCodec(path)
