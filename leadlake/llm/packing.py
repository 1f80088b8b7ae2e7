"""Best-fit packing of tokenised documents into sequences.

Documents become ids (a public tokenizer's, then an end id) and, where longer
than a sequence, pieces: full ones, after a first one that may be shorter. Pieces
are dealt into groups of about ``group_rows`` and each group is packed by vector
best fit: items by falling length go to the open bin that fits them in every
capacity (tokens, documents, attention cost: the sum of squared lengths) and
whose weighted residual after placing is smallest (``rule="norm"``), or whose
weighted dot product of demand and residual is largest (``rule="dot"``); a new
bin opens only if none fits. Bins are never shared between groups, which costs a
fraction of a sequence per group.

Only lengths and checksums travel: ids are counted where the text is read.
Words are looked up in a bounded cache, so the tokenizer sees each new word once.

Defined results: a null or empty text is the end id alone; a text is tokenised
whole; an added token of the tokenizer that stands in a text is its one id; repeated rows are packed each; an empty table gives an empty result; with
the default document and attention capacities only tokens bind.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import map_texts, ship_code, written

#: The tokenizer whose ids count: its added tokens are found inside texts.
CONTRACT = public_tokenizers.path("byte_bpe_50k.json")
#: Its vocabulary as ranks: the same ids between added tokens (tests compare the two), found about four times as fast.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_ID = 2
_ODD_SPACE = re.compile(r" (?=\s|\Z)")


def added_tokens(tokenizer: str = CONTRACT) -> dict[str, int]:
    """The added tokens of a tokenizer's JSON and their ids; only such as match as they stand."""
    with open(tokenizer, encoding="utf-8") as f:
        whole = json.load(f)
    for t in whole["added_tokens"]:
        if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] and whole["normalizer"]:
            raise ValueError(f"added token {t['content']!r} is not matched literally")
    return {t["content"]: t["id"] for t in whole["added_tokens"]}


class Encoder:
    """Little-endian 32-bit ids of texts, by the ranks of a byte-level vocabulary.

    ``added`` tokens are found in the text first, the longest of those that start at a
    place; what stands between them is encoded on its own.
    The tokenizer never joins what a space followed by a non-space separates, so
    stretches between such spaces are encoded once and kept, up to a bound."""

    def __init__(self, ranks: bytes, cache_words: int = 300_000, added: dict[str, int] | None = None):
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        self.bpe = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                     mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs})
        self.most, self.cache = cache_words, {}
        self.added = {t: array("I", [i]).tobytes() for t, i in (added or {}).items()}
        longest_first = sorted(map(re.escape, self.added), key=len, reverse=True)
        self.split = re.compile(f"({'|'.join(longest_first)})").split if self.added else None

    def _encode(self, text: str) -> bytes:
        return array("I", self.bpe.encode_ordinary(text)).tobytes()

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if self.split and len(parts := self.split(text)) > 1:
            return b"".join(self.added[x] if k % 2 else self._ordinary(x) for k, x in enumerate(parts) if x)
        return self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        if _ODD_SPACE.search(text):  # spaces in a row or beside other white space
            return self._encode(text)
        first, *rest = text.split(" ")
        stretches = [first, *[" " + x for x in rest]]
        cache = self.cache
        if len(cache) > self.most:
            cache.clear()
        for x in set(stretches).difference(cache):
            cache[x] = self._encode(x)
        return b"".join(map(cache.__getitem__, stretches))


def cut(ids: bytes, most: int) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of the pieces of a document's ids."""
    n = len(ids) // 4
    first = n % most or min(n, most)
    starts = [0, *range(first, n, most)]
    return [(k, s, e - s, zlib.crc32(ids[4 * s:4 * e])) for k, (s, e) in enumerate(zip(starts, [*starts[1:], n]))]


def pieces(docs: DataFrame, most: int = 1024, tokenizer: str = TOKENIZER, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text", contract: str = CONTRACT) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32."""
    added = added_tokens(contract)
    with open(tokenizer, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary file: bounded
    end = np.array([end_id], "<u4").tobytes()

    def cutter():
        encoder = Encoder(shared.value, added=added)
        return lambda texts: [cut(encoder.ids(t) + end, most) for t in texts]

    rows = docs.select(F.col(id_col), F.col(text_col).alias("_text"))
    return map_texts(rows, cutter, {"piece": "int", "start": "long", "length": "long", "ids_crc32": "long"}, many=True)


def best_fit(lengths: np.ndarray, capacities: tuple[float, float, float], weights: tuple[float, float, float],
             rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) for lengths given in falling order."""
    n = len(lengths)
    where, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    cap, weight = np.array(capacities, float), np.array(weights, float)
    left = np.empty((3, n))  # residual capacities of the open bins, dense; number: which bin
    number, used, bins, opened = np.empty(n, np.int64), np.zeros(n, np.int64), 0, 0
    shortest = int(lengths[-1]) if n else 0
    for k in range(n):
        t = int(lengths[k])
        need = np.array([t, 1.0, float(t) * t])
        chosen = -1
        if opened and t < cap[0]:
            free = left[:, :opened]
            fits = np.flatnonzero((free[0] >= need[0]) & (free[1] >= need[1]) & (free[2] >= need[2]))
            if len(fits):
                some = free[:, fits]
                if rule == "norm":
                    rest = (some - need[:, None]) / cap[:, None]
                    chosen = int(fits[(weight @ np.square(rest)).argmin()])
                else:
                    chosen = int(fits[((weight * need / cap / cap) @ some).argmax()])
        if chosen < 0:
            left[:, opened], number[opened] = cap, bins
            chosen, opened, bins = opened, opened + 1, bins + 1
        b = number[chosen]
        where[k], offset[k] = b, used[b]
        used[b] += t
        left[:, chosen] -= need
        if left[0, chosen] < shortest or left[1, chosen] < 1 or left[2, chosen] < shortest * shortest:
            opened -= 1  # nothing fits any more: the last open bin takes its place
            left[:, chosen], number[chosen] = left[:, opened], number[opened]
    return where, offset


def pack(parts: DataFrame, most: int = 1024, max_docs: int | None = None, max_attention: float | None = None,
         weights: tuple[float, float, float] = (1.0, 0.001, 0.001), rule: str = "norm",
         group_rows: int = 16_384) -> DataFrame:
    """``parts`` (rows with ``length``) with sequence_id and offset."""
    ship_code(parts.sparkSession)
    capacities = (float(most), float(max_docs or most), float(max_attention or most * most))
    groups = max(1, -(-parts.count() // group_rows))
    names = parts.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = list(batches)  # about group_rows narrow rows
        if not group:
            return
        t = pa.Table.from_batches(group).sort_by([("length", "descending"), *((c, "ascending") for c in names if c != "length")])
        where, offset = best_fit(t.column("length").to_numpy(), capacities, weights, rule)
        first = TaskContext.get().partitionId() << 32
        t = t.append_column("sequence_id", pa.array(where + first, pa.int64()))
        yield from t.append_column("offset", pa.array(offset, pa.int64())).combine_chunks().to_batches()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    # Dealt round robin: no key, so no group is larger than the others.
    return parts.repartition(groups).mapInArrow(run, f"{schema}, sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, most: int = 1024, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                     id_col: str = "doc_id", text_col: str = "text", **pack_options) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document."""
    return pack(written(pieces(docs, most, tokenizer, end_id, id_col, text_col), "pack-pieces"), most, **pack_options)
