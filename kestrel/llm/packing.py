"""Best-fit-decreasing packing of tokenised documents into fixed-length sequences.

Documents become token ids plus an end id; longer ones are cut into capacity-long
pieces, the first piece taking the remainder. Best-fit decreasing looks only at
lengths, and there are at most ``capacity`` of them: the driver packs the global
length histogram, finding the tightest open bin with a segment tree over the
remaining capacities, and writes the outcome as runs ("the pieces of length L with
ranks a..b go q by q into sequences from s on, at offset o"). Every piece then finds its
place from its length and its rank among pieces of that length. So the packing is
the one best-fit decreasing gives for the whole corpus, though no task sees more than
its share and the driver sees ``capacity`` numbers.

Defined results: null text is an empty document (just the end id); repeated rows
and null ids are packed as documents of their own; pieces of equal length are ranked by
input task and order; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import zlib
from collections import Counter, deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import BoundedCache, map_arrow, strings
from kestrel.session import materialize

CACHED = 300_000


class CapacityTree:
    """Segment tree over remaining capacities 0..capacity: how many open bins each has."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.size)

    def add(self, remaining: int, bins: int) -> None:
        i = remaining + self.size
        while i:
            self.count[i] += bins
            i //= 2

    def tightest(self, need: int) -> int | None:
        """The smallest remaining capacity >= need with an open bin: up from the leaf
        to the first right sibling with bins, then down its left-most path."""
        i = need + self.size
        if not self.count[i]:
            while i > 1 and not (i % 2 == 0 and self.count[i + 1]):
                i //= 2
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        return i - self.size


def best_fit_runs(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over ``length -> count``: runs (length, first rank, end rank,
    first sequence, pieces per sequence, first offset). A bin that took a piece and still
    has room for another of its length is then the tightest, so equal lengths go into a
    bin until it is too full: whole groups of equal bins are filled in one step."""
    tree, open_bins = CapacityTree(capacity), [deque() for _ in range(capacity + 1)]
    runs, next_sequence = [], 0

    def put(remaining: int, first: int, bins: int) -> None:
        if remaining:
            open_bins[remaining].append((first, bins))
            tree.add(remaining, bins)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                first, bins = next_sequence, -(-left // (capacity // length))
                next_sequence += bins
            else:
                first, bins = open_bins[room].popleft()
                tree.add(room, -bins)
            each = room // length
            full = min(bins, left // each)
            if full:
                runs.append((length, rank, rank + full * each, first, each, capacity - room))
                rank, left = rank + full * each, left - full * each
                put(room - each * length, first, full)
                first, bins = first + full, bins - full
            if bins and left:
                runs.append((length, rank, rank + left, first, left, capacity - room))
                put(room - left * length, first, 1)
                rank, left, first, bins = rank + left, 0, first + 1, bins - 1
            if bins:
                put(room, first, bins)
    return runs


@functools.cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


def _bytes_of() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 for
    itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@functools.cache
def _ranked(path: str):
    """The same merges for one chunk at a time without the tokenizer's per-call cost, or None where a
    vocabulary's ids are not its merge order (then every chunk goes to the tokenizer)."""
    import tiktoken
    model, byte = json.loads(_tokenizer(path).to_str())["model"], _bytes_of()
    vocab, merges = model.get("vocab", {}), [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
    if model.get("type") != "BPE" or model.get("ignore_merges") or any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
        return None
    ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if i < 256 + len(merges)}
    return tiktoken.Encoding("chunks", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})


#: The split of byte-level tokenizers, and the chunks in which it cannot depend on a
#: library's Unicode tables: printable ASCII and the letters and signs up to U+024F.
_WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_STABLE = re.compile("[!-~\u00a1-\u024f]+")


class _Encoder:
    """Ids of a text as the tokenizer at ``path`` gives them, as little-endian bytes.

    A byte-level tokenizer without normaliser cuts at single spaces and newlines between
    other characters whatever stands around them, so such chunks are encoded once and
    remembered; texts where white space meets, or that hold an added token, go to the
    tokenizer whole."""

    def __init__(self, path: str):
        self.tok = _tokenizer(path)
        made = json.loads(self.tok.to_str())
        added = [re.escape(a["content"]) for a in made.get("added_tokens", [])]
        self.whole = re.compile("|".join([r"[ \n]\s|\s[ \n]", *added]))
        split = made.get("pre_tokenizer") or {}
        self.cuttable = (made.get("normalizer") is None and split.get("type") == "ByteLevel"
                         and split.get("use_regex") and not split.get("add_prefix_space"))
        self.ranked = _ranked(path) if self.cuttable else None
        self.mid = BoundedCache(lambda chunk: self._chunk(chunk, " "), CACHED)
        self.start = BoundedCache(lambda chunk: self._chunk(chunk, ""), CACHED // 4)
        self.newline = self._encode("\n")

    def _encode(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _chunk(self, chunk: str, lead: str) -> bytes:
        if self.ranked and _STABLE.fullmatch(chunk):
            return struct.pack(f"<{len(ids)}I", *ids) if (ids := self.ranked.encode_ordinary(lead + chunk)) else b""
        return self._encode(lead + chunk)

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.cuttable or self.whole.search(text):
            return self._encode(text)
        lines, mid, start = [], self.mid.__getitem__, self.start
        for line in text.split("\n"):
            first, *rest = line.split(" ")
            lines.append(start[first] + b"".join(map(mid, rest)))
        return self.newline.join(lines)


@functools.cache
def _encoder(path: str) -> _Encoder:
    """One per worker process: its memory of chunks serves all of the worker's tasks."""
    return _Encoder(path)


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2,
                 with_ids: bool = False, id_col: str = "doc_id") -> DataFrame:
    """Every document cut into pieces: (id, piece, start, length, ids_crc32[, ids], part, rank),
    rank counting the earlier pieces of the same length in the same task."""
    src = docs.select(F.col(id_col).alias("id"), F.col("text"))
    kind = dict(src.dtypes)["id"]

    def cut(batches):
        encode, part, seen = _encoder(tokenizer_path), TaskContext.get().partitionId(), Counter()
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            at, piece, start, length, crc, ids, rank = [], [], [], [], [], [], []
            for row, text in enumerate(strings(batch, "text")):
                data = encode(text or "") + end
                n = len(data) // 4
                edges = [0, *range(n % capacity or capacity, n + 1, capacity)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    own = data[4 * a:4 * b]
                    at.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(own))
                    rank.append(seen[b - a])
                    seen[b - a] += 1
                    if with_ids:
                        ids.append(np.frombuffer(own, "<u4").astype(np.int32))
            cols = {"id": batch.column(0).take(pa.array(at, pa.int32())), "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
            if with_ids:
                cols["ids"] = pa.array(ids, pa.list_(pa.int32()))
            cols |= {"part": pa.array([part] * len(at), pa.int32()), "rank": pa.array(rank, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return map_arrow(src, cut, f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
                     + ("ids array<int>, " if with_ids else "") + "part int, rank bigint")


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Give every piece (length, part, rank) its sequence_id and offset. ``pieces`` must be
    a written table: it is read three times and its ranks must not change."""
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    runs = best_fit_runs(histogram, capacity)
    table = np.array(runs or np.zeros((0, 6)), np.int64).reshape(-1, 6)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = (pieces.join(bases, ["length", "part"])
              .withColumn("rank", F.col("rank") + F.col("base")).drop("base", "part"))
    shared = pieces.sparkSession.sparkContext.broadcast(table)  # bounded by the capacity, not by the corpus
    kept = [f for f in ranked.schema if f.name != "rank"]

    def find(batches):
        runs_of = shared.value
        lows = {int(x): (int(a), int(b)) for x, a, b in _bounds(runs_of[:, 0])}
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("rank")).to_numpy()
            run = np.empty(len(rank), np.int64)
            for x in np.unique(length):
                a, b = lows[int(x)]
                own = length == x
                run[own] = a + np.searchsorted(runs_of[a:b, 1], rank[own], side="right") - 1
            r = runs_of[run].reshape(-1, 6)
            nth = rank - r[:, 1]
            cols = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(r[:, 3] + nth // r[:, 4]), pa.array(r[:, 5] + nth % r[:, 4] * length)],
                                             names=[*(f.name for f in kept), "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", sequence_id bigint, offset bigint"
    return map_arrow(ranked, find, schema)


def _bounds(keys: np.ndarray):
    if len(keys):
        cut = np.flatnonzero(np.diff(keys)) + 1
        yield from zip(keys[np.r_[0, cut]], np.r_[0, cut], np.r_[cut, len(keys)])


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2,
                   with_ids: bool = False, id_col: str = "doc_id") -> DataFrame:
    """Pieces of every document with their place: id, piece, start, length, ids_crc32[, ids],
    sequence_id, offset; sequences are gapless from offset 0."""
    pieces = materialize(token_pieces(docs, tokenizer_path, capacity, end_id, with_ids, id_col), "token-pieces")
    out = place(pieces, capacity).withColumnRenamed("id", id_col)
    return out.select(id_col, "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), "sequence_id", "offset")
