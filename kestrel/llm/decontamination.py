"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is short and a document long, so their Jaccard similarity says little; what
counts is the share of the item's shingles that the document holds. Items are partitioned
by set size, (2^(p-1), 2^p] shingles each, and every partition has an index of its own with its
own sketch size and required hits. Up to EXACT shingles the sketch is the whole set, so
that search is exact; beyond, it is the smallest hashes of the item, more of them in partitions of
larger items, and the hits required are so few that an item contained to ``threshold`` is
missed with a probability under 1e-7. Documents stream past the partitions' indexes; candidates
are verified on the full sets.

Items are the stated query set: they are taken in blocks of a bounded number of
shingles, one broadcast and one pass over the documents per block. A block is run, written and its
broadcast released before the next one is built, so nothing that grows with the benchmark is
broadcast or held.

Defined results: null or empty texts (documents or items) match nothing; an item
of fewer than five words matches only where the document is that same sequence; an item larger than a
block is a block of its own; long documents are searched whole; repeated rows and null ids match
row by row; an empty benchmark or document table gives no matches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import byte_texts, map_arrow
from kestrel.llm.shingles import shingle_hashes, shingle_set
from kestrel.session import materialize

THRESHOLD = 0.75
#: Items of up to EXACT shingles are searched by their whole sets.
EXACT = 64
#: Sketch size of the first partition beyond EXACT, what each further one adds, and the largest.
SKETCH, SKETCH_STEP, SKETCH_MAX = 64, 8, 96
#: Shingles of one block of items (8 bytes each, about 32 MB broadcast).
BLOCK_SHINGLES = 4_000_000
_PREFIX = 20


def size_partition(size: int) -> int:
    """p of the partition (2^(p-1), 2^p] that a set of ``size`` shingles belongs to."""
    return max(size - 1, 0).bit_length()


def sketch_size(partition: int) -> int:
    """Values that the sketches of a partition keep: all of them up to EXACT shingles."""
    beyond = partition - size_partition(EXACT)
    return 1 << partition if beyond <= 0 else min(SKETCH_MAX, SKETCH + SKETCH_STEP * (beyond - 1))


def needed_hits(size: int, threshold: float) -> int:
    """Sketch values a document must hold if it contains an item of that size to ``threshold``:
    in a partition of whole sets that share of the set, else 5.5 deviations below the mean, the same for the partition."""
    if size <= EXACT:
        return max(1, math.ceil(threshold * size - 1e-9))
    k = sketch_size(size_partition(size))
    return max(1, math.floor(k * threshold - 5.5 * math.sqrt(k * threshold * (1 - threshold))))


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - _PREFIX)).astype(np.int64)


@dataclass
class SizePartition:
    """Inverted lists over the sketches of one partition's items."""
    values: np.ndarray  # sorted distinct sketch values
    starts: np.ndarray  # postings of value i: postings[starts[i]:starts[i + 1]]
    postings: np.ndarray  # places in ``items``
    items: np.ndarray
    needed: np.ndarray  # hits that each of ``items`` requires

    @classmethod
    def build(cls, items: np.ndarray, sets: list[np.ndarray], partition: int, threshold: float) -> SizePartition:
        sketches = [sets[i][:sketch_size(partition)] for i in items]
        value = np.concatenate(sketches)
        place = np.repeat(np.arange(len(items)), [len(s) for s in sketches])
        order = np.argsort(value, kind="stable")
        distinct, starts = np.unique(value[order], return_index=True)
        needed = np.array([needed_hits(len(sets[i]), threshold) for i in items], np.int64)
        return cls(distinct, np.r_[starts, len(value)], place[order], items, needed)

    def candidates(self, hashes: np.ndarray) -> np.ndarray:
        """The items of which a document with these (distinct) shingles holds enough sketch values."""
        at = np.searchsorted(self.values, hashes)
        at[at == len(self.values)] = 0
        found = at[self.values[at] == hashes]
        if not len(found):
            return self.items[:0]
        place, hits = np.unique(np.concatenate([self.postings[self.starts[i]:self.starts[i + 1]] for i in found]), return_counts=True)
        return self.items[place[hits >= self.needed[place]]]


@dataclass
class ItemIndex:
    """A block of items: their full sets and one index per size partition."""
    sets: list  # full sorted shingle sets
    partitions: list
    present: np.ndarray  # by the first bits of a hash: may it be in a sketch

    @classmethod
    def build(cls, sets: list[np.ndarray], threshold: float) -> ItemIndex:
        part = np.array([size_partition(len(s)) if len(s) else -1 for s in sets], np.int64)
        partitions = [SizePartition.build(np.flatnonzero(part == p), sets, int(p), threshold) for p in np.unique(part[part >= 0])]
        present = np.zeros(1 << _PREFIX, bool)
        for p in partitions:
            present[_bucket(p.values)] = True
        return cls(sets, partitions, present)


def matches(text: bytes | None, index: ItemIndex, threshold: float) -> list[tuple[int, int]]:
    """(item, shared shingles) of the items contained in the text."""
    hashes = shingle_hashes(text)
    maybe = np.unique(hashes[index.present[_bucket(hashes)]])
    if not len(maybe):
        return []
    who = np.concatenate([p.candidates(maybe) for p in index.partitions])
    out = []
    if len(who):
        own = np.unique(hashes)
        for i in np.sort(who).tolist():
            shared = int(np.isin(index.sets[i], own, assume_unique=True).sum())
            if shared >= threshold * len(index.sets[i]) - 1e-9:
                out.append((i, shared))
    return out


def _sets(batches):
    for batch in batches:
        sets = [shingle_set(t) for t in byte_texts(batch, "text")]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.tobytes() for s in sets], pa.binary()),
                                          pa.array([len(s) for s in sets], pa.int64())], names=["item_id", "shingles", "n"])


def item_blocks(items: DataFrame, block_shingles: int = BLOCK_SHINGLES):
    """The items in blocks of at most ``block_shingles`` (a larger item is a block of its own),
    read one block at a time: the driver never holds more than one."""
    src = items.select("item_id", "text")
    kind = dict(src.dtypes)["item_id"]
    sets = materialize(map_arrow(src, _sets, f"item_id {kind}, shingles binary, n bigint").where("n > 0"), "item-shingles")
    block, held = [], 0
    for r in sets.toLocalIterator():
        if block and held + r["n"] > block_shingles:
            yield block
            block, held = [], 0
        block.append((r["item_id"], np.frombuffer(bytes(r["shingles"]), np.uint64)))
        held += r["n"]
    if block:
        yield block


def _one_by_one(blocks):
    """(block, is it the last one)"""
    held = next(blocks, None)
    while held is not None:
        after = next(blocks, None)
        yield held, after is None
        held = after


def contained_items(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                    block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, item_id, n_item_shingles, n_shared, containment) for every item that a document
    contains to ``threshold``; documents are scanned once per block of items, without a shuffle."""
    src = docs.select("doc_id", "text")
    kinds = dict(src.dtypes)["doc_id"], dict(items.dtypes)["item_id"]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, n_item_shingles bigint, n_shared bigint"
    out = None
    for block, last in _one_by_one(item_blocks(items, block_shingles)):
        search, shared = _searcher(docs, block, threshold, items.schema["item_id"].dataType)
        part = map_arrow(src, search, schema)
        if not last:
            part = materialize(part, "contained-items")
            shared.unpersist()
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumn("containment", F.col("n_shared") / F.col("n_item_shingles"))


def _searcher(docs: DataFrame, block, threshold: float, id_kind):
    from pyspark.sql.pandas.types import to_arrow_type
    shared = docs.sparkSession.sparkContext.broadcast(([i for i, _ in block], ItemIndex.build([s for _, s in block], threshold)))
    id_type = to_arrow_type(id_kind)

    def search(batches):
        ids, index = shared.value
        for batch in batches:
            rows, found, n, shared_n = [], [], [], []
            for k, text in enumerate(byte_texts(batch, "text")):
                for i, s in matches(text, index, threshold):
                    rows.append(k)
                    found.append(ids[i])
                    n.append(len(index.sets[i]))
                    shared_n.append(s)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int32())), pa.array(found, id_type),
                                              pa.array(n, pa.int64()), pa.array(shared_n, pa.int64())],
                                             names=["doc_id", "item_id", "n_item_shingles", "n_shared"])
    return search, shared


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                      block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns kept, without a shuffle. What a block
    of items leaves is written before the next block is searched."""
    names = docs.columns
    for block, last in _one_by_one(item_blocks(items, block_shingles)):
        src = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text"))
        shared = docs.sparkSession.sparkContext.broadcast(ItemIndex.build([s for _, s in block], threshold))

        def clean(batches, shared=shared):
            for batch in batches:
                keep = [not matches(t, shared.value, threshold) for t in byte_texts(batch, "text")]
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep, pa.bool_()))], names=["row"])

        docs = map_arrow(src, clean, f"row {src.schema['row'].dataType.simpleString()}").select("row.*")
        if not last:
            docs = materialize(docs, "uncontaminated")
            shared.unpersist()
    return docs
