"""Token counts with a two-tier map-side lookup.

Every text is cut into pre-tokens where the vocabulary cannot merge across:
before each run of spaces. Tier one is a compact table of the corpus' frequent
pre-tokens and their token counts, broadcast once; tier two is a bounded cache
in each worker, filled by encoding the misses. No pre-token is shuffled: the
frequent table comes from one bounded sketch per task, merged level by level.

Defined results: null text counts as empty (0 tokens, 0 bytes); spaces at the
ends, runs of spaces and the literal space mark count as the library counts
them; repeated rows and null ids keep their row; an empty table stays empty.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import BoundedCache, map_arrow, strings
from kestrel.session import materialize

MARK = "▁"
#: Entries of a task's sketch and of the broadcast table, and what a worker may cache.
SKETCH, FREQUENT, CACHED = 4096, 16384, 200_000
FAN_IN = 64
_PRE = re.compile(f"[ {MARK}]*[^ {MARK}]+|[ {MARK}]+")
_ODD = re.compile(f"  |{MARK}")


def pre_tokens(text: str) -> list[str]:
    """The pre-tokens, each without the one space (the model's own, for the first) that starts it."""
    if _ODD.search(text) or text[:1] == " " or text[-1:] == " ":
        return [x[1:] for x in _PRE.findall(" " + text)] if text else []
    return text.split(" ") if text else []


@functools.cache
def _processor(path: str):
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if any(MARK in model.id_to_piece(i).lstrip(MARK) for i in range(model.get_piece_size())):
        raise ValueError("a piece of this vocabulary crosses a space: its texts cannot be cut there")
    return model


def _length(path: str, pre: str) -> int:
    """Tokens of one pre-token; the library puts its own space before it."""
    return len(_processor(path).encode(pre, num_threads=1)) if pre else 1


def _sketches(batches):
    """One row per task: its SKETCH most frequent pre-tokens, over all its texts
    (the counter is cut to twice the sketch whenever it outgrows sixteen sketches)."""
    seen: Counter = Counter()
    for batch in batches:
        for text in strings(batch, "text"):
            if text:
                seen.update(x for x in pre_tokens(text) if 0 < len(x) <= 32 and " " not in x)
        if len(seen) > 16 * SKETCH:
            seen = Counter(dict(seen.most_common(2 * SKETCH)))
    yield _packed(TaskContext.get().partitionId(), seen, SKETCH)


def _packed(part: int, seen: Counter, size: int) -> pa.RecordBatch:
    top = sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:size]
    blob = zlib.compress(" ".join(w for w, _ in top).encode(), 1)
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([blob], pa.binary()),
                                       pa.array([np.array([n for _, n in top], np.int64).tobytes()], pa.binary())],
                                      names=["part", "words", "counts"])


def _unpacked(words: bytes, counts: bytes) -> Counter:
    n = np.frombuffer(counts, np.int64).tolist()
    return Counter(dict(zip(zlib.decompress(words).decode().split(" "), n)) if n else {})


def _merged(table: pa.Table) -> pa.Table:
    total: Counter = Counter()
    for r in table.to_pylist():
        total.update(_unpacked(r["words"], r["counts"]))
    return pa.Table.from_batches([_packed(table.column("part")[0].as_py() // FAN_IN, total, FREQUENT)])


def frequent_table(docs: DataFrame, model_path: str) -> tuple[bytes, bytes]:
    """The FREQUENT commonest pre-tokens (joined by spaces, compressed) and their
    token counts (two bytes each). Sketches have a fixed size and merge FAN_IN at
    a time until at most FAN_IN are left, so neither a task nor the driver
    ever holds more than FAN_IN of them."""
    schema = "part int, words binary, counts binary"
    level = materialize(map_arrow(docs.select("text"), _sketches, schema), "token-sketches")
    while level.count() > FAN_IN:
        level = materialize(level.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(_merged, schema), "token-sketches")
    total: Counter = Counter()
    for r in level.collect():
        total.update(_unpacked(bytes(r["words"]), bytes(r["counts"])))
    words = [w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:FREQUENT]]
    lengths = np.array([_length(model_path, w) for w in words], np.uint16)
    return zlib.compress(" ".join(words).encode()), lengths.tobytes()


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id") -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every document, without a shuffle."""
    src = docs.select(F.col(id_col).alias("id"), F.col("text"))
    spark, kind = docs.sparkSession, dict(src.dtypes)["id"]
    shared = spark.sparkContext.broadcast(frequent_table(src, model_path))

    def count(batches):
        words, lengths = shared.value
        n = np.frombuffer(lengths, np.uint16).tolist()
        known = dict(zip(zlib.decompress(words).decode().split(" "), n)) if n else {}
        misses = BoundedCache(functools.partial(_length, model_path), CACHED)
        look = known.get
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in strings(batch, "text"):
                total = 0
                for pre in pre_tokens(text or ""):
                    c = look(pre)
                    total += misses[pre] if c is None else c
                n_tokens.append(total)
                n_bytes.append(len((text or "").encode()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64())],
                                             names=["id", "n_bytes", "n_tokens"])

    out = map_arrow(src, count, f"id {kind}, n_bytes bigint, n_tokens bigint")
    return out.withColumn("over_limit", F.col("n_tokens") > limit).withColumnRenamed("id", id_col)
