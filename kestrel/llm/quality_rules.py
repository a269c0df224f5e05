"""Quality rules as a bitmask ledger.

``ledger`` reads every text once, stores the measurements and one failure bit per
rule. A policy is a named, versioned mask over those bits: applying another
policy, or asking what each rule alone removes (``ablation``), is bitwise work
on the ledger and never reads a text again.

Defined results: a null text measures as an empty one (all zero, rule
``few_words`` fails); repeated rows and null ids are measured row by row; an
empty table gives an empty ledger; other input columns are ignored.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import byte_texts, map_arrow

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_ascii_letters",
            "n_alpha_words", "n_exclaim", "n_echo_words")

#: bit -> (rule, SQL condition that fails the document). Bits are never reused.
RULES = (
    ("few_words", "n_words < 20"),
    ("repeat_words", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("upper_case", "10 * n_upper > 3 * n_ascii_letters"),
    ("word_length", "word_chars < 3 * n_words OR word_chars > 12 * n_words"),
    ("alpha_words", "100 * n_alpha_words < 80 * n_words"),
    ("dup_lines", "2 * n_dup_lines > n_lines"),
    ("exclaim", "2 * n_exclaim > n_words"),
    ("echo_words", "5 * n_echo_words > n_words"),  # words equal to the word before
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version of what is enforced: a document is kept if no enforced bit is set."""
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", 1, ("few_words", "repeat_words"))
STANDARD = Policy("standard", 1, tuple(BIT))

# classes of bytes: 0 rest, 1 white space, 2 symbol, 3 upper, 4 lower, 5 '!', 6 UTF-8 lead byte, 7 UTF-8 continuation
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, *range(9, 14)]] = 1
_CLASS[list(b"#*$%&|<>")] = 2
_CLASS[65:91], _CLASS[97:123], _CLASS[0x21] = 3, 4, 5
_CLASS[0xC0:], _CLASS[0x80:0xC0] = 6, 7
_LETTER = np.isin(np.arange(8), (3, 4, 6))


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window of ``width`` words found at least twice."""
    m = len(words) - width + 1
    if m < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key, odd = np.zeros(m, np.uint64), np.uint64(0x9E3779B97F4A7C15)
    for j in range(width):
        key = key * odd + h[j:j + m]
    first, inverse, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)[1:]
    at = np.flatnonzero(count[inverse] > 1)
    if not len(at):
        return 0
    ids: dict = {}
    exact = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    seen = first[inverse[at]]
    if all(np.array_equal(exact[at + j], exact[seen + j]) for j in range(width)):
        hit = at
    else:  # two different windows with one hash: count the windows themselves
        windows = np.lib.stride_tricks.sliding_window_view(exact, width)
        inverse, count = np.unique(windows, axis=0, return_inverse=True, return_counts=True)[1:]
        hit = np.flatnonzero(count[inverse.ravel()] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + width, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def measure(text: bytes | None) -> tuple[int, ...]:
    """The MEASURES of one text."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.split()
    kinds = _CLASS[np.frombuffer(text, np.uint8)]
    n = np.bincount(kinds, minlength=8)
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    alpha = 0
    if words:
        gap = kinds == 1
        starts = np.flatnonzero(np.diff(gap, prepend=True) & ~gap)
        alpha = int(np.count_nonzero(np.add.reduceat(_LETTER[kinds], starts, dtype=np.int64)))
    return (len(words), int(len(kinds) - n[7] - n[1]), int(n[2]), len(lines) - len(set(lines)), repeated_words(words),
            len(lines), int(n[3]), int(n[3] + n[4]), alpha, int(n[5]), sum(map(operator.eq, words, words[1:])))


def _measured(batches):
    for batch in batches:
        rows = [measure(t) for t in byte_texts(batch, "text")]
        cols = [pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * len(MEASURES)
        names = [n for n in batch.schema.names if n != "text"]
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in names] + cols,
                                         names=[*names, *MEASURES])


def fail_bits():
    """The failure bits as one expression over the measurement columns."""
    out = F.lit(0).cast("bigint")
    for name, failed in RULES:
        out = out.bitwiseOR(F.when(F.expr(failed), F.lit(BIT[name])).otherwise(F.lit(0)).cast("bigint"))
    return out


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, the MEASURES and ``fail_bits`` of every document, without a shuffle."""
    kind = dict(docs.dtypes)[id_col]
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    out = map_arrow(src, _measured, f"id {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES))
    return out.withColumn("fail_bits", fail_bits()).withColumnRenamed("id", id_col)


def passes(policy: Policy, bits: str = "fail_bits"):
    return F.col(bits).bitwiseAND(F.lit(policy.mask)) == 0


def ablation(ledger_df: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, and documents only it rejects
    (what would come back without the rule). One pass, one small aggregate."""
    bits = F.col("fail_bits").bitwiseAND(F.lit(policy.mask))
    one = ledger_df.groupBy(bits.alias("bits")).count()  # at most 2^rules groups
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("bigint").alias("bit")) for r in policy.rules])
    return (one.select("bits", "count", F.explode(rules).alias("r"))
            .groupBy(F.lit(policy.name).alias("policy"), F.lit(policy.version).alias("version"), F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("count")).otherwise(0)).alias("failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("only_this")))


def keep_documents(docs: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """The rows of ``docs`` that pass the policy, all columns kept, whatever their names."""
    names = docs.columns
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text"))
    kind = src.schema["row"].dataType.simpleString()
    out = map_arrow(src, _measured, f"row {kind}, " + ", ".join(f"{m} bigint" for m in MEASURES))
    return out.where(fail_bits().bitwiseAND(F.lit(policy.mask)) == 0).select("row.*")
