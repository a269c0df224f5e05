"""Alignment of two tokenizers over the same texts, and the corpus' counts of aligned ids.

Exact-text deduplication: texts are grouped by their whole text in one shuffle, each distinct text is
encoded by both tokenizers and aligned once, and what it adds to the id-pair counts is weighted by how many documents
hold it. Measures go back to documents by the text's SHA-256.

Tokenizer A (byte-level, a ``tokenizers`` file) encodes space + text, B (a ``sentencepiece`` model) the text, before which it puts
its own space, so both spell the same bytes. Where a token of A and one of B end at the same byte, the text is cut into
groups and the two tokens are linked.

Both tokenizers cut at a single space or newline between other characters, so chunks between those are encoded and
aligned once per worker and remembered; other texts are aligned whole.

Pair counts: tasks pre-aggregate in arrays of bounded size; the ``FREQUENT`` commonest pairs are broadcast (at most 4 MB),
links of other pairs are joined with the whole table. So every link has its exact corpus count at any size of the table.

Defined results: null and empty texts, and texts whose joined tokens of A or B are not the bytes of space + text (an unknown piece, a
literal space mark), have no tokens: zeros and an empty hash; repeated rows and null ids keep their row; ties for the
highest count of a B id all count; an empty table stays empty; very long texts are aligned whole; other columns are
ignored.
"""

from __future__ import annotations

import functools
import hashlib
import re
import struct
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import byte_texts, map_arrow, strings
from kestrel.llm.packing import _STABLE, _ranked
from kestrel.session import materialize

MARK = "▁"
#: Pairs in the broadcast table, distinct pairs that a task holds before it passes them on, chunks that a worker remembers.
FREQUENT, HELD, CACHED = 1 << 18, 1 << 20, 350_000
#: The most copied texts, whose measures are repeated so that their documents spread over tasks.
HOT_TEXTS, SPREAD = 1024, 64
_CODE = struct.Struct("<q")
_BYTE = re.compile("<0x([0-9A-F]{2})>")
#: White space that meets, starts or ends the text, or a literal space mark: such texts are aligned whole.
_WHOLE = re.compile(rf"[ \n]\s|\s[ \n]|^\s|\s$|{MARK}")


def byte_alphabet() -> dict[str, int]:
    """The character for each byte in a byte-level vocabulary: printable Latin-1 stands for itself, the rest follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    own = {chr(b): b for b in plain}
    return own | {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}


class Pair:
    """The two tokenizers with the bytes of each id."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings in a text are text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = byte_alphabet()
        self.a_bytes = [bytes(byte[c] for c in self.a.id_to_token(i)) if all(c in byte for c in self.a.id_to_token(i) or "") else None
                        for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(m[1], 16)]) if (m := _BYTE.fullmatch(p)) else p.replace(MARK, " ").encode() for p in pieces]
        newline = self.b.encode("\n")
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces) or len(newline) != 2:
            raise ValueError("a piece of this vocabulary crosses a space or a newline: its texts cannot be cut there")
        self.ranked = _ranked(a_path)
        self.known: dict = {}  # (chunk as A reads it) -> alignment; words after a space start with it
        self.break_ = self.aligned(self.a_ids("\n"), newline[1:], b"\n")

    def a_ids(self, text: str) -> list[int]:
        return self.a.encode(text, add_special_tokens=False).ids

    def aligned(self, a: list[int], b: list[int], data: bytes):
        """(groups, pair codes as bytes, n_a, n_b, n_groups), or None where the tokens do not spell ``data``."""
        a_parts, b_parts = list(map(self.a_bytes.__getitem__, a)), list(map(self.b_bytes.__getitem__, b))
        if None in a_parts or b"".join(a_parts) != data or b"".join(b_parts) != data:
            return None
        if len(a) == len(b) == 1:
            return f"{a[0]}|{b[0]}", _CODE.pack(a[0] << 32 | b[0]), 1, 1, 1
        a_ends, b_ends = list(accumulate(map(len, a_parts))), list(accumulate(map(len, b_parts)))
        a_text, b_text = list(map(str, a)), list(map(str, b))
        at_end, groups, codes, from_a, from_b = dict(zip(b_ends, range(len(b)))), [], [], 0, 0
        for at_a, end in enumerate(a_ends):
            at_b = at_end.get(end)
            if at_b is not None:
                groups.append(",".join(a_text[from_a:at_a + 1]) + "|" + ",".join(b_text[from_b:at_b + 1]))
                codes.append(a[at_a] << 32 | b[at_b])
                from_a, from_b = at_a + 1, at_b + 1
        return ";".join(groups), struct.pack(f"<{len(codes)}q", *codes), len(a), len(b), len(groups)

    def whole(self, text: str):
        return self.aligned(self.a_ids(" " + text), self.b.encode(text), (" " + text).encode())

    def chunks(self, text: str) -> list[str] | None:
        """The chunks of space + text between its white space, or None where it must be aligned whole."""
        if _WHOLE.search(text):
            return None
        first, *rest = text.split("\n")
        out = (" " + first.replace(" ", "\0 ")).split("\0") if "\0" not in text else None
        if out is None:
            return None
        for line in rest:
            out.append("\n")
            out += line.replace(" ", "\0 ").split("\0")
        return out

    def learn(self, chunks: set[str]) -> None:
        """Align the chunks that are not known yet, B's side in one call."""
        new = [c for c in chunks if c not in self.known]
        if len(self.known) + len(new) > CACHED:
            self.known.clear()
            new = list(chunks)
        ids = self.b.encode([c[1:] if c[0] == " " else "\n" + c for c in new], num_threads=1)
        for c, b in zip(new, ids):
            a = self.ranked.encode_ordinary(c) if self.ranked and _STABLE.fullmatch(c, 1 if c[0] == " " else 0) else self.a_ids(c)
            self.known[c] = self.aligned(a, b if c[0] == " " else b[2:], c.encode())
        self.known["\n"] = self.break_

    def align(self, texts: list[str]) -> list:
        """Each text's alignment, by chunks where it can be cut."""
        out = []
        for a in range(0, len(texts), 64):
            cut = [self.chunks(t) for t in texts[a:a + 64]]
            self.learn({c for chunks in cut if chunks for c in chunks if c != "\n"})
            for text, chunks in zip(texts[a:a + 64], cut):
                out.append(self.whole(text) if chunks is None else self._joined(list(map(self.known.__getitem__, chunks))))
        return out

    @staticmethod
    def _joined(parts: list):
        if None in parts:
            return None
        groups, codes, n_a, n_b, n = zip(*parts)
        return ";".join(groups), b"".join(codes), sum(n_a), sum(n_b), sum(n)


@functools.cache
def tokenizer_pair(a_path: str, b_path: str) -> Pair:
    """One per worker process: its memory of chunks serves all of the worker's tasks."""
    return Pair(a_path, b_path)


def _summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(codes, return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, at, n)
    return keys, total


def align_texts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Every distinct non-empty text, aligned, as a written table: digest, times (documents that hold it), n_a, n_b,
    n_groups, n_links, groups_sha256, and its distinct pair ``codes`` (a << 32 | b, little-endian) with their ``counts``."""
    texts = docs.where(F.col("text") != "").groupBy("text").agg(F.count("*").alias("times"))

    def run(batches):
        pair = tokenizer_pair(a_path, b_path)
        for batch in batches:
            rows = []
            texts = byte_texts(batch, "text")
            for data, found in zip(texts, pair.align([t.decode() for t in texts])):
                digest = hashlib.sha256(data).digest()
                if found is None:
                    rows.append((digest, 0, 0, 0, 0, "", b"", b""))
                    continue
                groups, codes, n_a, n_b, n = found
                keys, counts = np.unique(np.frombuffer(codes, "<i8"), return_counts=True)
                rows.append((digest, n_a, n_b, n, len(codes) // 8, hashlib.sha256(groups.encode()).hexdigest(),
                             keys.astype("<i8").tobytes(), counts.astype("<u4").tobytes()))
            cols = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.binary(), *[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary()]
            times = batch.column(batch.schema.get_field_index("times"))
            yield pa.RecordBatch.from_arrays([times, *(pa.array(c, k) for c, k in zip(cols, kinds))],
                                             names=["times", "digest", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "counts"])

    schema = ("times bigint, digest binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
              "codes binary, counts binary")
    return materialize(map_arrow(texts, run, schema), "aligned-texts")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``code``, ``b`` and ``n``: how many links of all documents hold each id pair, as a written table."""
    def run(batches):
        codes, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(codes), pa.array(counts)], names=["code", "n"])

        for batch in batches:
            own = [(np.frombuffer(c, "<i8"), np.frombuffer(k, "<u4").astype(np.int64) * t) for c, k, t in
                   zip(strings(batch, "codes"), strings(batch, "counts"), strings(batch, "times"))]
            codes, counts = _summed(np.concatenate([codes, *(c for c, _ in own)]), np.concatenate([counts, *(k for _, k in own)]))
            if len(codes) >= HELD:
                yield rows()
                codes, counts = codes[:0], counts[:0]
        yield rows()

    parts = map_arrow(aligned.select("codes", "counts", "times"), run, "code bigint, n bigint")
    total = parts.groupBy("code").agg(F.sum("n").alias("n"))
    return materialize(total.select("code", F.col("code").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b"), "n"), "pair-counts")


def score_links(aligned: DataFrame, pairs: DataFrame) -> DataFrame:
    """The aligned texts with n_best and count_sum. What is broadcast has a row per B id (a vocabulary) and FREQUENT pairs."""
    spark = aligned.sparkSession
    best = pairs.groupBy("b").agg(F.max("n").alias("top")).toArrow()
    common = pairs.select("code", "n").orderBy(F.desc("n"), "code").limit(FREQUENT).toArrow()
    order = np.argsort(common.column("code").to_numpy())
    top = np.zeros(max(best.column("b").to_pylist(), default=-1) + 1, np.int64)
    top[best.column("b").to_numpy()] = best.column("top").to_numpy()
    shared = spark.sparkContext.broadcast((common.column("code").to_numpy()[order], common.column("n").to_numpy()[order], top))
    plain = ["times", "digest", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches):
        known, n, top = shared.value
        for batch in batches:
            n_best, count_sum, rest = [], [], []
            for c, k in zip(strings(batch, "codes"), strings(batch, "counts")):
                codes, counts = np.frombuffer(c, "<i8"), np.frombuffer(k, "<u4").astype(np.int64)
                at = np.searchsorted(known, codes)
                hit = np.take(known, at, mode="clip") == codes if len(known) else np.zeros(len(codes), bool)
                found, times = n[at[hit]], counts[hit]
                n_best.append(int(times[found == top[codes[hit] & 0xFFFFFFFF]].sum()))
                count_sum.append(int((found * times).sum()))
                rest.append([{"code": x, "k": y} for x, y in zip(codes[~hit].tolist(), counts[~hit].tolist())])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(x)) for x in plain), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()),
                 pa.array(rest, pa.list_(pa.struct([("code", pa.int64()), ("k", pa.int64())])))], names=[*plain, "n_best", "count_sum", "rest"])

    kinds = dict(aligned.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in plain) + ", n_best bigint, count_sum bigint, rest array<struct<code: bigint, k: bigint>>"
    scored = materialize(map_arrow(aligned.select(*plain, "codes", "counts"), run, schema), "scored-texts")
    rare = (scored.select("digest", F.explode("rest").alias("r")).select("digest", "r.code", "r.k")
            .join(pairs, "code").join(F.broadcast(pairs.groupBy("b").agg(F.max("n").alias("top"))), "b")  # a row per B id
            .groupBy("digest").agg(F.sum(F.when(F.col("n") == F.col("top"), F.col("k")).otherwise(0)).alias("more_best"),
                                   F.sum(F.col("n") * F.col("k")).alias("more_sum")))
    return (scored.drop("rest").join(rare, "digest", "left")
            .withColumn("n_best", F.col("n_best") + F.coalesce("more_best", F.lit(0)))
            .withColumn("count_sum", F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).drop("more_best", "more_sum"))


MEASURES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def alignment_measures(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document: ``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    src = docs.select(F.col(id_col).alias("id"), "text")
    aligned = align_texts(src, a_path, b_path)
    scored = score_links(aligned, pair_counts(aligned))
    # the documents of the most copied texts are dealt over SPREAD keys; no other text holds more than 1/HOT_TEXTS of the rows
    hot = aligned.orderBy(F.desc("times"), "digest").limit(HOT_TEXTS).select("digest", F.lit(True).alias("hot"))
    hot = materialize(hot, "hot-texts")
    salts = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(0)))
    measures = scored.join(F.broadcast(hot), "digest", "left").withColumn("salt", F.explode(salts)).drop("hot", "times")
    rows = (src.select("id", F.unhex(F.sha2("text", 256)).alias("digest")).join(F.broadcast(hot), "digest", "left")
            .withColumn("salt", F.when(F.col("hot"), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)).cast("int")).otherwise(0)))
    out = rows.join(measures, ["digest", "salt"], "left")
    return out.select(F.col("id").alias(id_col), *(F.coalesce(c, F.lit(0)).alias(c) for c in MEASURES),
                      F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"))
