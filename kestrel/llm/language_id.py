"""Language ID with interpolated Kneser-Ney character models.

One model per language, of order ORDER, over lower-cased letters with every other run of
characters as one space. The models lie side by side in sorted hash arrays: for
each order the hashes of all n-grams any language has seen, with one row of log
probabilities per hash (a column per language), and the same for back-off weights of contexts, so
one search serves all languages. A text gets the language of lowest cross-entropy per
character. Entropies of labelled texts that were kept out of the counts calibrate the score (a
softmax with a fitted temperature) and the rejection: a text whose entropy lies far
above what texts of its length in a known language have.

Training reads a bounded sample: about SAMPLE_DOCS texts per language, of any length, chosen by the hash of id and
text (equal rows count once, and every language has at least its text of the least hash); a text of more than SAMPLE_BYTES characters is read in slices from all over it, as many characters in all. Every fifth
text calibrates, if its language has others.

Defined results: null text or no letter: ``und``, score 0, rejected; ties go to the
first language by name; a null id counts as an empty text in the hold-out rule; repeated rows are
predicted row by row; without labelled rows everything is ``und``; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import map_arrow, strings
from kestrel.llm.shingles import _mix

ORDER, SAMPLE_DOCS, SAMPLE_BYTES, FOLDS = 4, 400, 20_000, 5
#: Slices that stand for a text of more than SAMPLE_BYTES characters.
SLICES = 8
UNKNOWN = "und"
#: Characters the score takes into account, and where a text counts as foreign: this many
#: standard errors and this much (nats a character) over the calibration mean.
SCORE_CHARS, REJECT_SIGMAS, REJECT_NATS = 60, 8.0, 0.5


@functools.cache
def _letters() -> np.ndarray:
    """code point -> its lower-case letter in 16 bits, or a space."""
    table = np.full(0x110000, 32, np.uint16)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ord(ch.lower()[0])
            table[c] = low if low < 0x10000 else 0xE000 + low % 0x1000  # beyond 16 bits: folded into the private area
    return table


def characters(text: str | None) -> np.ndarray:
    """The text's symbols: lower-case letters, other runs as one space, a space at either end;
    empty without a letter."""
    if not text:
        return np.empty(0, np.uint16)
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    codes = np.r_[np.uint16(32), codes, np.uint16(32)]
    codes = codes[np.r_[True, (codes[1:] != 32) | (codes[:-1] != 32)]]
    return codes if len(codes) > 1 else codes[:0]


def grams(codes: np.ndarray, n: int) -> np.ndarray:
    """The packed n-gram that ends at each position but the first; before the text stand spaces."""
    padded = np.r_[np.full(n, 32, np.uint16), codes].astype(np.uint64)
    out = np.zeros(len(codes) - 1, np.uint64)
    for j in range(n):
        out = (out << np.uint64(16)) | padded[2 + j:2 + j + len(codes) - 1]
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted hash in the sorted keys, -1 where absent."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)


@dataclass
class KneserNey:
    languages: list
    keys: list  # per order 1..ORDER: sorted n-gram hashes
    logp: list  # per order: [n-grams, languages] interpolated log probability
    contexts: list  # per order 2..ORDER: sorted context hashes
    backoff: list  # per order: [contexts, languages] log weight of the lower order
    floor: float  # log probability of an unseen character
    temperature: float = 1.0
    mean: float = 0.0
    sigma: float = 0.0

    @classmethod
    def train(cls, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> KneserNey:
        """From each language's (packed ORDER-grams, counts)."""
        languages = sorted(counts)
        levels = []  # per language, per order: (packed, count); below the top: distinct left extensions
        for lang in languages:
            packed, n = counts[lang]
            own = [(packed, n.astype(np.float64))]
            for order in range(ORDER - 1, 0, -1):
                packed, left = np.unique(own[0][0] & np.uint64((1 << 16 * order) - 1), return_counts=True)
                own.insert(0, (packed, left.astype(np.float64)))
            levels.append(own)
        vocabulary = len(np.unique(np.concatenate([own[0][0] for own in levels]))) + 1
        model = cls(languages, [], [], [], [], -math.log(vocabulary))
        below = None
        for order in range(1, ORDER + 1):
            union = np.unique(np.concatenate([own[order - 1][0] for own in levels]))
            p = np.empty((len(union), len(languages)))
            if order == 1:
                lower = np.full(p.shape, 1.0 / vocabulary)
            else:
                lower = below[1][_find(below[0], union & np.uint64((1 << 16 * (order - 1)) - 1))]
            heads = np.unique(union >> np.uint64(16))
            weight = np.ones((len(heads), len(languages)))
            for k, own in enumerate(levels):
                packed, n = own[order - 1]
                once, twice = np.count_nonzero(n == 1), np.count_nonzero(n == 2)
                discount = min(0.95, max(0.1, once / max(1, once + 2 * twice)))
                head, where = np.unique(packed >> np.uint64(16), return_inverse=True)
                total, kinds = np.bincount(where, n), np.bincount(where)
                at = _find(heads, head)
                weight[at, k] = discount * kinds / total
                slot = _find(heads, union >> np.uint64(16))
                p[:, k] = weight[slot, k] * lower[:, k]
                p[_find(union, packed), k] += (n - discount) / total[where]
            below = (union, p)
            order_keys = _mix(union)
            by = np.argsort(order_keys)
            model.keys.append(order_keys[by])
            model.logp.append(np.log(p[by]).astype(np.float32))
            head_keys = _mix(heads)
            by = np.argsort(head_keys)
            model.contexts.append(head_keys[by])
            model.backoff.append(np.log(weight[by]).astype(np.float32))
        return model

    def log_probabilities(self, codes: np.ndarray) -> np.ndarray:
        """[positions, languages] for a run of symbols (see ``characters``)."""
        out = np.zeros((len(codes) - 1, len(self.languages)), np.float32)
        left = np.arange(len(out))
        for order in range(ORDER, 0, -1):
            packed = grams(codes, order)[left]
            at = _find(self.keys[order - 1], _mix(packed))
            hit = at >= 0
            out[left[hit]] += self.logp[order - 1][at[hit]]
            left, packed = left[~hit], packed[~hit]
            if not len(left):
                return out
            head = _find(self.contexts[order - 1], _mix(packed >> np.uint64(16)))
            known = head >= 0
            out[left[known]] += self.backoff[order - 1][head[known]]
        out[left] += self.floor
        return out

    def entropy(self, codes: np.ndarray) -> np.ndarray:
        """Cross-entropy in nats a character, per language; long texts in overlapping blocks."""
        block, total = max(4096, (1 << 20) // max(1, len(self.languages))), np.zeros(len(self.languages))
        for a in range(0, len(codes) - 1, block):
            ahead = min(a, ORDER)
            total += self.log_probabilities(codes[a - ahead:a + block + 1])[ahead:].sum(axis=0, dtype=np.float64)
        return -total / (len(codes) - 1)

    def calibrate(self, samples: list[tuple[str, int, list[float]]]) -> None:
        """From (language, characters, entropies) of labelled texts kept out of the counts."""
        if not samples:
            self.mean = math.inf  # nothing to tell what is foreign by
            return
        own = np.array([e[self.languages.index(lang)] for lang, _, e in samples])
        size = np.array([n for _, n, _ in samples], np.float64)
        self.mean = float(np.average(own, weights=size))
        self.sigma = float(np.sqrt(np.mean(size * (own - self.mean) ** 2)))
        right = np.array([self.languages.index(lang) for lang, _, _ in samples])

        def loss(t):
            p = np.array([self.posterior(np.array(e), n, t) for _, n, e in samples])
            return -np.log(np.maximum(p[np.arange(len(p)), right], 1e-9)).mean()
        self.temperature = min((0.5, 1.0, 2.0, 4.0, 8.0, 16.0), key=loss)

    def posterior(self, entropy: np.ndarray, n: int, temperature: float) -> np.ndarray:
        x = -entropy * min(n, SCORE_CHARS) / temperature
        x = np.exp(x - x.max())
        return x / x.sum()

    def predict(self, text: str | None) -> tuple[str, float, float | None, bool]:
        """(language, score, entropy, rejected)."""
        codes = characters(text)
        if not len(codes) or not self.languages:
            return UNKNOWN, 0.0, None, True
        e, n = self.entropy(codes), len(codes) - 1
        best = int(e.argmin())
        limit = self.mean + REJECT_NATS + REJECT_SIGMAS * self.sigma / math.sqrt(n)
        return self.languages[best], float(self.posterior(e, n, self.temperature)[best]), float(e[best]), bool(e[best] > limit)


def held_out(id_col: str = "doc_id"):
    """Rows a model never learns from: crc32 of the id's text divides by FOLDS."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == 0


def sampled(text: str) -> str:
    """The text, or SLICES slices spread evenly from its start to its end if it has more than SAMPLE_BYTES characters."""
    size = SAMPLE_BYTES // SLICES
    if len(text) <= size * SLICES:
        return text
    starts = np.linspace(0, len(text) - size, SLICES).astype(int).tolist()
    return " ".join(text[a:a + size] for a in starts)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> KneserNey:
    """Learn from the text and lang of a bounded sample of the documents that are not held out."""
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)
    rows = (docs.select("doc_id", "text", "lang").where(~held_out() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
            .withColumn("own", F.pmod(F.xxhash64("doc_id", "text", F.lit("calibrate")), F.lit(5)) == 0).withColumn("draw", draw))
    spread = 1 << 62
    # per language its different texts, and the least draw of those that may be counted (null: all are for calibration)
    sizes = {r["lang"]: (r["n"], r["least"], r["first"]) for r in rows.groupBy("lang").agg(
        F.approx_count_distinct("draw").alias("n"), F.min(F.when(~F.col("own"), F.col("draw"))).alias("least"), F.min("draw").alias("first")).collect()}
    if not sizes:
        return KneserNey([], [], [], [], [], 0.0)
    share = {lang: max(int(spread * min(1.0, sample_docs / max(1, n))), 1 + (first if least is None else least))
             for lang, (n, least, first) in sorted(sizes.items())}
    counted = {lang: least is not None for lang, (_, least, _) in sorted(sizes.items())}
    in_map = lambda m: F.create_map(*[F.lit(x) for pair in m.items() for x in pair])[F.col("lang")]
    sample = (rows.where(F.col("draw") < in_map(share)).withColumn("own", F.col("own") & in_map(counted))
              .dropDuplicates(["lang", "draw"]))  # a hot text counts once

    def count(batches):
        seen: dict = {}
        for batch in batches:
            for text, lang in zip(strings(batch, "text"), strings(batch, "lang")):
                codes = characters(sampled(text))
                if len(codes):
                    seen.setdefault(lang, []).append(grams(codes, ORDER))
        for lang, parts in seen.items():
            packed, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(packed), pa.string()), pa.array(packed.view(np.int64)),
                                              pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    table = (map_arrow(sample.where("NOT own").select("text", "lang"), count, "lang string, gram bigint, n bigint")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow())  # bounded by the sample
    lang = np.array(table.column("lang").to_pylist(), object)
    gram, n = table.column("gram").to_numpy().view(np.uint64), table.column("n").to_numpy()
    counts = {}
    for name in sorted(set(lang.tolist())):
        own = np.flatnonzero(lang == name)
        own = own[np.argsort(gram[own])]
        counts[name] = (gram[own], n[own])
    if not counts:
        return KneserNey([], [], [], [], [], 0.0)
    model = KneserNey.train(counts)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def entropies(batches):
        for batch in batches:
            out = [(lang, len(c) - 1, shared.value.entropy(c).tolist()) for text, lang in zip(strings(batch, "text"), strings(batch, "lang"))
                   if len(c := characters(sampled(text))) and lang in shared.value.languages]
            yield pa.RecordBatch.from_pylist([{"lang": a, "n": b, "e": c} for a, b, c in out],
                                             schema=pa.schema([("lang", pa.string()), ("n", pa.int64()), ("e", pa.list_(pa.float64()))]))

    kept = map_arrow(sample.where("own").select("text", "lang"), entropies, "lang string, n bigint, e array<double>")
    model.calibrate(sorted((r["lang"], r["n"], list(r["e"])) for r in kept.collect()))  # about a fifth of the sample
    return model


def identify(docs: DataFrame, model: KneserNey) -> DataFrame:
    """doc_id, held_out, lang_pred, score, entropy, rejected of every document, without a shuffle."""
    src = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        for batch in batches:
            out = [shared.value.predict(t) for t in strings(batch, "text")]
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(
                cols, (pa.string(), pa.float64(), pa.float64(), pa.bool_())))], names=["doc_id", "lang_pred", "score", "entropy", "rejected"])

    kind = dict(src.dtypes)["doc_id"]
    out = map_arrow(src, predict, f"doc_id {kind}, lang_pred string, score double, entropy double, rejected boolean")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "entropy", "rejected")


def keep_identified(docs: DataFrame, model: KneserNey) -> DataFrame:
    """The rows of ``docs`` in a language the model knows, all columns kept, without a shuffle."""
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches):
        for batch in batches:
            good = [not shared.value.predict(t)[3] for t in strings(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(good, pa.bool_()))], names=["row"])

    return map_arrow(src, keep, f"row {src.schema['row'].dataType.simpleString()}").select("row.*")
