"""Language-model scoring by prediction by partial matching over bytes.

Text becomes its words (A-Z lower-cased) joined by one space and closed by an end symbol.
The byte-context trie holds, per context of up to ORDER bytes, how often each byte followed
it in all training texts. A byte is coded in the longest known context; one not seen
there costs an escape (method D: every distinct follower gives up half a count) and is coded in the next
shorter context, where the bytes the longer context had seen are excluded, since they
would have been coded there; after the empty context every other symbol is equally likely.

The pretrained trie is compiled into an automaton: one state per context, and per state and byte
the log10 probability (escapes and exclusions worked in) and the next state. States depend on
the last ORDER bytes only, so texts are scored in blocks side by side, whatever their
length. The automaton holds the STATES most frequent contexts, the bound of its broadcast, and is only a
cache in front of the written table of all contexts: where it is in a context shorter than ORDER, a longer
one may be known there. Of those bytes, the up to RESOLVED commonest (context and byte, a "gram") come from a second broadcast; the
others are kept as (document, gram, times), their distinct ones resolved from the whole table, and the log
probabilities summed per document, so the score is that of the whole trie whatever the sizes of the caches are. Without a
pretrained trie, ``adaptive_code_length`` learns while it codes one document.

The table has one row per gram of each order. Grams are dealt once by the last three bytes of their context: all longer contexts of a
gram then lie in its task, so their counts are sums over sorted runs there, and no order is exploded, shuffled or joined by itself. Orders up
to two are bounded by the alphabet and kept beside the automaton. Grams to resolve are dealt the same way.

The base score needs the count of every word: frequent words come from a broadcast table of
FREQUENT entries, the rest from a join on the word, after summing per document. Words of more than 64 bytes are counted under their SHA-256.

Defined results: null text is empty (one end token); a null id counts as an empty text in the
hold-out rule; repeated rows are scored (and learned from) row by row; without training rows
all counts are 0 and the model is uniform; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import byte_texts, map_arrow
from kestrel.session import materialize

ORDER, STATES, FREQUENT = 5, 65_536, 50_000
#: Grams of the second broadcast (12 bytes each), and rows that a task takes together (whole buckets of grams).
RESOLVED, TOGETHER = 1 << 20, 1 << 20
#: Context bytes by which grams are dealt over tasks.
DEALT = 3
FOLDS, HELD = 7, 2
END, SPACE = 10, 32
#: Bytes that can follow: white space other than the separator cannot, and END closes the text.
SYMBOLS = np.array([b for b in range(256) if b not in (9, 11, 12, 13)], np.int64)
_BLOCK = 256


def canonical(text: bytes | None) -> bytes:
    """The byte sequence that is scored; one per token sequence."""
    return b" ".join((text or b"").lower().split()) + bytes([END])


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % FOLDS == HELD


def _masked(context, order):
    return context & ((1 << 8 * order) - 1)


def packed_grams(sequences: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (ORDER context bytes, next byte) of the sequences and their counts; END stands before a text."""
    lead = bytes([END]) * ORDER
    data = np.frombuffer(b"".join(lead + s for s in sequences), np.uint8)
    ends = np.cumsum([len(s) + ORDER for s in sequences])
    own = np.ones(len(data), bool)
    for j in range(ORDER):
        own[np.r_[0, ends[:-1]] + j] = False
    at = np.flatnonzero(own)
    key = np.zeros(len(at), np.int64)
    for j in range(ORDER + 1):
        key = (key << 8) | data[at - ORDER + j]
    return np.unique(key, return_counts=True)


def _counted(batches):
    """(gram, n) of a task's texts; partial sums are passed on whenever they outgrow a million."""
    keys, sums, held, size = [], [], [], 0

    def fold():
        k, n = packed_grams(held)
        keys.append(k)
        sums.append(n)
        distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
        keys[:], sums[:] = [distinct], [np.bincount(where, np.concatenate(sums)).astype(np.int64)]
        held.clear()

    def rows():
        for a in range(0, len(keys[0]), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(keys[0][a:a + 100_000]), pa.array(sums[0][a:a + 100_000])], names=["gram", "n"])

    for batch in batches:
        for text in byte_texts(batch, "text"):
            held.append(canonical(text))
            size += len(held[-1])
            if size > 4 << 20:
                fold()
                size = 0
        if keys and len(keys[0]) > 1_000_000:
            yield from rows()
            keys, sums = [], []
    if held:
        fold()
    if keys:
        yield from rows()


@dataclass
class Automaton:
    """logp[state, column] and follow[state, column]; state 0 is the empty context. ``columns`` gives
    a byte's column; all bytes that training never saw share one. The last column is padding: it
    costs nothing and leads nowhere. Per state: its order, the sum and number of its followers' counts and the
    escape probability; ``cells`` (sorted state * columns + column) and ``cell_n`` are the counts
    themselves. ``whole``: no context of the training texts is missing."""
    logp: np.ndarray
    follow: np.ndarray
    columns: np.ndarray
    order: np.ndarray
    total: np.ndarray
    kinds: np.ndarray
    free: np.ndarray
    cells: np.ndarray
    cell_n: np.ndarray
    whole: bool = True

    def scores(self, sequences: list[bytes]) -> np.ndarray:
        """log10 probability of each sequence in the contexts held here."""
        return self.known(sequences, np.zeros(len(self.order), bool))[0]

    def known(self, sequences: list[bytes], short: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """log10 probability of each sequence without the bytes for which a longer context may be known
        (coded in a state that is ``short``), all of them block by block in parallel; and those
        bytes: (sequence, gram, times)."""
        if short is None:
            short = (self.order < ORDER) & (not self.whole)
        lead = bytes([END]) * ORDER
        raw = np.frombuffer(b"".join(lead + s for s in sequences), np.uint8)
        data = self.columns[raw]
        size = np.array([len(s) for s in sequences])
        first = np.r_[0, np.cumsum(size + ORDER)[:-1]]  # of each text's lead
        blocks = -(-size // _BLOCK)
        doc = np.repeat(np.arange(len(size)), blocks)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin, left = first[doc] + nth * _BLOCK, np.minimum(_BLOCK, size[doc] - nth * _BLOCK)
        width, logp, follow = self.logp.shape[1], self.logp.ravel(), self.follow.ravel()
        total, last = np.zeros(len(doc)), len(data) - 1
        state = np.zeros(len(doc), np.int64)
        open_doc, open_at, any_short = [], [], bool(short.any())
        for step in range(ORDER + int(left.max(initial=0))):
            column = data[np.minimum(begin + step, last)].astype(np.int64)
            if step >= ORDER:
                column[step - ORDER >= left] = width - 1
            cell = state * width + column
            if step >= ORDER:
                cost = logp[cell]
                if any_short:
                    at = np.flatnonzero(short[state])
                    at = at[step - ORDER < left[at]]
                    cost[at] = 0
                    open_doc.append(doc[at])
                    open_at.append(begin[at] + step)
                total += cost
            state = follow[cell].astype(np.int64)
        who, at = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (open_doc, open_at))
        gram = np.zeros(len(at), np.int64)
        for j in range(ORDER + 1):
            gram = (gram << 8) | raw[at - ORDER + j]
        by = np.lexsort((gram, who))
        who, gram = who[by], gram[by]
        head = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (gram[1:] != gram[:-1])][:len(who)])
        return np.bincount(doc, total, minlength=len(size)), who[head], gram[head], np.diff(np.r_[head, len(who)])

    def reached(self, grams: np.ndarray) -> np.ndarray:
        """The state in which the last byte of each gram is coded."""
        state = np.zeros(len(grams), np.int64)
        for j in range(ORDER, 0, -1):
            state = self.follow[state, self.columns[(grams >> 8 * j) & 255]].astype(np.int64)
        return state

    def resolved(self, grams: np.ndarray, levels: dict[int, tuple[np.ndarray, ...]]) -> np.ndarray:
        """log10 probability of each gram's last byte, given per order what the whole table says of its context:
        (count of the byte, sum and number of the followers' counts, sum of the shorter context's counts
        over these followers), the sum 0 where the context is unknown."""
        state, alphabet, width = self.reached(grams), len(SYMBOLS), self.logp.shape[1]
        column = self.columns[grams & 255].astype(np.int64)
        order = self.order[state]
        p = 10.0 ** self.logp[state, column].astype(np.float64)
        below = p / np.maximum(self.free[state], 1e-300)  # of a byte not seen in the context reached
        n, total, kinds = np.zeros(len(grams)), self.total[state], self.kinds[state]
        if len(self.cells):
            cell = state * width + column
            at = np.minimum(np.searchsorted(self.cells, cell), len(self.cells) - 1)
            n = np.where(self.cells[at] == cell, self.cell_n[at], 0.0)
        for level in range(1, ORDER + 1):
            own_n, own_total, own_kinds, excluded = levels[level]
            on = (level > order) & (own_total > 0)
            coded, escape = _coded(n, total - excluded, kinds - own_kinds, kinds == alphabet)
            rest = np.where(n > 0, coded, escape * below)
            own, free = _coded(own_n, own_total, own_kinds, own_kinds == alphabet)
            p = np.where(on, np.where(own_n > 0, own, free * rest), p)
            below = np.where(on, rest, below)
            n, total, kinds = np.where(on, own_n, n), np.where(on, own_total, total), np.where(on, own_kinds, kinds)
        return np.log10(np.maximum(p, 1e-37))


def _coded(n, total, kinds, complete):
    """Method D: probability of a symbol seen ``n`` times, and of the escape."""
    size = np.maximum(2 * total, 1)
    return np.where(complete, n / np.maximum(total, 1), (2 * n - 1) / size), np.where(complete, 0.0, np.where(kinds == 0, 1.0, kinds / size))


def compile_trie(nodes: list[tuple[int, int]], counts: tuple[np.ndarray, np.ndarray, np.ndarray], whole: bool = True) -> Automaton:
    """From the kept contexts (order, packed bytes), closed under prefix and suffix, and their
    (node, symbol, n); ``whole``: all contexts are kept."""
    nodes = nodes or [(0, 0)]
    who, symbol, n = counts
    seen_bytes, alphabet = np.unique(symbol), len(SYMBOLS)
    columns = np.full(256, len(seen_bytes), np.uint16)
    columns[seen_bytes] = np.arange(len(seen_bytes))
    width = len(seen_bytes) + 1
    cells = who * (width + 1) + columns[symbol]
    by = np.argsort(cells)
    nodes_at = {x: i for i, x in enumerate(nodes)}
    order = np.array([o for o, _ in nodes])
    parent = np.array([nodes_at[(o - 1, _masked(c, o - 1))] if o else 0 for o, c in nodes])
    count = np.zeros((len(nodes), width), np.float32)
    count[who, columns[symbol]] = n
    logp = np.zeros((len(nodes), width + 1), np.float32)
    follow = np.zeros((len(nodes), width + 1), np.uint16 if len(nodes) <= 65_536 else np.int32)
    free = np.empty((len(nodes), 1))  # escape probability of a context with nothing excluded
    for level in range(ORDER + 1):
        at_level = np.flatnonzero(order == level)
        for rows in np.array_split(at_level, len(at_level) // 2048 + 1):
            own = count[rows].astype(np.float64)
            seen = own > 0
            kinds = seen.sum(1, keepdims=True)
            p, free[rows] = _coded(own, own.sum(1, keepdims=True), kinds, kinds == alphabet)
            if level == 0:
                rest = 1.0 / np.maximum(alphabet - kinds, 1)
            else:  # the shorter context without the symbols seen here, then what lies below it
                up = parent[rows]
                other = np.where(seen, 0.0, count[up].astype(np.float64))
                o_kinds = (other > 0).sum(1, keepdims=True)
                coded, escape = _coded(other, other.sum(1, keepdims=True), o_kinds, o_kinds + kinds == alphabet)
                below = 10.0 ** logp[up, :width].astype(np.float64) / np.maximum(free[up], 1e-300)
                rest = np.where(other > 0, coded, escape * below)
            logp[rows, :width] = np.log10(np.maximum(np.where(seen, p, free[rows] * rest), 1e-37))
    for level in range(ORDER + 1):
        rows = np.flatnonzero(order == level)
        if level:
            follow[rows, :width] = follow[parent[rows], :width]
        for i in np.flatnonzero(order == level + 1).tolist():
            before = nodes_at.get((level, nodes[i][1] >> 8))
            if before is not None:
                follow[before, columns[nodes[i][1] & 255]] = i
    return Automaton(logp, follow, columns, order, np.bincount(who, n, len(nodes)), np.bincount(who, minlength=len(nodes)).astype(float),
                     free[:, 0], cells[by], n[by].astype(float), whole)


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, with the sums of their counts."""
    by = np.argsort(keys, kind="stable")
    keys, n = keys[by], n[by]
    head = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]][:len(keys)])
    return keys[head], np.add.reduceat(n, head) if len(head) else n[:0]


@dataclass
class Level:
    """The contexts of one order: ``keys`` (context << 8 | byte, sorted) with counts ``n``; and per context the sum and
    number of its followers' counts."""
    keys: np.ndarray
    n: np.ndarray

    def __post_init__(self):
        context = self.keys >> 8
        self.head = np.flatnonzero(np.r_[True, context[1:] != context[:-1]][:len(context)])
        self.contexts = context[self.head]
        self.total = np.add.reduceat(self.n, self.head) if len(self.head) else self.n[:0]
        self.kinds = np.diff(np.r_[self.head, len(context)])

    def shorter(self, order: int) -> Level:
        """The level of the next lower order, if all its grams are here."""
        return Level(*_summed(_masked(self.keys, order), self.n))

    def excluded(self, below: Level, order: int) -> np.ndarray:
        """Per context: the sum of the next shorter context's counts over its followers."""
        at = np.searchsorted(below.keys, _masked(self.keys, order))
        return np.add.reduceat(below.n[at], self.head) if len(self.head) else self.n[:0]

    def of(self, grams: np.ndarray, order: int, excluded: np.ndarray) -> tuple[np.ndarray, ...]:
        """What ``Automaton.resolved`` needs of this order."""
        at, found = _at(self.contexts, _masked(grams >> 8, order))
        key, known = _at(self.keys, _masked(grams, order + 1))
        pick = lambda x, i, ok: np.where(ok, x[i], 0).astype(float) if len(x) else np.zeros(len(grams))
        return pick(self.n, key, known), pick(self.total, at, found), pick(self.kinds, at, found), pick(excluded, at, found)


def _at(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
    return at, keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)


def _whole_buckets(batches):
    """The columns of rows sorted by their first column (bucket), some TOGETHER rows at a time, no bucket cut."""
    held, size, enough = [], 0, TOGETHER
    for batch in batches:
        held.append([c.to_numpy() for c in batch.columns])
        size += batch.num_rows
        if size >= enough:
            cols = [np.concatenate(c) for c in zip(*held)]
            cut = int(np.searchsorted(cols[0], cols[0][-1]))
            if cut:
                yield [c[:cut] for c in cols]
            held, size = [[c[cut:] for c in cols]], len(cols[0]) - cut
            enough = max(TOGETHER, 2 * size)
    if size:
        yield [np.concatenate(c) for c in zip(*held)]


def _dealt(grams: DataFrame) -> DataFrame:
    """Rows (gram, n) in the order of their bucket, the last DEALT bytes of the context; a bucket lies in one task."""
    bucket = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * DEALT) - 1))
    return grams.select(bucket.alias("bucket"), "gram", "n").repartition("bucket").sortWithinPartitions("bucket")


def _levels(batches):
    """Rows of the context table from whole buckets: all of order DEALT and above, and partial sums of the order below."""
    for _, gram, n in _whole_buckets(batches):
        level = Level(*_summed(gram, n))
        for order in range(ORDER, DEALT - 2, -1):
            total = np.zeros(len(level.keys), np.int64)
            if order >= DEALT:
                total[level.head] = level.total
            for a in range(0, len(total), 100_000):
                key = level.keys[a:a + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), order, np.int32)), pa.array(key >> 8), pa.array((key & 255).astype(np.int32)),
                     pa.array(level.n[a:a + 100_000]), pa.array(total[a:a + 100_000])], names=["depth", "context", "symbol", "n", "total"])
            level = level.shorter(order)


def context_table(texts: DataFrame) -> DataFrame:
    """(depth, context, symbol, n, total) of the contexts of the training texts, written: whole from order DEALT on, with the
    context's total in its first row (0 in others), and partial rows of order DEALT - 1."""
    grams = map_arrow(texts.select("text"), _counted, "gram bigint, n bigint")
    return materialize(map_arrow(_dealt(grams), _levels, "depth int, context bigint, symbol int, n bigint, total bigint"), "ppm-contexts")


def low_levels(table: DataFrame) -> dict[int, Level]:
    """Orders below DEALT. Their size is bounded by the alphabet, not by the corpus."""
    rows = table.where(F.col("depth") == DEALT - 1).groupBy("context", "symbol").agg(F.sum("n").alias("n")).toArrow()
    level = Level(*_summed(rows.column("context").to_numpy() << 8 | rows.column("symbol").to_numpy(), rows.column("n").to_numpy()))
    out = {DEALT - 1: level}
    for order in range(DEALT - 1, 0, -1):
        out[order - 1] = level = level.shorter(order)
    return out


def train_trie(texts: DataFrame, states: int = STATES) -> Automaton:
    """The automaton of the ``states`` most frequent contexts of the training texts."""
    table = context_table(texts)
    return _front(table, low_levels(table), states)


def _front(table: DataFrame, low: dict[int, Level], states: int) -> Automaton:
    """The driver compiles the ``states`` most frequent contexts (parents and prefixes are at least as
    frequent and shorter, so the set is closed)."""
    kept = (table.where("total > 0").select("depth", "context", "total")
            .orderBy(F.desc("total"), "depth", "context").limit(states + 1).toArrow())
    ranked = [(-t, d, c) for d, c, t in zip(*(kept.column(x).to_pylist() for x in ("depth", "context", "total")))]
    ranked += [(-t, order, c) for order, level in low.items() for c, t in zip(level.contexts.tolist(), level.total.tolist())]
    nodes = [(d, c) for _, d, c in sorted(ranked)]
    whole, nodes = len(nodes) <= states, nodes[:states]
    have = set(nodes)
    nodes = sorted(x for x in nodes if x[0] == 0 or (x[0] - 1, x[1] >> 8) in have)  # a tie at the edge may part a pair
    if not nodes:
        return compile_trie([], (np.empty(0, np.int64),) * 3)
    number = {x: i for i, x in enumerate(nodes)}
    index = table.sparkSession.createDataFrame([(o, c, i) for (o, c), i in number.items() if o >= DEALT], "depth int, context bigint, node int")
    own = table.join(F.broadcast(index), ["depth", "context"]).select("node", "symbol", "n").toArrow()  # <= states * symbols
    cells = [tuple(own.column(c).to_numpy().astype(np.int64) for c in ("node", "symbol", "n"))]
    for order, level in low.items():
        who = np.array([number.get((order, c), -1) for c in (level.keys >> 8).tolist()], np.int64)
        cells.append((who[who >= 0], level.keys[who >= 0] & 255, level.n[who >= 0]))
    return compile_trie(nodes, tuple(np.concatenate(c) for c in zip(*cells)), whole)


def resolve(grams: DataFrame, table: DataFrame, shared) -> DataFrame:
    """(gram, logp) of the distinct ``grams`` by the whole context table; ``shared``: broadcast (automaton, low levels)."""
    def answer(batches):
        model, low = shared.value
        fixed = {k: (low[k], low[k].excluded(low[k - 1], k)) for k in range(1, DEALT)}
        for _, gram, n in _whole_buckets(batches):
            asked = np.unique(gram[n == 0])
            if not len(asked):
                continue
            own = {ORDER: Level(*_summed(gram[n > 0], n[n > 0]))}
            for order in range(ORDER, DEALT, -1):
                own[order - 1] = own[order].shorter(order)
            levels = {k: level.of(asked, k, excluded) for k, (level, excluded) in fixed.items()}
            for k, level in own.items():
                levels[k] = level.of(asked, k, level.excluded(own.get(k - 1) or low[k - 1], k))
            yield pa.RecordBatch.from_arrays([pa.array(asked), pa.array(model.resolved(asked, levels))], names=["gram", "logp"])

    known = table.where(F.col("depth") == ORDER).select(F.shiftleft("context", 8).bitwiseOR(F.col("symbol").cast("bigint")).alias("gram"), "n")
    return map_arrow(_dealt(known.unionByName(grams.select("gram", F.lit(0).cast("bigint").alias("n")))), answer, "gram bigint, logp double")


def _common_grams(table: DataFrame, shared, resolved: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``resolved`` grams that the automaton leaves open, the commonest, with their log probabilities."""
    def open_only(batches):
        model = shared.value[0]
        for batch in batches:
            gram = batch.column(0).to_numpy()
            yield batch.filter(pa.array((model.order[model.reached(gram)] < ORDER) & (not model.whole)))

    own = table.where(F.col("depth") == ORDER).select(F.shiftleft("context", 8).bitwiseOR(F.col("symbol").cast("bigint")).alias("gram"), "n")
    left = materialize(map_arrow(own, open_only, "gram bigint, n bigint"), "open-grams")
    top, least = 1 << 16, None  # the least count from which on at most ``resolved`` grams are taken
    seen = 0
    for r in sorted(left.groupBy(F.least("n", F.lit(top)).alias("n")).count().collect(), key=lambda r: -r["n"]):  # <= top rows
        seen += r["count"]
        if seen > resolved:
            break
        least = r["n"]
    if least is None:
        return np.empty(0, np.int64), np.empty(0)
    found = resolve(left.where(F.col("n") >= least).select("gram"), table, shared).toArrow()
    order = np.argsort(found.column("gram").to_numpy())
    return found.column("gram").to_numpy()[order], found.column("logp").to_numpy()[order].astype(np.float32)


def adaptive_code_length(text: bytes | None, order: int = ORDER) -> float:
    """log10 probability of one text under a trie that starts empty and learns as it codes."""
    trie: dict[bytes, Counter] = {}
    seq, total = canonical(text), 0.0
    data = bytes([END]) * order + seq
    for i in range(order, len(data)):
        symbol, excluded = data[i], set()
        for o in range(order, -1, -1):
            seen = trie.get(data[i - o:i])
            if not seen:
                continue
            own = {s: n for s, n in seen.items() if s not in excluded}
            if not own:
                continue
            size = sum(own.values())
            if symbol in own:
                complete = len(own) + len(excluded) == len(SYMBOLS)
                total += math.log10(own[symbol] / size if complete else (2 * own[symbol] - 1) / (2 * size))
                break
            total += math.log10(len(own) / (2 * size))
            excluded |= own.keys()
        else:
            total -= math.log10(len(SYMBOLS) - len(excluded))
        for o in range(order + 1):
            trie.setdefault(data[i - o:i], Counter())[symbol] += 1
    return total


def _counted_words(text: bytes | None) -> list[bytes]:
    """The text's words as they are counted: one of more than 64 bytes under a hash that no word can be (it starts with white space)."""
    words = (text or b"").lower().split()
    return [w if len(w) <= 64 else b"\v" + hashlib.sha256(w).digest() for w in words] if max(map(len, words), default=0) > 64 else words


def _word_counts(batches):
    seen: Counter = Counter()

    def rows(c):
        words = list(c)
        for a in range(0, len(words), 50_000):
            part = words[a:a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([c[w] for w in part], pa.int64())], names=["word", "n"])

    for batch in batches:
        for text in byte_texts(batch, "text"):
            words = _counted_words(text)
            for a in range(0, len(words), 100_000):
                seen.update(words[a:a + 100_000])
                if len(seen) > 600_000:
                    yield from rows(seen)
                    seen = Counter()
            seen[b"\n"] += 1  # the end: no word holds a line feed
    yield from rows(seen)


def score_documents(docs: DataFrame, states: int = STATES, frequent: int = FREQUENT, resolved: int = RESOLVED) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    src = docs.select("doc_id", "text")
    spark, kind = docs.sparkSession, dict(src.dtypes)["doc_id"]
    learn = src.where(~held_out())
    counts = materialize(map_arrow(learn.select("text"), _word_counts, "word binary, n bigint")
                         .groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    r = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("distinct")).first()
    n_all, norm = r["tokens"], math.log10(r["tokens"] + r["distinct"] + 1)
    top = counts.orderBy(F.desc("n"), "word").limit(frequent).collect()
    shared = spark.sparkContext.broadcast({bytes(x["word"]): math.log10(x["n"] + 1) for x in top})
    table = context_table(learn)
    low = low_levels(table)
    model = spark.sparkContext.broadcast((_front(table, low, states), low))
    common = spark.sparkContext.broadcast(_common_grams(table, model, resolved))

    def score(batches):
        part, nth, look = TaskContext.get().partitionId(), 0, shared.value.get
        for batch in batches:
            rows = {k: [] for k in ("row", "n_tokens", "known", "log_sum", "rare", "rare_n")}
            sequences = []
            for text in byte_texts(batch, "text"):
                words = _counted_words(text)
                sequences.append(canonical(text))
                words.append(b"\n")
                logs = list(map(look, words))
                rare = Counter(w for w, x in zip(words, logs) if x is None) if None in logs else {}
                rows["row"].append((part << 40) | nth)
                rows["n_tokens"].append(len(words))
                rows["known"].append(len(words) - sum(rare.values()))
                rows["log_sum"].append(math.fsum(x for x in logs if x is not None))
                rows["rare"].append(list(rare))
                rows["rare_n"].append(list(rare.values()))
                nth += 1
            types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
            score, ends, gram, times = _scores(model.value[0], sequences, *common.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, t) for v, t in zip(rows.values(), types)), pa.array(score),
                                              pa.ListArray.from_arrays(ends, gram), pa.ListArray.from_arrays(ends, times)],
                                             names=["doc_id", *rows, "score", "gram", "times"])

    facts = materialize(map_arrow(src, score, f"doc_id {kind}, row bigint, n_tokens bigint, known bigint, log_sum double, "
                                  "rare array<binary>, rare_n array<bigint>, score double, gram array<bigint>, times array<int>"), "scored")
    rare = (facts.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("w"))
            .select("row", F.col("w.rare").alias("word"), F.col("w.rare_n").alias("times")))
    rest = (rare.join(counts.withColumnRenamed("n", "c"), "word")
            .groupBy("row").agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("c") + 1)).alias("more_log")))
    out = facts.drop("rare", "rare_n", "gram", "times").join(rest, "row", "left")
    longer = (facts.select("row", F.explode(F.arrays_zip("gram", "times")).alias("g"))
              .select("row", F.col("g.gram").alias("gram"), F.col("g.times").alias("times")))
    known = resolve(longer.select("gram").distinct(), table, model)
    out = out.join(longer.join(known, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("logp")).alias("more_score")), "row", "left")
    return out.select("doc_id", held_out().alias("held_out"), "n_tokens",
                      (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
                      F.lit(n_all).cast("bigint").alias("train_tokens"),
                      (F.col("log_sum") + F.coalesce("more_log", F.lit(0.0)) - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
                      (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))


def _scores(model: Automaton, sequences: list[bytes], common: np.ndarray, logp: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array, pa.Array]:
    """Scores with the ``common`` grams worked in, and per sequence the grams to resolve (list offsets, grams, times); in
    groups of a few MB, so that memory follows the longest text at most."""
    out, group, size, first = [], [], 0, 0
    for i, s in enumerate(sequences, 1):
        group.append(s)
        size += len(s)
        if size > 4 << 20 or i == len(sequences):
            score, who, gram, times = model.known(group)
            at, hit = _at(common, gram)
            if hit.any():
                score = score + np.bincount(who[hit], times[hit] * logp[at[hit]].astype(float), minlength=len(group))
            out.append((score, who[~hit] + first, gram[~hit], times[~hit]))
            first, group, size = i, [], 0
    score, who, gram, times = (np.concatenate(x) for x in zip(*out)) if out else (np.empty(0), *(np.empty(0, np.int64),) * 3)
    ends = np.searchsorted(who, np.arange(len(sequences) + 1)).astype(np.int32)
    return score, pa.array(ends), pa.array(gram), pa.array(times.astype(np.int32))
