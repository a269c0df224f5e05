"""Near-duplicates by bottom-k MinHash sketches, linked exactly.

One hash function gives each document's set of word shingles; the sketch is its K
smallest values. Documents of one set collapse into a class first, so exact copies
cost one row each. Inverted lists of the retained values then gather the classes that can
be similar. Two sets of Jaccard similarity >= 0.75 share at least NEEDED of their K values
(missed with a probability under 1e-7), so a class that shares fewer with all others leaves, and
with the values in one global order (rarest first) two similar classes meet in the first
K - NEEDED + 1 of them: passages that many documents hold stay out of the lists.

Classes that meet in a list form a candidate group (each list adds a star, not its pairs; the
stars' components are the groups). A group's full sets are compared block by block:
a group of m classes is dealt into tasks of at most two blocks, the union sketches' estimate
leaves out what cannot be similar, and the exact intersection of the rest decides. A task passes on
a spanning forest of its exact links, which keeps every connection; the components of
all forests are the result. No task or driver holds a group or a list whole.

Defined results: texts without words have an empty set and link with nothing (component: their own id);
fewer than five words are one shingle; repeated rows and equal ids are documents of their own with that id;
a null id never names a component unless all its ids are null; an empty table stays empty; other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import byte_texts, map_arrow
from kestrel.llm.shingles import shingle_set
from kestrel.session import materialize

K, THRESHOLD, NEEDED = 48, 0.75, 0.375
#: Rows and bytes of one block of a candidate group.
BLOCK_ROWS, BLOCK_BYTES = 512, 8 << 20
#: Tasks over which the edges of one node are dealt.
SALTS = 8
#: Bits of the filter that keeps texts out of shuffles they need not enter.
BITMAP_BITS = 1 << 27


def _digest(s: np.ndarray) -> bytes | None:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _sketched(batches):
    part, nth = TaskContext.get().partitionId(), 0
    for batch in batches:
        sets = [shingle_set(t) for t in byte_texts(batch, "text")]
        rows = [(part << 40) | (nth + i) for i in range(len(sets))]
        nth += len(sets)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(rows, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
             pa.array([_digest(s) for s in sets], pa.binary()),
             pa.array([s[:K].view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["doc_id", "row", "n", "digest", "sketch"])


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """``edges`` (u, v) with the ``m`` that ``least`` gives for u. The edges of a node are dealt over
    SALTS tasks by v and the one row of ``least`` goes to each, so a hub is no hot spot."""
    dealt = edges.withColumn("s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return dealt.join(least.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["u", "s"]).drop("s")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the connected components of ``edges`` (a, b: long), root the smallest
    node: alternating large-star and small-star steps, each written once; partial
    minima before every shuffle and salted joins, so a node of many edges is no hot spot."""
    e = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = materialize(_with_least(both.where("v > u"), low).select(F.col("v").alias("u"), F.col("m").alias("v"))
                            .where("u <> v").distinct(), "cc")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        e = materialize(_with_least(large, least).where("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                        .unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "cc")
        now = e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        if now == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def candidate_groups(reps: DataFrame) -> DataFrame:
    """(node, root): the classes that can have a similar one, by candidate group."""
    values = reps.select("node", F.size("sketch").alias("k"), F.explode("sketch").alias("value"))
    common = values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    shared = (values.join(common, "value").groupBy("node")
              .agg(F.first("k").alias("k"), F.sort_array(F.collect_list(F.struct("df", "value"))).alias("own")))  # at most K each
    need = F.greatest(F.lit(1), F.floor(F.col("k") * NEEDED)).cast("int")
    prefix = (shared.withColumn("need", need).where("size(own) >= need")
              .select("node", F.explode(F.expr("slice(own, 1, size(own) - need + 1)")).alias("o"))
              .select("node", F.col("o.value").alias("value")))
    prefix = materialize(prefix, "prefix")
    first = prefix.groupBy("value").agg(F.min("node").alias("a"))
    stars = prefix.join(first, "value").select("a", F.col("node").alias("b")).where("a <> b").distinct()
    leaves = components(stars)
    return leaves.unionByName(leaves.select(F.col("root").alias("node"), "root").distinct())


def _sets(batches):
    for batch in batches:
        sets = [shingle_set(t) for t in byte_texts(batch, "text")]
        yield pa.RecordBatch.from_arrays([pa.array([_digest(s) for s in sets], pa.binary()),
                                          pa.array([s.tobytes() for s in sets], pa.binary())], names=["digest", "shingles"])


def _with_digest(batches):
    for batch in batches:
        digests = [_digest(shingle_set(t)) for t in byte_texts(batch, "text")]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.binary())], names=["row", "digest"])


def id_bitmap(ids: DataFrame, column: str) -> np.ndarray:
    """A bitmap of BITMAP_BITS (16 MB) of the hashes of the ids, the same at every size. It decides nothing: rows it lets pass
    still meet an exact join; the more ids there are, the more rows pass (one in eight at 17 million, 63 % at 134 million)."""
    at = F.pmod(F.xxhash64(column), F.lit(BITMAP_BITS))
    words = (ids.select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{column}`), 64) as int))").alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(BITMAP_BITS // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out


def map_inside(df: DataFrame, id_col: str, bitmap: np.ndarray, columns: list, fn, schema: str, inside: bool = True) -> DataFrame:
    """``fn`` on the batches of ``columns`` of those rows of ``df`` whose id may be (``inside``) or surely is not in the bitmap,
    without a shuffle. Rows are chosen and mapped in one Python step: of two in a row, each task holds a worker for either."""
    src = df.select(*columns, F.xxhash64(id_col).alias("_id_hash"))
    shared = df.sparkSession.sparkContext.broadcast(bitmap)

    def chosen(batches):
        for batch in batches:
            last = batch.num_columns - 1
            at = batch.column(last).to_numpy() & (64 * len(shared.value) - 1)
            hit = (shared.value[at >> 6] >> (at & 63)) & 1 == 1
            yield batch.select(list(range(last))).filter(pa.array(hit == inside))

    return map_arrow(src, lambda batches: fn(chosen(batches)), schema)


def _whole_row(df: DataFrame):
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def split_rows(df: DataFrame, id_col: str, bitmap: np.ndarray, inside: bool) -> DataFrame:
    """The rows of ``df`` whose id may be (``inside``) or surely is not in the bitmap, without a shuffle."""
    row = _whole_row(df)
    kind = df.select(row).schema["row"].dataType.simpleString()
    return map_inside(df, id_col, bitmap, [row], lambda batches: batches, f"row {kind}", inside).select("row.*")


def _incidence(sets: list[np.ndarray], values: np.ndarray) -> np.ndarray:
    out = np.zeros((len(sets), len(values)), np.float32)
    for i, s in enumerate(sets):
        at = np.searchsorted(values, s)
        at[at == len(values)] = 0
        out[i, at[values[at] == s]] = 1
    return out


def overlaps(a: list[np.ndarray], b: list[np.ndarray], step: int = 4096) -> np.ndarray:
    """Intersection sizes of every set of ``a`` with every set of ``b``, exact."""
    both = np.intersect1d(np.concatenate(a), np.concatenate(b)) if a and b else np.empty(0, np.uint64)
    out = np.zeros((len(a), len(b)), np.float32)
    for i in range(0, len(both), step):
        part = both[i:i + step]
        lo, hi = part[0], part[-1]
        cut = [[s[np.searchsorted(s, lo):np.searchsorted(s, hi, side="right")] for s in sets] for sets in (a, b)]
        out += _incidence(cut[0], part) @ _incidence(cut[1], part).T
    return out


def exact_links(a: list[np.ndarray], b: list[np.ndarray], same: bool) -> np.ndarray:
    """[(i, j)] with similarity >= THRESHOLD (i < j if ``same``). First the union sketch: of
    the K smallest values of the union, the share both hold must allow the threshold; only rows and
    columns with such a pair are intersected whole."""
    sketch = overlaps([s[:K] for s in a], [s[:K] for s in b])
    size = np.minimum([[min(len(s), K)] for s in a], [[min(len(s), K) for s in b]])
    # both sketches' common values bound from above those among the K smallest of the union: what fewer share cannot reach the estimate
    maybe = sketch >= np.maximum(1, np.floor(size * NEEDED))
    if same:
        maybe &= np.tri(len(a), dtype=bool).T & ~np.eye(len(a), dtype=bool)
    rows, cols = np.flatnonzero(maybe.any(1)), np.flatnonzero(maybe.any(0))
    if not len(rows):
        return np.empty((0, 2), np.int64)
    left, right = [a[i] for i in rows], [b[j] for j in cols]
    inter = overlaps(left, right).astype(np.int64)
    union = np.array([[len(s)] for s in left]) + np.array([[len(s) for s in right]]) - inter
    i, j = np.nonzero((100 * inter >= round(100 * THRESHOLD) * union) & maybe[np.ix_(rows, cols)])
    return np.c_[rows[i], cols[j]]


def _forest(nodes: list[int], links) -> list[tuple[int, int]]:
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in links:
        p, q = find(x), find(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _compare(table: pa.Table) -> pa.Table:
    """One pair of blocks of a group: a spanning forest of its exact links."""
    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    node, block = table.column("node").to_pylist(), table.column("block").to_pylist()
    sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
    a = [i for i, x in enumerate(block) if x == lo]
    b = [i for i, x in enumerate(block) if x == hi]
    found = exact_links([sets[i] for i in a], [sets[i] for i in b], lo == hi).tolist() if a and b else []
    tree = _forest(node, [(node[a[i]], node[b[j]]) for i, j in found])
    return pa.table({"a": pa.array([x for x, _ in tree], pa.int64()), "b": pa.array([y for _, y in tree], pa.int64())})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, and ``digest`` of the set, for every document."""
    src = docs.select("doc_id", "text")
    kind = dict(src.dtypes)["doc_id"]
    rows = materialize(map_arrow(src, _sketched, f"doc_id {kind}, row bigint, n bigint, digest binary, sketch array<bigint>"), "sketches")
    full = rows.where("n > 0")
    classes = materialize(full.groupBy("digest").agg(F.min("row").alias("node"), F.min("doc_id").alias("doc"), F.count("*").alias("rows"),
                                                     F.first("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    groups = materialize(candidate_groups(classes.select("node", "sketch")), "groups")
    members = groups.join(classes.select("node", "digest", "doc", "n"), "node")
    sizes = (members.groupBy("root").agg(F.count("*").alias("m"), F.sum(8 * F.col("n")).alias("bytes"))
             .select("root", F.ceil(F.greatest(F.col("m") / BLOCK_ROWS, F.col("bytes") / BLOCK_BYTES)).cast("int").alias("blocks")))
    need = materialize(members.join(sizes, "root").select("node", "root", "digest", "doc", "blocks"), "members")
    # the bitmap lets others pass; the join on the digest is exact
    sets = map_inside(src, "doc_id", id_bitmap(need.select("doc").distinct(), "doc"), ["text"], _sets, "digest binary, shingles binary")
    sets = sets.join(need, "digest").dropDuplicates(["digest"])
    dealt = (sets.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("root", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "shingles"))
    links = dealt.groupBy("root", "lo", "hi").applyInArrow(_compare, "a bigint, b bigint")
    linked = components(links)
    linked = linked.unionByName(linked.select(F.col("root").alias("node"), "root").distinct())
    named = linked.join(classes.select("node", "digest", "doc"), "node")
    least = named.groupBy("root").agg(F.min("doc").alias("component"))
    labels = (named.join(least, "root").select("digest", "component")
              .unionByName(classes.join(linked, "node", "left_anti").where("rows > 1").select("digest", F.col("doc").alias("component"))))
    labels = labels.withColumn("known", F.lit(True))
    out = rows.select("doc_id", "n", "digest").join(labels, "digest", "left")
    component = F.when(F.col("known"), F.col("component")).otherwise(F.col("doc_id"))
    return (out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "digest")
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one document of each component, all columns kept. Ids that
    only one row has are settled by an anti join with the dropped ids, which rows outside the
    ids' bitmap pass by; rows that share an id (or have none) are told apart by their sets."""
    marks = materialize(near_duplicates(docs).select("doc_id", "digest", "kept"), "near-marks")
    repeated = materialize(marks.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("_id")), "repeated-ids")
    dropped = materialize(marks.where("NOT kept").select(F.col("doc_id").alias("_id")).unionByName(repeated).distinct(), "dropped-ids")
    bitmap = id_bitmap(dropped, "_id")
    doubtful = split_rows(docs, "doc_id", bitmap, True)
    single = doubtful.join(dropped, doubtful["doc_id"].eqNullSafe(F.col("_id")), "left_anti")
    single = split_rows(docs, "doc_id", bitmap, False).unionByName(single)
    if repeated.isEmpty():
        return single
    row = _whole_row(docs)
    kind = docs.select(row).schema["row"].dataType.simpleString()
    told = map_inside(docs, "doc_id", id_bitmap(repeated, "_id"), [row, "text"], _with_digest, f"row {kind}, digest binary")
    told = told.join(repeated, told["row.doc_id"].eqNullSafe(F.col("_id")), "left_semi")
    good = marks.where("kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    told = told.join(good, told["row.doc_id"].eqNullSafe(F.col("_id")) & told["digest"].eqNullSafe(F.col("_digest")), "left_semi")
    once = told.where("digest IS NOT NULL").groupBy("row.doc_id", "digest").agg(F.min("row").alias("row"))
    return single.unionByName(once.select("row.*")).unionByName(told.where("digest IS NULL").select("row.*"))
