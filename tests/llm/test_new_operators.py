"""Fingerprints, conversation trie and tokenizer alignment against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import LONG, WEIRD, documents, rows
from kestrel.llm import alignment, fingerprints, prefix_trie

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---------------------------------------------------------------- fingerprints

def slow_sketch(paragraph: bytes) -> np.ndarray:
    out = np.zeros(fingerprints.SKETCH, np.int64)
    data = bytes(7) + paragraph + bytes(7)
    for i in range(len(data) - 7):
        w = int.from_bytes(data[i:i + 8], "little")
        if w:
            h = w * 0x9E3779B97F4A7C15 % 2**64
            h = (h ^ h >> 32) * 0xD6E8FEB86659FD93 % 2**64
            out[h >> 56] += 1 - 2 * (h >> 55 & 1)
    return out


def slow_lanes(text):
    v = np.zeros(fingerprints.LANES, np.uint32)
    for p in (text.encode().split(b"\n") if text else []):
        v[:32] += np.frombuffer(hashlib.shake_128(p).digest(128), "<u4")
        v[32:] += slow_sketch(p).astype(np.uint32)
    return v


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab \né\0", max_size=60), st.randoms())
def test_fingerprint_is_a_sum_over_paragraphs(text, r):
    parts = fingerprints.paragraphs(text)
    v = fingerprints.lanes(parts)
    assert np.array_equal(v, slow_lanes(text))
    assert np.array_equal(fingerprints.decode(fingerprints.encode(v)), v)
    r.shuffle(parts)
    assert np.array_equal(fingerprints.lanes(parts), v)
    if parts:
        assert np.array_equal(fingerprints.lanes(parts[1:]) + fingerprints.lanes(parts[:1]), v)


def test_sketch_blocks_of_a_long_text(monkeypatch):
    text = (LONG[:5000] + "\n") * 3
    whole = fingerprints.lanes(fingerprints.paragraphs(text))
    monkeypatch.setattr(fingerprints, "_BLOCK", 100)
    assert np.array_equal(fingerprints.lanes(fingerprints.paragraphs(text)), whole)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abc\n", max_size=40), st.text(alphabet="abc\n", max_size=40))
def test_edited_vector_is_that_of_the_edited_text(text, follower):
    new = fingerprints.edited(text, follower)
    assert len(new) == len(text) - len(text) // 4 + min(len(follower), len(text) // 4)
    v = fingerprints.lanes(fingerprints.paragraphs(text))
    assert np.array_equal(fingerprints._after_edit(text, v, new), slow_lanes(new))


def slow_edits(docs):
    out, full = [], sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))
    for (i, t), (_, n) in zip(full, full[1:] + full[:1]):
        t, n = t or "", n or ""
        k = len(t) // 4
        new = t[:len(t) - k] + n[:k]
        v = slow_lanes(t)
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), fingerprints.encode(v), fingerprints.encode(slow_lanes(new)),
                    round(fingerprints.likeness(v, slow_lanes(new)), 9), round(fingerprints.likeness(v, slow_lanes(n)), 9)))
    return out


def run_edits(df):
    return [(r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
            for r in fingerprints.edited_fingerprints(df).collect()]


def test_edited_fingerprints_follow_the_id_order(spark):
    r = random.Random(5)
    texts = [t for t in WEIRD if t is not LONG] + [" ".join(r.choices(["alpha", "beta", "gamma", "x\ny"], k=r.randrange(40))) for _ in range(150)]
    docs = [(i * 7 - 300, t) for i, t in enumerate(texts)] + [(None, "no id")]
    r.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(7)
    assert sorted(run_edits(df), key=repr) == sorted(slow_edits(docs), key=repr)
    one = spark.createDataFrame([(3, "only one here")], "doc_id bigint, text string")
    assert run_edits(one) == slow_edits([(3, "only one here")])
    assert run_edits(one.limit(0)) == []


def test_edited_fingerprints_of_repeated_rows_and_ids(spark):
    """Many rows of one id, and a third of all rows equal: every row is there, equal rows follow each other."""
    docs = [(5, "same text of many rows")] * 300 + [(5, f"other {i}") for i in range(100)] + [(i, f"text number {i}") for i in range(500)]
    got = run_edits(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(9))
    assert Counter((g[0], g[1], g[3]) for g in got) == Counter((i, len(t), fingerprints.encode(slow_lanes(t))) for i, t in docs)
    equal = fingerprints.encode(slow_lanes("same text of many rows"))
    assert sum(g[3] == equal and g[6] == 1.0 for g in got) == 299
    extra = documents(spark)
    assert extra.count() == len(run_edits(extra))


def test_edits_apply_to_fingerprints(spark):
    docs = spark.createDataFrame([(1, "a\nb\nc"), (2, ""), (3, None), (4, "keep")], "doc_id bigint, text string")
    edits = [(1, "b", -1), (1, "d", 2), (2, "new", 1), (3, "", 2), (9, "unknown", 1), (4, None, 1)] + [(2, "many", 1), (2, "many", -1)] * 300
    edits = spark.createDataFrame(edits, "doc_id bigint, paragraph string, copies int").repartition(5)
    got = dict(rows(fingerprints.apply_edits(fingerprints.fingerprints(docs), edits)))
    want = {1: "d\nc\nd\na", 2: "new", 3: "\n", 4: "keep"}
    assert got == {k: fingerprints.encode(slow_lanes(t)) for k, t in want.items()}


def test_likeness_tells_edits_from_other_texts(spark):
    got = fingerprints.edited_fingerprints(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    long = [r for r in got if r.n_chars >= 200]
    assert np.mean([r.near_edited > 0.5 for r in long]) > 0.97 and np.median([r.near_next for r in long]) < 0.2
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))


# ---------------------------------------------------------------- trie

def slow_trie(turns, family, most=4):
    own = defaultdict(list)
    for c, n, role, text in turns:
        if c is not None:
            own[c].append((n is not None, n or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in own.items()}
    seqs = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % most if family else 0
        seqs[c] = (own.get(c - c % family, [])[:h] if family else []) + t[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, s in seqs.items():
        ends[tuple(s)].append(c)
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(WORD.findall(p[-1][1])) if p else 0
    sha = lambda p: hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], sha(p)) for p, m in members.items())


def run_trie(spark, turns, family, **extra):
    df = spark.createDataFrame(turns, "conv_id bigint, turn int, role string, text string")
    for c in ("depth", "t0", "block", "level", "k0", "a0", "saved"):
        df = df.withColumn(c, prefix_trie.F.lit("clash"))
    out = prefix_trie.trie(prefix_trie.sequences(df, family=family, **extra))
    return sorted(tuple(r)[:8] for r in out.collect())


def talks(seed, n, longest=20):
    r = random.Random(seed)
    out = []
    for c in range(n):
        for i in range(r.choice([1, 2, 3, r.randrange(1, longest)])):
            out.append((c, i, r.choice(["user", "assistant"]) if r.random() < .2 else "user", r.choice(["hi there", "a b c", "x"])))
    return out


@pytest.mark.parametrize("family", [0, 20])
def test_trie_matches_brute_force(spark, family):
    turns = talks(1, 90, 30) + [(95, None, None, "null turn"), (95, 0, "user", None), (95, 0, "user", None), (None, 1, "user", "no conversation"),
                                (141, 0, "user", "no base"), (143, 0, "user", "x")]
    assert run_trie(spark, turns, family) == slow_trie(turns, family)


def test_trie_of_long_conversations_and_copies(spark):
    r = random.Random(2)
    base = [("user" if i % 2 else "assistant", r.choice(["one two", "three"])) for i in range(150)]
    turns = [(c, i, *t) for c in range(1000, 1012) for i, t in enumerate(base[:150 - 9 * (c % 5)])]
    turns += [(c, i, "user", "same first") for c in range(200) for i in range(1 + c % 2)]  # copies of a hot conversation
    assert run_trie(spark, turns, 0) == slow_trie(turns, 0)
    assert run_trie(spark, turns, 20) == slow_trie(turns, 20)


def test_trie_with_spans_shorter_than_a_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SPAN", 2)
    monkeypatch.setattr(prefix_trie, "RUN", 3)
    turns = talks(3, 30, 60)
    assert run_trie(spark, turns, 20) == slow_trie(turns, 20)


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn int, role string, text string")
    assert prefix_trie.trie(prefix_trie.sequences(empty, family=20)).count() == 0
    assert run_trie(spark, [(None, 1, "user", "x")], 20) == []
    words = {r.text for r in prefix_trie.turn_dictionary(spark.createDataFrame([(1, 0, "u", None), (1, 1, "u", "t")], empty.schema)).collect()}
    assert words == {"", "t"}


# ---------------------------------------------------------------- alignment

def slow_alignment(texts):
    pair = alignment.tokenizer_pair(A, B)
    found = []
    for t in texts:
        a, b = pair.a_ids(" " + (t or "")), pair.b.encode(t or "")
        pa_, pb = [pair.a_bytes[i] for i in a], [pair.b_bytes[i] for i in b]
        if not t or b"".join(pa_) != (" " + t).encode() or b"".join(pb) != (" " + t).encode():
            found.append(None)
            continue
        ends = [dict(zip(np.cumsum([len(x) for x in p]).tolist(), range(len(p)))) for p in (pa_, pb)]
        groups, links, i, j = [], [], 0, 0
        for e in sorted(ends[0].keys() & ends[1].keys()):
            p, q = ends[0][e], ends[1][e]
            groups.append(",".join(map(str, a[i:p + 1])) + "|" + ",".join(map(str, b[j:q + 1])))
            links.append((a[p], b[q]))
            i, j = p + 1, q + 1
        found.append((len(a), len(b), groups, links))
    n = Counter(x for f in found if f for x in f[3])
    top = Counter()
    for (x, y), k in n.items():
        top[y] = max(top[y], k)
    return [(0,) * 6 + ("",) if f is None else
            (f[0], f[1], len(f[2]), len(f[3]), sum(n[x] == top[x[1]] for x in f[3]), sum(n[x] for x in f[3]),
             hashlib.sha256(";".join(f[2]).encode()).hexdigest()) for f in found]


def corpus():
    r = random.Random(4)
    words = ["The", "quick", "éclair", "naïve", "x1y2", "don't", "🙂", "漢字", "foo,bar", "a\nb", "tab\tin", "ünder", "Wörter"]
    texts = [" ".join(r.choices(words, k=r.randrange(1, 30))) for _ in range(60)]
    return [*(t for t in WEIRD if t is not LONG), *texts, *texts[:5] * 3, "<s> special </s> <|endoftext|>", "▁mark", "\n", "  ", LONG[:20_000]]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 5])
def test_alignment_matches_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)
    monkeypatch.setattr(alignment, "HELD", 64)
    texts = corpus()
    got = {r[0]: tuple(r)[1:] for r in alignment.alignment_measures(documents(spark, texts), A, B).dropDuplicates(["doc_id"]).collect() if r[0] is not None}
    want = slow_alignment(texts + [texts[-1]] * 2 + ["a b c d"])  # helpers.documents adds repeated rows and a null id
    assert [got[i] for i in range(len(texts))] == want[:len(texts)]


def test_alignment_keeps_every_row(spark):
    df = documents(spark, ["same words here"] * 50 + [None, ""])
    assert alignment.alignment_measures(df, A, B).count() == df.count()
    assert alignment.alignment_measures(df.limit(0), A, B).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from([" ", "\n", "  ", "\t", " \n", "'s", "▁", "<s>", " ", "\x85", "\x1c"]), st.text(max_size=4)), max_size=12))
def test_chunks_align_as_whole_texts(parts):
    text = "".join(parts).encode("utf-8", "ignore").decode()
    pair = alignment.tokenizer_pair(A, B)
    if text:
        assert pair.align([text]) == [pair.whole(text)]
