"""Quality rules, token counts, packing and decontamination against plain Python."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import LONG, WEIRD, documents, rows, shingles
from kestrel.llm import decontamination, packing, quality_rules, token_counts

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def slow_repeats(words, width=8):
    windows = [tuple(words[i:i + width]) for i in range(len(words) - width + 1)]
    n, hit = Counter(windows), set()
    for i, w in enumerate(windows):
        if n[w] > 1:
            hit |= set(range(i, i + width))
    return len(hit)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60))
def test_repeated_words_match_brute_force(words):
    assert quality_rules.repeated_words(words) == slow_repeats(words)


def test_measures_of_odd_texts():
    for t in WEIRD:
        m = dict(zip(quality_rules.MEASURES, quality_rules.measure(t and t.encode())))
        text = t or ""
        words = text.encode().split()
        assert m["n_words"] == len(words)
        assert m["word_chars"] == sum(len(w.decode()) for w in words)
        assert m["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        lines = [x for x in text.split("\n") if x.encode().split()]
        assert m["n_dup_lines"] == len(lines) - len(set(lines))
        assert m["n_alpha_words"] == sum(any(c.isascii() and c.isalpha() or ord(c) > 127 for c in w.decode()) for w in words)


def test_ledger_policies_and_ablation(spark):
    good = " ".join(f"word{i}" for i in range(40))
    df = documents(spark, [good, None, "x " * 50, good + " ###" * 20, good.upper(), "\n".join([good] * 3)])
    led = quality_rules.ledger(df)
    got = {r.doc_id: r for r in led.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).collect()}
    assert got[0].fail_bits == 0 and got[1].fail_bits & quality_rules.BIT["few_words"]
    assert got[2].fail_bits & quality_rules.BIT["repeat_words"] and got[3].fail_bits & quality_rules.BIT["symbols"]
    assert got[4].fail_bits == quality_rules.BIT["upper_case"]
    assert led.count() == df.count()
    abl = {r.rule: r for r in quality_rules.ablation(led, quality_rules.STANDARD).collect()}
    bits = [r.fail_bits for r in led.collect()]
    for rule, bit in quality_rules.BIT.items():
        assert abl[rule].failed == sum(b & bit != 0 for b in bits) and abl[rule].only_this == sum(b == bit for b in bits)
    kept = quality_rules.keep_documents(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {0}
    none = documents(spark, [])
    assert quality_rules.ledger(none).count() == 0 and quality_rules.keep_documents(none).count() == 0


def test_token_counts_match_the_library(spark):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    df = documents(spark, WEIRD * 3)
    out = token_counts.token_counts(df, PIECES, limit=5)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and out.count() == df.count()
    texts = {r.doc_id: r.text for r in df.collect() if r.doc_id is not None}
    for r in out.where("doc_id IS NOT NULL").collect():
        t = texts[r.doc_id] or ""
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (len(lib.encode(t)), len(t.encode()), len(lib.encode(t)) > 5), t[:50]
    assert token_counts.token_counts(documents(spark, []), PIECES).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab .▁\n\té漢"), max_size=30))
def test_pre_tokens_count_like_the_whole(text):
    assert sum(token_counts._length(PIECES, p) for p in token_counts.pre_tokens(text)) == len(token_counts._processor(PIECES).encode(text))


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet=st.sampled_from("abZ '.!1é漢 \n\t\x85 \x1c<|>"), max_size=40))
def test_chunked_encoding_equals_the_tokenizer(text):
    enc = _encoder()
    assert np.frombuffer(enc(text), "<u4").tolist() == enc.tok.encode(text, add_special_tokens=False).ids


_ENC = []


def _encoder():
    if not _ENC:
        _ENC.append(packing._Encoder(BPE))
    return _ENC[0]


def slow_best_fit(lengths, capacity):
    bins = []
    for x in sorted(lengths, reverse=True):
        fit = [i for i, free in enumerate(bins) if free >= x]
        if fit:
            i = min(fit, key=lambda j: bins[j])
            bins[i] -= x
        else:
            bins.append(capacity - x)
    return Counter(bins)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 24), max_size=80))
def test_runs_are_best_fit_decreasing(lengths):
    capacity, used = 24, defaultdict(list)
    hist = Counter(lengths)
    placed = Counter()
    for length, lo, hi, first, each, offset in packing.best_fit_runs(hist, capacity):
        for k in range(hi - lo):
            used[first + k // each].append((offset + k % each * length, length))
        placed[length] += hi - lo
    assert placed == hist
    free = Counter()
    for items in used.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        free[capacity - at] += 1
        assert at <= capacity
    assert free == slow_best_fit(lengths, capacity)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(0, 3)), max_size=20), st.integers(0, 40))
def test_tightest_bin(adds, need):
    tree, have = packing.CapacityTree(40), Counter()
    for r, n in adds:
        tree.add(r, n)
        have[r] += n
    assert tree.tightest(need) == min((r for r, n in have.items() if n and r >= need), default=None)


def test_packing_round_trip(spark):
    df = documents(spark)
    out = packing.pack_documents(df, BPE, capacity=64, with_ids=True).collect()
    tok = packing._tokenizer(BPE)
    texts = {r.doc_id: r.text for r in df.collect() if r.doc_id is not None}
    by, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
        sequences[r.sequence_id].append((r.offset, r.length))
        if r.doc_id is not None and r.doc_id != len(WEIRD) - 1:  # that row is there three times
            by[r.doc_id].append(r)
    for i, pieces in by.items():
        pieces.sort(key=lambda r: r.piece)
        assert [r.piece for r in pieces] == list(range(len(pieces))) and all(r.length == 64 for r in pieces[1:])
        ids = [x for r in pieces for x in r.ids]
        assert ids == tok.encode(texts[i] or "", add_special_tokens=False).ids + [2]
        assert [r.start for r in pieces] == np.cumsum([0, *(r.length for r in pieces)])[:-1].tolist()
    for items in sequences.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= 64
    lengths = [r.length for r in out]
    assert len(sequences) == sum(slow_best_fit(lengths, 64).values())
    assert packing.pack_documents(documents(spark, []), BPE).count() == 0


def test_containment_matches_brute_force(spark):
    item = " ".join(f"q{i}" for i in range(40))
    big = " ".join(f"r{i}" for i in range(400))
    damaged = item.split()
    damaged[3] = "other"
    broken = big.split()
    for k in (50, 120, 190, 260, 330):
        broken[k] = "other"
    texts = [f"before {item.upper()} after", " ".join(damaged), " ".join(item.split()[:25]), LONG, "yes", "say yes", None, "",
             f"{LONG} {item} {big}", " ".join(broken), item, item]
    df = documents(spark, texts)
    items = [(0, item), (1, big), (2, "yes"), (3, None), (4, ""), (None, "yes"), (0, item)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = Counter(rows(decontamination.contained_items(df, bench)))
    want = Counter()
    for r in df.collect():
        own = shingles(r.text)
        for i, t in items:
            s = shingles(t)
            if s and 100 * len(s & own) >= 75 * len(s):
                want[(r.doc_id, i, len(s), len(s & own), len(s & own) / len(s))] += 1
    assert got == want and len(want) > 8
    assert Counter(rows(decontamination.contained_items(df, bench, block_shingles=10))) == want  # many blocks
    clean = decontamination.drop_contaminated(df, bench)
    assert clean.columns == df.columns
    bad = {k[0] for k in want}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(r.doc_id) for r in df.collect() if r.doc_id not in bad)
    for d, b in ((documents(spark, []), bench), (df, bench.limit(0))):
        assert decontamination.contained_items(d, b).count() == 0
        assert decontamination.drop_contaminated(d, b).count() == d.count()


@pytest.mark.parametrize("size", [1, 5, 63, 64, 65, 200, 5000])
def test_needed_hits_allow_what_the_threshold_allows(size):
    assert decontamination.needed_hits(size, 0.75) <= max(1, -(-3 * min(size, 64) // 4))


@pytest.mark.parametrize("size", [1, 2, 3, 64, 65, 128, 129, 5000])
def test_size_partitions(size):
    p = decontamination.size_partition(size)
    assert 2 ** p >= size and (size == 1 or 2 ** (p - 1) < size)
    k = decontamination.sketch_size(p)
    assert (k >= size) if size <= 64 else (64 <= k <= 96 and decontamination.needed_hits(size, 0.75) < 0.75 * k)


def test_large_items_match_brute_force(spark):
    """Items of 10 to 5,000 shingles in partitions of their own, contained to 0.7 to 1 in long documents."""
    rng = np.random.default_rng(5)
    words = [[f"w{n}x{i}" for i in range(n + 4)] for n in (10, 64, 65, 130, 200, 700, 5000)]
    filler = [f"f{i}" for i in rng.integers(0, 3000, 4000)]
    texts = [" ".join(filler)]
    for item in words:
        for share in (1.0, 0.9, 0.76, 0.74, 0.6):
            texts.append(" ".join(filler[:300] + item[:4 + round(share * (len(item) - 4))] + filler[300:600]))
    df = documents(spark, texts)
    bench = spark.createDataFrame([(i, " ".join(item)) for i, item in enumerate(words)], "item_id bigint, text string")
    sets = [shingles(" ".join(item)) for item in words]
    own = {r.doc_id: shingles(r.text) for r in df.collect()}
    want = {(d, i, len(s), len(s & t)) for d, t in own.items() for i, s in enumerate(sets) if 100 * len(s & t) >= 75 * len(s)}
    index = decontamination.ItemIndex.build([np.array(sorted(set(range(len(s)))), np.uint64) for s in sets], 0.75)
    assert len(index.partitions) > 4 and sum(len(p.items) for p in index.partitions) == len(words)
    for block in (decontamination.BLOCK_SHINGLES, 1000):
        got = [(r.doc_id, r.item_id, r.n_item_shingles, r.n_shared) for r in decontamination.contained_items(df, bench, block_shingles=block).collect()]
        assert len(got) == len(want) and set(got) == want and len(want) >= 3 * len(words)
        clean = {r.doc_id for r in decontamination.drop_contaminated(df, bench, block_shingles=block).collect()}
        assert clean == set(own) - {d for d, *_ in want}
