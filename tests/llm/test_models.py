"""Language-model scoring and language ID."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from helpers import WEIRD, documents
from kestrel.llm import language_id, ppm

SF = "/root/testdata/sf0.001"


def slow_ppm(training, text):
    """Recursive PPM over the full trie, from the definition."""
    count = defaultdict(Counter)
    for t in training:
        data = bytes([ppm.END]) * ppm.ORDER + ppm.canonical(t)
        for i in range(ppm.ORDER, len(data)):
            for o in range(ppm.ORDER + 1):
                count[data[i - o:i]][data[i]] += 1
    data, total = bytes([ppm.END]) * ppm.ORDER + ppm.canonical(text), 0.0
    for i in range(ppm.ORDER, len(data)):
        out, p = set(), 1.0
        for o in range(ppm.ORDER, -1, -1):
            own = {s: n for s, n in count.get(data[i - o:i], {}).items() if s not in out}
            if not own:
                continue
            size = sum(own.values())
            if data[i] in own:
                p *= (2 * own[data[i]] - 1) / (2 * size)
                break
            p *= len(own) / (2 * size)
            out |= own.keys()
        else:
            p /= len(ppm.SYMBOLS) - len(out)
        total += math.log10(p)
    return total


TRAIN = ["the cat sat on the mat", "The dog sat on the log and the cat ran", "a mat, a log; a cat", "é ü ß"]


def test_automaton_equals_the_definition(spark):
    model = ppm.train_trie(spark.createDataFrame([(t,) for t in TRAIN], "text string"))
    probes = ["the cat", "zebra! 漢", "", "sat on the log " * 60, TRAIN[1]]
    got = model.scores([ppm.canonical(t.encode()) for t in probes])
    for g, t in zip(got, probes):
        assert g == pytest.approx(slow_ppm([x.encode() for x in TRAIN], t.encode()), rel=1e-4)


def test_every_state_is_a_distribution(spark):
    model = ppm.train_trie(spark.createDataFrame([(t,) for t in TRAIN * 3], "text string"))
    unseen = len(ppm.SYMBOLS) - (model.logp.shape[1] - 2)
    p = 10.0 ** model.logp[:, :-1].astype(np.float64)
    assert np.allclose(p[:, :-1].sum(1) + unseen * p[:, -1], 1, atol=1e-5)


def test_a_small_model_keeps_the_trie_closed(spark):
    for states in (1, 2, 7, 30):
        model = ppm.train_trie(spark.createDataFrame([(t,) for t in TRAIN], "text string"), states)
        assert len(model.logp) <= states
        unseen = len(ppm.SYMBOLS) - (model.logp.shape[1] - 2)
        p = 10.0 ** model.logp[:, :-1].astype(np.float64)
        assert np.allclose(p[:, :-1].sum(1) + unseen * p[:, -1], 1, atol=1e-5)


def test_scores_come_from_all_contexts(spark, monkeypatch):
    r = random.Random(5)
    texts = [" ".join(r.choice(TRAIN).split()[r.randrange(3)] + r.choice("abcé") for _ in range(r.randrange(1, 40))) for _ in range(40)]
    texts += ["zq zq! 漢", "the cat sat on the log " * 60, "", *TRAIN]
    df = documents(spark, texts, extra=False)
    rows = df.collect()
    learned = [(x.text or "").encode() for x in rows if zlib.crc32(("" if x.doc_id is None else str(x.doc_id)).encode()) % 7 != 2]
    want = sorted(slow_ppm(learned, (x.text or "").encode()) for x in rows)
    for states, resolved, together in ((1, 50, 10), (40, 0, 1 << 20), (300, 1 << 20, 1), (300, 0, 30), (1_000_000, 1 << 20, 1 << 20)):
        monkeypatch.setattr(ppm, "TOGETHER", together)
        got = sorted(x.score for x in ppm.score_documents(df, states=states, resolved=resolved).collect())
        assert got == pytest.approx(want, rel=1e-4), (states, resolved)


def test_adaptive_mode_learns_as_it_codes():
    once, many = ppm.adaptive_code_length(b"some words here"), ppm.adaptive_code_length(b"some words here " * 20)
    assert many > 20 * once / 3 and ppm.adaptive_code_length(None) == pytest.approx(-math.log10(len(ppm.SYMBOLS)))


def test_scores_of_odd_documents(spark):
    df = documents(spark, WEIRD)
    out = ppm.score_documents(df, frequent=5)
    got = out.collect()
    assert len(got) == df.count()
    learned, held = Counter(), {}
    for r in df.collect():
        held[r.doc_id] = zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 7 == 2
        if not held[r.doc_id]:
            learned.update((r.text or "").encode().lower().split())
            learned[b"\n"] += 1
    n, v = sum(learned.values()), len(learned)
    texts = {r.doc_id: r.text for r in df.collect()}
    for r in got:
        assert r.held_out == held[r.doc_id] and r.train_tokens == n and r.score < 0
        if r.doc_id is None:
            continue
        words = (texts[r.doc_id] or "").encode().lower().split() + [b"\n"]
        assert r.n_tokens == len(words) and r.n_known == sum(learned[w] > 0 for w in words)
        assert r.base_score == pytest.approx(sum(math.log10((learned[w] + 1) / (n + v + 1)) for w in words))
    assert ppm.score_documents(documents(spark, [])).count() == 0
    only_held = df.where("doc_id = 2")
    assert {r.train_tokens for r in ppm.score_documents(only_held).collect()} <= {0, 1}


def test_kneser_ney_is_a_distribution():
    texts = {"en": "the cat sat on the mat and the dog ran to the log", "de": "der hund lief und die katze sass auf der matte"}
    counts = {}
    for lang, t in texts.items():
        packed, n = np.unique(language_id.grams(language_id.characters(t), language_id.ORDER), return_counts=True)
        counts[lang] = (packed, n)
    model = language_id.KneserNey.train(counts)
    letters = sorted({int(c) for t in texts.values() for c in language_id.characters(t)})
    for context in ("the", "xyz", "at ", "un"):
        head = language_id.characters(context)[1:-1]
        p = [model.log_probabilities(np.r_[np.uint16(32), head, np.uint16(c)])[-1] for c in letters]
        total = np.exp(np.array(p, np.float64)).sum(0) + np.exp(np.float64(model.floor)) * 0
        assert np.all(total < 1 + 1e-4) and np.all(total > 0.8)


def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.train(docs)
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert len(held) > 20 and np.mean([got[i].lang_pred == truth[i] for i in held]) >= 0.95
    assert all(0 <= r.score <= 1 for r in got.values()) and np.mean([r.rejected for r in got.values()]) < 0.01
    odd = documents(spark, ["漢字" * 200, "1234 !!", None, "", "ζωη και φως " * 30, docs.first().text, "x" * 300_000])
    out = {r.doc_id: r for r in language_id.identify(odd, model).collect()}
    assert out[0].rejected and out[4].rejected and not out[5].rejected
    for i in (1, 2, 3):
        assert (out[i].lang_pred, out[i].score, out[i].rejected) == ("und", 0.0, True)
    kept = language_id.keep_identified(odd, model)
    assert kept.columns == odd.columns and 5 in {r.doc_id for r in kept.collect()}


def test_language_id_without_labels(spark):
    df = documents(spark, ["some text here", None])
    from pyspark.sql import functions as F
    for docs in (df.withColumn("lang", F.lit(None).cast("string")), documents(spark, [])):
        model = language_id.train(docs)
        assert all(r.lang_pred == "und" and r.rejected for r in language_id.identify(docs, model).collect())


EN, DE = "the cat sat on the mat and the dog ran to the house ", "der hund lief und die katze sass auf der matte im haus "


def test_languages_of_long_texts_are_learned(spark):
    texts = [(i, (EN if i % 2 else DE) * 500, "en" if i % 2 else "de") for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, lang string")
    model = language_id.train(docs)
    assert model.languages == ["de", "en"]
    for r in language_id.identify(docs, model).collect():
        assert r.lang_pred == texts[r.doc_id][2] and not r.rejected
    text = "a" * 30_000 + "b" * 30_000 + "c" * 30_000
    assert len(language_id.sampled(text)) <= language_id.SAMPLE_BYTES + language_id.SLICES and set(language_id.sampled(text)) == set("abc ")


def test_a_language_with_one_text_is_learned_in_either_fold(spark):
    many = [(i, EN * 3, "en") for i in range(60)]
    for only in range(1000, 1040):
        if zlib.crc32(str(only).encode()) % language_id.FOLDS == 0:
            continue
        docs = spark.createDataFrame([*many, (only, DE * 3, "de")], "doc_id bigint, text string, lang string")
        own = docs.where(f"doc_id = {only} AND pmod(xxhash64(doc_id, 'calibrate'), 5) = 0").count()
        if own:
            assert language_id.train(docs).languages == ["de", "en"]
            alone = docs.where("lang = 'de'")
            assert [(r.lang_pred, r.rejected) for r in language_id.identify(alone, language_id.train(alone)).collect()] == [("de", False)]
            return
    raise AssertionError("no id of the calibration fold")


def test_long_texts_score_alike_in_blocks():
    counts = {}
    for lang, t in (("en", "the cat sat on the mat"), ("de", "die katze auf der matte")):
        counts[lang] = np.unique(language_id.grams(language_id.characters(t), language_id.ORDER), return_counts=True)
    model = language_id.KneserNey.train(counts)
    r = random.Random(1)
    codes = language_id.characters("".join(r.choice("abcdehtmn ") for _ in range(1_100_000)))
    whole = -model.log_probabilities(codes).sum(0, dtype=np.float64) / (len(codes) - 1)
    assert np.allclose(model.entropy(codes), whole, rtol=1e-6)


def test_languages_of_repeated_and_null_ids_are_learned(spark):
    """Above SAMPLE_DOCS rows a language under one id, under null ids, and of one hot row: all are learned from a bounded sample."""
    r = random.Random(8)
    words = {"en": "the cat sat on a mat and dog ran home".split(), "de": "der hund lief und die katze sass auf matte".split(), "xx": "zo qua vix pol mer tun".split()}
    texts = {lang: [" ".join(r.choices(w, k=12)) + f" {i}" for i in range(900)] for lang, w in words.items()}
    for ids in ((1, 1, 1), (None, None, None), (1, 2, None)):
        rows = [(i, t, lang) for i, (lang, ts) in zip(ids, texts.items()) for t in ts]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
        model = language_id.train(docs, 50)
        learn = {lang for i, lang in zip(ids, texts) if zlib.crc32(str("" if i is None else i).encode()) % 5}
        assert set(model.languages) == learn
        got = language_id.identify(docs, model).groupBy("lang_pred").count().collect()
        assert {x.lang_pred for x in got} == (learn or {"und"})
    hot = spark.createDataFrame([(1, texts["en"][0], "en")] * 2000 + [(1, texts["de"][0], "de")], "doc_id bigint, text string, lang string")
    assert set(language_id.train(hot, 50).languages) == {"en", "de"}


def test_letters_of_every_plane_count():
    assert len(language_id.characters(chr(0x30000))) > 1 and len(language_id.characters("\U00010400")) > 1
    assert len(language_id.characters("12 !")) == 0


def slow_kneser_ney(texts, vocabulary):
    """P(symbol | context) of one language by recursion over dictionary counts."""
    n = language_id.ORDER
    counts = [Counter()]
    for t in texts:
        s = [32] * n + language_id.characters(t).tolist()
        counts[0].update(tuple(s[i - n + 1:i + 1]) for i in range(n + 1, len(s)))
    for _ in range(n - 1):  # shorter ones count their distinct left extensions
        counts.insert(0, Counter(g[1:] for g in counts[0]))
    discount = [min(0.95, max(0.1, (k := list(c.values())).count(1) / max(1, k.count(1) + 2 * k.count(2)))) for c in counts]

    def p(context, symbol):
        if context is None:
            return 1 / vocabulary
        c, d = counts[len(context)], discount[len(context)]
        followers = {g[-1]: x for g, x in c.items() if g[:-1] == context}
        lower = p(context[1:] if context else None, symbol)
        if not followers:
            return lower
        total = sum(followers.values())
        return max(followers.get(symbol, 0) - d, 0) / total + d * len(followers) / total * lower

    return p


def test_entropy_equals_kneser_ney_by_recursion():
    texts = {"en": ["the cat sat on the mat and the dog ran to the log", "a cat and a mat"], "de": ["der hund lief und die katze sass auf der matte", "die matte"]}
    counts = {}
    for lang, ts in texts.items():
        counts[lang] = np.unique(np.concatenate([language_id.grams(language_id.characters(t), language_id.ORDER) for t in ts]), return_counts=True)
    model = language_id.KneserNey.train(counts)
    vocabulary = len({c for ts in texts.values() for t in ts for c in language_id.characters(t).tolist()[1:]}) + 1
    for probe in ("the katze und the dog", "xyz the", "matte", "q"):
        codes = language_id.characters(probe).tolist()
        padded = [32] * language_id.ORDER + codes
        for lang, got in zip(model.languages, model.entropy(np.array(codes, np.uint16))):
            p = slow_kneser_ney(texts[lang], vocabulary)
            want = -np.mean([math.log(p(tuple(padded[i - language_id.ORDER + 1:i]), padded[i])) for i in range(language_id.ORDER + 1, len(padded))])
            assert got == pytest.approx(want, rel=1e-4), (lang, probe)
