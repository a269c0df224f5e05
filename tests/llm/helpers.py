"""Frames and plain-Python counterparts for the corpus tests."""

import random

LONG = " ".join(f"w{i % 997}" for i in range(30_000))
WEIRD = [None, "", " ", "\n\n", "one", "a b c d", "Ünï çödé ẞ 漢字 🙂", "x  y   z ", " lead", "trail ", "tab\there\x0bv\x0cf\rr", "<|endoftext|> a",
         "▁mark ▁▁ two", "\x85\xa0 odd space", "don't WE'LL 12,345.67 ##**", "no\x1cbreak\x1fhere", LONG]


def documents(spark, texts=None, extra=True):
    """Documents with odd texts, null ids and langs, repeated rows and columns that clash with results."""
    texts = WEIRD if texts is None else texts
    rows = [(i, t, ("en", "de", None)[i % 3], "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[-1], rows[-1], (None, "a b c d", None, None, None), (None, None, "en", None, None)] if rows else []
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    if extra:
        from pyspark.sql import functions as F
        for c in ("kept", "row", "id", "digest", "n", "score", "sequence_id", "part", "rank", "fail_bits", "html", "piece"):
            df = df.withColumn(c, F.lit("clash"))
    return df


def shingles(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not w:
        return set()
    return {tuple(w)} if len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def variants(seed=3, groups=6, words=60):
    """Groups of exact and near copies, a passage that many texts hold, and unrelated texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(20))
    out = []
    for g in range(groups):
        base = [word() for _ in range(words + 10 * g)]
        out += [" ".join(base)] * (1 + g % 3)
        for k in range(1 + 2 * g):
            own = list(base)
            for _ in range(1 + k % 4):
                own[r.randrange(len(own))] = word()
            out.append(" ".join(own))
    out += [passage + " " + " ".join(word() for _ in range(r.randrange(5, 60))) for _ in range(40)]
    r.shuffle(out)
    return out


def rows(df):
    return [tuple(r) for r in df.collect()]
