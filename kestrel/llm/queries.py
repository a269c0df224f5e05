"""The operators over their whole tables, with production parameters, and their SQL
where SQL can express them."""

from __future__ import annotations

import public_tokenizers

from kestrel.llm import (alignment, chat, decontamination, fingerprints, html_text, language_id, near_dedup, packing, ppm, prefix_trie,
                         quality_rules, token_counts, warc)
from kestrel.sources.tables import read_table

REGISTRY: dict = {}
ORACLE: dict = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


@query("op1_decontamination")
def op1(spark, sf):
    """Every (document, test item) with at least 0.75 of the item's shingles in the document."""
    return decontamination.contained_items(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


@query("op2_packing")
def op2(spark, sf):
    out = packing.pack_documents(read_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op3_quality_rules")
def op3(spark, sf):
    ledger = quality_rules.ledger(read_table(spark, sf, "documents"))
    return ledger.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (~quality_rules.passes(quality_rules.BASE)).alias("base_failed"),
                         quality_rules.passes(quality_rules.STANDARD).alias("kept"), "fail_bits")


@query("op4_token_counts")
def op4(spark, sf):
    return token_counts.token_counts(read_table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


@query("op5_lm_scoring")
def op5(spark, sf):
    return ppm.score_documents(read_table(spark, sf, "documents"))


@query("op6_language_id")
def op6(spark, sf):
    docs = read_table(spark, sf, "documents")
    return language_id.identify(docs, language_id.train(docs))


@query("op7_warc")
def op7(spark, sf):
    """Write the archive, then return what reading it back gives."""
    uri = warc.archive_path(spark)
    warc.write_archive(read_table(spark, sf, "pages"), uri, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return warc.read_archive(spark, uri).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op8_minhash_near_dedup")
def op8(spark, sf):
    return near_dedup.near_duplicates(read_table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@query("op9_html_extraction")
def op9(spark, sf):
    return html_text.extract(read_table(spark, sf, "pages"))


@query("op10_chat_formatting")
def op10(spark, sf):
    return chat.format_conversations(read_table(spark, sf, "conversations"))


@query("op11_document_fingerprints")
def op11(spark, sf):
    return fingerprints.edited_fingerprints(read_table(spark, sf, "documents"))


@query("op12_conversation_trie")
def op12(spark, sf):
    return prefix_trie.trie(prefix_trie.sequences(read_table(spark, sf, "conversations"), family=20)).drop("turn_id")


@query("op13_tokenizer_alignment")
def op13(spark, sf):
    return alignment.alignment_measures(read_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                        public_tokenizers.path("piece_bpe_32k.model"))


_WORDS = "list_filter(regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SHINGLES = ("SELECT DISTINCT {id}, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] "
             "ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM "
             f"(SELECT {{id}}, {_WORDS.format(_LOWER)} AS w FROM {{table}} WHERE text IS NOT NULL)")

ORACLE["op1_decontamination"] = f"""
WITH d AS ({_SHINGLES.format(id='doc_id', table='documents')}), b AS ({_SHINGLES.format(id='item_id', table='benchmark')}),
n AS (SELECT item_id, count(*) AS n FROM b GROUP BY item_id),
c AS (SELECT doc_id, item_id, count(*) AS k FROM d JOIN b USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n AS n_item_shingles, k AS n_shared, k / n AS containment FROM c JOIN n USING (item_id) WHERE 100 * k >= 75 * n"""

ORACLE["op3_quality_rules"] = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines FROM documents),
win AS (SELECT r, p, array_to_string(w[p:p + 7], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS p FROM t)),
rep AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, s) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + 8)) AS q FROM rep) GROUP BY r),
m AS (SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(lines) AS n_lines,
             length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
             length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g')) AS n_letters,
             len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\\x00-\\x7F]'))) AS n_alpha,
             length(text) - length(replace(text, '!', '')) AS n_exclaim,
             len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echo
      FROM t LEFT JOIN cov USING (r)),
f AS (SELECT *, CAST((n_words < 20)::INT + 2 * (100 * n_repeat_words > 30 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
                + 8 * (10 * n_upper > 3 * n_letters)::INT + 16 * (word_chars < 3 * n_words OR word_chars > 12 * n_words)::INT
                + 32 * (100 * n_alpha < 80 * n_words)::INT + 64 * (2 * n_dup_lines > n_lines)::INT + 128 * (2 * n_exclaim > n_words)::INT
                + 256 * (5 * n_echo > n_words)::INT AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM f"""

ORACLE["op7_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
g AS (SELECT payload_digest, max(page_id) AS top FROM q WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN top IS NULL OR page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM q LEFT JOIN g USING (payload_digest)"""

ORACLE["op8_minhash_near_dedup"] = f"""
WITH RECURSIVE s AS MATERIALIZED ({_SHINGLES.format(id='doc_id', table='documents')}),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY x, y),
e AS MATERIALIZED (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM reach r JOIN e ON r.y = e.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.y) AS component_id, d.doc_id = min(r.y) AS kept
FROM documents d JOIN reach r ON r.x = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id, n.n"""

_CRC32 = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)), "
          "lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda r, i: xor(r >> 1, (r & 1) * 3988292384))), 4294967295)")
ORACLE["op12_conversation_trie"] = f"""
WITH f AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
u AS (SELECT role, text, row_number() OVER () AS id, len({_WORDS.format('text')}) AS words FROM (SELECT DISTINCT role, text FROM f)),
t AS (SELECT conv_id, id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos FROM f JOIN u USING (role, text)),
c AS (SELECT conv_id, {_CRC32} % 4 AS h, conv_id - conv_id % 20 AS base FROM (SELECT DISTINCT conv_id FROM f)),
r AS (SELECT c.conv_id, 0 AS own, t.pos, t.id FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
      UNION ALL SELECT c.conv_id, 1, t.pos, t.id FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h),
s AS (SELECT conv_id, coalesce(path, []) AS path FROM c LEFT JOIN (SELECT conv_id, list(id ORDER BY own, pos) AS path FROM r GROUP BY conv_id) USING (conv_id)),
n AS (SELECT conv_id, d, path[1:d] AS p, d = len(path) AS ends FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM s)),
g AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256 FROM n GROUP BY p, d),
k AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM g WHERE d > 0 GROUP BY 1),
w AS (SELECT g.*, coalesce(n_children, 0) AS n_children, (n_convs - 1) * coalesce(words, 0) AS saved FROM g LEFT JOIN k USING (p) LEFT JOIN u ON u.id = g.p[g.d]),
b AS (SELECT p[1:a] AS p, CAST(sum(saved) AS BIGINT) AS saved_tokens, CAST(count(*) FILTER (WHERE n_children = 0) AS BIGINT) AS n_leaves
      FROM (SELECT p, saved, n_children, unnest(range(0, d + 1)) AS a FROM w) GROUP BY 1)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, CASE WHEN w.d > 0 THEN g.conv_id END AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256
FROM w JOIN b USING (p) LEFT JOIN g ON g.p = w.p[1:w.d - 1]"""
