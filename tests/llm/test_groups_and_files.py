"""Near-duplicates, archives, page text and chats against brute force and round trips."""

import itertools
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import documents, shingles, variants
from kestrel.llm import chat, html_text, near_dedup, warc


def union_find(nodes, edges):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        p, q = find(a), find(b)
        parent[max(p, q)] = min(p, q)
    return {x: find(x) for x in nodes}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_of_random_graphs(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(130)] + [(i, i + 1) for i in range(300, 340)] + [(5, 5)]
    got = {a: b for a, b in near_dedup.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = union_find({x for e in edges for x in e}, edges)
    assert got == {x: y for x, y in want.items() if x != y}
    assert near_dedup.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def slow_near(texts):
    sets = [shingles(t) for t in texts]
    edges = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2)
             if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    return sets, union_find(range(len(sets)), edges)


def test_near_duplicates_match_brute_force(spark, monkeypatch):
    texts = variants() + [None, "", "  ", "a b", "A B", "a b c", "one two three four five", "one two three four five six"]
    sets, root = slow_near(texts)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    for block, bits in ((512, 1 << 27), (3, 64), (3, 1 << 10)):  # groups in one block, and dealt into many; no, a full and a sparse filter
        monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block)
        monkeypatch.setattr(near_dedup, "BITMAP_BITS", bits)
        got = {r.doc_id: r for r in near_dedup.near_duplicates(df).collect()}
        assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == \
            {i: (len(sets[i]), root[i], root[i] == i) for i in range(len(texts))}
        assert {r.doc_id for r in near_dedup.keep_one(df).collect()} == {i for i in root if root[i] == i}
    assert sum(root[i] != i for i in root) > 30


def test_near_duplicates_of_repeated_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(50))
    df = documents(spark, [text, text, None, "", "other words entirely here now", text.upper()])
    df = df.unionByName(df.where("doc_id = 0")).unionByName(df.limit(1).selectExpr(*["cast(null as bigint) as doc_id" if c == "doc_id" else f"`{c}`" for c in df.columns]))
    got = near_dedup.near_duplicates(df).collect()
    assert len(got) == df.count() and all(r.component_id == 0 for r in got if r.n_shingles == 46)
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[0] == 1 and ids[1] == 0 and ids[5] == 0 and ids[4] == 1 and ids[2] >= 1
    for empty in (documents(spark, []), documents(spark, [None, ""])):
        assert near_dedup.near_duplicates(empty).count() == empty.count()
        assert near_dedup.keep_one(empty).count() == empty.count()


def test_near_duplicates_hold_one_worker_a_task(spark, monkeypatch):
    """No Python step reads from another: a task would hold a worker for each, and executors keep them all for the rest of the run."""
    inputs, real = [], near_dedup.map_arrow

    def watched(df, fn, schema):
        inputs.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real(df, fn, schema)

    monkeypatch.setattr(near_dedup, "map_arrow", watched)
    texts = variants()
    df = spark.createDataFrame([(i % 50, t) for i, t in enumerate(texts)] + [(None, texts[0]), (7, None), (7, None)], "doc_id int, text string")
    kept = near_dedup.keep_one(df).collect()
    assert len(texts) > 50 and len(kept) < len(texts) and sum(r.text is None for r in kept) == 2
    assert len(inputs) == 5 and not any("Arrow" in plan for plan in inputs)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1), min_size=1, max_size=12), st.integers(0, 11))
def test_exact_links(sets, cut):
    a, b = sets[:cut] or sets, sets[cut:] or sets
    arrays = [[np.array(sorted(s), np.uint64) for s in side] for side in (a, b)]
    assert near_dedup.overlaps(*arrays, step=3).tolist() == [[len(x & y) for y in b] for x in a]
    want = [(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if 100 * len(x & y) >= 75 * len(x | y)]
    assert sorted(map(tuple, near_dedup.exact_links(*arrays, False).tolist())) == want


def page_frame(spark):
    big, other = "<p>" + "long page " * 200 + "</p>", "<p>" + "é other " * 300 + "</p>"
    data = [(1, "http://a/1", big), (2, "http://a/2\r\nX: y", big), (9, None, big), (3, "http://b", "small"), (4, "http://c", "small"),
            (5, "u", None), (6, "u", ""), (7, "u", other), (7, "u", other), (8, "u", other + "x"), (None, "n", big), (10, "u", "z" * 300_000)]
    return spark.createDataFrame(data, "page_id bigint, url string, html string").selectExpr("*", "'clash' AS kind", "'clash' AS digest")


def test_archive_round_trip(spark, tmp_dir):
    import hashlib
    df = page_frame(spark)
    manifests = []
    for name in ("one", "two"):
        uri = f"file://{tmp_dir}/{name}"
        warc.write_archive(df, uri, 3, roll_bytes=600)
        manifests.append(sorted(spark.read.parquet(f"{uri}/_manifest").collect()))
    assert manifests[0] == manifests[1] and len(manifests[0]) > 3  # the same files, byte for byte
    got = warc.read_archive(spark, uri, with_payload=True).collect()
    source = df.collect()
    assert len(got) == len(source)
    top = {hashlib.sha1((r.html or "").encode()).hexdigest(): 0 for r in source}
    for r in source:
        d = hashlib.sha1((r.html or "").encode()).hexdigest()
        top[d] = max(top[d], r.page_id or 0)
    want = Counter((r.page_id, len((r.html or "").encode()), hashlib.sha1((r.html or "").encode()).hexdigest()) for r in source)
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in got) == want
    by = {r.page_id: r for r in got if r.page_id != 7}
    assert by[9].record_type == "response" and by[9].payload.decode().startswith("<p>long")
    assert [(by[i].record_type, by[i].refers_to) for i in (1, 2, None)] == [("revisit", 9)] * 3
    assert by[3].record_type == by[4].record_type == by[5].record_type == "response" and by[10].payload_bytes == 300_000
    assert sorted((r.record_type, r.refers_to) for r in got if r.page_id == 7) == [("response", None), ("revisit", 7)]
    assert "\n" not in by[2].url
    name = max(manifests[0], key=lambda m: m.bytes).file
    with open(f"{tmp_dir}/two/{name}", "r+b") as f:
        f.seek(40)
        f.write(b"\0\0\0")
    with pytest.raises(Exception):
        warc.read_archive(spark, uri).collect()


def test_empty_archive(spark, tmp_dir):
    uri = f"file://{tmp_dir}/none"
    warc.write_archive(page_frame(spark).limit(0), uri, 3)
    assert warc.read_archive(spark, uri).count() == 0


TEXT = "Onhalyti the in erthst orth it thon tiontiontion edshti on the onheretionshon eronouen the tionanon."


@pytest.mark.parametrize("page, want", [
    (f"<header><h1>Site</h1></header><nav><a href=a>Home</a></nav><div class='cookie-banner'>We use cookies on all of our sites here.</div><main><article><h1>T</h1>"
     f"<p>{TEXT}</p><aside>Read more of this</aside><p>Ea.</p><p>{TEXT}<br>\n{TEXT}</p><form><label>Mail</label></form></article>"
     f"<section id=comments><p>{TEXT}</p></section></main><div class='sidebar'><p>{TEXT}</p></div><footer>c</footer>", f"T\n{TEXT}\nEa.\n{TEXT} {TEXT}"),
    (f"<div class='nav'><ul><li><a href=x>A b</a></ul></div><div class=content><h1>Title</h1><p>{TEXT}<p>Ea.<p>{TEXT}</div><div class=notice>{TEXT}</div>", f"Title\n{TEXT}\nEa.\n{TEXT}"),
    (f"<div><a href=x>A b</a></div><h1>Title</h1><p>{TEXT}&amp;&lt;b&gt;&nbsp;x<script>if(a<b)'</p>'</script></p><!-- <p>no --><textarea>hidden</textarea>", f"Title\n{TEXT}&<b> x"),
    (f"<article><p>{TEXT}", TEXT), ("<article><p>x <b>y</b>z</p></article>", "x yz"), (f"<head><title>no</title><style>p{{}}</style><body><p>{TEXT}</p>", TEXT),
    (f"<form id=aspnet><div>menu</div><article><p>{TEXT}</p></article></form>", TEXT),
    (None, ""), ("", ""), ("<script>only", ""), ("<!-- only", ""), ("<p></p> <br>", ""),
])
def test_main_text(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    (f"<div class='page has-sidebar'><article><h1>T</h1><p>{TEXT}</p><p>Ea.</p></article><div class='sidebar'><p>{TEXT}</p></div></div>", f"T\n{TEXT}\nEa."),
    (f"<div class='with-nav'><nav><a href=a>Home</a></nav><main><p>{TEXT}</p></main></div>", TEXT),
    (f"<div id=sidebar-layout><article><p>{TEXT}</p><p>Ea.</p></article></div><footer>c</footer>", f"{TEXT}\nEa."),
    (f"<article><p>{TEXT}</p><section class='discussion'><h2>Dis</h2><p>{TEXT}</p></section></article>", f"{TEXT}\nDis\n{TEXT}"),
    (f"<section class='discussion'><article><p>{TEXT}</p></article></section>", TEXT),
    (f"<article><p>{TEXT}</p></article><div class='comments'><article><p>{TEXT} no</p></article></div>", TEXT),
])
def test_wrappers_with_names_of_boilerplate_keep_the_article(page, want):
    assert html_text.main_text(page) == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([*"<>/\"'=!- pa&;b", "<p>", "</p>", "<div class=", "<script>", "<!--", "-->", "<a href='"]), max_size=40).map("".join))
def test_broken_markup_never_fails(page):
    for b in html_text.blocks(page):
        assert b.text == " ".join(b.text.split()) != ""


def test_the_tree_fits_its_table():
    x, y = html_text.labelled()
    assert (html_text.block_tree().predict(x) == (y > 0.5)).mean() > 0.95


def test_extract_keeps_every_row(spark):
    df = page_frame(spark)
    out = html_text.extract(df).collect()
    assert len(out) == df.count() and all(r.n_chars == len(r.text) for r in out)
    assert html_text.extract(df.limit(0)).count() == 0


def legal(roles):
    out = roles[1:] if roles[:1] == [chat.SYSTEM] else roles
    return len(out) % 2 == 0 and all(r == (chat.USER, chat.ASSISTANT)[i % 2] for i, r in enumerate(out)) and bool(out)


def cheapest(roles):
    """Lowest cost over all legal results, turn by turn with every insertion (at most two between turns)."""
    best = {(): 0.0}
    inserts = [p for k in range(4) for p in itertools.product((chat.SYSTEM, chat.USER, chat.ASSISTANT), repeat=k)]
    change = lambda r, t: 0 if r == t else chat.RELABEL_UNKNOWN if r == chat.UNKNOWN else chat.RELABEL
    prefix_ok = lambda p: legal(list(p)) or legal([*p, chat.ASSISTANT]) or p in ((), (chat.SYSTEM,))
    for r in roles:
        new = {}
        for p, c in best.items():
            options = [(p, c + chat.MERGE + change(r, p[-1]))] if p else []
            for ins in inserts:
                for t in (chat.SYSTEM, chat.USER, chat.ASSISTANT):
                    options.append(((*p, *ins, t), c + chat.INSERT * len(ins) + change(r, t)))
            for q, cost in options:
                if prefix_ok(q) and cost < new.get(q, 1e9):
                    new[q] = cost
        best = {q: c for q, c in new.items()}
    return min(c + chat.INSERT * len(ins) for p, c in best.items() for ins in inserts if legal([*p, *ins]))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=4))
def test_repairs_are_legal_and_cheapest(roles):
    turns, (cost, *_counts) = chat.repair(roles, [f"t{i}" for i in range(len(roles))])
    assert legal([t[0] for t in turns]) and cost == pytest.approx(cheapest(roles))


def parse(text):
    out = []
    for part in text.split("<|end|>\n")[:-1]:
        head, _, body = part.partition("|>\n")
        out.append((head.removeprefix("<|"), chat.unescape(body)))
    return out


def test_legal_conversations_round_trip(spark):
    nasty = ["<|end|>\n", "<|user|>", "<\\|end|>", "a\n\nb", "", "<|", "\\", "<\\\\|x"]
    data = [(1, i, ("user", "assistant")[i % 2], t) for i, t in enumerate(nasty)]
    df = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string")
    [r] = chat.format_conversations(df, 1).collect()
    assert r.cost == 0 and parse(r.text) == [(x[2], x[3]) for x in data]


def test_splitting_changes_nothing(spark, monkeypatch):
    r = random.Random(4)
    roles = ["user", "assistant", "system", "Human", "bot", None, "other", "assistant ", "user"]
    data = [(c, t, r.choice(roles), f"c{c} t{t} " * r.randrange(3)) for c in (1, 2, 3, None) for t in range((3, 40, 400, 7)[(c or 4) - 1])]
    data += [data[0], data[0], (9, None, None, None), (10, 1, "assistant", None)]
    df = spark.createDataFrame(data, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'clash' AS part", "1 AS nth")

    def whole(parts):
        texts, costs, turns = defaultdict(str), Counter(), Counter()
        for x in sorted(chat.format_conversations(df, parts).collect(), key=lambda x: x.segment):
            texts[x.conv_id] += x.text
            costs[x.conv_id] += x.cost
            turns[x.conv_id] += x.n_turns
        return texts, costs, turns

    one = whole(1)
    assert sum(one[2].values()) == len(data)
    for roles_out in ([p[0] for p in parse(t)] for t in one[0].values()):
        assert legal([chat.ROLES[x] for x in roles_out])
    monkeypatch.setattr(chat, "BLOCK_TURNS", 5)
    many = whole(7)
    assert many[1] == one[1] and many[2] == one[2] and many[0].keys() == one[0].keys()
    for t in many[0].values():
        assert legal([chat.ROLES[p[0]] for p in parse(t)])
    assert chat.format_conversations(df.limit(0), 2).count() == 0


LONG_P = "<p>" + html_text._LONG + "</p>"


@pytest.mark.parametrize("name", ["id='comments'", "class='comments'", "class='responses'", "class='thread'", "class='reader-comments'"])
def test_reader_comments_go_however_long_they_are(name):
    for n in (1, 2, 5, 8, 20, 30):
        page = f"<html><body><article>{LONG_P}</article><section {name}>{LONG_P * n}<p>I agree.</p></section></body></html>"
        assert html_text.main_text(page) == html_text._LONG.strip()
        assert html_text.main_text(f"<body><div>{LONG_P}</div><div {name}>{LONG_P * n}</div></body>") == html_text._LONG.strip()


def test_links_of_an_article_stay():
    page = f"<nav><a href='/'>Home</a></nav><article>{LONG_P}<p><a href='/s'>Read the source here</a></p><ul><li><a href='/1'>One</a></li></ul></article>"
    assert html_text.main_text(page).split("\n") == [html_text._LONG.strip(), "Read the source here", "One"]


def test_unclosed_menus_and_hidden_parts():
    want = "T\n" + html_text._LONG.strip()
    for tag in ("nav", "aside", "footer"):
        assert html_text.main_text(f"<{tag}><a href='/'>Home</a><article><h1>T</h1>{LONG_P}</article>") == want
    # a teaser article inside a sidebar is none when the page has its own
    assert html_text.main_text(f"<article><h1>T</h1>{LONG_P}</article><aside><article><p>Another story of the day</p></article></aside>") == want
    hidden = "<p hidden>secret</p><div style='color:red; display: none'>unseen <p>words</p></div><div data-x='hidden'></div><p class='overlay'>We use cookies</p>"
    assert html_text.main_text(f"<article><h1>T</h1>{hidden}{LONG_P}</article>") == want


def test_neighbours_decide_where_nothing_else_does():
    x, _ = html_text.labelled()
    tree, rng = html_text.block_tree(), np.random.default_rng(0)
    moved = x.copy()
    for name in ("words_before", "link_density_before", "words_after", "link_density_after"):
        i = html_text.FEATURES.index(name)
        moved[:, i] = rng.permutation(moved[:, i])
    assert (tree.predict(moved) != tree.predict(x)).sum() >= 5
    menu = "<div><a href='/'>Home</a> <a href='/n'>News</a></div>"
    body = html_text.main_text(f"{menu}<div>All about towns</div>{menu}<div>{html_text._LONG}</div><div>It was late.</div><div>{html_text._LONG}</div>{menu}")
    assert "It was late." in body and "All about towns" not in body


def plain_article(page):
    """The article element of a page by the standard library's parser: a second, plain way for pages that have one."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.depth, self.lines, self.now = 0, [], []

        def cut(self):
            text = " ".join("".join(self.now).split())
            self.now = []
            if text:
                self.lines.append(text)

        def handle_starttag(self, tag, attrs):
            if tag == "article":
                self.depth += 1
            if tag in html_text.BLOCKS:
                self.cut()
            elif tag == "br":
                self.now.append(" ")

        def handle_endtag(self, tag):
            if tag in html_text.BLOCKS:
                self.cut()
            if tag == "article":
                self.depth -= 1

        def handle_data(self, data):
            if self.depth > 0:
                self.now.append(data)

    r = Reader()
    r.feed(page)
    r.close()
    r.cut()
    return "\n".join(r.lines)


def test_given_pages_equal_a_plain_reading_of_their_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()
    differ = [r.html for r in pages if r.html and "<article" in r.html and html_text.main_text(r.html) != plain_article(r.html)]
    assert len(pages) > 200 and not differ


def test_a_very_long_page():
    page = f"<article>{LONG_P * 20_000}</article>"
    assert html_text.main_text(page).count("\n") == 19_999

