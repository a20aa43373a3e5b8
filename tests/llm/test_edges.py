"""Nulls, empty and long texts, ties, repeated rows, empty tables, clashing names, and crowded groups."""

import random
import textwrap
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brute import Leaves, binomial_below, license_row, near_components, quality_counts, shingles, tag_path_text
from martlake.llm import graph, html, licenses, mixing, neardup, quality, sharding, tokens, toxicity, urls, vectors
from martlake.llm.common import prepare

#: Names that operators use for columns of their own.
CLASHING = "n_words kept score size row stratum source_size rate seed window subject component ids copies _score".split()
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} int" for c in CLASHING)
PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice("ab cd efg hij klm nop qrs tuv wxy zab".split()) + str(rng.randrange(50)) for _ in range(n))


LONG = prose(1, 60_000)
ROWS = [
    (1, prose(2, 80), "en", "a"),
    (1, prose(2, 80), "en", "a"),
    (2, prose(2, 80) + " more", "en", None),
    (3, "", "de", "b"),
    (4, None, None, None),
    (None, prose(3, 70), "de", "b"),
    (None, None, None, None),
    (5, LONG, "fr", "é"),
    (6, "one\x00two \x85 \u2003 <|endoftext|> ß 日本語 \U0001f600 MIT License", None, "b"),
    (7, "one two", "en", "a"),
    (8, "ONE  two", "en", "a"),
    (9, "same " * 200, "en", "c"),
    (9, prose(4, 90), "en", "c"),
    (10, prose(4, 90), "en", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame([(*r, *range(len(CLASHING))) for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    prepare(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (1, 0, 1), (5, 1, None), (None, 1, 1), (9, None, 0), (77, 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def test_near_duplicates(docs, empty):
    found = neardup.near_duplicates(docs, 85).collect()
    assert len(found) == len(ROWS)
    wanted = near_components([(i, t) for i, t, *_ in ROWS if i is not None and t], 85)
    for r in found:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == wanted.get(r.doc_id, r.doc_id)
            assert r.kept == (r.component_id == r.doc_id)
    assert Counter(r.n_shingles for r in found) == Counter(len(shingles(t)) for _, t, *_ in ROWS)
    assert neardup.near_duplicates(empty, 85).count() == 0
    kept = neardup.keep_one(docs, 85)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4, 5, 6, 7, 9, None}
    assert sum(r.doc_id == 1 for r in kept.collect()) == 1


def test_one_row_of_a_group_stays_whatever_its_id(spark):
    """Rows with one text: of null ids, of an id that is repeated, and of another one."""
    prepare(spark)
    text, other = prose(2, 80), prose(77, 80)
    rows = [(i, text) for i in (None, None, None, 5, 5, 5, 5, 9)] + [(5, other), (None, None), (None, "")]
    found = neardup.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 80).collect()
    assert Counter(r.text for r in found) == {text: 1, other: 1, None: 1, "": 1}


def test_crowded_buckets(spark, monkeypatch):
    """Chains, groups around a base below the threshold, and far copies, with blocks of a few classes."""
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rng = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(60):
        words = list(base)
        for place in rng.sample(range(60), rng.randrange(0, 4)):
            words[place] = f"x{rng.randrange(1000)}"
        rows.append((k, " ".join(words)))
    chain = list(base)
    for k in range(60, 100):
        chain = [*chain[2:], f"y{k}", f"z{k}"]
        rows.append((k, " ".join(chain)))
    rows += [(k, rows[k % 7][1]) for k in range(100, 130)]
    rng.shuffle(rows)
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    assert {r.doc_id: r.component_id for r in found} == near_components(rows, 85)


def test_sketches_estimate_similarity(spark):
    """Bits of near pairs stay below the bound, those of unlike pairs far above."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(400)]
    rows = []
    for k in range(40):
        words = list(base)
        for place in rng.sample(range(400), 5):
            words[place] = f"x{k}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, prose(100 + k, 300)) for k in range(20)]
    signed = neardup.signatures(spark.createDataFrame(rows, "doc_id long, text string"), 85).collect()
    sketch = {r.doc_id: np.array(r.sketch, dtype=np.int64).view(np.uint64) for r in signed}
    bits = lambda a, b: int(np.bitwise_count(sketch[a] ^ sketch[b]).sum())
    sets = {i: shingles(t) for i, t in rows}
    for k in range(1, 40):
        share = len(sets[0] & sets[k]) / len(sets[0] | sets[k])
        assert share < 0.85 or bits(0, k) <= neardup.most_bits(85)
    assert all(bits(0, 100 + k) > neardup.most_bits(85) for k in range(20))


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(0, 200)] + [(i, 1000) for i in range(500, 600)] + [(7, 7), (1000, 500)]
    random.Random(2).shuffle(links)
    found = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 201)}, **{i: 500 for i in [*range(501, 600), 1000]}}


def test_quality(docs, empty, labels, no_labels):
    for given in (labels, no_labels):
        found = quality.quality_rules(docs, given).collect()
        assert len(found) == len(ROWS)
        for r in found:
            assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
            assert r.kept == (not r.base_failed)  # too few labels certify nothing
    counts = quality.count_batch(pa.array([t for _, t, *_ in ROWS]))
    for k, (_, text, *_) in enumerate(ROWS):
        assert {c: counts[c][k] for c in quality_counts(text)} == quality_counts(text)
    assert quality.quality_rules(empty, labels).count() == 0
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "10", "2", "5", "9", "None"]


def test_line_and_window_counts():
    texts = ["a\na\n\n \n a\na\r\na", "a b c a b c", "a a a a", "x\ty z\nx y\u00a0z", "\n\n"]
    counts = quality.count_batch(pa.array(texts))
    for k, text in enumerate(texts):
        assert {c: counts[c][k] for c in quality_counts(text)} == quality_counts(text)


@pytest.mark.parametrize("rejected,n", [(0, 10), (0, 58), (0, 59), (3, 200), (7, 300), (50, 900), (9, 9)])
def test_binomial_bound_is_exact(rejected, n):
    wanted = rejected < n and binomial_below(rejected, n, 0.05) <= 0.05
    assert quality.upper_bound_holds(rejected, n, 0.05, 0.05) == wanted


def test_cutoffs_limit_false_rejections():
    """Over many holdouts, a chosen cutoff hardly ever rejects more good rows than the risk."""
    rng = np.random.default_rng(3)
    truth = rng.dirichlet(np.linspace(3, 0.01, quality.TOP + 1))
    bad = np.full(quality.TOP + 1, 2)
    wrong = sum(
        truth[quality.choose_cutoff(rng.multinomial(400, truth), bad, 0.05, 0.05) + 1 :].sum() > 0.05 for _ in range(300)
    )
    assert wrong <= 30
    none = np.zeros(quality.TOP + 1, dtype=np.int64)
    assert quality.choose_cutoff(none, bad, 0.05, 0.05) == quality.TOP


@pytest.mark.parametrize("same", ["id", "text"])
def test_repeated_rows_certify_nothing(spark, same):
    """Two labels in a stratum are two trials, however often their rows or texts are repeated."""
    prepare(spark)
    good, bad = prose(5, 80), "# " * 40 + prose(6, 80)
    rows = [(1 if same == "id" else 100 + k, good, "en") for k in range(600)] + [(2, bad, "en"), (3, "# " + prose(7, 80), "en")]
    labels = [(r[0], 1) for r in rows[:600]] + [(2, 0)]
    found = quality.quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    )
    assert found.filter("rejected_by is not null").count() == 0


def test_many_labels_certify_a_cutoff(spark):
    prepare(spark)
    rows = [(k, prose(k, 80), "en") for k in range(900)] + [(k, "# " * 40 + prose(k, 80), "en") for k in range(900, 1000)]
    labels = [(k, int(k < 900)) for k in range(1000)]
    found = quality.quality_rules(
        spark.createDataFrame(rows, "doc_id long, text string, lang string"),
        spark.createDataFrame(labels, "doc_id long, quality int"),
    )
    assert {r.doc_id for r in found.filter("rejected_by = 'symbols'").collect()} == set(range(900, 1000))


def test_shards(spark, docs, empty):
    found = sharding.byte_shards(docs, 3).collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter((i, len((t or "").encode()) + 1) for i, t, *_ in ROWS)
    for s in {r.shard for r in found}:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sum(r.shard == s for r in found)))
    assert sharding.byte_shards(empty, 3).count() == 0
    assert sorted(sharding.with_shards(docs, 3).columns) == sorted([*docs.columns, "shard"])
    assert sharding.with_shards(docs, 3).count() == len(ROWS)
    # One row repeated is a third of everything, and still cut at the targets.
    many = spark.range(70_000).select(F.when(F.col("id") < 69_000, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("x").alias("text"))
    bytes_ = [r.b for r in sharding.byte_shards(many, 8).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(bytes_) == 8 and max(bytes_) - min(bytes_) <= 4


def test_mix(spark, docs, empty):
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    first, again = (Counter(str(r) for r in out.collect()) for _ in range(2))
    assert first == again
    assert mixing.mixed(empty).count() == 0
    sizes = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate([("a", 100), ("b", 1), (None, 50), ("c", 0)])], "doc_id long, source string, size long")
    targets = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # Weights 5, 2, 1, 5 in the order a, b, c, null; b stops at 3 and c at 0, a and null share the other 148 equally.
    assert targets == {"a": 74.0, "b": 3.0, "c": 0.0, None: 74.0}


@pytest.mark.parametrize("ids", ["null", "one", "equal rows"])
def test_mix_meets_targets_with_repeated_ids(spark, ids):
    prepare(spark)
    text = (lambda k: "a b c") if ids == "equal rows" else (lambda k: f"a b c{k}")
    rows = [(None if ids == "null" else 7, text(k), "abc"[k % 3]) for k in range(3000)]
    rows = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    taken = Counter(r.source for r in mixing.mixed(rows).collect())
    # Weights 5, 2 and 1 of 9000 words, in documents of 3.
    for source, wanted in zip("abc", (1875, 750, 375), strict=True):
        assert abs(taken[source] - wanted) < 0.05 * wanted
    assert sum(r.n for r in mixing.keyed(rows, "key", "doc_id", "text").groupBy("key").agg(F.count("*").alias("n")).collect()) == 3000
    assert mixing.keyed(rows, "key", "doc_id", "text").select("key").distinct().count() == 3000


def test_targets_follow_repeated_sharing(spark):
    rng = random.Random(4)
    sizes = {f"s{k:02}": rng.choice([1, 3, 10, 1000, 20_000]) for k in range(17)}
    rows = [(k, s, n) for k, (s, n) in enumerate(sizes.items())]
    found = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes))}
    total = sum(sizes.values())
    target = {s: total * weight[s] / sum(weight.values()) for s in sizes}
    while any(target[s] > 3 * sizes[s] + 1e-9 for s in sizes):
        excess = sum(max(0, target[s] - 3 * sizes[s]) for s in sizes)
        target = {s: min(t, 3 * sizes[s]) for s, t in target.items()}
        free = [s for s in sizes if target[s] < 3 * sizes[s] - 1e-9]
        for s in free:
            target[s] += excess * weight[s] / sum(weight[f] for f in free)
    assert all(abs(found[s] - target[s]) < 1e-3 for s in sizes)


def test_bpe(docs, empty):
    out = tokens.encoded(docs, PATH, public_tokenizers.PATTERN)
    found = out.select("doc_id", "ids", "decoded").collect()
    assert Counter(bytes(r.decoded) for r in found) == Counter((t or "").encode() for _, t, *_ in ROWS)
    assert tokens.digests(empty, PATH, public_tokenizers.PATTERN).count() == 0
    assert out.columns == [*[c for c in docs.columns if c not in ("text", "ids")], "ids", "decoded"]


def test_long_words_agree_with_the_library():
    import base64

    import tiktoken

    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = tokens.codec(PATH, public_tokenizers.PATTERN)
    rng = random.Random(8)
    texts = ["a" * 5000, "ab" * 2000, "aab" * 900, "banana" * 300, "日本" * 400, "".join(rng.choice("abcde") for _ in range(900))]
    texts += ["".join(rng.choice("estanri") for _ in range(rng.randrange(65, 200))) for _ in range(60)]
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert np.frombuffer(ids, dtype="<u4").tolist() == library.encode_ordinary(text)
    back = codec.decode([np.frombuffer(x, dtype="<u4") for x in codec.encode(texts)])
    assert [b.decode() for b in back] == texts


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="with-sidebar">
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/x">News, and more</a></ul></nav>
<div id="cookie-notice">We use cookies, and so on. Accept them, please.</div><!-- <p>gone</p> -->
%s
<aside><p>Popular: a long sentence, with commas, and more words, and more.</p></aside>
<section class="comments"><article><p>Great post, thank you very much, I liked it!</p></article></section>
<form><p>Subscribe, please.</p><input></form><footer>&copy; 2020, all rights reserved.</footer>
<script>if (a<b) { "</p>" }</script></body></html>"""
BODY = """<h2>Heading</h2><p>First&nbsp;para   graph, with &lt;b&gt; and <b>bo</b>ld 3 < 4.
Some length makes it<br>content.<p>Short.</p><ul><li>one<li>two</ul><div class="ad">Buy now, it is cheap.</div>"""
TEXT = "Heading\n\nFirst para graph, with <b> and bold 3 < 4. Some length makes it content.\n\nShort.\n\none\n\ntwo"


@pytest.mark.parametrize("wrap", ["<article>%s</article>", "<main>%s</main>", '<div class="story">%s</div>'])
def test_main_text_of_kinds_of_pages(wrap):
    assert html.main_text(PAGE % (wrap % BODY)) == TEXT


@pytest.mark.parametrize(
    "heading",
    [
        '<h1 class="article-title">Heading</h1>',
        '<p class="article-date">Heading</p>',
        '<h2 id="main-heading">Heading</h2>',
        '<h1 class="article-title"><a href="/x">Heading</a></h1>',
    ],
)
def test_named_headings_do_not_name_the_article(heading):
    body = BODY.removeprefix("<h2>Heading</h2>")
    assert html.main_text(PAGE % (heading + f"<div>{body}</div>")) == TEXT
    assert html.main_text(PAGE % f"<div>{heading}<div>{body}</div></div>") == TEXT


def test_names_of_articles():
    beside = "<div><p>Beside it, a sentence.</p></div>"
    assert html.main_text(PAGE % (f'<div class="article-body">{BODY}</div>' + beside)) == TEXT
    assert html.main_text(PAGE % (f"<article>{BODY}</article>" + beside)) == TEXT
    assert html.main_text(PAGE % (f'<div id="main"><h2>Heading</h2><article>{BODY[16:]}</article></div>' + beside)) == TEXT
    menu = '<ul><li><a href="/a">One, two</a></ul>'
    assert html.main_text(f'<body class="article-page">{menu}<div><p>A long sentence, with words, in it.</p></div>') == "A long sentence, with words, in it."


def test_attributes_are_read_by_name():
    for quiet in ['title="A hidden gem"', "aria-label='class=ad style=display:none'", 'data-x="id" hidden-x', "data-note=hidden", 'alt="" title = "hidden"']:
        assert html.name_words(" " + quiet) == (set(), False)
        assert html.main_text(f"<article {quiet}><p>The text, in full.</p></article>") == "The text, in full."
    assert html.name_words(' data-x="a hidden b" hidden id=\'main\' CLASS = "sideBar x2" role=nav')[1]
    assert html.name_words(' title="a"class="nav b"id=c') == ({"nav", "b", "c"}, False)
    assert html.name_words(' title="=" style="color:red; display : none"') == (set(), True)
    assert html.name_words(' class="" id hidden="until-found"') == (set(), True)
    assert html.main_text('<article><p title="a">Shown, yes.</p><p title="b" hidden>Gone, no.</p></article>') == "Shown, yes."


def test_main_text_edges(spark):
    assert html.main_text(None) == html.main_text("") == html.main_text("<p></p><script>x") == ""
    assert html.main_text("<p>One sentence, of some length, and no more.") == "One sentence, of some length, and no more."
    long = "<article>" + "<p>A sentence, again.</p>" * 20_000 + "</article>"
    assert html.main_text(long).count("\n\n") == 19_999
    assert html.main_text("<article>" + "<b><div>" * 500 + "deep, deep text.") == "deep, deep text."
    rows = [(1, None, None), (None, "u", "<p>Text, and text.</p>"), (1, None, None)]
    found = html.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in found) == [("1", "", 0), ("1", "", 0), ("None", "Text, and text.", 15)]


STORY = "<p>A long paragraph of the story, with commas, that goes on for some time. It has sentences, too.</p>" * 3


def test_ratios_outweigh_names():
    told = "\n\n".join(STORY[3:-4].split("</p><p>"))
    assert html.main_text(f"<body><article><h3>Teaser one</h3></article><div>{STORY}</div>").endswith(told)
    assert html.main_text(f'<form id="aspnetForm"><nav>One</nav><div><article>{STORY}</article></div></form>') == told
    assert html.main_text(f"<article>{STORY}</article><form><p>Subscribe, please.</p></form>") == told
    for name in ("share-price story", "legal-news", "notice"):
        page = f'<body><nav><a href="/">Home</a></nav><div class="{name}">{STORY}</div><footer>All rights, reserved.</footer>'
        assert html.main_text(page) == told
    comments = '<div class="comments">' + STORY * 4 + "</div>"
    assert html.main_text(f"<body><div><h1>Heading</h1>{STORY}</div>{comments}") == "Heading\n\n" + told
    assert html.main_text('<body><ul><li><a href="/">Home</a><li><a href="/x">News, all of them</a></ul>') == ""


@pytest.mark.parametrize(
    "page",
    [
        "<a " * 350_000,
        "<!x" * 350_000,
        "<!--" * 250_000,
        "<div>word " * 100_000,
        "<ul>word " * 100_000,
        '<a ">" ' * 150_000 + '"',
        "<script>" + "</script " * 100_000,
        "< " * 300_000 + ">",
        "<b>" * 300_000 + "x",
    ],
    ids=range(9),
)
def test_broken_pages_take_linear_time(page):
    begun = time.process_time()
    html.main_text(page)
    assert time.process_time() - begun < 30


def test_tags_end():
    assert html.main_text('<p title="a > b">Shown, yes.</p>') == "Shown, yes."
    assert html.main_text('<p title="a>Shown, yes.</p><p id=x>Also, this.</p>') == "Shown, yes.\n\nAlso, this."
    assert html.main_text("<p>Shown, 1 < 2 <b") == "Shown, 1 < 2 <b"
    assert html.main_text("<p>Shown, yes.<!-- <p>gone") == "Shown, yes."
    assert html.main_text("<p>Shown, yes.</p> <a <!-- gone") == "Shown, yes.\n\n<a"


def test_paths_are_chosen_by_their_ratios():
    rng = random.Random(5)
    words = {"ad": -1, "comments": -1, "story": 1, "": 0, "box": 0, "x": 0}

    def blocks():
        for _ in range(rng.randint(1, 4)):
            text = " ".join(rng.choice(["word", "text,", "end.", "other"]) for _ in range(rng.choice([1, 3, 30, 80])))
            yield rng.choice(["<p>%s</p>", "<h1>%s</h1>", "<p>%s</p>", '<p class="x">%s</p>', "<ul><li>%s</li></ul>", "<div><a>%s</a></div>"]) % text

    def part(depth):
        inner = "".join(part(depth - 1) for _ in range(rng.randint(1, 3))) if depth else "".join(blocks())
        name = rng.choice(["div", "div", "div", "article"])
        return f'<{name} class="{rng.choice(list(words))}">{inner}</{name}>'

    chosen = 0
    for _ in range(400):
        page = f"<body>{part(rng.randint(0, 2))}{part(1)}</body>"
        wanted = tag_path_text(page, words, html.SIGMA, html.EVIDENCE, html.AGAINST, html.SHARE, html.DROP, html.MOST)
        assert html.main_text(page) == wanted
        chosen += 0 < len(wanted) < len(" ".join(t for _, t in filter(None, Leaves(page).texts)))
    assert chosen > 200


def test_licenses(docs, empty):
    found = licenses.license_scan(docs).collect()
    wanted = Counter(license_row(t, licenses.PHRASES, licenses.TEMPLATES, licenses.THRESHOLD, licenses.SPAN) for _, t, *_ in ROWS)
    assert Counter(tuple(r)[1:8] for r in found) == wanted
    assert licenses.license_scan(empty).count() == 0


def test_license_blocks():
    notice = "Permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the Software to deal in the Software"
    texts = [
        "MIT\nlicense the mit-LICENSE mit license",
        "w " * 100 + notice + " without restriction" + " z" * 90,
        notice + "\nwithout restriction",
        "general public\tlicense apache license",
        "Licensed under the Apache\nLicense, Version 2.0",
    ]
    join = licenses.Join(licenses.TEMPLATES, {"the": 100, "license": 3}, licenses.THRESHOLD)
    out = licenses.scan_texts(pa.array(texts), join)
    found = list(zip(*[c.to_pylist() for c in out[:7]], strict=True))
    assert found == [license_row(t, licenses.PHRASES, licenses.TEMPLATES, licenses.THRESHOLD, licenses.SPAN) for t in texts]
    assert found[1][5] == "mit" and found[3][4] == "apache,gpl"


def test_a_wrapped_notice_counts_beside_a_weaker_line():
    template = licenses.TEMPLATES[1][1]
    words = template.split()
    weak = " ".join(words[:22] + ["other"] + words[24:])
    text = f"{weak}\nsomething else\n" + "\n".join(textwrap.wrap(template, 60))
    join = licenses.Join(licenses.TEMPLATES, {}, licenses.THRESHOLD)
    spans = [s for s in licenses.scan_texts(pa.array([text]), join)[7].to_pylist()[0] if s["template"] == 1]
    assert max(s["containment"] for s in spans) == 1.0 > min(s["containment"] for s in spans)


@pytest.mark.parametrize(
    "text, label",
    [
        ("SPDX-License-Identifier: ISC", "isc"),
        ("// SPDX-License-Identifier: Apache-2.0", "apache"),
        ("CC0 1.0 Universal", "cc0"),
        ("under the terms of the GNU Affero General\n * Public License as published", "agpl,gpl"),
        ("the GNU Lesser General Public License", "gpl,lgpl"),
        ("the GNU General Public License", "gpl"),
        ("SPDX is a format. A license needs an identifier.", ""),
    ],
)
def test_more_licenses(text, label):
    join = licenses.Join(licenses.TEMPLATES, {}, licenses.THRESHOLD)
    assert licenses.scan_texts(pa.array([text]), join)[5].to_pylist() == [label]


@pytest.mark.parametrize("prefix", ["", " * ", "# ", "REM "])
@pytest.mark.parametrize("before", [0, 3, 31, 32, 63, 64, 200])
def test_wrapped_notices(prefix, before):
    wrapped = [
        "\n".join(prefix + line for line in textwrap.wrap("filler " * before + text, 60)) for _, text in licenses.TEMPLATES
    ]
    join = licenses.Join(licenses.TEMPLATES, {}, licenses.THRESHOLD)
    spans = licenses.scan_texts(pa.array([None, *wrapped, "", "one\nline"]), join)[7].to_pylist()
    assert spans[0] == spans[-1] == spans[-2] == []
    for k, own in enumerate(spans[1:-2]):
        best = max((s["containment"] for s in own if s["template"] == k), default=0)
        assert best >= licenses.THRESHOLD, licenses.TEMPLATES[k]
        assert all(s["first_word"] + s["n_words"] <= len(licenses.text_words(wrapped[k])) for s in own)
    apart = licenses.scan_texts(pa.array(["This program is free software: you can\n" + "w " * 70 + "\n" + "License as published"]), join)
    assert apart[7].to_pylist() == [[]]


def test_nearest_edges(spark):
    rng = np.random.default_rng(6)
    points = rng.normal(size=(60, 4)).round(1).tolist()
    rows = [(i, p, 0) for i, p in enumerate(points)] + [(100 + i, points[3], 1) for i in range(80)]
    odd = [None, [], [0.0] * 4, [1.0, None, 0.0, 0.0], [float("nan")] * 4, [float("inf"), 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows += [(1000 + 20 * i, v, 0) for i, v in enumerate(odd)] + [(None, points[0], 0), (20, points[5], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = {}
    for r in vectors.nearest(table, F.col("vec_id") % 20 == 0, k=20, probe=1.0, words=4).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    fine = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v, _ in rows if i is not None and i < 1000]
    assert set(found) == {i for i, _ in fine if i % 20 == 0}
    for query, vector in fine:
        if query % 20 or query == 20:
            continue
        ranked = sorted((-round(float((vector * v).sum()), 9), i) for i, v in fine if i != query)[:20]
        own = sorted(found[query])
        assert [(i, round(s, 9)) for _, i, s in own] == [(i, -s) for s, i in ranked]
    assert vectors.nearest(table.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_toxicity(docs, empty, labels, no_labels):
    for given in (labels, no_labels):
        found = toxicity.toxicity(docs, given).collect()
        assert len(found) == len(ROWS) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.toxicity(empty, labels).count() == 0
    kept = toxicity.keep_clean(docs, no_labels)
    assert kept.columns == docs.columns and kept.count() == len(ROWS)


def test_toxicity_learns_its_words():
    rng = random.Random(7)
    plain = [(prose(k, rng.randrange(10, 200)), 0) for k in range(400)]
    bad = [(prose(1000 + k, 40) + " worthless scumbag " + prose(2000 + k, 20) + " pathetic moron", 1) for k in range(200)]
    rows = plain + bad
    rng.shuffle(rows)
    model = toxicity.fit(rows)
    lengths = toxicity.Lengths(model)
    fresh = pa.array([prose(5000 + k, 60) for k in range(50)] + [None, ""] + [prose(6000 + k, 60) + " WORTHLESS scumbag, pathetic moron" for k in range(50)])
    scores = toxicity.score_texts(fresh, model, lengths)
    assert (scores[:50] < 0.5).mean() > 0.95 and (scores[50:52] < 0.5).all() and (scores[52:] >= 0.5).mean() > 0.9


def test_urls(spark):
    rows = [
        (1, None), (2, "no scheme"), (3, "HTTP://Sub.Example.ORG/es/1?x=/en/1"), (4, "http://a.org"), (5, "x://a.com/fr/://y"),
        (None, "http://a.com/de/#z"), (7, "http://notorg/fr/"), (7, "http://example.net/en/5"), (8, "://"), (9, "http://org/EN/"),
        (10, "http://example.org/en/12"),
    ]
    table = spark.createDataFrame([(i, u, 0) for i, u in rows], "page_id long, url string, host int")
    found = Counter(tuple(r)[:5] for r in urls.judge_urls(table).collect())
    wanted = [
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "sub.example.org", "/es/1", "example.org/es/", "block"),
        (4, "a.org", "", None, None), (5, "a.com", "/fr/://y", "com/fr/", "allow"), (None, "a.com", "/de/", "com/de/", "block"),
        (7, "notorg", "/fr/", None, None), (7, "example.net", "/en/5", None, None), (8, "", "", None, "allow"),
        (9, "org", "/EN/", "org/", "allow"), (10, "example.org", "/en/12", "example.org/en/1", "block"),
    ]
    assert sum(found.values()) == len(wanted)
    for row in wanted:
        assert any(f[:4] == row[:4] and (row[4] is None or f[4] == row[4]) for f in found), row
    assert urls.judge_urls(table.limit(0)).count() == 0


def test_toxicity_learns_from_whole_texts(spark):
    rng = random.Random(8)
    prepare(spark)
    rows = [(i, prose(100 + i, 900), int(i % 3 == 0)) for i in range(240)]
    rows = [(i, t + (" vile grob scum " + rng.choice(["nasty", "filthy"])) * (40 * y), y) for i, t, y in rows]
    assert all(len(t) > 4000 for _, t, _ in rows)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert b"vile grob" in model.toxic[: toxicity.TOXIC_SIZE]
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [(found[i].predicted, y) for i, _, y in rows if found[i].held_out]
    assert all(p == 1 for p, y in held if y) and sum(p for p, y in held if not y) <= 1
    # The same rows in the same order give the same model on the driver.
    kept = [(i, t, y) for i, t, y in rows if not found[i].held_out]
    draws = {r.doc_id: r.draw for r in docs.select("doc_id", F.xxhash64("doc_id").alias("draw")).collect()}
    same = toxicity.fit([(t, y) for _, i, t, y in sorted((draws[i], i, t, y) for i, t, y in kept)])
    assert same.toxic == model.toxic and same.chance == model.chance and np.allclose(same.weights, model.weights)


def test_dictionaries_learn_from_every_window(monkeypatch):
    trained = {}
    monkeypatch.setattr(toxicity, "dictionary", lambda size, samples: trained.update({size: samples}) or b"")
    texts = [(toxicity.lowered(prose(i, n)), int(i % 5 == 0)) for i, n in enumerate([20, 5000, 3, 700, 900, 60_000])]
    toxicity.learn(texts)
    assert trained[toxicity.ORDINARY_SIZE] == [w for t, toxic in texts if not toxic for w in toxicity.windows(t)]
