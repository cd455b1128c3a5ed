"""Near copies, benchmark leaks and page texts against brute force."""

import random
import re
import time
from collections import Counter
from html import unescape

import numpy as np
import pytest

from llm.edge import ODD, documents, prose
from tillworks.llm import dart_minhash, host_paths, template_leaks


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def weighted(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def plain_classes(rows):
    """(doc_id, class_id) by comparing all pairs of texts."""
    texts = sorted({t for _, t in rows if shingles(t)})
    bags, root = [shingles(t) for t in texts], list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if weighted(bags[i], bags[j]) >= 0.8:
                root[top(i)] = top(j)
    of = {t: top(i) for i, t in enumerate(texts)}
    ids: dict = {}
    for i, t in rows:
        if t in of and i is not None:
            ids[of[t]] = min(i, ids.get(of[t], i))
    return [(i, ids.get(of[t]) if t in of else i) for i, t in rows]


def edited(text, r, n):
    words = text.split(" ")
    for _ in range(n):
        words[r.randrange(len(words))] = f"edit{r.randrange(10 ** 6)}"
    return " ".join(words)


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("seed", [0, 1])
def test_classes_are_brute_force(spark, seed):
    r = random.Random(seed)
    bases = [prose(500 + k, r.choice([12, 60, 150, 400])) for k in range(12)]
    rows = [*ODD, *[(100 + i, edited(b := r.choice(bases), r, r.randrange(0, 1 + b.count(" ") // 25))) for i in range(260)]]
    found = dart_minhash.near_copies(documents(spark, *rows).repartition(4)).collect()
    assert order((x.doc_id, x.class_id) for x in found) == order(plain_classes(rows))


def test_small_tiles_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(dart_minhash, "TILE", 3)
    monkeypatch.setattr(dart_minhash, "TEXT_TILE", 3)
    monkeypatch.setattr(dart_minhash, "SMALL_TILE", 2)
    assert np.allclose(dart_minhash.likenesses(*[[dart_minhash.regions(prose(k, 40) + x) for k in (1, 2)] for x in ("", " a")]), [
        [weighted(shingles(prose(k, 40)), shingles(prose(j, 40) + " a")) for j in (1, 2)] for k in (1, 2)])
    r, base = random.Random(4), prose(77, 120)
    rows = [(i, edited(base, r, i % 9)) for i in range(90)]
    found = dart_minhash.near_copies(documents(spark, *rows)).collect()
    assert order((x.doc_id, x.class_id) for x in found) == order(plain_classes(rows))


def test_signatures_estimate_weighted_likeness():
    a, b = "x y z v w " * 30 + prose(1, 200), "x y z v w " * 15 + prose(1, 200)
    ra, rb = dart_minhash.regions(a), dart_minhash.regions(b)
    exact = weighted(shingles(a), shingles(b))
    assert dart_minhash.likeness(ra, rb) == pytest.approx(exact)
    agree = []
    for k in range(60):  # other darts: shift the regions alike
        sa, sb = dart_minhash.signatures([dart_minhash.mixed(ra + np.uint64(k)), dart_minhash.mixed(rb + np.uint64(k))])
        agree.append((sa == sb).mean())
    assert np.mean(agree) == pytest.approx(exact, abs=0.02)
    assert np.isfinite(dart_minhash.signatures([dart_minhash.regions("a"), dart_minhash.regions("a b")])).all()


def test_one_of_each(spark):
    frame = documents(spark, *ODD, (50, prose(2, 80) + " more"), (51, prose(8, 60)))
    kept = dart_minhash.one_of_each(frame)
    assert kept.columns == frame.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x or 0))
    assert ids == [0, 1, 2, 3, 4, 5, 7, 8, 9, 51, None]
    assert dart_minhash.one_of_each(frame.limit(0)).count() == 0 == dart_minhash.near_copies(frame.limit(0)).count()


ITEMS = [
    (1, "A train leaves Paris at 9 and travels 120 km in 2 hours. How fast does the train go on its way?"),
    (2, prose(900, 40)), (2, prose(900, 40)), (3, None), (4, ""), (5, "12 13 14"), (6, "tiny item here"), (None, prose(901, 30)),
]


def test_leaks(spark):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    again = "Once more. A train leaves Lyon at 7 and travels 300 km in 4 hours. How fast does the train go on its way? End."
    mixed_up = ("A train leaves Lyon at 7 and travels 300 km in 4 hours. How fast does the train go on its way? "
                "A train leaves Rome at 5 and travels 77 km in 8 hours. How fast does the train go on its way? "
                "A train leaves Bonn at 6 and travels 99 km in 3 hours. How fast does the train go on its way?")
    rows = [
        *ODD, (100, ITEMS[0][1]), (101, again), (102, prose(1, 20) + "\n" + prose(900, 40) + " " + prose(3, 20)), (103, "A tiny item here!"),
        (104, prose(900, 40)[:120]), (105, "12 13 14 15"), (106, mixed_up), (102, "other"), (107, ITEMS[1][1].upper()),
    ]
    found = {(r.doc_id, r.item_id) for r in template_leaks.leaks(documents(spark, *rows), items).collect()}
    # Three copies with other numbers each are one occurrence each: a leak.
    assert found == {(100, 1), (101, 1), (102, 2), (106, 1), (107, 2)}
    frame = documents(spark, *rows)
    kept = template_leaks.without_leaks(frame, items)
    assert kept.columns == frame.columns and kept.count() == len(rows) - 5
    assert (102, "other") in {(r.doc_id, r.text) for r in kept.collect()}
    assert template_leaks.leaks(frame, items.limit(0)).count() == 0 == template_leaks.leaks(frame.limit(0), items).count()


def leaked(spark, items, *texts):
    """(doc_id, item_id) of each leak; texts are numbered from 0."""
    items = spark.createDataFrame(items, "item_id bigint, text string")
    return {(r.doc_id, r.item_id) for r in template_leaks.leaks(documents(spark, *enumerate(texts)), items).collect()}


def test_leaks_by_occurrence(spark):
    ask = "A train leaves {} at {} and travels {} km in {} hours. How fast does the train go on its way?".format
    twice = "She puts 3 red apples in the big basket and he puts 5 red apples in the big basket today."
    apart = ask("Lyon", 7, 300, 4).replace("How fast", prose(4, 60) + " How fast")
    bad = ("A train leaves Lyon at 7 and travels 300 km in 4 hours. How fast does the train go on its way?" + " 5 red apples") * 2
    same = "Take 7 of the old coins and 7 of the new coins, then put 7 of the best coins and 7 of the worst coins aside."
    wrong = "Take 1 of the old coins and 2 of the new coins, then put 3 of the best coins and 4 of the worst coins aside."
    assert leaked(
        spark, [(1, ask("Paris", 9, 120, 2)), (2, twice), (3, same)],
        ask("Paris", 9, 120, 2) + " " + ask("Rome", 5, 77, 8), prose(5, 200) + " " + " ".join(ask(c, k, k + 50, k + 9) for k, c in enumerate(["Rome", "Bonn", "Bern"])),
        twice, apart + " " + ask("Rome", 5, 77, 8), bad, wrong, same.replace("7", "12"), prose(6, 300),
    ) == {(0, 1), (1, 1), (2, 2), (3, 1), (4, 1), (6, 3)}


def test_leaks_with_other_names_and_units(spark):
    ask = "{0} has 5 apples. {1} gives {0} 3 more. How many apples does {0} have?".format
    run = "On Monday the {} ran {} around the old lake, and then the old {} slept for {} days in the tall grass.".format
    corpus = "how many of the apples are old, and how many more are on the lake? how old are the many apples?"
    assert leaked(
        spark, [(1, ask("Alice", "Bob")), (2, run("fox", "5km", "fox", "five")), (3, "the McDonald farm sells the best milk to O'Brien and to the old town")],
        ask("Carol", "Dave"), "We read: " + ask("Alice", "Bob"), run("fox", "8km", "fox", "twenty"), "the McArthur farm sells the best milk to O'Neill and to the old town",
        ask("Carol", "Dave").replace("How many", "So few"), corpus, corpus + " so few.", ask("Will", "Dave") + " he will, she will",
    ) == {(0, 1), (1, 1), (2, 2), (3, 3), (7, 1)}


def test_leaks_by_item_and_text(spark):
    two, three, none = (prose(910 + k, 40) for k in range(3))
    assert leaked(spark, [(1, two), (1, three), (1, three), (None, none)], two, three, none, two + " " + three, prose(9, 90)) == {
        (0, 1), (1, 1), (2, None), (3, 1)}


def test_leaks_with_emphasis(spark):
    item = "the old man met us on the way to the extraordinarily big red hut in the low hills"
    assert leaked(spark, [(1, item)], item.replace("extraordinarily", "_extraordinarily_"), item) == {(0, 1), (1, 1)}


def test_leaks_with_a_common_phrase(spark):
    """Many items share most of their windows: a document meets those that it holds."""
    phrase = "what is the value of the old red copper coin in the garden of the king"
    items = [(k, f"{phrase} when the {w} of the town is sold to the {w} of the river?") for k, w in enumerate("mill bridge tower market".split())]
    docs = [items[2][1], phrase, (phrase + " ") * 50, items[0][1] + " " + items[3][1], prose(3, 400)]
    assert leaked(spark, items, *docs) == {(0, 2), (3, 0), (3, 3)}


def test_leaks_without_a_list(spark, monkeypatch):
    """More benchmark windows than tasks can be given: all windows take part in the join."""
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    rows = [*ODD, (100, ITEMS[0][1]), (102, prose(1, 20) + " " + prose(900, 40))]
    monkeypatch.setattr(template_leaks, "MOST_LISTED", 3)
    assert {(r.doc_id, r.item_id) for r in template_leaks.leaks(documents(spark, *rows), items).collect()} == {(100, 1), (102, 2)}


def test_leaks_of_the_benchmark(spark):
    """On the given tables: a document leaks an item if it holds the item's words in a row."""
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    plain = lambda t: " ".join(re.findall(r"\w+", (t or "").lower()))
    texts, items_plain = [(r.doc_id, plain(r.text)) for r in docs.collect()], [(r.item_id, plain(r.text)) for r in items.collect()]
    expected = {(d, i) for d, t in texts for i, b in items_plain if b in t}
    assert {(r.doc_id, r.item_id) for r in template_leaks.leaks(docs, items).collect()} == expected


TEMPLATE = (
    '<!DOCTYPE html><html><head><title>T</title><script>var t="</p><p>no";</script></head><body class=page-{n}><nav><ul><li><a href="/">Home</a></ul></nav>'
    '<div class="ad ad-{n}">Buy</div><div id=cookie-notice>Cookies</div><div class="story col-{n}"><h1>Head &amp; {n}</h1><p><b>One\n two<br>x<p>Three &lt;&#52;'
    '<aside>See also</aside><form><p>Mail</p></form><ul><li>item a<li>item <i>b</i></ul><div class="comments"><p>{c}</p></div></div><footer>&copy;</footer></body></html>'
)


def test_main_text(spark):
    rows = [(i, f"http://h.example.com/{i}", TEMPLATE.format(n=i, c="reader " * 5)) for i in range(9)]
    rows += [(20, "http://H.example.com/thin", '<body><div class="story col-3">tiny</div><div class="x">' + "longer text elsewhere " * 20 + "</div></body>"),
             (21, "http://other/", None), (22, None, ""), (23, "http://other/", "no tags at  all &eacute"), (24, "http://h2/", "<p>a<p>b</body>c"),
             (25, "http://h3/", "<script>only</script><nav>menu</nav>"), (26, "http://h3/", "<article><p>unclosed <b>bold"), (26, "http://h3/", "<article><p>unclosed <b>bold")]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, path string")
    found = {r.page_id: r.text for r in host_paths.main_texts(frame).collect()}
    for i in range(9):
        assert found[i] == f"Head & {i}\nOne two x\nThree <4\nitem a\nitem b"
    assert found[20] == "tiny"  # the host's path wins over the page's longest container
    assert [found[i] for i in (21, 22, 23, 24, 25, 26)] == ["", "", "no tags at all é", "a\nb\nc", "", "unclosed bold"]
    assert host_paths.main_texts(frame).count() == len(rows) and host_paths.main_texts(frame.limit(0)).count() == 0


def texts_of_pages(spark, *pages):
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id bigint, url string, html string")
    return [r.text for r in host_paths.main_texts(frame).orderBy("page_id").collect()]


def test_sections_and_templates(spark):
    part = "<h2>Part</h2><p>" + "words of a part " * 9 + "</p>"
    whole = f"<h1>Head</h1><p>A lead.</p><section>{part}</section><section>{part}</section><table><tr><td>{part}</table>"
    flat = "\n".join(["Head", "A lead.", *["Part", ("words of a part " * 9).strip()] * 3])
    furniture = "<div class=teasers>" + "<p><a href=/x>another story to read here</a></p>" * 20 + "</div>"
    rows = [(f"http://a/{k}", f"<body><div class=page><main><article>{whole}</article>{furniture}</main></div></body>") for k in range(3)]
    rows += [(f"http://b/{k}", f"<body><div class=story>{whole}</div>{furniture}<div class=other>Some other words</div></body>") for k in range(3)]
    rows += [(f"http://c/{k}", f"<body class=post-{k}><div class=top>{'date and tags ' * 3}</div><div class=story>{part}</div></body>") for k in range(9)]
    rows += [(f"http://c/q{k}", f"<body class=forum><div class=story>Rules</div><div class=top>{part}</div></body>") for k in range(6)]
    part_text = flat.partition("A lead.\n")[2].split("\nPart")[0]
    assert texts_of_pages(spark, *rows) == [flat] * 6 + [part_text] * 15


def test_noise_words_of_wrappers(spark):
    story, menu = "<h1>Head</h1><p>" + "words of a story " * 9 + "</p>", "<div class=sidebar><p>Read this too</p></div>"
    inside = [
        f"<div class='layout has-sidebar'>{story}{menu}</div>", f"<div class=content-with-sidebar><article>{story}</article>{menu}</div>", f"<div class=no-header>{story}</div>",
        f"<div class='search-result'>{story}{menu}</div>", f"<div id=search><main>{story}</main>{'<p>x y z</p>' * 3}</div>", f"<div class=comments>{story}</div>",
        f"<div class=story>{story}</div><div class=comments><article class=comment><p>{'reader says ' * 90}</p></article></div>",
    ]
    assert texts_of_pages(spark, *[(f"http://h{k}/", f"<body>{h}</body>") for k, h in enumerate(inside)]) == ["Head\n" + ("words of a story " * 9).strip()] * 7


def test_articles_are_kept_whole(spark):
    words = "plain words of a text " * 6
    text = words.strip()
    pages = [
        f"<body><article><p><a href=/a>{words}</a></p><p>and more</p></article><div><p>short other text</p></div></body>",
        f"<body><article><header><h1>Title</h1></header><p>{words}</p></article><header>Site</header></body>",
        f"<body><article><h2 class=search-methods>Methods</h2><p>{words}</p><div class=related-work><p>{words}</p></div></article></body>",
        f"<body><article><p>{words}</p><pre>x = 1 <span class=hljs-comment># why</span></pre></article></body>",
        f"<body><main><p>{words}</p><div class=related><a href=/x>{words}</a></div><div class=comments><p>{words}</p></div></main><footer>{words}</footer></body>",
    ]
    want = [f"{text}\nand more", f"Title\n{text}", f"Methods\n{text}\n{text}", f"{text}\nx = 1 # why", text]
    assert texts_of_pages(spark, *[(f"http://p{k}/", h) for k, h in enumerate(pages)]) == want


def test_broken_markup_takes_linear_time():
    begun = time.monotonic()
    for part in ("<a ", "<a '", '<a "> ', "<!", "<b <i", "</x>", "<a b='\">", "<script"):
        host_paths.Page("<p>text</p>" + part * (1_000_000 // len(part))).text("")
    assert time.monotonic() - begun < 40
    quoted = host_paths.Page("<p title='a > b'>one <b class=\"x>y\">two</b></p><a href='open>three")
    assert quoted.text("") == "one two\nthree"


def test_many_winning_paths(spark, monkeypatch):
    """More paths than tasks are given: a host's pages are dealt out by salt."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    few = sorted(map(tuple, host_paths.main_texts(pages).collect()))
    monkeypatch.setattr(host_paths, "MOST_PATHS", 0)
    assert sorted(map(tuple, host_paths.main_texts(pages).collect())) == few


def test_pages_of_the_tables(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in host_paths.main_texts(pages).collect():
        article = re.search(r"<article>(.*)</article>", html[r.page_id], re.S)[1]
        blocks = [re.sub(r"\s+", " ", unescape(re.sub(r"</?b>", "", b).replace("<br>", " "))).strip() for b in re.split(r"</?(?:h1|p)>", article)]
        assert r.text == "\n".join(b for b in blocks if b)
