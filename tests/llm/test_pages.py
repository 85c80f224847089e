import random
import re
import time

import numpy as np

from silverline.llm import pages

PAGE = ('<!DOCTYPE html><html lang="fr"><head><meta charset="utf-8"><title>T&amp;</title><style>p{{margin:0}}</style><script>var t="</p>";track({i});</script></head>'
        '<body><nav><ul><li><a href="/a">Home</a></li></ul></nav><!-- ad {i} --><div class="ad">Buy now.</div><article><h1>Title  {i} &amp;&amp;</h1>'
        "<p><b>First\n {i}.<br><p>Second &eacute;&#233; <i>x</i>y{i}.</p></article><footer>&copy; host</footer></body></html>")


def test_article_text():
    got = pages.main_texts([PAGE.format(i=i) for i in range(5)] + [None, ""])
    assert got == [f"Title {i} &&\nFirst {i}.\nSecond éé xy{i}." for i in range(5)] + ["", ""]


def test_boilerplate_without_article_goes_by_repetition():
    notice = "<div>We use a lot of little files on this site</div>"
    made = [f"<html><body>{notice}<p>{i}x own words number {i}y</p><ul><li>Home</li><li>About us</li><li>Shop</li><li>Jobs</li></ul><p>We use a lot of little files on this site {i}z and page more</p></body></html>" for i in range(4)]
    got = pages.main_texts(made)
    assert got == [f"{i}x own words number {i}y\n{i}z and page more" for i in range(4)]
    assert pages.main_texts(made[:1]) == ["We use a lot of little files on this site\n0x own words number 0y\nHome\nAbout us\nShop\nJobs\nWe use a lot of little files on this site 0z and page more"]


def test_markup_traps():
    page = ('<body><header>Site</header><article><header><h2>Head</h2></header><div class="share-buttons">Share</div><p title="a > b">one<!-- <p>no</p> --> two</p>'
            '<aside>side</aside><form><p>mail</p></form><pre>a\n  b</pre><textarea><p>x</textarea></article><section id="comments"><p>reader</p></section>'
            '<div role="dialog">cookie</div><script>if (a < b) "<p>no</p>"</script><p>tail &lt;b&gt;')
    assert pages.main_texts([page]) == ["Head\none two\na b"]
    assert pages.main_texts(["<p>un<b>closed <script>never"]) == ["un closed".replace("un ", "un")]


def test_suffix_array_coverage_matches_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(30):
        streams = [rng.integers(0, 4, rng.integers(0, 60)) for _ in range(rng.integers(1, 6))]
        n = int(rng.integers(2, 9))
        where = {}
        for k, s in enumerate(streams):
            for i in range(len(s) - n + 1):
                where.setdefault(tuple(s[i:i + n]), set()).add(k)
        got = pages.covered(streams, n)
        for k, s in enumerate(streams):
            want = np.zeros(len(s), bool)
            for i in range(len(s) - n + 1):
                if len(where[tuple(s[i:i + n])]) > 1:
                    want[i:i + n] = True
            assert (got[k] == want).all()


def test_every_page_has_a_row(spark):
    rows = [(i, f"http://{'hot' if i % 3 else 'h' + str(i % 5)}.example.com/{i}", PAGE.format(i=i), "x", "y") for i in range(300)]
    rows += [(None, None, None, "", ""), (1, "odd", "", "", ""), rows[5], rows[5]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string, part string")
    got = pages.extract(df, group_pages=40).collect()
    assert sorted((r["page_id"] or -1, r["url"] or "", r["text"]) for r in got) == sorted(
        (r[0] or -1, r[1] or "", pages.main_texts([r[2]])[0]) for r in rows)
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert pages.extract(df.limit(0)).count() == 0


def test_repeats_across_groups_of_a_host_match_one_group(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{k}" for k in range(400)]
    passages = [" ".join(rng.choice(vocabulary, rng.integers(5, 12))) for _ in range(60)]
    made = []
    for i in range(240):
        parts = [f"<div>{' '.join(rng.choice(vocabulary, 8))}</div>"]
        if i % 3 == 0:  # most passages stand on two to five pages of the host
            parts.append(f"<p>{passages[rng.integers(60)]} own{i}</p>")
        if i % 4 == 0:
            parts.append(f"<article><p>{passages[rng.integers(60)]}</p></article>")
        made.append("<body>" + "".join(parts) + "</body>")
    made += made[:3] * 5 + [None, ""]  # equal pages are one page
    rows = [(i, "http://hot.example.com/", h) for i, h in enumerate(made)]
    distinct = list(dict.fromkeys(h or "" for h in made))
    want = dict(zip(distinct, pages.main_texts(distinct), strict=True))
    got = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), group_pages=16).collect()
    assert {r["page_id"]: r["text"] for r in got} == {i: want[h or ""] for i, _, h in rows}
    assert len(got) == len(rows)
    assert any(len(want[h].split()) < len(pages.main_texts([h])[0].split()) for h in distinct if h)


def test_article_below_flags_and_forms():
    text = "<h1>Head</h1><p>the article itself</p>"
    for wrapper in ("div class='content no-sidebar'", "div class=with-sidebar", "div class='has-sidebar'", "div class='comments-open'", "div class='share-enabled'",
                    "div id='page-menu-open'", "section class='sidebar'", "form action='/x'"):
        tag = wrapper.split()[0]
        for inner in ("article", "main"):
            page = f"<body><nav>Home</nav><{wrapper}><{inner}>{text}<div class='share-buttons'>Share</div></{inner}></{tag}><footer>end</footer></body>"
            assert pages.main_texts([page]) == ["Head\nthe article itself"], page
    assert pages.main_texts(["<div class='content no-sidebar'><p>plain text</p></div><div class='site-footer'>end</div><div class='sidebar-left'>side</div>"]) == ["plain text"]
    assert pages.main_texts(["<article><p>own</p></article><section id='comments'><article>reader</article></section>"]) == ["own"]
    assert pages.main_texts(["<article></article><form><article>own</article></form>"]) == ["own"]


def _say(rng, n):
    return " ".join(f"w{k}" for k in rng.integers(0, 3000, n))


def test_near_copies_do_not_delete_each_other():
    rng = np.random.default_rng(7)
    shared = "".join(f"<p>{_say(rng, 60)}</p>" for _ in range(5))
    made = [f"<body><script>id={i}</script><p>Seen on day {i} by reader{i}</p>{shared}</body>" for i in range(5)]
    made += [f"<body><p>Seen on day x{i} by nobody{i}</p><p>{_say(rng, 200)}</p></body>" for i in range(3)]
    assert pages.main_texts(made) == [pages.main_texts([p])[0] for p in made]


def _large_host(rng, n):
    phrases = [_say(rng, 6) for _ in range(12)]
    notice = "<div>Please accept the small files of this site now</div>"
    own = ["".join(f"<p>{_say(rng, 9)} {phrases[rng.integers(12)]} {_say(rng, 9)}</p>" for _ in range(4)) for _ in range(n)]
    return [f"<body>{notice}{p}</body>" for p in own], ["\n".join(pages.main_texts([f"<body>{p}</body>"])) for p in own]


def test_ordinary_phrases_of_a_large_host_stay():
    made, want = _large_host(np.random.default_rng(8), 200)
    assert pages.main_texts(made) == want


def test_ordinary_phrases_stay_across_groups(spark):
    made, want = _large_host(np.random.default_rng(9), 150)
    rows = [(i, "http://hot.example.com/", h) for i, h in enumerate(made)]
    got = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), group_pages=16).collect()
    assert {r["page_id"]: r["text"] for r in got} == dict(enumerate(want))


def test_notices_inside_articles(spark):
    rng = np.random.default_rng(10)
    notice = "<p>Subscribe to our weekly letter and get the best stories first</p>"
    own = [(_say(rng, 40), _say(rng, 30)) for _ in range(60)]
    made = [f"<body><article><h2>Story</h2><p>{a}</p>{notice}<p>{b}</p></article></body>" for a, b in own]
    copies = [f"<body><article><p>{own[0][0]} {own[1][1]} {own[2][1]}</p><p>{own[3][0]}</p><p>copy{i}</p></article></body>" for i in range(50)]
    want = [f"Story\n{a}\n{b}" for a, b in own]
    assert pages.main_texts(made) == want
    assert pages.main_texts(copies) == [pages.main_texts([p])[0] for p in copies]
    rows = [(i, "http://hot.example.com/", h) for i, h in enumerate(made)]
    got = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), group_pages=16).collect()
    assert {r["page_id"]: r["text"] for r in got} == dict(enumerate(want))


def test_many_common_runs_go_to_the_groups(spark, monkeypatch):
    monkeypatch.setattr(pages, "SENT_RUNS", 0)
    test_ordinary_phrases_stay_across_groups(spark)
    test_notices_inside_articles(spark)


# The tags of a page as one pattern; slow on pages of unclosed tags, but plain.
PIECE = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>|<[!?/][^>]*>", re.S)


def test_the_scanner_finds_what_the_pattern_finds():
    rng = random.Random(8)
    parts = ["<", ">", "a", "</", "<a ", "<div class=", "\"", "'", "x y", "<!--", "-->", "--!>", "->", "<!", "<?", "/>", "<br/>", "</p >", "\n", "=", "<script>", "é"]
    for _ in range(6000):
        page = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 25)))
        scanner, at, got = pages.Scanner(page), 0, []
        while found := scanner.piece(at):
            got.append(found)
            at = found[1]
        want, at = [], 0
        while m := PIECE.search(page, at):
            want.append((m.start(), m.end(), (m[2] or m[5] or "").lower(), bool(m[1] or m[4]), m[3] or m[6] or ""))
            at = m.end()
        assert got == want, page


def test_a_long_page_of_any_kind_takes_a_short_time():
    n = 1 << 20
    for unit in ("<a ", "<a \"", "<a '\"", "<", "</", "<!--", "<!-- -->", "<a \">", "<a<", "<div>", "</script ", "<script>", "<div class='", "&amp;", "<p>x", "<div></p></section>"):
        page = unit * (n // len(unit))
        start = time.process_time()
        pages.blocks(page)
        pages.blocks(page + ">")
        assert time.process_time() - start < 12, unit
    words = "long text of many words " * 40_000
    assert pages.main_texts([f"<html><body><article><p>{words}</p></article><a " + "<a " * 1000]) [0].startswith("long text of many words")
