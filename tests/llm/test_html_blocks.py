import pytest

from sensorgrid.llm import html_blocks as hb

LONG = "This is the kind of text that we have in it and it is so for the rest of the day and the night."
CASES = [
    ("", ""), ("plain text only", "plain text only"), ("<p></p>", ""),
    (f"<article><h1>T &amp; t</h1><p>{LONG}<p>Short.</p></article>", f"T & t\n{LONG}\nShort."),
    (f"<nav><ul><li>{LONG}</li></ul></nav><article><p>{LONG}</p></article><footer>{LONG}</footer>", LONG),
    (f"<header>{LONG}</header><div class='ad'>{LONG}</div><main><p>{LONG}</p></main><aside>{LONG}</aside>", LONG),
    (f"<article><p>{LONG}</p><form>{LONG}</form><div class=\"comments\"><p>{LONG}</p></div></article>", LONG),
    (f"<div id='cookie-notice'>{LONG}</div><article><p>{LONG}</p></article><section id=comments>{LONG}</section>", LONG),
    ("<article><p>a<script>if (a<b) { '</p>' }</script>b<style>p{}</style><!-- no <p> --></p></article>", "ab"),
    ("<article><p>one<br>two &nbsp; three&#33; &lt;b&gt; &copy;</p></article>", "one two three! <b> ©"),
    (f"<article><p><b>Bold and {LONG}<br><p>next</article>", f"Bold and {LONG}\nnext"),
    (f"<article><ul><li><a href=x>link one</a><li><a href=y>link two</a></ul><p>{LONG}</p></article>", LONG),
    (f"<article><p>{LONG}</p><p>cut off at &am", f"{LONG}\ncut off at &am"),
    (f"<div><p>{LONG}</p><p>Short one.</p></div><div><a href=x>Home</a></div>", f"{LONG}\nShort one."),
    (f"<article class='has-sidebar'><header><h1>Head</h1></header><p>{LONG}</p></article>", f"Head\n{LONG}"),
    (f"<div><p>{LONG}</p><p>{LONG} More.</p></div><article><a href=x>A teaser that leads elsewhere</a></article>", f"{LONG}\n{LONG} More."),
    (f"<article><p class=x'>{LONG}</p><p>it's here</p></article>", f"{LONG}\nit's here"),
    (f"<article><p>if a <b and it's so> {LONG}</p><p>next</p></article>", f"if a {LONG}\nnext"),
    (f'<article><p title="a > b" class=\'c\'>{LONG}</p></article>', LONG),
    (f"<article><p>{LONG}</p><select><option>one<p>{LONG}</p></article>", f"{LONG}\none\n{LONG}"),
    (f"<article><p>{LONG}</p><textarea>in it <p>{LONG}</p></article>", f"{LONG}\nin it\n{LONG}"),
    (f"<article><p>{LONG} <math><mi>x</mi><mo>=</mo><mn>1</mn></math> so</p><object>{LONG}</object></article>", f"{LONG} x=1 so\n{LONG}"),
    (f"<article><p>{LONG} zero\u200bwidth\u00a0gap</p></article>", f"{LONG} zero\u200bwidth gap"),
    (f'<article><p class="notice-of-death">{LONG}</p><div class="history-of-advertising"><p>{LONG}</p></div><p class="cookie-notice">{LONG}</p></article>', f"{LONG}\n{LONG}"),
    (f"<article><p hidden>{LONG}</p><p>{LONG}</p><p>  </p></article>", LONG),
]


@pytest.mark.parametrize("page,want", CASES)
def test_pages(page, want):
    assert hb.main_text(page) == want


def test_first_pass_against_its_rule():
    """Length, stop words and links, counted word by word."""
    import random
    rnd = random.Random(6)
    for _ in range(400):
        n = rnd.choice([0, 3, 11, 12, 13, 29, 30, 31, 60])
        words = [rnd.choice(["the", "of", "die", "que"]) if rnd.random() < rnd.choice([0.05, 0.2, 0.4]) else rnd.choice(["stone", "Haus", "42", "x-y"]) for _ in range(n)]
        text = " ".join(words)
        linked = rnd.choice([0, len(text) // 3, len(text)])
        single = [w for x in words for w in "".join(c if c.isalpha() else " " for c in x.lower()).split()]
        share = sum(w in hb.STOP_WORDS for w in single) / max(1, len(single))
        if linked > 0.5 * max(1, sum(map(len, words))):
            want = hb.BAD
        elif len(single) >= 12 and (share >= 0.3 or (len(single) >= 30 and share >= 0.15)):
            want = hb.GOOD
        else:
            want = hb.OPEN
        assert hb.first_pass((text, linked, False, False, 0)) == want
        assert hb.first_pass((text, linked, True, False, 0)) == hb.BAD


def test_deep_and_broken_pages():
    import time
    for page in ("<div>" * 100_000 + LONG, "<b>" * 50_000 + LONG + "</b>" * 50_000, "<ul><li>" * 30_000 + LONG + "</ul>" * 10, "<p><span>" * 40_000 + LONG,
                 "</div>" * 50_000 + f"<p>{LONG}", "<table><tr><td>" * 20_000 + LONG):
        start = time.process_time()
        assert hb.main_text(page) == LONG
        assert time.process_time() - start < 8            # linear; the square of it takes minutes


def test_undecided_blocks_follow_the_nearest():
    b = lambda x, art=False, box=0: (x, 0, False, art, box)
    found = [b("a"), b("b"), b("c"), b("d"), b("e")]
    assert hb.second_pass(found, [1, 0, 0, 0, -1]) == [True, True, False, False, False]     # a tie outside an article goes
    found = [b("a", box=1), b("b", box=1), b("c", box=2)]
    assert hb.second_pass(found, [1, 0, -1]) == [True, True, False]                          # its own box comes first
    found = [b("a", True), b("b", True), b("c", True)]
    assert hb.second_pass(found, [1, 0, -1]) == [True, True, False]


def test_table(spark):
    rows = [(i, "u", p) for i, (p, _) in enumerate(CASES)] + [(90, None, None), (91, "u", "<p>" + "word and the " * 50_000), (92, "u", "<p>x"), (92, "u", "<p>x")]
    df = spark.createDataFrame([(i, u, h, "old") for i, u, h in rows], "page_id bigint, url string, html string, text string").repartition(3)
    got = hb.summary(hb.extract(df)).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for i, (_, want) in enumerate(CASES):
        assert (by[i].text, by[i].n_chars) == (want, len(want))
    assert by[90].text == "" and by[91].n_chars == 13 * 50_000 - 1
    assert hb.extract(df.limit(0)).count() == 0


def test_every_sample_page_yields_its_article(spark):
    """On the sample pages the main text is what stands in ``article``."""
    import html
    import re
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    for r in rows:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S)[1].replace("<br>", " ")
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>?", "", x))).strip() for x in re.split(r"</?(?:p|h\d)>", inner)]
        assert hb.main_text(r.html) == "\n".join(x for x in parts if x)
