import random
import time

import pytest

from statelake.llm.extraction import host_wrappers, main_text, page_items
from statelake.llm.wrappers import align, choose, extract, main_texts, wrapper_of


def page(title, *paragraphs, aside=""):
    body = "".join(f"<p>{p}" for p in paragraphs)
    return (
        f"<html><head><title>{title}</title><script>var a='<p>no</p>';</script><style>p{{}}</style></head><body><nav><ul><li><a>Home</a><li>"
        f"<a>About</a></ul></nav><!-- <p>hidden</p> --><div class='ad'>Buy!</div>{aside}<article><h1>{title}</h1>{body}"
        f"<div class=\"comments\"><p>First!</p></div></article><aside>More</aside><form><p>Mail?</p></form><footer>&copy; us</footer></body></html>"
    )


PAGES = [
    (1, "http://h.example/1", page("One", "a &amp; b", "two\n  <b>bold</b> words<br>end")),
    (2, "http://h.example/2", page("Two", "c", aside="<div id=cookie-notice><p>Cookies</p></div>")),
    (3, "http://h.example/3", page("Three", *[f"p{k}" for k in range(30)])),
    (3, "http://h.example/3", page("Three", *[f"p{k}" for k in range(30)])),
    (4, "http://h.example/4", None),
    (5, None, ""),
    (6, "no address", "plain text, <i>no</i> blocks"),
    (None, "http://other/", "<article><p>never closed"),
]
TEXTS = ["One\na & b\ntwo bold words end", "Two\nc", "Three\n" + "\n".join(f"p{k}" for k in range(30))]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id bigint, url string, html string, text string")


def test_main_text(spark):
    got = sorted((tuple(r) for r in main_text(frame(spark, PAGES)).collect()), key=str)
    texts = [TEXTS[0], TEXTS[1], TEXTS[2], TEXTS[2], "", "", "plain text, no blocks", "never closed"]
    assert got == sorted(((i, u, t, len(t)) for (i, u, _), t in zip(PAGES, texts, strict=True)), key=str)


def test_one_wrapper_per_host_however_pages_are_dealt(spark):
    pages = frame(spark, PAGES * 5)
    for parts in (1, 6):
        hosts = [r["host"] for r in host_wrappers(pages.repartition(parts)).collect()]
        assert sorted(hosts) == ["", "h.example", "other"]


def test_empty_table(spark):
    assert main_text(frame(spark, PAGES).filter("1 = 0")).count() == 0


def test_alignment_finds_repeats_optional_parts_and_slots():
    one = wrapper_of(page_items("<div><h2>x</h2><p>a</p><p>b</p></div><hr><section>same</section>"))
    two = wrapper_of(page_items("<div><h2>y</h2><p>a</p></div><section>same</section>"))
    div, rule, section = align(one, two)
    heading, paragraph = div[5]
    assert paragraph[1] == 1 and heading[5][0][4] is None  # repeated; a slot
    assert rule[2] == 1 and section[2] == 0 and section[5][0][4] is not None  # optional; required; constant


def test_pairs_of_labels_repeat_as_a_group():
    items = page_items("<dl><dt>a<dd>b<dt>c<dd>d<dt>e<dd>f</dl>")
    assert [x[0] for x in wrapper_of(items)[0][5]] == ["(dt dd)"]


def test_without_main_elements_constant_slots_go():
    sources = [f"<body><div><p>Welcome</p></div><div><div><p>story {k}</p></div></div></body>" for k in range(4)]
    wrapper = wrapper_of(page_items(sources[0]))
    for s in sources[1:]:
        wrapper = align(wrapper, wrapper_of(page_items(s)))
    assert choose(wrapper) is None and extract(page_items(sources[2]), wrapper, None) == ["story 2"]


def texts_of(spark, sources, url="http://mixed.example/"):
    rows = [(k, url, s) for k, s in enumerate(sources)]
    return [r["text"] for r in main_text(frame(spark, rows)).orderBy("page_id").collect()]


def test_pages_of_one_host_with_several_templates(spark):
    sources = ["<article><p>one</article><p>out", "<main><p>two</main><p>out", "<div class=content><p>three</div><p>out", "<p>four"]
    for url in ("http://mixed.example/", None):
        assert texts_of(spark, sources, url) == ["one", "two", "three", "four"]


def test_an_advert_in_a_repeated_group_drops_itself_only(spark):
    article = "<article>" + "".join(f"<p>p{k}</p><div class='ad slot'>Buy!</div>" for k in range(3)) + "</article>"
    content = "<div class='a'>no</div><div class='content x'>yes</div>" * 2
    assert texts_of(spark, [article, content]) == ["p0\np1\np2", "yes\nyes"]


def test_copies_and_repeats_of_a_page_are_no_support(spark):
    copies = ["<body><h1>Title</h1><p>only</p><table><tr><td>x<td>x<td>x</table></body>"] * 5
    assert texts_of(spark, copies) == ["Title\nonly\nx\nx\nx"] * 5
    assert texts_of(spark, copies[:1]) == ["Title\nonly\nx\nx\nx"]
    sides = [f"<body><nav>{k}</nav><p>only</p></body>" for k in range(4)]
    assert texts_of(spark, sides) == ["only"] * 4
    assert texts_of(spark, [f"<p>Welcome</p><div>story {k}</div>" for k in (1, 2, 2, 3)]) == ["story 1", "story 2", "story 2", "story 3"]


def test_classes_of_page_and_main_elements_make_no_aside(spark):
    sources = [
        "<html class='with-header'><body class='no-sidebar'><article class='post comments-open'><p>one</article></body></html>",
        "<body class='has-sidebar'><main class='with-sidebar'><p>two</main></body>", "<body class='comments-open'><p>three</body>",
    ]
    assert texts_of(spark, sources) == ["one", "two", "three"]


# -- the main part follows from the wrapper ----------------------------------------------------------

WELCOME = "Welcome to this site, which has said the same at great length on every single page for many years now"


def test_the_wrapper_decides_what_the_main_part_is():
    """A part that calls itself post says the same on all pages; what differs is elsewhere."""
    sources = [f"<body><div class=post><p>{WELCOME}</p></div><div class=x><p>story {k} is told</p></div></body>" for k in range(4)]
    wrapper = wrapper_of(page_items(sources[0]))
    for s in sources[1:]:
        wrapper = align(wrapper, wrapper_of(page_items(s)))
    items = page_items(sources[2])
    assert main_texts(items, wrapper) == ["story 2 is told"]
    assert main_texts(items, []) == [WELCOME]


def test_the_wrapper_reaches_the_result(spark):
    sources = [f"<body><div class=post><p>{WELCOME}</p></div><div class=x><p>story {k} is told</p></div></body>" for k in range(5)]
    assert texts_of(spark, sources) == [f"story {k} is told" for k in range(5)]


def test_teasers_beside_the_main_part_are_left_out(spark):
    long = "a long and winding tale number {} that goes on and on until the reader knows it all"
    first = [f"<body><div class=post><h1>T{k}</h1><p>{long.format(k)}</p></div><article><p>read on {k}</p></article></body>" for k in range(4)]
    second = [f"<body><article><p>{long.format(k)}</p></article><article><p>more {k}</p></article></body>" for k in range(4)]
    assert texts_of(spark, first) == [f"T{k}\n{long.format(k)}" for k in range(4)]
    assert texts_of(spark, second) == [long.format(k) for k in range(4)]
    index = [f"<body><article><p>{long.format(k)}</p></article><article><p>{long.format(k + 9)}</p></article></body>" for k in range(4)]
    assert texts_of(spark, index) == [f"{long.format(k)}\n{long.format(k + 9)}" for k in range(4)]


def test_ids_and_parts_of_words_do_not_drop_headings_or_paragraphs(spark):
    source = "<article><h2 id='related-work'>A</h2><h2 id='how-to-search'>B</h2><p class='notice-period'>C</p><p id=comments>D</p><div class='site-footer'>E</div><div id=comments>F</div></article>"
    assert texts_of(spark, [source]) == ["A\nB\nC\nD"]


def test_inline_adverts_and_hidden_parts(spark):
    source = (
        "<article><p>one <span class='ad'>BUY <span>IT</span> NOW</span>two</p><div hidden>no</div><p style='display: none'>no</p>"
        "<p>three <em class=sponsored>no<p>four</p><div class=ad-free>kept?</div><p title='class=ad'>five</p></article>"
    )
    assert texts_of(spark, [source]) == ["one two\nthree\nfour\nfive"]


def test_quotes_and_brackets(spark):
    cases = {
        "<p title='a > b'>x</p>": "x", '<p title="<p>">x': "x", '<p title="never closed>x</p><p>y</p>': "x\ny", "a < b and <3": "a < b and <3",
        "<p>a<!-- <p>b --> c<![CDATA[d]]></p>": "a c", "<p>x<": "x<", '<a href="': '<a href="', "<script>a<b</script >x": "x", "<script src=x />y</script>z": "z",
        "<P CLASS=AD>no</P><P>yes</P>": "yes", "<p>&lt;p&gt; &amp;amp;</p>": "<p> &amp;", "<textarea>no</textarea>x<style>": "x",
    }
    assert texts_of(spark, list(cases)) == list(cases.values())


def test_long_and_deep_pages_take_linear_time(spark):
    n = 100_000
    pages = {
        "<div>" * n + "text" + "</div>" * n: "text", "<div>" * n + "<p>a</p><nav>no</nav>" + "</span></li>" * n + "b": "a\nb", "<a title=\"" * n + "x": None,
        "<a \">\"" * n: None, "<a '" * n + ">x": "x", "<!--" * n: "", "<" * n: "<" * n, "<article><p>" + "word " * (n * 2): ("word " * (n * 2)).strip(),
        "<ul><li>" * 10_000 + "deep": "deep", "".join(f"<p class={chr(97 + i * 7919 % 26)}{chr(97 + i * 31 % 26)}>{i}</p>" for i in range(n // 5)): "\n".join(map(str, range(n // 5))),
    }
    began = time.time()
    got = texts_of(spark, list(pages))
    assert time.time() - began < 90
    for found, wanted in zip(got, pages.values()):
        assert wanted is None or found == wanted


# -- generated sites against a plain extractor --------------------------------------------------------


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def site(rng, marked):
    """A template, and pages of it with the text that a reader would call the article's."""
    holder = rng.choice(["<article{}>|</article>", "<main{}>|</main>", "<div class='entry{}'>|</div>"]) if marked else "<div class='c{}'>|</div>"
    start, end = holder.replace("{}", rng.choice([" lang=en", ""]) if "<div" not in holder else "").split("|")
    menu = "".join(f"<li><a href=/{k}>{sentence(rng, 1)}</a>" for k in range(rng.randrange(1, 9)))
    tops = [f"<nav><ul>{menu}</ul></nav>", f"<div class=menu><ul>{menu}</ul></div>", f"<header><p>{sentence(rng, 5)}</p></header>", f"<div class='top'><p>{sentence(rng, 30)}</p></div>"]
    rng.shuffle(tops)
    tops = "".join(tops[: rng.randrange(1, 5)])
    wrap = rng.randrange(3)

    def page():
        blocks, out = [], []

        def say(text, markup):
            blocks.append(markup.replace("{}", text))
            out.append(text)

        say(sentence(rng, 4), "<h1>{}</h1>")
        for _ in range(rng.randrange(1, 12)):
            kind = rng.randrange(6)
            if kind < 3:
                say(sentence(rng, rng.randrange(3, 40)), rng.choice(["<p>{}</p>", "<p><b>{}</b></p>", "<p>{}"]))
            elif kind == 3:
                for _ in range(rng.randrange(1, 5)):
                    say(sentence(rng, 6), "<ul><li>{}</li></ul>")
            elif kind == 4:
                blocks.append(f"<div class='{rng.choice(['ad', 'share social', 'related'])}'><p>{sentence(rng, 9)}</p></div>")
            else:
                say(sentence(rng, 12), "<blockquote><p>{}</p></blockquote>")
        after = f"<div class=comments><p>{sentence(rng, 20)}</p></div><footer>{sentence(rng, 9)}</footer>"
        inner = "<div class=w>" * wrap + start + "".join(blocks) + end + "</div>" * wrap
        return f"<html><head><title>{out[0]}</title></head><body>{tops}{inner}{after}</body></html>", "\n".join(out)

    return [page() for _ in range(rng.randrange(6, 14))]


@pytest.mark.parametrize("marked", [True, False])
def test_generated_sites(spark, marked):
    rng = random.Random(11 + marked)
    rows, want = [], {}
    for host in range(25):
        for source, text in site(rng, marked):
            want[len(rows)] = text
            rows.append((len(rows), f"http://h{host}.example/{len(rows)}", source))
    got = {r["page_id"]: r["text"] for r in main_text(frame(spark, rows)).collect()}
    assert got == want
