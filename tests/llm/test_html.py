import html as entities
import re

from edgefilter.llm import html as X
from edgefilter.llm.common import table


def brute(page):
    """Blocks of the one article, cut by its own tags."""
    article = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
    out = []
    for part in re.split(r"</?(?:p|h1|div|ul|li)\b[^>]*>", article):
        plain = re.sub(r"<[^>]*>", lambda m: " " if m.group(0).startswith("<br") else "", part)
        out.append(" ".join(entities.unescape(plain).split()))
    return "\n".join(t for t in out if t)


def test_query_equals_the_articles(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in table(spark, sf, "pages").collect()}
    rows = X.op9_html(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        assert r.text == brute(pages[r.page_id]) and r.n_chars == len(r.text)


LONG = "The cat and the dog of the house that was in the wood had not been there when they came. " * 3


def test_second_pass_on_a_page_without_an_article():
    page = f"""<body><div><a href=/>Home</a> <a href=/x>News of the day</a></div><div><h2>A heading</h2><p>{LONG}<p>Short one.
      <p>{LONG}<p>Short last.</div><div class="x comments-list"><p>{LONG}</div><div class=sidebar>{LONG}</div>
      <form><p>{LONG}</form><p>tail &copy; x</p><div>© 2020 all of it</div>"""
    long = " ".join(LONG.split())
    assert X.main_text(page) == "\n".join(["A heading", long, "Short one.", long, "Short last."])


def test_text_outside_an_article_is_left_out():
    assert X.main_text(f"<div><p>{LONG}</div><article><p>{LONG}<p>end</article><p>{LONG}") == f"{LONG.strip()}\nend"


def test_first_pass_by_itself():
    def block(text, links=0, aside=False, main=False):
        return X.decide(X.Block(text, links, 0, aside, main, False))
    assert block(LONG) == "text" and block(LONG, aside=True) == "other" and block(LONG, links=len(LONG)) == "other"
    assert block("Short.") == "open" and block("xq zv " * 60) == "other" and block("xq zv " * 60, main=True) == "open"


def test_odd_markup():
    a = "<article>{}</article>"
    for inner, want in [
        ("<p>a&nbsp;&amp;\n b&lt;c&#233;&hellip;", "a & b<cé…"), ("<p>x<b>y</b>z<br>w", "xyz w"),
        ("<p title='a>b'>t</p><!-- <p>no --><p>u", "t\nu"), ("<script>'<p>no</p>'</script><style>p{}</style>ok", "ok"),
        ("<p>one<p>two</div></p>three", "one\ntwo\nthree"), ("a<script>never ended <p>no", "a"), ("<p>5 < 6 > 4 & 3", "5 < 6 > 4 & 3"),
        ("<header><h1>T</h1></header><p>b", "T\nb"), ("<ul><li>i<li>j</ul>", "i\nj"), ("<p><b>x<p>y</b>z", "x\nyz"),
        ("<p>t<aside>no</aside><div class='ad'>no</div><div role=navigation>no</div>u", "t\nu"),
        ("<td>a</td><!-- open", "a"), ("", "")]:
        assert X.main_text(a.format(inner)) == want, inner


def test_edge_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "v", "<article><p>x</article>"), (3, "w", "<p>" * 3000 + LONG),
            (3, "w", "<p>" * 3000 + LONG), (4, "z", "<article>" + f"<p>{LONG}" * 3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = sorted(((r.page_id, r.url, r.n_chars) for r in X.extract(df).collect()), key=str)
    n = len(" ".join(LONG.split()))
    assert got == sorted([(1, "u", 0), (2, None, 0), (None, "v", 1), (3, "w", n), (3, "w", n),
                          (4, "z", 3000 * (n + 1) - 1)], key=str)
    assert X.extract(df.where("false")).collect() == []


def test_head_without_an_end_tag():
    for start in ("<html><head><meta charset=utf-8><title>t</title><body><article>", "<head><title>t</title><article>",
                  "<head><bgsound src=x><main>", "<html><head><link href=x></head><body><article>", "<head><img src=x><article>"):
        assert X.main_text(f"{start}<p>{LONG}<p>end") == f"{LONG.strip()}\nend", start
    assert X.main_text(f"<head><title>t</title>\n{LONG}") == LONG.strip()


def test_names_around_the_main_text_mark_nothing():
    text = LONG.strip()
    for page in ("<body class='has-sidebar'><p>{}", "<div class='content-sidebar-wrap'><main><p>{}</main></div>",
                 "<article class='post no-comments'><p>{}</article>", "<html class=no-widget><body id=search><div><p>{}",
                 "<div class='has-sidebar'><p>{}</div>", "<div class='elementor-widget'><p>{}</div><div class='elementor-widget'></div>",
                 "<div id=x class='with-sidebar'><article><p>{}</article></div>", "<div class=banner><main><p>{}</main></div>"):
        assert X.main_text(page.format(LONG)) == text, page
    # the wrapper's mark is lifted, that of the sidebar inside and of comments beside it isn't
    page = f"""<div class=has-sidebar><div><p>{LONG}</div><div class=sidebar>{LONG}</div></div>
      <div class=comments-area id=comments><p>{LONG}{LONG}</div>"""
    assert X.main_text(page) == text
    page = f"<div class=entry><p>{LONG}</div><div id=comments><ol class=comment-list><article><p>{LONG}</article></ol></div>"
    assert X.main_text(page) == text


def test_languages_without_stop_words_in_the_list():
    menu, foot = "<nav><a href=/>x</a></nav><div><a href=/y>link</a></div>", "<footer>f</footer>"
    for text in ("Быстрая коричневая лиса прыгает через ленивую собаку, потом возвращается домой. " * 3,
                 "Szybki brązowy lis przeskakuje nad leniwym psem, potem wraca do domu, gdzie czekają dzieci. " * 3,
                 "敏捷的棕色狐狸跳过了那只懒惰的狗，然后回到家里，它的孩子们正在等着它回来一起吃晚饭。" * 2,
                 "Rychlá hnědá liška skáče přes líného psa, potom běží domů, kde čekají její děti."):
        page = f"<body>{menu}<div><h1>T</h1><p>{text}<p>{text}</div>{foot}"
        assert X.main_text(page) == f"T\n{text.strip()}\n{text.strip()}", text
        # beside a notice in English
        assert text.strip() in X.main_text(f"<body>{menu}<div><p>{text}<p>{text}</div><p>{LONG[:90]}")
    # in a covered language a long block without stop words is still no text
    assert X.main_text(f"<div><p>{LONG}{LONG}</div><div>{'xq zv ' * 60}</div>") == f"{LONG}{LONG}".strip()


def test_a_small_article_beside_the_main_text():
    teaser, body = LONG[:90].strip(), (LONG * 3).strip()
    assert X.main_text(f"<header class='main-header'><p>{teaser}</p></header><div class='content'><p>{body}</div>") == body
    assert X.main_text(f"<article><p>{teaser}</article><div class=entry><p>{body}</div>") == f"{teaser}\n{body}"
    parts = "".join(f"<section><p>{LONG}</section>" for _ in range(3))
    got = X.main_text(f"<div class=entry><div>{parts}</div></div><article><p>{LONG}{LONG}</article>")
    assert got.count(LONG.strip()) == 5
    # an element that is "main" as a whole is one
    for main in ("<main>", "<div role=main>", "<div id=main>", "<div class='x main'>"):
        assert X.main_text(f"<div><p>{teaser}</div>{main}<p>{body}") == body, main


def test_broken_markup_takes_linear_time():
    import time
    for page in ("<p>" + "<a " * 350_000, "<b>" * 100_000 + "</i>" * 100_000, "<a '" * 99_999 + ">", "<" + "a" * 1_000_000,
                 "<p><table>" + "<b>" * 60_000 + "<hr>" * 60_000, '<a "x> ' * 120_001, "<!-- " * 200_000):
        start = time.process_time()
        X.main_text(page)
        assert time.process_time() - start < 4, page[:20]


def test_a_tag_without_end_is_text():
    words = "the house of the man is in the town and it is not far from the sea, as he said to us all on that day. " * 3
    assert X.main_text(f"<p>{words}</p><p>{words} 1 <b 2</p><p>{words}</p>").count("the house") == 9
    assert X.main_text(f"<p>{words}</p><p>{words} <a href='x") == (words.strip() + "\n" + words.strip() + " <a href='x").replace("\n", "\n")


def test_articles_keep_their_own_blocks():
    words = "the house of the man is in the town and it is not far from the sea, as he said to us all on that day. " * 3
    page = (f"<article><p>{words}</p><p>© 1999 was the year in which they came to the town.</p>"
            f"<p><a href='x'>He said so in the book that he wrote for us.</a></p><p>{words}</p></article>")
    assert X.main_text(page).count("\n") == 3


def test_a_page_of_short_blocks_only():
    page = ("<nav><a href='a'>Home</a></nav><div><p>Short one is here.</p><p>And a short two.</p></div>"
            "<div class='sidebar'><p>Read this.</p></div><footer>© us</footer>")
    assert X.main_text(page) == "Short one is here.\nAnd a short two."
