import random
import time

from jobtide.llm import main_text
from jobtide.llm.arrow import unpacked


def extract(pages):
    found = main_text.extract_pages(pages, ["page_id", "url"])
    return {r["page_id"]: r["text"] for r in found.select(*unpacked(["page_id", "url"]), "text", "n_chars").collect() if r["n_chars"] == len(r["text"])}


def site(n, number, body, notice="We use cookies."):
    """Pages of a host whose containers have no telling names."""
    return [
        {"page_id": number * 100 + i, "url": f"https://h{number}.net/{i}", "html": f"<html><body><div class='x1'><p>Home</p><p>About us</p></div><div class='x2'>{body(i)}</div><div class='x3'><p>{notice}</p></div></body></html>"}
        for i in range(n)
    ]


def test_slots_without_names_lose_what_the_template_has(table):
    random.seed(1)
    rows = site(8, 1, lambda i: "".join(f"<p>Text {i} {j} &amp; more</p>" for j in range(i % 3 + 1)))
    found = extract(table("page_id long, url string, html string", rows))
    for i in range(8):
        assert found[100 + i] == "\n\n".join(f"Text {i} {j} & more" for j in range(i % 3 + 1))


def test_names_say_what_is_around():
    page = """<html><head><title>t</title></head><body><div class="siteHeader">Site</div><nav><ul><li>n</ul></nav><div id="content"><h1>A &amp; B</h1>
    <p>One<br>two<p>Thr<b>ee</b>&nbsp;x<ul><li>a<li>b</ul><aside>no</aside><form>f<input><select><option>o</select></form><table><tr><td>c1<td>c2</table>
    <script>var a = "<p>no</p>"</script><style>p{}</style><!-- <p>no --></div><div class="cookie-notice">c</div><div id="comments"><p>nice</div><div class="ad">buy</div><footer>f</footer>"""
    assert main_text.extract(page, None) == "A & B\n\nOne two\n\nThree x\n\na\n\nb\n\nc1\n\nc2"


def test_the_article_wins_and_its_comments_go():
    page = "<body><div>loose</div><article><header><h1>H</h1></header><p>p<p><b>q.<br><p>r</article><section class=comments><article><p>me too</article></section></body>"
    assert main_text.extract(page, None) == "H\n\np\n\nq.\n\nr"


def test_copies_on_a_host_keep_their_article(table):
    html = "<body><nav><a href=/>x</a></nav><article><h1>Same</h1><p>Same text.</p></article><footer>y</footer></body>"
    rows = [{"page_id": i, "url": "http://a.org/", "html": html} for i in range(6)]
    assert set(extract(table("page_id long, url string, html string", rows)).values()) == {"Same\n\nSame text."}


def test_occurrence_vectors_make_classes():
    tokens = [("/b", 4, 10, 0.0), ("/b/n", 4, 10, 1.0), ("/b/m", 4, 10, 5.0), ("/b/n/li", 4, 33, 2.0), ("/b/x", 2, 7, 3.0)]
    template = main_text.Template(tokens)
    assert list(template.root) == ["/b", "/b/n", "/b/m"]
    keys = ["/b", "/b/n", "/b/n/li", "/b/n/li", "/b/m", "/b/x"]
    slots = template.slots(keys)
    assert slots == [0, 1, 1, 1, 2, 2] and (4, 33) in template.nested(keys, slots)
    # in another order, or with few of the tokens, a page does not follow
    assert template.slots(["/b/m", "/b/n"]) is None and template.slots(["/b"]) is None


def test_odd_rows(table):
    rows = [
        {"page_id": 1, "url": None, "html": None}, {"page_id": 2, "url": "no host", "html": ""}, {"page_id": 3, "url": "http://a/", "html": "no tags &lt;here&gt;"},
        {"page_id": 3, "url": "http://a/", "html": "no tags &lt;here&gt;"}, {"page_id": 4, "url": "http://a/", "html": "<p>" * 3000 + "deep"}, {"page_id": 5, "url": "http://a/", "html": "<article><p>" + "long " * 100_000},
        {"page_id": 6, "url": "http://a/", "html": "<p>cut <a href='x"},
    ]
    pages = table("page_id long, url string, html string", rows, clashing=True)
    found = extract(pages)
    assert (found[1], found[2], found[3], found[4]) == ("", "", "no tags <here>", "deep")
    assert found[5] == ("long " * 100_000).strip() and found[6].startswith("cut")
    assert main_text.extract_pages(pages, ["page_id"]).count() == 7
    assert main_text.extract_pages(pages.where("false"), ["page_id"]).count() == 0


def test_names_do_not_take_away_what_holds_the_main_text(table):
    article = "<article><h1>H</h1><p>Own text.</p></article>"
    for page in (
        f"<body><nav>n</nav><div class='content-with-sidebar'>{article}</div><div class='sidebar'>s</div>",
        f"<body><div class='page has-header'>{article}<div id='comments'><article>me too</article></div></div><footer>f</footer>",
        f"<body><div class='sidebar-layout banner'><form id='f'>{article}</form></div>",
        "<body><article class='post category-legal has-comments'><h1>H</h1><p>Own text.</p></article><p>loose",
        "<body><article><div class='article-header'><h1>H</h1></div><p>Own text.</p><div class='share'>s</div></article>",
        "<body><div class='sidebar-page'><h1>H</h1><p>Own text.</p></div>",
    ):
        assert main_text.extract(page, None) == "H\n\nOwn text.", page
    # text that stands apart stays away from a page that has its own
    assert main_text.extract("<body><div><p>Much more own text.</p></div><aside><article>teaser</article></aside>", None) == "Much more own text."
    rows = [
        {"page_id": i, "url": f"http://w.org/{i}", "html": f"<body><div class='menu-left'><p>Home</p><div class='x'><p>Text {i}</p><p>More {i * i}</p></div><p>Imprint</p></div><div class='y'>c</div></body>"}
        for i in range(6)
    ]
    assert extract(table("page_id long, url string, html string", rows)) == {i: f"Text {i}\n\nMore {i * i}" for i in range(6)}


def test_the_template_decides_inside_the_article_too(table):
    def page(i, line):
        return f"<body><article><h1>Title {i}</h1><p>Words {i} of {i * i}.</p><p>Subscribe to our letter.</p>{line}</article><p>Imprint</p></body>"

    rows = [{"page_id": i, "url": f"http://t.org/{i}", "html": page(i, "<p>Buy now.</p>" if i % 3 else "")} for i in range(9)]
    # copies of one page that tell the time
    same = " ".join(f"word{j}" for j in range(50))
    rows += [{"page_id": 100 + i, "url": f"http://c.org/{i}", "html": f"<body><article><p>{same}</p></article><p>{i}</p></body>"} for i in range(5)]
    found = extract(table("page_id long, url string, html string", rows))
    assert found == {i: f"Title {i}\n\nWords {i} of {i * i}." for i in range(9)} | {100 + i: same for i in range(5)}


def test_deep_pages_take_time_and_memory_in_proportion():
    depth = 100_000
    deep = "<body><nav>m</nav>" + "<div>" * depth + "the text" + "</div>" * depth
    texts = "<body>" + "<div class='sidebar'>a " * 30_000 + "<p>end</p>"
    start = time.time()
    assert main_text.extract(deep, None) == "the text"
    assert len(main_text.read(deep)) > 2 * depth
    main_text.extract(texts, None)
    main_text.extract("<table>" + "<tr><td>x" * 30_000, None)
    main_text.extract("<p>" + "<b>y" * 60_000, None)
    assert time.time() - start < 30
    assert max(len(key) for key, _, _ in main_text.read(deep)) < 60
