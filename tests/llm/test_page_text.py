import pytest

from tessera.llm import page_text
from tessera.llm import queries as q

CASES = [
    ("<p>a<p>b", "a\nb"),
    ("<div>x<b>y</div>z", "xy\nz"),
    ("<article><div class='ad-box'>no</div><p>yes&nbsp;&lt;x&gt;<li>q", "yes <x>\nq"),
    ("<a title='x>y'>k</a> <b \"un", "k"),
    ("<!-- open", ""),
    ("a<br>b <i>c</i>\n\t d<p>", "a b c d"),
    ("text < 5 &amp; more &#233;&eacute", "text < 5 & more éé"),
    ("<script>if(a<b){'</p>'}</script>z<style>p{}</style>", "z"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "a\nb\nc"),
    ("<body class='sidebar'><nav>m</nav><header>h</header><main><article><header><h1>T</h1></header><p>x</p><aside>s</aside>"
     "<form>f</form><footer>f</footer></article><section id=comments>c</section></main><footer>g</footer>", "T\nx"),
    ("<main><p>m</p></main><p>outside</p>", "m"),
    ("<article><p>x</p><article class='comment'>c</article><div class='cookieNotice'>n</div><p class='gradient'>kept</p></article>", "x\nkept"),
    ("<p hidden>h</p><p style='display: none'>i</p><p>j", "j"),
    ("<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>end", "deep\nend"),
    ("", ""), (None, ""),
]


@pytest.mark.parametrize("html,text", CASES)
def test_structure(html, text):
    assert "\n".join(s for s, _ in page_text.parse(html or "")[0]) == text


@pytest.mark.parametrize("html,text", [
    ("<div><article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "<p>rest</p></article></div><p>out", "deep\nrest"),
    ("<div>" * 600 + "<script>a</script><style>b</style><nav>c</nav><div class='ad'>d</div><p>kept", "kept"),
    ("<article>" + "<b>" * 900 + "x" + "</b>" * 900 + "<ul><li>y<li>z</ul></article>no", "x\ny\nz")])
def test_deep_nesting(html, text):
    blocks = page_text.parse(html)[0]
    assert "\n".join(s for s, _ in blocks) == text and all(len(inside) <= page_text.MAX_AROUND for _, inside in blocks)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 AS host", "'b' AS blocks", "3 AS content")


def test_templates_per_host(spark, table_dir):
    site = "<div><div><p>Follow us</p><p>everywhere</p></div><p>Text number {0} is here</p><p>shared passage</p><div>{0}</div></div>"
    rows = [(i, f"http://A.example/{i}", site.format(i)) for i in range(8)]
    rows += [(50 + i, "https://u@b.example:80/x", site.format(1)) for i in range(8)]  # exact copies count once
    rows += [(70, "http://c.example", site.format(3)), (80, None, site.format(4)), (81, "not a url", None), (None, "http://a.example", ""),
             (0, "http://A.example/0", site.format(0))]
    got = [tuple(r) for r in q.op5_page_text(spark, table_dir(pages=pages(spark, rows))).collect()]
    full = "Follow us\neverywhere\nText number {0} is here\nshared passage\n{0}"
    cut = "Text number {0} is here\nshared passage\n{0}"
    want = [(i, u, (cut.format(i) if u.startswith("http://A") else full.format(1 if u.startswith("https") else 3))) for i, u, _ in rows[:17]]
    want += [(80, None, full.format(4)), (81, "not a url", ""), (None, "http://a.example", ""), (0, "http://A.example/0", cut.format(0))]
    assert sorted(got, key=str) == sorted([(*w, len(w[2])) for w in want], key=str)


def test_prose_on_most_pages_of_a_host(spark, table_dir):
    page = "<article><p>Read more of this every day</p><p>own {0}</p>{1}</article>"
    rows = [(i, "http://a.example", page.format(i, "<p>in a third</p>" if i % 3 == 0 else "")) for i in range(30)]
    rows += [(100 + i, "http://b.example", page.format(i, "")) for i in range(9)]
    got = {r.page_id: r.text for r in q.op5_page_text(spark, table_dir(pages=pages(spark, rows))).collect()}
    assert got[3] == "own 3\nin a third" and got[4] == "own 4" and got[104] == "Read more of this every day\nown 4"


def test_hot_host_with_shared_lists_and_near_copies(spark, table_dir):
    """Lists, tables and wrapped passages that a part of the articles share stay; near copies make no template."""
    words = lambda i, n: " ".join(f"w{(i * 7919 + k * k * 31 + k) % 4999}" for k in range(n))
    shared = ["<ul><li>milk</li><li>eggs</li></ul>", "<table><tr><td>1</td></tr></table>", "<div><p>wrapped passage</p></div>"]
    page = "<div><div>Follow us everywhere</div><article><h1>Title {0}</h1><p>{1}</p>{2}</article></div>"
    rows = [(i, "http://hot.example", page.format(i, words(i, 40), shared[i % 3] if i < 60 else "")) for i in range(200)]
    near = "<article><h1>One title for all</h1><p>a common opening of the copies</p><p>{}</p></article>"
    copy = [near.format(" ".join([*words(900, 80).split()[:k], f"changed{k}", *words(900, 80).split()[k + 1:]])) for k in range(60)]
    rows += [(1000 + k, "http://hot.example", h) for k, h in enumerate(copy)]  # beside other articles
    rows += [(2000 + k, "http://b.example", h) for k, h in enumerate(copy)]  # most pages of their host
    rows += [(3000 + k, "http://b.example", page.format(k, words(5000 + k, 40), "")) for k in range(9)]
    got = {r.page_id: r.text for r in q.op5_page_text(spark, table_dir(pages=pages(spark, rows))).collect()}
    assert all(got[i].endswith(("milk\neggs", "1", "wrapped passage")[i % 3]) for i in range(60))
    assert all(got[b + k].startswith("One title for all\na common opening of the copies\n") for b in (1000, 2000) for k in range(60))


def test_templates_decide_before_the_article_rule(spark, table_dir):
    """A teaser in an article element does not displace the body; a template as long as the body goes all the same."""
    words = lambda i, n: " ".join(f"w{(i * 7919 + k * k * 31 + k) % 4999}" for k in range(n))
    around = "<div><p>" + words(7000, 80) + "</p></div>"
    rows = [(i, "http://a.example", f"{around}<div><p>{words(i, 60)}</p></div><article><p>See {i}</p></article>") for i in range(12)]
    rows += [(100 + i, "http://b.example", f"{around}<article><p>{words(50 + i, 20)}</p></article>") for i in range(12)]
    got = {r.page_id: r.text for r in q.op5_page_text(spark, table_dir(pages=pages(spark, rows))).collect()}
    assert all(got[i] == f"{words(i, 60)}\nSee {i}" and got[100 + i] == words(50 + i, 20) for i in range(12))


def test_empty(spark, table_dir):
    assert q.op5_page_text(spark, table_dir(pages=pages(spark, []))).collect() == []


def test_whole_table_against_documents(spark, sf):
    """Every page was made from a document: title, then the document's lines as blocks."""
    texts = {" ".join(r.text.split()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = q.op5_page_text(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/pages.parquet").count()
    assert all(r.n_chars == len(r.text) for r in rows)
    assert sum(" ".join(r.text.partition("\n")[2].split()) in texts for r in rows) >= 0.98 * len(rows)
