import base64
import json

from inkstream.plans import report as RP
from inkstream.sources import html
from inkstream.sources import ingest as IG


def test_html():
    assert html.clean_html("<p>A <b>b</b></p><script>x()</script>") == "A b" and html.clean_html(None) == ""
    page = "<body><nav>Menu</nav><article><p>" + "Long text. " * 20 + "</p><aside>ad</aside></article><footer>f</footer></body>"
    assert html.article_body(page, ("main", "article")) == ("Long text. " * 20).strip()
    state = '<script id="__NEXT_DATA__">{"a": [{"title": "A headline of some length", "url": "/x", "inner": {"title": "never reached, as above", "url": "/y"}}]}</script>'
    assert html.state_links(state, "https://s.example") == [("https://s.example/x", "A headline of some length")]
    part = {"mimeType": "multipart/mixed", "parts": [{"mimeType": "text/plain", "body": {"data": "eA"}}, {"mimeType": "text/html", "body": {"data": base64.urlsafe_b64encode("<p>é</p>".encode()).decode().rstrip("=")}}]}
    assert html.mail_html(json.dumps(part)) == "<p>é</p>" and html.mail_html("no json") == ""


def test_links_of_mail_and_pages(spark):
    a = lambda n, u: f'<a href="{u}">{"x" * n}</a>'
    body = base64.urlsafe_b64encode("".join([a(20, "http://a/1"), a(21, "http://a/2"), a(249, "http://a/3"), a(250, "http://a/4"), a(30, "/rel"), a(40, "http://a/2")]).encode()).decode()
    mails = spark.createDataFrame([("m", "s", "subj", json.dumps({"mimeType": "text/html", "body": {"data": body}}))], "mail_id string, source string, subject string, payload string")
    assert sorted(r["url"] for r in IG.mail_links(mails).collect()) == ["http://a/2", "http://a/3"]
    page = "".join([a(20, "/news/1"), a(350, "https://www.s.example/news/2?x=1"), a(19, "/news/3"), a(30, "https://other.example/n"), a(30, "/tag/x"), a(30, "/")])
    pages = spark.createDataFrame([("s", "https://www.s.example/", page)], "source string, base string, html string")
    assert sorted(r["url"] for r in IG.page_links(pages, skip=("/tag/",)).collect()) == ["https://www.s.example/news/1", "https://www.s.example/news/2"]


def test_feed(spark, tmp_path):
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>T</title><link>http://a/b?c=1</link><description>&lt;p&gt;Hi&lt;/p&gt;</description><pubDate>Thu, 01 Jan 2026 00:00:00 GMT</pubDate></item><item><title></title><link>http://a/c</link></item></channel></rss>")
    from pyspark.sql import functions as F

    e = IG.read_feed(spark, str(tmp_path / "f.xml")).select(F.lit("s").alias("source"), "title", "link", F.col("description").alias("summary"), "content", F.col("pubDate").alias("published"), "updated")
    got = IG.feed_items(e, "now").collect()
    assert [(r["url"], r["body"], r["ts"]) for r in got] == [("http://a/b", "Hi", "Thu, 01 Jan 2026 00:00:00 GMT")]


def test_senders(spark):
    mails = spark.createDataFrame([("1", "X <a@News.Example>"), ("2", "b@c")], "mail_id string, sender string")
    conf = spark.createDataFrame([(2, "late", "example"), (1, "early", "news.example")], "ord int, source string, domain string")
    assert {r["mail_id"]: r["source"] for r in IG.classify_sender(mails, conf).collect()} == {"1": "early", "2": "mail"}


def test_headings_and_picks(spark):
    lines = ["## Known", "### Known2", "- C1: x", "- C1: again", "## Unknown", "### Known2", "- C2: y"]
    df = spark.createDataFrame([("d", i, t) for i, t in enumerate(lines)], "doc string, no int, line string")
    got = RP.picks(RP.carried_headings(df, "doc", "no", "line", ["Known"], ["Known2"]), "doc", "no", "line").collect()
    assert [(r["label"], r["pick"]) for r in got] == [("C1", "x")]


def test_sparkline():
    assert "polyline" not in RP.sparkline([1.0, float("inf")]) and "polyline" in RP.sparkline([1, 1])
