import html as stdlib_html
import re
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from builders import PAGE
from pagemill import schemas
from pagemill.functions import content, html
from pagemill.plans import corpus
from pagemill.sources.responses import with_content

PAGES = "/root/testdata/sf0.001"


class Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.depth = [], 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in ("script", "style", "noscript")

    def handle_endtag(self, tag):
        self.depth -= tag in ("script", "style", "noscript") and self.depth > 0

    def handle_data(self, data):
        if not self.depth and data.strip():
            self.parts.append(data.strip())


def visible(markup):
    parser = Text()
    parser.feed(markup)
    parser.close()
    return " ".join(parser.parts)


def test_text_equals_html_parser(spark):
    pages = corpus.table(spark, PAGES, "pages").select("html", html.html_text(F.col("html")).alias("t"))
    assert [r.html for r in pages.collect() if visible(r.html) != r.t] == []


def test_text_cases(column):
    given = [
        PAGE, "a &lt;b&gt; c<p>&nbsp; x &nbsp;</p>", "<p title='a>b'>x</p><!-- <b>no</b> -->y",
        "x<noscript><b>n</b></noscript>z<style>s", "AT&amp;amp;T &notit; &#x41;",
    ]
    assert column(given, html.html_text) == [
        "Hello A", "a <b> c x", "x y", "x z", "AT&amp;T ¬it; A"
    ]


def test_entities_equal_standard_library(column):
    given = [
        "&amp;lt;", "&notit;", "&notin; x", "&#8212;&#x41;", "&#0;", "&#128;", "&#129;", "&#x110000;",
        "&#99999999999;", "&copy", "AT&T", "&ampfoo;", "a & b", "&#xD800;", "&#11;", "&;", "&#;",
        "&CounterClockwiseContourIntegral;", "&rarr;&#x0000041;", "&fjlig;", "&verbar;&equals;", "&#x1F600;",
    ]
    assert column(given, html.decode_entities) == [stdlib_html.unescape(v) for v in given]


def test_images(column):
    given = [
        '<a href="/n">x</a><img src="/hero.png" alt="Hero" width="10">',
        '<img src="data:image/png;base64,AAAA" alt="Inline"><IMG SRC=\'/h.png\' alt="a&amp;b">',
        '<img data-src=z src=q.png alt><img alt="src=bad"><img src=" "><img src=1 src=2 />',
        '<!-- <img src=c> --><script>"<img src=d>"</script><img src="a>b" alt=\'q"r\'>',
    ]
    found = column(given, html.image_structs)
    assert [[(i.src, i.alt) for i in row] for row in found] == [
        [("/hero.png", "Hero")],
        [("/h.png", "a&b")],
        [("q.png", ""), ("1", None)],
        [("a>b", 'q"r')],
    ]


def test_markdown(column):
    given = [
        PAGE,
        '<h2>T</h2><p>a <a href="/x"><b>y</b></a></p><ul><li>1</li><li><i>2</i></li></ul>',
        '<img src="/a.png" alt="A"><hr>b<br>c<pre>x\n  y &lt;</pre>',
    ]
    assert column(given, html.html_markdown) == [
        "Hello **A**\n",
        "## T\n\na [**y**](/x)\n\n- 1\n- *2*\n",
        "![A](/a.png)\n\n---\n\nb\nc\n\n```\nx\n  y <\n```\n",
    ]


def test_strip_steps(column):
    def steps(*kinds):
        return lambda c: content.strip_html(c, F.lit("text/html"), kinds)

    assert column([PAGE], steps("scripts", "image-data-urls")) == [
        "<html><head></head><body>Hello <b>A</b></body></html>"
    ]
    styled = (
        "<html>\n  <head><style>.x { color: red; }</style></head>\n"
        '  <body><p style="color: red">Hello</p></body>\n</html>'
    )
    assert column([styled], steps("css", "whitespace")) == [
        "<html><head></head><body><p>Hello</p></body></html>"
    ]
    inline = (
        '<img src="data:image/png;base64,AAAA" alt="Inline">'
        '<img src="/hero.png" srcset="data:image/png;base64,BBBB 1x" alt="Hero">'
    )
    assert column([inline], steps("image-data-urls")) == [
        '<img alt="Inline"><img src="/hero.png" alt="Hero">'
    ]
    assert column(["<LINK href=a rel='stylesheet'><link rel=icon>"], steps("css")) == [
        "<link rel=icon>"
    ]
    assert column(["<script>a"], lambda c: content.strip_html(c, F.lit("text/plain"), {"scripts"})) == [
        "<script>a"
    ]


def test_whitespace_equals_python(column):
    given = ["<p> \n<b> a  \t b</b> </p><!-- x\n -->　", "  x\x1c "]

    def python(text):
        text = re.sub(r"<!--.*?-->", "", text, flags=re.DOTALL)
        return re.sub(r"[ \t\r\n]{2,}", " ", re.sub(r">\s+<", "><", text)).strip()

    assert column(given, content.strip_whitespace) == [python(text) for text in given]


def test_regions_fall_back(column):
    given = ["<nav>Menu</nav><article>Main</article>", "<nav>Only</nav>"]
    assert column(given, content.strip_regions) == ["<article>Main</article>", "<nav>Only</nav>"]


def test_charset_and_decoding(spark):
    rows = [
        (b"\xffa\xc3\xa9", "text/html", "�aé"),
        ("é".encode("latin-1"), 'text/html; Charset="ISO-8859-1"', "é"),
        ("日本".encode("shift_jis"), "text/html;charset=shift_jis", "日本"),
        ("é".encode(), "text/html; charset=bogus", "é"),
        ("é".encode("cp1252"), "text/html; charset=windows-1252; x=1", "é"),
        (None, "text/html; charset=windows-1252", None),
    ]
    df = spark.createDataFrame(rows, "body binary, content_type string, expected string")
    got = with_content(df)
    assert [r for r in got.collect() if r.expected != r.content] == []
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"


def test_charsets_as_python_decodes_them(spark):
    names = ("utf-16", "UTF-16LE", "utf_16_be", "utf-32", "utf-32-be", "windows-1251", "cp1250", "koi8-r", "gbk",
             "gb18030", "big5", "euc-jp", "euc-kr", "iso-8859-2", "ISO_8859-15", "latin2", "ibm866", "us-ascii",
             "iso-2022-jp")
    rows = []
    for name in names:
        for text in ("plain", "Привет", "žluť", "日本語", "한국", "中文", "é€", ""):
            try:
                rows.append((text.encode(name), f"text/html; charset={name}", text))
            except UnicodeEncodeError:
                continue
    rows += [(b"a\xff", "text/html; charset=us-ascii", "a\ufffd"), (b"a\x00b", "text/html; charset=utf-16-le", "a\ufffd")]
    df = spark.createDataFrame(rows, "body binary, content_type string, expected string")
    assert len(rows) > 60 and [r for r in with_content(df).collect() if r.expected != r.content] == []


def test_kinds(column):
    given = ["TEXT/HTML", "application/xml", "application/json", "image/png", ""]
    assert column(given, content.is_textual) == [True, True, True, False, False]
    assert column(given, content.is_html) == [True, True, False, False, False]


@pytest.mark.parametrize(
    ("options", "message"),
    [
        ({"batch_size": 0}, "batch_size"),
        ({"max_batch_bytes": 0}, "max_batch_bytes"),
        ({"max_batch_delay": 0}, "max_batch_delay"),
        ({"frontier_batch_size": 0}, "frontier_batch_size"),
        ({"primary_key": ""}, "primary_key"),
        ({"limit": -1}, "limit"),
        ({"optimize_every": 0}, "optimize_every"),
        ({"content_format": "pdf"}, "content_format"),
        ({"strip": "scripts,unknown"}, "strip must contain only"),
        ({"strip": "none,css"}, "cannot be combined"),
        ({"strip_order": "never"}, "strip_order"),
        ({"clean": "maybe"}, "clean must be"),
        ({"index_columns": ("url",)}, "index_columns"),
    ],
)
def test_option_checks(options, message):
    with pytest.raises(ValueError, match=message):
        schemas.ImportOptions(**options)


def test_strip_resolution():
    assert schemas.strip_kinds("html") == {"scripts", "image-data-urls"}
    assert schemas.strip_kinds("md") == schemas.strip_kinds("text") == {"clean"}
    assert schemas.strip_kinds("md", clean="none") == frozenset()
    assert schemas.strip_kinds("md", " css, whitespace ,", clean="none") == {"css", "whitespace"}
    assert schemas.strip_order("before-links", "after-links") == "after-links"
    assert schemas.strip_order("after-links", "none") == "after-links"
