"""Content types, charsets, body decoding and the HTML strip steps."""

from __future__ import annotations

from collections.abc import Collection, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from pagemill.functions.binding import literal, over

#: White space as Unicode defines it, spelled out so that every regex dialect agrees.
WHITESPACE = (
    r"\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
#: The same characters, for trimming.
WHITESPACE_CHARS = "".join(
    chr(code)
    for code in (
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    )
)

# What the default filter accepts as text.
_TEXT_MARKS = ("text/", "html", "xml", "json")
# Names of the two charsets that nearly all pages have.
_UTF8_NAMES = ("utf-8", "utf8", "utf_8", "u8")
_LATIN1_NAMES = ("iso-8859-1", "iso8859-1", "iso_8859-1", "latin-1", "latin1", "l1", "8859")

# What each strip step removes.
_SCRIPT = r"(?is)<script\b[^>]*>.*?</script\s*>"
_STYLE = r"(?is)<style\b[^>]*>.*?</style\s*>"
_STYLESHEET_LINK = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?stylesheet\b[^>]*>"""
_SPACE = r"[\s\x1C-\x1F]"  # with the U flag: white space as Unicode defines it
_BARE = r"[^\s\x1C-\x1F>]"
_STYLE_ATTRIBUTE = rf"""(?isU){_SPACE}+style\s*=\s*("[^"]*"|'[^']*'|{_BARE}+)"""
_IMAGE_DATA = (
    rf"(?isU){_SPACE}+(?:src|srcset)\s*=\s*"
    rf"""("[^"]*\bdata:image/[^"]*"|'[^']*\bdata:image/[^']*'"""
    rf"|{_BARE}*\bdata:image/{_BARE}*)"
)
_COMMENT = r"(?s)<!--.*?-->"
_GAP_BETWEEN_TAGS = rf"(?U)>{_SPACE}+<"
_BLANK_RUN = r"[ \t\r\n]{2,}"
#: Page regions that hold navigation and other furniture.
REGION_TAGS = ("nav", "header", "footer", "aside", "form")
_REGIONS = "(?is)<(?:{})".format(
    "|".join(rf"{tag}\b[^>]*>.*?</{tag}\s*>" for tag in REGION_TAGS)
)


def _remove(text: Column, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(text, F.lit(pattern), F.lit(by))


def content_type(headers: Column) -> Column:
    """The ``content-type`` header of a map with lower-case names, else ''."""
    return F.coalesce(F.try_element_at(headers, F.lit("content-type")), F.lit(""))


def is_textual(kind: Column) -> Column:
    kind = F.lower(kind)
    found = F.lit(False)
    for mark in _TEXT_MARKS:
        found = found | kind.contains(mark)
    return found


def is_html(kind: Column) -> Column:
    kind = F.lower(kind)
    return kind.contains("html") | kind.contains("xml")


def charset(kind: Column) -> Column:
    """The first ``charset`` parameter without quotes, else ``utf-8``."""
    named = F.btrim(
        F.regexp_extract(kind, r"(?i)(?:^|;)\s*charset\s*=\s*([^;]*[^;\s])", 1), F.lit(" \t\"'")
    )
    return F.when(named == "", F.lit("utf-8")).otherwise(named)


def _java_names() -> dict[str, str]:
    """Java's charset by label, where labels are in lower case without ``-``, ``_`` and spaces."""
    names = {f"iso8859{n}": f"ISO-8859-{n}" for n in (*range(2, 10), 13, 15, 16)}
    names |= {f"latin{n}": f"ISO-8859-{part}" for n, part in ((2, 2), (3, 3), (4, 4), (5, 9), (9, 15))}
    for n in range(1250, 1259):
        names |= {f"windows{n}": f"windows-{n}", f"cp{n}": f"windows-{n}"}
    for n in (437, 850, 852, 855, 857, 866):
        names |= {f"ibm{n}": f"IBM{n}", f"cp{n}": f"IBM{n}"}
    for name in ("EUC-JP", "EUC-KR", "GB2312", "GBK", "GB18030", "Big5", "Big5-HKSCS", "ISO-2022-JP", "ISO-2022-KR",
                 "Shift_JIS", "KOI8-R", "KOI8-U", "TIS-620", "US-ASCII", "UTF-16BE", "UTF-16LE", "UTF-32BE",
                 "UTF-32LE"):
        names[name.lower().replace("-", "").replace("_", "")] = name
    return names | {
        "ascii": "US-ASCII", "sjis": "Shift_JIS", "xsjis": "Shift_JIS", "cp932": "windows-31j", "cp936": "GBK",
        "cp949": "x-windows-949", "macintosh": "x-MacRoman", "xmacroman": "x-MacRoman", "macroman": "x-MacRoman",
    }


_JAVA_NAMES = _java_names()


@contextmanager
def any_charset(spark: SparkSession) -> Iterator[None]:
    """While a plan is built, ``decode`` takes any of Java's charsets and replaces bad bytes.

    Spark fixes both in the expression when it analyses it, so the session keeps its settings.
    """
    names = ("spark.sql.legacy.javaCharsets", "spark.sql.legacy.codingErrorAction")
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.set(name, "true")
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def decode_body(body: Column, kind: Column) -> Column:
    """The body as text; bytes that do not decode become U+FFFD, unknown charsets are UTF-8.

    For a plan built under :func:`any_charset`.  All of it runs on the JVM.  UTF-16 and UTF-32
    without a byte order mark are little-endian.
    """
    label = F.lower(charset(kind))
    utf8 = F.make_valid_utf8(body.cast("string"))
    other = F.struct(body.alias("body"), F.regexp_replace(label, "[-_ ]", "").alias("name"))
    # Bound to a name, the rare part stays out of the generated code of the common one.
    return (
        F.when(~F.lower(kind).contains("charset") | label.isin(*_UTF8_NAMES), utf8)
        .when(label.isin(*_LATIN1_NAMES), F.decode(body, "ISO-8859-1"))
        .otherwise(F.coalesce(over(other, "b", _OTHER_CHARSETS), utf8))
    )


_JAVA_TABLE = "map(" + ", ".join(literal(part) for pair in _JAVA_NAMES.items() for part in pair) + ")"
_OTHER_CHARSETS = f"""CASE
    WHEN b.name = 'utf16' THEN
        decode(b.body, if(hex(substring(b.body, 1, 2)) IN ('FEFF', 'FFFE'), 'UTF-16', 'UTF-16LE'))
    WHEN b.name = 'utf32' THEN
        decode(b.body, if(hex(substring(b.body, 1, 4)) IN ('0000FEFF', 'FFFE0000'), 'UTF-32', 'UTF-32LE'))
    WHEN try_element_at({_JAVA_TABLE}, b.name) IS NOT NULL THEN
        decode(b.body, try_element_at({_JAVA_TABLE}, b.name)) END"""


def strip_scripts(text: Column) -> Column:
    return _remove(text, _SCRIPT)


def strip_css(text: Column) -> Column:
    return _remove(_remove(_remove(text, _STYLE), _STYLESHEET_LINK), _STYLE_ATTRIBUTE)


def strip_image_data(text: Column) -> Column:
    return _remove(text, _IMAGE_DATA)


def strip_whitespace(text: Column) -> Column:
    text = _remove(_remove(text, _COMMENT), _GAP_BETWEEN_TAGS, "><")
    return F.btrim(_remove(text, _BLANK_RUN, " "), F.lit(WHITESPACE_CHARS))


def strip_regions(text: Column) -> Column:
    """Drop navigation, header, footer, aside and form regions.

    A page that holds nothing else keeps its text.
    """
    from pagemill.functions.html import chunks_sql

    kept = F.regexp_replace(text, F.lit(_REGIONS), F.lit(""))
    return over(
        F.struct(text.alias("page"), kept.alias("kept")),
        "v",
        f"if(size({chunks_sql('v.kept')}) > 0, v.kept, v.page)",
    )


def strip_html(text: Column, kind: Column, kinds: Collection[str]) -> Column:
    """Run the chosen strip steps, always in the same order, on HTML and XML only."""
    steps = (
        ("scripts", strip_scripts),
        ("css", strip_css),
        ("image-data-urls", strip_image_data),
        ("whitespace", strip_whitespace),
        ("clean", strip_regions),
    )
    stripped = text
    for name, step in steps:
        if name in kinds:
            stripped = step(stripped)
    return F.when(is_html(kind), stripped).otherwise(text)
