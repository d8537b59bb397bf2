"""HTML to text, markdown, images and link attributes, as JVM-side expressions."""

from __future__ import annotations

from collections.abc import Mapping
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagemill.functions.binding import bind, literal, over
from pagemill.functions.content import WHITESPACE_CHARS

# A comment or a block whose content is not shown; an unclosed one runs to the end.
_HIDDEN_BLOCKS = (
    r"!--.*?(?:-->|\z)"
    r"|script\b[^>]*>.*?(?:</script[^>]*>|\z)"
    r"|style\b[^>]*>.*?(?:</style[^>]*>|\z)"
)
_HIDDEN = f"(?is)<(?:{_HIDDEN_BLOCKS})"
#: Everything that is not shown: comments, scripts, styles and noscript blocks.
HIDDEN = rf"(?is)<(?:{_HIDDEN_BLOCKS}|noscript\b[^>]*>.*?(?:</noscript[^>]*>|\z))"
_QUOTED_REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_TAG = rf"<(?:/?[A-Za-z]{_QUOTED_REST}|[!?/][^>]*+>)"
_ATTRIBUTE = r"""[^\s"'<>/=][^\s>/=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+))?"""

_PAIR, _SIDE = "\x1e", "\x1f"
# Names that also count without a semicolon; the longest one wins.
_LEGACY = sorted((name for name in html5 if not name.endswith(";")), key=len, reverse=True)
_C1_CHARACTERS = {
    str(code): bytes([code]).decode("cp1252", errors="ignore") or chr(code)
    for code in range(0x80, 0xA0)
}


def _lookup(key: str, table: Mapping[str, str]) -> str:
    """SQL for the entry of a constant table, or NULL.

    The table is one string: a map literal of this size slows planning down.
    """
    packed = _PAIR + _PAIR.join(f"{name}{_SIDE}{text}" for name, text in table.items())
    after = f"substring_index({literal(packed)}, concat('{_PAIR}', {key}, '{_SIDE}'), -1)"
    # Without the key the whole table comes back, which starts with a separator.
    found = f"if(startswith(after, '{_PAIR}'), NULL, substring_index(after, '{_PAIR}', 1))"
    return bind("after", after, found)


# The character of a numeric reference; ``code`` is NULL when it is too large.
_CHARACTER = f"""CASE
    WHEN code IS NULL OR code = 0 OR code > 1114111 OR code BETWEEN 55296 AND 57343 THEN '�'
    WHEN code BETWEEN 128 AND 159 THEN {_lookup("CAST(code AS STRING)", _C1_CHARACTERS)}
    WHEN code < 9 OR code = 11 OR code BETWEEN 14 AND 31 OR code = 127
        OR code BETWEEN 64976 AND 65007 OR code % 65536 >= 65534 THEN ''
    ELSE decode(unhex(lpad(hex(code), 8, '0')), 'UTF-32') END"""


def _number(digits: str, base: int) -> str:
    trimmed = f"ltrim('0', {digits})"
    return f"if(length({trimmed}) <= 8, CAST(conv({digits}, {base}, 10) AS BIGINT), NULL)"


def _reference() -> str:
    """SQL to decode the reference at the start of ``part``, the text after an ``&``."""
    legacy_table = {name: html5[name] for name in _LEGACY}
    numeric = literal(r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?")
    digits = f"regexp_extract(part, {literal(r'^#[xX]?([0-9a-fA-F]+)')}, 1)"
    number = f"if(part RLIKE '^#[xX]', {_number(digits, 16)}, {_number(digits, 10)})"
    exact = "regexp_extract(part, '^[A-Za-z][A-Za-z0-9]*;', 0)"
    legacy = f"regexp_extract(part, '^(?:{'|'.join(_LEGACY)})', 0)"

    def named(pattern: str, table: Mapping[str, str], otherwise: str) -> str:
        entry = bind("hit", _lookup("name", table), f"""if(hit IS NULL, {otherwise},
            concat(hit, substr(part, length(name) + 1)))""")
        return bind("name", pattern, f"if(name = '', {otherwise}, {entry})")

    plain = "concat('&', part)"
    return f"""CASE WHEN startswith(part, 'amp;') THEN concat('&', substr(part, 5))
        WHEN part RLIKE {numeric}
        THEN concat({bind("code", number, _CHARACTER)}, regexp_replace(part, {numeric}, ''))
        ELSE coalesce({named(exact, html5, "NULL")}, {named(legacy, legacy_table, plain)}) END"""


_WHOLE = bind(
    "parts",
    "split(raw, '&')",
    f"""concat(parts[0], array_join(transform(
        slice(parts, 2, greatest(size(parts) - 1, 0)), part -> {_reference()}), ''))""",
)


def entities_sql(text: str) -> str:
    """SQL that replaces every character reference once, as HTML5 defines them."""
    return bind("raw", text, f"if(contains(raw, '&'), {_WHOLE}, raw)")


def trim_sql(text: str) -> str:
    return f"btrim({text}, {literal(WHITESPACE_CHARS)})"


def decode_entities(text: Column) -> Column:
    return over(text, "given", entities_sql("given"))


def trim(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE_CHARS))


def chunks_sql(html: str) -> str:
    """SQL array of the visible text between tags, trimmed and decoded, blanks left out."""
    return shown_chunks_sql(f"regexp_replace({html}, {literal(HIDDEN)}, '<!>')")


def shown_chunks_sql(shown: str) -> str:
    """The same for text whose hidden blocks are gone already."""
    return f"""filter(transform(split({shown}, {literal(_TAG)}),
        chunk -> {trim_sql(entities_sql("chunk"))}), chunk -> chunk <> '')"""


def html_text(html: Column) -> Column:
    """Visible text, one blank between chunks."""
    return over(html, "page", f"array_join({chunks_sql('page')}, ' ')")


def _tags(html: str, *names: str) -> str:
    """SQL array of the start tags of the given names, in order, outside hidden blocks."""
    shown = f"regexp_replace({html}, {literal(_HIDDEN)}, '')"
    pattern = rf"(?i)<(?:{'|'.join(names)})(?=[\s/>]){_QUOTED_REST}"
    return f"regexp_extract_all({shown}, {literal(pattern)}, 0)"


def _attribute(attributes: str, name: str) -> str:
    """SQL for the raw first attribute of that name: NULL when absent, '' without a value."""
    names = rf"""transform({attributes}, item -> lower(regexp_extract(item, {literal(r"^[^\s=]+")}, 0)))"""
    item = f"get({attributes}, CAST(array_position({names}, '{name}') AS INT) - 1)"
    value = f"regexp_replace({item}, {literal(r'(?s)^[^=]*=?\s*')}, '')"
    quotes = literal(r"""(?s)^(["'])(.*)\1$""")
    return f"regexp_replace({value}, {quotes}, '$2')"


def _attributes(tag: str) -> str:
    return f"regexp_extract_all({tag}, {literal(_ATTRIBUTE)}, 0)"


_IMAGE = bind(
    "attrs",
    _attributes("tag"),
    bind(
        "texts",
        f"""transform(array({_attribute("attrs", "src")}, {_attribute("attrs", "alt")}),
            given -> {entities_sql("given")})""",
        "named_struct('src', texts[0], 'alt', texts[1])",
    ),
)
_LINK_TAG = bind(
    "attrs",
    _attributes("tag"),
    f"""named_struct('base', tag RLIKE '(?i)^<base',
        'href', {entities_sql(_attribute('attrs', 'href'))})""",
)


def image_structs(html: Column) -> Column:
    """``{src, alt}`` of every image with a real source; inline data images are left out."""
    kept = f"""image -> image.src IS NOT NULL AND {trim_sql("image.src")} <> ''
        AND NOT startswith(lower({trim_sql("image.src")}), 'data:')"""
    body = f"filter(transform({_tags('page', 'img')}, tag -> {_IMAGE}), {kept})"
    return over(html, "page", body)


def link_references(html: Column) -> Column:
    """``{base, links}``: the first ``<base>`` address, or NULL, and the ``href`` values of
    anchors and areas, trimmed, in document order."""
    blanks = literal(" \t\n\f\r")
    found = f"""filter(transform({_tags("page", "base", "a", "area")}, tag -> {_LINK_TAG}),
        link -> link.href IS NOT NULL)"""
    body = bind(
        "found",
        found,
        f"""named_struct(
            'base', nullif(get(filter(found, link -> link.base), 0).href, ''),
            'links', transform(filter(found, link -> NOT link.base),
                               link -> btrim(link.href, {blanks})))""",
    )
    return over(html, "page", body)


# The markdown rules, in order.  Inline marks apply to the innermost element first, so
# bold and italic run before and after links.
_BOLD = (r"(?i)<(?:b|strong)(?:\s[^>]*)?>([^<]+)</(?:b|strong)\s*>", r"**$1**")
_ITALIC = (r"(?i)<(?:i|em)(?:\s[^>]*)?>([^<]+)</(?:i|em)\s*>", r"*$1*")
_LINK = (r"""(?i)<a\b[^>]*\bhref\s*=\s*["']?([^"'\s>]*)["']?[^>]*>([^<]+)</a\s*>""", r"[$2]($1)")
_IMAGE_RULES = (
    (
        r"""(?i)<img\b[^>]*\balt\s*=\s*"([^"]*)"[^>]*\bsrc\s*=\s*"([^"]*)"[^>]*>""",
        r"![$1]($2)",
    ),
    (
        r"""(?i)<img\b[^>]*\bsrc\s*=\s*"([^"]*)"[^>]*\balt\s*=\s*"([^"]*)"[^>]*>""",
        r"![$2]($1)",
    ),
    (r"""(?i)<img\b[^>]*\bsrc\s*=\s*["']?([^"'\s>]+)["']?[^>]*>""", r"![]($1)"),
)
_BLOCKS = (
    "address|article|aside|blockquote|body|dd|div|dl|dt|fieldset|figcaption|figure|footer"
    "|form|h[1-6]|header|html|main|nav|ol|p|pre|section|table|tbody|thead|ul"
)
MARKDOWN_RULES: tuple[tuple[str, str], ...] = (
    (r"(?is)<head\b[^>]*>.*?</head\s*>", ""),
    (r"\s+", " "),
    *_IMAGE_RULES,
    (r"(?i)<code(?:\s[^>]*)?>([^<]+)</code\s*>", r"`$1`"),
    _BOLD,
    _ITALIC,
    _LINK,
    _BOLD,
    _ITALIC,
    *((rf"(?i)<h{n}(?:\s[^>]*)?>\s*", "\n\n" + "#" * n + " ") for n in range(1, 7)),
    (r"(?i)\s*<li(?:\s[^>]*)?>\s*", "\n- "),
    (r"(?i)<hr\b[^>]*>", "\n\n---\n\n"),
    (r"(?i)\s*<br\b[^>]*>\s*", "\n"),
    (r"(?i)<tr\b[^>]*>", "\n"),
    (r"(?i)</t[dh]\s*>", " | "),
    (rf"(?i)\s*</?(?:{_BLOCKS})(?:\s[^>]*)?>\s*", "\n\n"),
    (r"</?[A-Za-z][^>]*>|<[!?][^>]*>", ""),
)
_TIDY_RULES = ((r"[ \t]+\n", "\n"), (r"\n{3,}", "\n\n"))


def _apply(text: Column, rules: tuple[tuple[str, str], ...]) -> Column:
    for pattern, replacement in rules:
        text = F.regexp_replace(text, F.lit(pattern), F.lit(replacement))
    return text


def html_markdown(html: Column) -> Column:
    """Markdown by a fixed rule list, ending in one line break.

    Covers headings, bold, italic, links, images, lists, code, rules, line breaks, table
    cells and preformatted blocks; other tags are dropped.
    """

    def render(section: Column, index: Column) -> Column:
        code = F.rtrim(F.regexp_replace(section, F.lit(_TAG), F.lit("")))
        code = F.concat(F.lit("\n\n```\n"), code, F.lit("\n```\n\n"))
        return F.when(index % 2 == 1, code).otherwise(_apply(section, MARKDOWN_RULES))

    # Preformatted blocks keep their spacing: only the sections between them are rewritten.
    shown = F.regexp_replace(html, F.lit(HIDDEN), F.lit(""))
    sections = F.split(shown, r"(?i)</?pre(?=[\s>])[^>]*>")
    text = F.array_join(F.transform(sections, render), "")
    return F.concat(trim(decode_entities(_apply(text, _TIDY_RULES))), F.lit("\n"))
