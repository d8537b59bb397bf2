"""The same results as the registered queries, as SQL for another engine.

Each text is one statement over the given tables.  The SQL says the rule directly (for
instance with the few entities the tables hold) and shares only arguments and the fixed
patterns with the Spark side.
"""

from __future__ import annotations

from pagemill.functions import html
from pagemill.functions.content import REGION_TAGS, WHITESPACE, WHITESPACE_CHARS
from pagemill.functions.urls import _URL_SAFE
from pagemill.operators.boilerplate import BLOCK_TAGS
from pagemill.operators.links import IGNORED_EXTENSIONS
from pagemill.plans import corpus, queries

ORACLES: dict[str, str] = {}


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(value: str, pattern: str, by: str = "''") -> str:
    return f"regexp_replace({value}, {q(pattern)}, {by}, 'g')"


def choose(number: str, values) -> str:
    cases = " ".join(f"WHEN {i} THEN {q(v)}" for i, v in enumerate(values))
    return f"(CASE {number} % {len(values)} {cases} END)"


# --- scalar pieces -----------------------------------------------------------------------

SPACE = q(WHITESPACE_CHARS).replace("\x00", "")


def entities(x: str) -> str:
    """The references the tables hold; the ampersand last, also without its semicolon."""
    named = f"replace(replace(replace({x}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·')"
    return sub(named, "&amp;?", "'&'")


def canon(u: str) -> str:
    path = f"regexp_extract({u}, '(?i)^https?://[^/?#]*([^?#]*)', 1)"
    return (
        f"(lower(regexp_extract({u}, '(?i)^https?://[^/?#]*', 0)) || "
        f"CASE WHEN {path} = '' THEN '/' ELSE {path} END || "
        f"regexp_extract({u}, '^[^?#]*([?][^#]+)', 1))"
    )


def origin(u: str) -> str:
    return f"lower(regexp_extract({u}, '(?i)^https?://[^/?#]*', 0))"


def host(u: str) -> str:
    return f"regexp_extract({origin(u)}, '://([^:]*)', 1)"


def is_html(kind: str) -> str:
    return f"(lower({kind}) LIKE '%html%' OR lower({kind}) LIKE '%xml%')"


def is_text(kind: str) -> str:
    return (
        f"(lower({kind}) LIKE '%text/%' OR {is_html(kind)} OR lower({kind}) LIKE '%json%')"
    )


def hidden(x: str, by: str, noscript: bool = True) -> str:
    tags = ["script", "style", *(["noscript"] if noscript else [])]
    blocks = "|".join(rf"<{t}\b[^>]*>.*?(?:</{t}[^>]*>|\z)" for t in tags)
    return sub(x, rf"(?is)<!--.*?(?:-->|\z)|{blocks}", by)


TAG = r"""<(?:/?[A-Za-z](?:[^>"']|"[^"]*"|'[^']*')*>|[!?/][^>]*>)"""


def chunks(x: str) -> str:
    parts = f"string_split_regex({hidden(x, q('<!>'))}, {q(TAG)})"
    trimmed = f"list_transform({parts}, lambda c: trim({entities('c')}, {SPACE}))"
    return f"list_filter({trimmed}, lambda c: c <> '')"


def text_of(x: str) -> str:
    return f"array_to_string({chunks(x)}, ' ')"


def scripts(x: str) -> str:
    return sub(x, r"(?is)<script\b[^>]*>.*?</script\s*>")


def css(x: str) -> str:
    x = sub(x, r"(?is)<style\b[^>]*>.*?</style\s*>")
    x = sub(x, r"""(?is)<link\b[^>]*\brel\s*=\s*["']?stylesheet\b[^>]*>""")
    return sub(x, rf"""(?is)[{WHITESPACE}]+style\s*=\s*("[^"]*"|'[^']*'|[^{WHITESPACE}>]+)""")


def image_data(x: str) -> str:
    return sub(x, rf"""(?is)[{WHITESPACE}]+(?:src|srcset)\s*=\s*"[^"]*\bdata:image/[^"]*\"""")


def squeezed(x: str) -> str:
    x = sub(sub(x, r"(?s)<!--.*?-->"), rf">[{WHITESPACE}]+<", "'><'")
    return f"trim({sub(x, '[ \t\r\n]{2,}', q(' '))}, {SPACE})"


def regions(x: str) -> str:
    kept = sub(x, "(?is)" + "|".join(rf"<{t}\b[^>]*>.*?</{t}\s*>" for t in REGION_TAGS))
    return f"(CASE WHEN len({chunks(kept)}) = 0 THEN {x} ELSE {kept} END)"


def markdown(x: str) -> str:
    x = hidden(x, "''")
    for pattern, by in (*html.MARKDOWN_RULES, (r"[ \t]+\n", "\n"), (r"\n{3,}", "\n\n")):
        x = sub(x, pattern, q(by.replace("$", "\\")))
    return f"trim({entities(x)}, {SPACE}) || chr(10)"


def attribute(tag: str, name: str) -> str:
    """The tables' own image tags name each attribute at most once."""
    pattern = rf"""(?i)\s{name}(?:=("[^"]*"|'[^']*'|[^\s"'>]*))?(?:\s|/?>)"""
    value = f"regexp_extract({tag}, {q(pattern)}, 1)"
    bare = f"""trim({value}, '"''')"""
    return f"CASE WHEN regexp_matches({tag}, {q(pattern)}) THEN {entities(bare)} END"


def images(x: str) -> str:
    tags = f"regexp_extract_all({hidden(x, q(''), False)}, '(?i)<img[\\s/][^>]*>')"
    found = (
        f"list_transform({tags}, lambda t: {{'src': {attribute('t', 'src')}, "
        f"'alt': {attribute('t', 'alt')}}})"
    )
    return (
        f"list_filter({found}, lambda i: i.src IS NOT NULL AND i.src <> '' "
        f"AND i.src NOT LIKE 'data:%')"
    )


def hrefs(x: str) -> str:
    values = (
        f"regexp_extract_all({hidden(x, q(''), False)}, "
        """'(?i)<(?:a|area)\\s(?:[^>]*\\s)?href="([^"]*)"[^>]*>', 1)"""
    )
    return f"list_transform({values}, lambda h: trim({entities('h')}, ' ' || chr(10)))"


def escaped(u: str) -> str:
    """Percent-encode character by character."""
    each = (
        f"list_transform(string_split({u}, ''), lambda c: CASE WHEN regexp_matches(c, "
        f"{q('^[' + _URL_SAFE + ']$')}) THEN c ELSE url_encode(c) END)"
    )
    return f"array_to_string({each}, '')"


# --- shared inputs -----------------------------------------------------------------------

_MARKUP = f"replace({choose('page_id', corpus.MARKUP)}, '{{id}}', page_id::VARCHAR)"
RESPONSES = f"""responses AS (
  SELECT page_id AS seq, url,
    CASE WHEN page_id % 10 = 0 THEN regexp_replace(url, '[?#].*$', '') || '/old' ELSE url END
      AS request_url,
    CASE WHEN page_id % 29 = 0 THEN NULL WHEN page_id % 17 = 0 THEN 404
         WHEN page_id % 23 = 0 THEN 500 ELSE 200 END::INTEGER AS status,
    {choose('page_id', corpus.CONTENT_TYPES)} AS content_type,
    replace(html, '</article>', {_MARKUP} || '</article>') AS content,
    page_id % 29 = 0 AS refused,
    strftime(make_timestamp(({corpus.FIRST_FETCH} + page_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ')
      AS fetched_at
  FROM pages)"""
GOOD = "(NOT refused AND status < 400)"
FRONTIER = f"""frontier AS (
  SELECT s.url, s.status, stamp AS discovered_at, stamp AS updated_at,
    {origin('s.url')} || '/' AS source_url, NULL::VARCHAR AS error, NULL::VARCHAR AS failure_type,
    CASE WHEN s.status = 'failed' THEN 503 END::BIGINT AS http_status,
    NULL::VARCHAR AS final_url, NULL::VARCHAR AS content_type
  FROM (SELECT unnest([
      {{'url': url, 'status': {choose('page_id', corpus.STATUSES)}}},
      {{'url': url || '#main', 'status': {choose('(page_id // 4)', corpus.STATUSES)}}}]) AS s,
      strftime(make_timestamp(({corpus.FIRST_FETCH} - page_id) * 1000000), '%Y-%m-%dT%H:%M:%SZ')
        AS stamp
    FROM pages))"""
RANK = (
    "CASE {0} WHEN 'pending' THEN 0 WHEN 'failed' THEN 1 WHEN 'skipped' THEN 2 "
    "WHEN 'done' THEN 3 ELSE -1 END"
)
ALIASES = f"aliases AS (SELECT {canon('url')} AS canonical, url, status FROM frontier)"
STATE = f"""state AS (
  SELECT canonical AS url, arg_max(status, {RANK.format('status')}) AS status
  FROM aliases GROUP BY canonical)"""
IDENTITIES = f"""identities AS (
  SELECT DISTINCT seq, u.url FROM (
    SELECT seq, unnest([{{'url': {canon('request_url')}}}, {{'url': {canon('url')}}}]) AS u
    FROM responses))"""
_PATTERNS = " OR ".join(
    f"regexp_matches(url, {q(pattern)})" for pattern in queries.URL_PATTERNS
)


def outcomes(matches: str) -> str:
    return f"""outcomes AS (
  SELECT *, CASE WHEN refused OR status >= 400 THEN 'failed'
      WHEN NOT ({matches}) THEN NULL
      WHEN {is_text('content_type')} THEN 'done' ELSE 'skipped' END AS outcome
  FROM responses)"""


EVENTS = f"""events AS (
  SELECT l.url, o.outcome AS status,
    CASE WHEN refused THEN 'connection refused' WHEN outcome = 'failed' THEN 'HTTP ' || o.status END
      AS error,
    CASE WHEN refused THEN 'ConnectionRefusedError' WHEN outcome = 'failed' THEN 'http_status' END
      AS failure_type,
    CASE WHEN NOT refused AND outcome = 'failed' THEN o.status END::BIGINT AS http_status,
    CASE WHEN outcome = 'failed' THEN o.url END AS final_url,
    CASE WHEN NOT refused AND outcome = 'failed' THEN o.content_type END AS content_type
  FROM (SELECT i.url, max(i.seq) AS seq FROM identities i JOIN outcomes o ON i.seq = o.seq
        WHERE o.outcome IS NOT NULL GROUP BY i.url) l
  JOIN outcomes o ON o.seq = l.seq)"""
_LINK = f"{origin('url')} || h"
_EXTENSIONS = "|".join(e.replace(".", r"\.") for e in IGNORED_EXTENSIONS)
_PATH = "lower(regexp_extract(link_url, '^https?://[^/?#]*([^?#]*)', 1))"


def edges(where: str) -> str:
    return f"""edges AS (
  SELECT *, {canon('link_url')} AS target_url FROM (
    SELECT DISTINCT seq, url AS source_url, {escaped(_LINK)} AS link_url
    FROM (SELECT seq, url, unnest({hrefs('content')}) AS h FROM responses WHERE {where}))
  WHERE NOT regexp_matches({_PATH}, {q(rf'[.](?:{_EXTENSIONS})$')}))"""


TEXT_EDGES = edges(f"{GOOD} AND {is_text('content_type')}")
SCOPED = f"""scoped AS (SELECT * FROM edges WHERE {host('link_url')} = {host('source_url')})"""
KNOWN = "known AS (SELECT DISTINCT target_url FROM edges WHERE length(target_url) % 2 = 0)"
FRESH = """fresh AS (
  SELECT target_url, arg_min(source_url, seq) AS source_url, min(seq) AS seq
  FROM scoped WHERE target_url NOT IN (SELECT target_url FROM known) GROUP BY target_url)"""


def ctes(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n"


# --- sources, tables, keyed rows -------------------------------------------------------

ORACLES["responses_scan"] = ctes(RESPONSES) + """
SELECT seq, url, request_url, status, content_type, fetched_at, strlen(content) AS octets
FROM responses"""
ORACLES["frontier_scan"] = ctes(FRONTIER) + "SELECT url, status FROM frontier"
ORACLES["frontier_by_status"] = ctes(FRONTIER) + """
SELECT url, source_url, discovered_at FROM frontier WHERE status = 'pending'"""

_VERSIONS = """stored_all AS (
  SELECT regexp_replace(url, '[?#].*$', '') AS url, md5(html) AS digest, page_id AS seq FROM pages),
stored AS (SELECT url, arg_max(digest, seq) AS digest, max(seq) AS seq FROM stored_all GROUP BY url),
updates_all AS (
  SELECT CASE WHEN page_id % 3 = 0 THEN regexp_replace(url, '[?#].*$', '') || '/new'
              ELSE regexp_replace(url, '[?#].*$', '') END AS url,
    md5(reverse(html)) AS digest, page_id AS seq FROM pages),
updates AS (SELECT url, arg_max(digest, seq) AS digest, max(seq) AS seq FROM updates_all GROUP BY url),
merged AS (
  SELECT url, digest, seq, NULL::BIGINT AS revision FROM stored
  WHERE url NOT IN (SELECT url FROM updates)
  UNION ALL SELECT url, digest, seq, 2::BIGINT FROM updates)"""
ORACLES["upsert_pages"] = ctes(_VERSIONS) + "SELECT * FROM merged"
ORACLES["compact_pages"] = ctes(
    _VERSIONS, "again AS (SELECT url || '/new' AS url, digest, seq FROM updates)"
) + """
SELECT * FROM merged WHERE url NOT IN (SELECT url FROM again)
UNION ALL SELECT url, digest, seq, 3::BIGINT FROM again"""
ORACLES["dedupe_last"] = f"""
SELECT host, max(page_id) AS seq, arg_max(url, page_id) AS url, arg_max(md5(html), page_id) AS digest
FROM (SELECT *, {host('url')} AS host FROM pages) GROUP BY host"""
ORACLES["unique_first"] = f"""
SELECT href, min(page_id) AS seq
FROM (SELECT page_id, unnest({hrefs('html')}) AS href FROM pages) GROUP BY href"""
ORACLES["schema_evolve"] = """
SELECT url, length(html) AS n_chars, NULL::VARCHAR AS title, NULL::VARCHAR AS note FROM pages
UNION ALL
SELECT url || '/v2', NULL, regexp_extract(html, '(?s)<title>(.*?)</title>', 1), NULL FROM pages"""
_POSTINGS = r"""postings AS (
  SELECT term, doc_id, count(*) AS tf
  FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\pL\pN]+')) AS term FROM documents)
  WHERE term <> '' GROUP BY term, doc_id)"""
ORACLES["text_postings"] = ctes(_POSTINGS) + "SELECT * FROM postings"
_TERMS = ", ".join(map(q, queries.SEARCH_TERMS))
ORACLES["term_search"] = ctes(
    _POSTINGS,
    f"found AS (SELECT * FROM postings WHERE term IN ({_TERMS}))",
    "frequency AS (SELECT term, count(*) AS df FROM found GROUP BY term)",
) + """
SELECT doc_id, count(*) AS matched,
  round(sum(tf * ln((SELECT count(*) FROM documents) / df::DOUBLE)), 6) AS score
FROM found JOIN frequency USING (term) GROUP BY doc_id"""
_STRIPPED_HTML = (
    f"CASE WHEN {is_html('content_type')} THEN {image_data(scripts('content'))} ELSE content END"
)
_TEXT_RECORDS = f"""records AS (
  SELECT seq, url, fetched_at AS date, content_type,
    CASE WHEN {is_html('content_type')} THEN {text_of('stripped')} ELSE stripped END AS text,
    CASE WHEN {is_html('content_type')} THEN {images('stripped')} ELSE [] END AS images
  FROM (SELECT *, {_STRIPPED_HTML} AS stripped FROM responses WHERE {is_text('content_type')}))"""
ORACLES["record_bytes"] = ctes(RESPONSES, _TEXT_RECORDS) + """
SELECT seq, (3 + 4 + 12 + 4 + 6 + strlen(url) + strlen(date) + strlen(content_type) + strlen(text)
  + coalesce(list_sum(list_transform(images,
      lambda i: 6 + strlen(i.src) + coalesce(strlen(i.alt), 0))), 0))::BIGINT AS record_bytes
FROM records"""
ORACLES["write_batches"] = ctes(
    f"""sized AS (
  SELECT {host('url')} AS host, page_id AS seq, strlen(html) AS size,
    row_number() OVER (PARTITION BY {host('url')} ORDER BY page_id, strlen(html)) AS n FROM pages)""",
    f"""walk AS (
  SELECT host, seq, size, n, 0::BIGINT AS batch, 1 AS held_rows, size AS held FROM sized WHERE n = 1
  UNION ALL
  SELECT s.host, s.seq, s.size, s.n,
    CASE WHEN w.held_rows >= {queries.BATCH_ROWS} OR w.held + s.size > {queries.BATCH_OCTETS}
      THEN w.batch + 1 ELSE w.batch END,
    CASE WHEN w.held_rows >= {queries.BATCH_ROWS} OR w.held + s.size > {queries.BATCH_OCTETS}
      THEN 1 ELSE w.held_rows + 1 END,
    CASE WHEN w.held_rows >= {queries.BATCH_ROWS} OR w.held + s.size > {queries.BATCH_OCTETS}
      THEN s.size ELSE w.held + s.size END
  FROM walk w JOIN sized s ON s.host IS NOT DISTINCT FROM w.host AND s.n = w.n + 1)""",
    recursive=True,
) + "SELECT host, seq, size::BIGINT AS record_bytes, batch FROM walk"
ORACLES["batch_files"] = f"""
SELECT {host('url')} AS host, count(*) AS rows, least(count(*), {queries.BATCH_ROWS}) AS largest,
  sum(strlen(html))::BIGINT AS record_bytes
FROM pages GROUP BY 1"""

# --- URLs --------------------------------------------------------------------------------

ORACLES["seed_urls"] = """
SELECT page_id, value, CASE page_id % 6 WHEN 0 THEN 'https://' || value WHEN 1 THEN 'https://' || value
  WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE value END AS seed
FROM (SELECT page_id, CASE page_id % 6
    WHEN 0 THEN regexp_replace(url, '^https?://', '')
    WHEN 1 THEN regexp_extract(url, '^https?://([^/]*)', 1)
    WHEN 2 THEN 'ftp://' || regexp_replace(url, '^https?://', '')
    WHEN 3 THEN '/' || regexp_replace(url, '^https?://', '')
    ELSE url END AS value FROM pages)"""
ORACLES["url_domain"] = f"SELECT page_id, {host('url')} AS domain FROM pages"
ORACLES["url_canonical"] = f"""
SELECT page_id, CASE page_id % 5
    WHEN 0 THEN {origin('url')} || upper(regexp_extract(url, '^https?://[^/]*([^#]*)', 1))
    WHEN 1 THEN regexp_replace(url, '[?#].*$', '')
    WHEN 2 THEN regexp_extract(url, '^https?://[^/]*', 0) || '/'
    WHEN 3 THEN regexp_replace(url, '[?#].*$', '') || ';a=B?Q=1&p;'
    ELSE regexp_replace(url, '#.*$', '') END AS canonical
FROM pages"""
ORACLES["url_filter"] = f"SELECT page_id, url FROM pages WHERE {_PATTERNS}"
_SCOPE_REST = queries.SCOPE.split("://")[1]
ORACLES["url_prefix_scope"] = f"""
SELECT page_id, url FROM pages
WHERE regexp_replace(url, '^https?://', '') = {q(_SCOPE_REST)}
   OR starts_with(regexp_replace(url, '^https?://', ''), {q(_SCOPE_REST + '/')})"""
ORACLES["sitemap_seeds"] = f"""
SELECT origin, origin || unnest(['/robots.txt', '/sitemap.xml']) AS sitemap_url
FROM (SELECT DISTINCT {origin('url')} AS origin FROM pages)"""

# --- filters, routing, limits ------------------------------------------------------------

ORACLES["text_responses"] = ctes(RESPONSES) + f"""
SELECT seq, url, content_type FROM responses WHERE {is_text('content_type')}"""
ORACLES["response_filter"] = ctes(RESPONSES) + """
SELECT seq, url FROM responses WHERE content_type LIKE '%html%' OR url LIKE '%.html'"""
ORACLES["headers_lower"] = """
SELECT page_id, 'content-type' AS name, 'text/html' AS value FROM pages
UNION ALL SELECT page_id, 'x-page', page_id::VARCHAR FROM pages"""
ORACLES["failed_responses"] = ctes(RESPONSES) + """
SELECT seq, request_url, url AS final_url,
  CASE WHEN refused THEN 'connection refused' ELSE 'HTTP ' || status END AS error,
  CASE WHEN refused THEN 'ConnectionRefusedError' ELSE 'http_status' END AS failure_type,
  CASE WHEN NOT refused THEN status END::BIGINT AS http_status,
  CASE WHEN NOT refused THEN content_type END AS content_type
FROM responses WHERE refused OR status >= 400"""
ORACLES["limit_pages"] = ctes(RESPONSES) + f"""
SELECT seq, url FROM responses WHERE {GOOD} ORDER BY seq LIMIT {queries.PAGE_LIMIT}"""

# --- content -----------------------------------------------------------------------------

ORACLES["content_kind"] = """
SELECT page_id, k.content_type, k.charset, k.is_html, k.is_textual
FROM (SELECT page_id, CASE page_id % 6
  WHEN 0 THEN {'content_type': 'text/html; charset=UTF-8', 'charset': 'UTF-8', 'is_html': true, 'is_textual': true}
  WHEN 1 THEN {'content_type': 'text/html;Charset="latin-1"', 'charset': 'latin-1', 'is_html': true, 'is_textual': true}
  WHEN 2 THEN {'content_type': 'application/xhtml+xml', 'charset': 'utf-8', 'is_html': true, 'is_textual': true}
  WHEN 3 THEN {'content_type': 'image/png; q=1; charset = utf-16 ; x=y', 'charset': 'utf-16', 'is_html': false, 'is_textual': false}
  WHEN 4 THEN {'content_type': 'application/json', 'charset': 'utf-8', 'is_html': false, 'is_textual': true}
  ELSE {'content_type': '', 'charset': 'utf-8', 'is_html': false, 'is_textual': false} END AS k FROM pages)"""
ORACLES["decode_body"] = r"""
SELECT page_id, CASE page_id % 4 WHEN 0 THEN chr(65533) || html
  WHEN 1 THEN regexp_replace(html, '[^\x00-\x{FF}]', '?', 'g') ELSE html END AS text
FROM pages"""


def _strip_oracle(value: str) -> str:
    return ctes(RESPONSES) + f"SELECT seq, {value} AS text FROM responses"


ORACLES["strip_scripts"] = _strip_oracle(scripts("content"))
ORACLES["strip_css"] = _strip_oracle(css("content"))
ORACLES["strip_image_data"] = _strip_oracle(image_data("content"))
ORACLES["strip_whitespace"] = _strip_oracle(squeezed("content"))
ORACLES["strip_html"] = _strip_oracle(
    f"CASE WHEN {is_html('content_type')} THEN "
    f"{squeezed(image_data(css(scripts('content'))))} ELSE content END"
)
ORACLES["html_text"] = _strip_oracle(text_of("content"))
ORACLES["html_markdown"] = _strip_oracle(markdown("content"))


def _sources(x: str) -> str:
    return (
        f"CASE WHEN {is_html('content_type')} THEN "
        f"array_to_string(list_transform({images(x)}, lambda i: i.src), ' ') ELSE '' END"
    )


ORACLES["images_raw_vs_stripped"] = ctes(RESPONSES) + f"""
SELECT seq, {_sources('cleaned')} AS before_links, {_sources('content')} AS after_links
FROM (SELECT *, {regions('content')} AS cleaned FROM responses)"""
ORACLES["page_images"] = ctes(RESPONSES) + f"""
SELECT seq, (p - 1)::BIGINT AS position, found[p].src AS src, found[p].alt AS alt
FROM (SELECT seq, found, unnest(range(1, len(found) + 1)) AS p
  FROM (SELECT seq, {images('content')} AS found FROM responses WHERE {is_html('content_type')}))"""


def _records(stripped: str, text: str) -> str:
    image_text = "array_to_string(list_filter(list_transform(found, lambda i: i.alt), lambda a: a IS NOT NULL), ' ')"
    return ctes(RESPONSES) + f"""
SELECT seq, url, date, content_type,
  CASE WHEN {is_html('content_type')} THEN {text} ELSE content END AS text,
  array_to_string(list_transform(found, lambda i: i.src), ' ') AS image_sources,
  {image_text} AS image_texts
FROM (SELECT *, CASE WHEN {is_html('content_type')} THEN {images('stripped')} ELSE [] END AS found
  FROM (SELECT *, fetched_at AS date, {stripped} AS stripped FROM responses
        WHERE {GOOD} AND {is_text('content_type')}))"""


ORACLES["page_records"] = _records(regions("content"), markdown("stripped"))
ORACLES["page_records_html"] = _records(image_data(scripts("content")), "stripped")
_BREAK = r"(?i)</?(?:" + "|".join(BLOCK_TAGS) + r")(?:[\s/][^>]*)?>"
_BLOCKS = f"""blocks AS (
  SELECT seq, url, {host('url')} AS host, list_filter(list_transform(
      string_split_regex({hidden('content', "''")}, {q(_BREAK)}), lambda b: {text_of('b')}),
      lambda t: t <> '') AS blocks
  FROM responses),
placed AS (SELECT seq, host, unnest(blocks) AS block, unnest(range(1, len(blocks) + 1)) AS position
  FROM blocks),
hosts AS (SELECT host, count(*) AS host_pages FROM blocks GROUP BY host),
repeated AS (SELECT host, block, pages FROM (
    SELECT host, block, count(DISTINCT seq) AS pages FROM placed GROUP BY host, block)
  JOIN hosts USING (host) WHERE pages > 2 AND pages * 100 > host_pages * 10)"""
ORACLES["boilerplate_blocks"] = ctes(RESPONSES, _BLOCKS) + "SELECT * FROM repeated"
ORACLES["clean_pages"] = ctes(RESPONSES, _BLOCKS) + """
SELECT b.seq, b.url,
  CASE WHEN k.kept IS NULL THEN array_to_string(b.blocks, chr(10)) ELSE k.kept END AS text,
  CASE WHEN k.kept IS NULL THEN 0 ELSE len(b.blocks) - k.n END::BIGINT AS dropped
FROM blocks b LEFT JOIN (
  SELECT seq, string_agg(block, chr(10) ORDER BY position) AS kept, count(*) AS n
  FROM placed p WHERE NOT EXISTS (
    SELECT 1 FROM repeated r WHERE r.host = p.host AND r.block = p.block)
  GROUP BY seq) k ON k.seq = b.seq"""
ORACLES["custom_extract"] = ctes(RESPONSES) + f"""
SELECT max(seq) AS seq, word, arg_max(title, seq) AS title
FROM (SELECT seq, string_split(title, ' ')[1] AS word, title FROM (
    SELECT seq, regexp_extract(content, '(?s)<title>(.*?)</title>', 1) AS title
    FROM responses WHERE {GOOD} AND {is_text('content_type')}))
WHERE length(word) > 3 GROUP BY word"""

# --- links, sitemaps ---------------------------------------------------------------------

ORACLES["link_edges"] = ctes(RESPONSES, TEXT_EDGES) + (
    "SELECT seq, source_url, link_url, target_url FROM edges"
)
ORACLES["links_in_scope"] = ctes(RESPONSES, TEXT_EDGES, SCOPED) + """
SELECT seq, source_url, target_url FROM scoped WHERE regexp_matches(link_url, '/[a-m]')"""
ORACLES["links_new"] = ctes(RESPONSES, TEXT_EDGES, SCOPED, KNOWN, FRESH) + "SELECT * FROM fresh"
ORACLES["frontier_discovered"] = ctes(RESPONSES, TEXT_EDGES, SCOPED, KNOWN, FRESH) + f"""
SELECT target_url AS url, 'pending' AS status, {q(corpus.SEED_STAMP)} AS discovered_at,
  {q(corpus.SEED_STAMP)} AS updated_at, source_url, NULL::VARCHAR AS error,
  NULL::VARCHAR AS failure_type, NULL::BIGINT AS http_status, NULL::VARCHAR AS final_url,
  NULL::VARCHAR AS content_type
FROM fresh"""
ORACLES["crawl_depth"] = ctes(
    f"""nodes AS (
  SELECT list_prepend(url, list_transform({hrefs('html')}, lambda h: {origin('url')} || h)) AS nodes
  FROM pages)""",
    """chain AS (
  SELECT DISTINCT nodes[i] AS source_url, nodes[i + 1] AS target_url
  FROM (SELECT nodes, unnest(range(1, len(nodes))) AS i FROM nodes))""",
    """reached AS (
  SELECT url, 0::BIGINT AS depth FROM pages
  UNION
  SELECT c.target_url, r.depth + 1 FROM reached r JOIN chain c ON c.source_url = r.url
  WHERE r.depth < 40)""",
    recursive=True,
) + "SELECT url, min(depth) AS depth FROM reached GROUP BY url"
ORACLES["robots_sitemaps"] = f"""
SELECT page_id AS seq, {origin('url')} || '/robots.txt' AS source_url,
  unnest([{origin('url')} || '/maps/' || page_id || '.xml', {origin('url')} || '/sitemap.xml'])
    AS sitemap_url
FROM pages WHERE page_id % 13 <> 0"""
_SITEMAPS = f"""maps AS (
  SELECT page_id AS seq, url AS page_url, {origin('url')} AS origin,
    {origin('url')} || '/sitemap-' || page_id || '.xml' AS source_url, html
  FROM pages WHERE page_id % 13 <> 0 AND page_id % 11 <> 0)"""
ORACLES["sitemap_children"] = ctes(_SITEMAPS) + """
SELECT seq, source_url,
  origin || '/sitemap-' || (seq + unnest([1, 5])) || '.xml' AS sitemap_url
FROM maps WHERE seq % 5 = 0"""
_ENTRY = f"list_prepend(page_url, list_transform({hrefs('html')}, lambda h: origin || h))"
ORACLES["sitemap_urls"] = ctes(
    _SITEMAPS,
    f"""entries AS (SELECT seq, source_url, unnest({_ENTRY}) AS u FROM maps WHERE seq % 5 > 1)""",
) + f"""
SELECT seq, source_url, target_url FROM (SELECT seq, source_url, {canon('u')} AS target_url FROM entries)
WHERE regexp_matches(target_url, '/[a-z]')"""

# --- frontier ----------------------------------------------------------------------------

ORACLES["frontier_aliases"] = ctes(FRONTIER, ALIASES) + "SELECT * FROM aliases"
ORACLES["frontier_state"] = ctes(FRONTIER, ALIASES, STATE) + "SELECT * FROM state"
ORACLES["frontier_reconcile"] = ctes(FRONTIER, ALIASES, STATE) + f"""
SELECT a.url, s.status FROM aliases a JOIN state s ON s.url = a.canonical
WHERE s.status IN ('done', 'skipped') AND a.url <> a.canonical
  AND {RANK.format('a.status')} < {RANK.format('s.status')}"""
ORACLES["page_identities"] = ctes(RESPONSES, IDENTITIES) + "SELECT * FROM identities"
ORACLES["frontier_expand_aliases"] = ctes(RESPONSES, IDENTITIES, FRONTIER, ALIASES) + """
SELECT DISTINCT url FROM identities
UNION SELECT a.url FROM aliases a WHERE a.canonical IN (SELECT url FROM identities)"""
_EXPANDED = """expanded AS (
  SELECT url, url AS canonical FROM events
  UNION SELECT a.url, a.canonical FROM aliases a WHERE a.canonical IN (SELECT url FROM events))"""
ORACLES["frontier_outcomes"] = ctes(
    RESPONSES, outcomes(_PATTERNS), IDENTITIES, EVENTS, FRONTIER, ALIASES, _EXPANDED
) + f"""
SELECT x.url, e.status, coalesce(f.discovered_at, {q(corpus.SEED_STAMP)}) AS discovered_at,
  {q(corpus.SEED_STAMP)} AS updated_at, f.source_url, e.error, e.failure_type, e.http_status,
  e.final_url, e.content_type
FROM expanded x JOIN events e ON e.url = x.canonical LEFT JOIN frontier f ON f.url = x.url"""
ORACLES["frontier_upsert"] = ctes(
    RESPONSES,
    FRONTIER,
    ALIASES,
    f"""seeds AS (
  SELECT DISTINCT {canon("url || '/more'")} AS url FROM pages
  WHERE {canon("url || '/more'")} NOT IN (SELECT canonical FROM aliases))""",
) + f"""
SELECT f.url, CASE WHEN r.url IS NULL THEN f.status
    WHEN NOT r.refused AND r.status < 400 THEN 'done' ELSE 'failed' END AS status, f.discovered_at,
  CASE WHEN r.url IS NULL THEN f.updated_at ELSE {q(corpus.SEED_STAMP)} END AS updated_at,
  f.source_url, f.error, f.failure_type,
  CASE WHEN r.url IS NULL THEN f.http_status END AS http_status, f.final_url, f.content_type
FROM frontier f LEFT JOIN responses r ON r.url = f.url
UNION ALL
SELECT url, 'pending', {q(corpus.SEED_STAMP)}, {q(corpus.SEED_STAMP)}, NULL, NULL, NULL, NULL, NULL,
  NULL FROM seeds"""
ORACLES["unresolved_seeds"] = ctes(RESPONSES, IDENTITIES) + f"""
SELECT DISTINCT u AS url, 'failed' AS status,
  'request finished without response callback' AS error, 'crawler_no_callback' AS failure_type
FROM (SELECT {canon("(url || CASE WHEN page_id % 2 = 0 THEN '/x' ELSE '' END)")} AS u FROM pages)
WHERE u NOT IN (SELECT url FROM identities)"""
ORACLES["resume_worklist"] = ctes(FRONTIER, ALIASES, STATE) + """
SELECT url FROM state WHERE status IN ('pending', 'failed') AND regexp_matches(url, '/(en|de)/')"""

# --- runs, streams -----------------------------------------------------------------------

_ALL = outcomes("true")
ORACLES["import_summary"] = ctes(RESPONSES, _ALL, TEXT_EDGES, SCOPED) + """
SELECT count(*) FILTER (outcome IN ('done', 'skipped')) AS matched_records,
  count(DISTINCT url) FILTER (outcome = 'done') AS imported_records,
  count(*) FILTER (outcome = 'skipped') AS skipped_records,
  count(*) FILTER (outcome IN ('done', 'skipped')) AS pages_read,
  (SELECT count(DISTINCT target_url) FROM scoped) AS discovered_urls,
  count(*) FILTER (outcome = 'failed') AS failed_urls
FROM outcomes"""
ORACLES["outcomes_by_host"] = ctes(RESPONSES, outcomes(_PATTERNS)) + """
SELECT host, outcome, count(*) AS responses FROM (
  SELECT """ + host("url") + """ AS host, coalesce(outcome, 'unmatched') AS outcome FROM outcomes)
GROUP BY ROLLUP (host, outcome)"""
ORACLES["stream_ingest"] = ctes(RESPONSES, _TEXT_RECORDS) + f"""
SELECT url, date, content_type, text FROM records
WHERE seq IN (SELECT seq FROM responses WHERE {GOOD})"""
ORACLES["stream_resume"] = ctes(RESPONSES, _ALL, IDENTITIES, EVENTS, TEXT_EDGES, SCOPED) + """
SELECT url, status FROM events
UNION ALL
SELECT DISTINCT target_url, 'pending' FROM scoped WHERE target_url NOT IN (SELECT url FROM events)"""

_NOW = "(SELECT max(fetched_at) FROM responses)"
_UNANSWERED = "'request finished without response callback', 'crawler_no_callback'"
ORACLES["import_seeded"] = ctes(
    RESPONSES, _ALL, IDENTITIES, EVENTS, FRONTIER, ALIASES, _EXPANDED, TEXT_EDGES, SCOPED
) + f"""
SELECT x.url, e.status, coalesce(f.discovered_at, {_NOW}) AS discovered_at, {_NOW} AS updated_at,
  f.source_url, e.error, e.failure_type, e.http_status, e.final_url, e.content_type
FROM expanded x JOIN events e ON e.url = x.canonical LEFT JOIN frontier f ON f.url = x.url
UNION ALL
SELECT target_url, 'pending', {_NOW}, {_NOW}, arg_min(source_url, seq), NULL, NULL, NULL, NULL, NULL
FROM scoped WHERE target_url NOT IN (SELECT url FROM events)
  AND target_url NOT IN (SELECT canonical FROM aliases) GROUP BY target_url
UNION ALL
SELECT {origin('url')} || '/gone/' || page_id, 'failed', {q(corpus.SEED_STAMP)}, {_NOW}, NULL,
  {_UNANSWERED}, NULL, NULL, NULL
FROM pages"""
_LISTED = f"""listed AS (
  SELECT {canon('u')} AS target_url FROM (SELECT unnest({_ENTRY}) AS u FROM maps WHERE seq % 5 > 1))"""
ORACLES["import_sitemap"] = ctes(
    RESPONSES, _ALL, IDENTITIES, EVENTS, TEXT_EDGES, SCOPED, _SITEMAPS, _LISTED
) + f"""
SELECT url, status FROM events
UNION ALL
SELECT p.url, e.status FROM (SELECT DISTINCT url, {canon('url')} AS canonical FROM pages) p
JOIN events e ON e.url = p.canonical WHERE p.url <> p.canonical
UNION ALL
SELECT target_url, 'pending' FROM (SELECT target_url FROM scoped UNION SELECT target_url FROM listed)
WHERE target_url NOT IN (SELECT url FROM events)"""
# A later import replaces the whole row: what it does not know of the page is NULL.
ORACLES["import_schema"] = ctes(RESPONSES, _ALL, _TEXT_RECORDS) + """
SELECT url, regexp_extract(content, '(?s)<title>(.*?)</title>', 1) AS title, NULL::DOUBLE AS rating,
  NULL::VARCHAR AS content_type, NULL::VARCHAR AS text
FROM outcomes WHERE outcome = 'done' AND seq % 2 = 0 AND seq % 3 <> 0
UNION ALL
SELECT url, NULL, NULL, content_type, text FROM records
WHERE seq % 3 = 0 AND seq IN (SELECT seq FROM outcomes WHERE outcome = 'done')"""
ORACLES["import_write_failed"] = ctes(RESPONSES, _ALL, IDENTITIES, EVENTS, TEXT_EDGES, SCOPED) + """
SELECT url, CASE status WHEN 'done' THEN 'failed' ELSE status END AS status,
  CASE status WHEN 'done' THEN 'dataset write failed after retries' ELSE error END AS error,
  CASE status WHEN 'done' THEN 'dataset_write_failed' ELSE failure_type END AS failure_type
FROM events
UNION ALL
SELECT DISTINCT target_url, 'pending', NULL, NULL FROM scoped WHERE target_url NOT IN (SELECT url FROM events)"""
ORACLES["import_progress"] = ctes(RESPONSES, _ALL, IDENTITIES, EVENTS, TEXT_EDGES, SCOPED, """counts AS (SELECT count(*) FILTER (outcome IN ('done', 'skipped')) AS matched,
    count(*) FILTER (outcome = 'failed') AS failed, count(*) FILTER (outcome = 'skipped') AS skipped,
    count(*) FILTER (outcome = 'done') AS done, count(DISTINCT url) FILTER (outcome = 'done') AS imported
  FROM outcomes)""") + """
SELECT s.stage, s.rows, s.imported FROM (SELECT unnest([
    {'stage': 'loading_frontier', 'rows': 0, 'imported': 0}, {'stage': 'frontier_loaded', 'rows': 0, 'imported': 0},
    {'stage': 'started', 'rows': 0, 'imported': 0}, {'stage': 'page_scraped', 'rows': matched, 'imported': 0},
    {'stage': 'request_failed', 'rows': failed, 'imported': 0},
    {'stage': 'response_filtered', 'rows': skipped, 'imported': 0},
    {'stage': 'record_extracted', 'rows': done, 'imported': 0},
    {'stage': 'batch_merged', 'rows': imported, 'imported': imported},
    {'stage': 'frontier_discovered', 'imported': imported, 'rows': (SELECT count(DISTINCT target_url)
      FROM scoped WHERE target_url NOT IN (SELECT url FROM events))},
    {'stage': 'completed', 'rows': 0, 'imported': imported}]) AS s FROM counts)"""

# Pages of the second import count those of the first too; texts of the first stay as they were.
_STORED_BLOCKS = f"""cleanable AS (
  SELECT seq, url, {host('url')} AS host, seq % 2 AS half, {is_html('content_type')} AS html, stripped,
    list_filter(list_transform(string_split_regex({hidden('stripped', "''")}, {q(_BREAK)}),
      lambda b: {text_of('b')}), lambda t: t <> '') AS blocks
  FROM (SELECT *, {_STRIPPED_HTML} AS stripped FROM responses WHERE {GOOD} AND {is_text('content_type')})),
placed AS (SELECT seq, host, half, unnest(blocks) AS block, unnest(range(1, len(blocks) + 1)) AS position
  FROM cleanable WHERE html),
totals AS (SELECT h.half, host, count(*) AS host_pages
  FROM (SELECT unnest([0, 1]) AS half) h JOIN cleanable c ON c.half <= h.half AND c.html GROUP BY h.half, host),
repeated AS (SELECT half, host, block FROM (
    SELECT h.half, host, block, count(DISTINCT seq) AS pages
    FROM (SELECT unnest([0, 1]) AS half) h JOIN placed p ON p.half <= h.half GROUP BY h.half, host, block)
  JOIN totals USING (half, host) WHERE pages > 2 AND pages * 100 > host_pages * 10)"""
ORACLES["import_cleaned"] = ctes(RESPONSES, _STORED_BLOCKS) + """
SELECT c.url, CASE WHEN NOT c.html THEN c.stripped
  ELSE coalesce(k.kept, array_to_string(c.blocks, chr(10))) END AS text
FROM cleanable c LEFT JOIN (
  SELECT seq, string_agg(block, chr(10) ORDER BY position) AS kept FROM placed p
  WHERE NOT EXISTS (SELECT 1 FROM repeated r WHERE r.half = p.half AND r.host = p.host AND r.block = p.block)
  GROUP BY seq) k ON k.seq = c.seq"""
