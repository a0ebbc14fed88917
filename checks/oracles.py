"""SQL for DuckDB that gives the result of each query in another way."""

from checks import inputs
from checks.inputs import for_duckdb


def _over(text: str) -> str:
    """A derived input as a subquery."""
    return f"({for_duckdb(text)}) t"


def _hostname(page: str) -> str:
    authority = f"regexp_extract({page}, '//([^/:]+)', 1)"
    host = f"regexp_extract({authority}, '^[^?#]*', 0)"
    return f"coalesce(regexp_replace({host}, '^.*@', ''), '')"


def _attr(name: str) -> str:
    return (
        rf"""regexp_extract(tag, '\A.*{name}=["'']?([^''"]*)["'']?.*\z', 1) AS "{name}" """
    )


_FEED_COLUMNS = f"""
page, tag, lower(type) AS type, {_hostname("page")} AS hostname,
{_attr("rel")}, {_attr("href")}, {_attr("title")}
"""
_FEEDS = f"SELECT {_FEED_COLUMNS} FROM {_over(inputs.FEED_TAGS)}"
_FEEDS_ONE_LINE = f"""
SELECT {_FEED_COLUMNS} FROM
  (SELECT page, replace(tag, chr(10), ' ') AS tag, type FROM {_over(inputs.FEED_TAGS)}) f
"""

_QUAD = r"'\A(\S+)\s+(\S+)\s+(.+)\s+<([^>]+)>\s+(<[^>]+>)\s+\.\z'"
_QUAD_FIELDS = ", ".join(
    f"regexp_extract(value, {_QUAD}, {i}) AS {name}"
    for i, name in enumerate(("subject", "predicate", "obj", "url", "extractor"), 1)
)
_QUADS = f"""
SELECT {_QUAD_FIELDS} FROM {_over(inputs.QUAD_LINES)} WHERE regexp_matches(value, {_QUAD})
"""
_FAILED = f"NOT regexp_matches(value, {_QUAD})"

# Suffixes that occur in the derived addresses, with the number of labels each rule takes:
# *.ck and *.kobe.jp take one more label than they show, !www.ck and !city.kobe.jp one less.
_RULES = """
(VALUES ('com', 1), ('net', 1), ('org', 1), ('uk', 1), ('co.uk', 2), ('jp', 1),
        ('www.ck', 1), ('ck', 2), ('city.kobe.jp', 2), ('kobe.jp', 3)) r(suffix, n)
"""
_DOMAIN = r"^([a-z0-9]([a-z0-9_-]*[a-z0-9])?\.)*[a-z]([a-z0-9_-]*[a-z0-9])?$"


def _domains(urls: str) -> str:
    """url -> tpd by the longest matching rule, for a subquery with a ``url`` column."""
    return rf"""
WITH hosts AS (
  SELECT DISTINCT url, regexp_replace(
    regexp_replace(regexp_extract(url, '^(?:https?)://([^/?#]*)', 1), '^.*@', ''),
    ':[0-9]*$', '') AS host
  FROM {urls}
), named AS (
  SELECT url, host, lower(host) AS name, string_split(lower(host), '.') AS labels FROM hosts
), hits AS (
  SELECT url, r.n, row_number() OVER (PARTITION BY url ORDER BY length(suffix) DESC) AS place
  FROM named JOIN {_RULES} ON (name = suffix OR ends_with(name, '.' || suffix))
), longest AS (SELECT url, n FROM hits WHERE place = 1)
SELECT named.url, CASE
    WHEN NOT regexp_matches(name, '{_DOMAIN}') THEN host
    WHEN n IS NULL THEN labels[len(labels)]
    WHEN n >= len(labels) THEN name
    ELSE labels[len(labels) - n] END AS tpd
FROM named LEFT JOIN longest ON named.url = longest.url
"""


_ANNOTATIONS = f"""
WITH quads AS ({_QUADS}), domains AS ({_domains("quads")})
SELECT subject, predicate, obj, quads.url, tpd, extractor
FROM quads JOIN domains ON quads.url = domains.url
UNION ALL
SELECT 'match_error', '', '', '', '', '' FROM {_over(inputs.QUAD_LINES)} WHERE {_FAILED}
"""


def _clean(text: str) -> str:
    return rf"lower(trim(regexp_replace({text}, '\W+', ' ', 'g')))"


def _title(link: str) -> str:
    """After the last prefix: what comes in front of the first one in the mirrored text."""
    mirrored = f"split_part(reverse({link}), reverse('wikipedia.org/wiki/'), 1)"
    return f"CASE WHEN contains({link}, 'wikipedia.org/wiki/') THEN reverse({mirrored}) END"


_WIKI = (
    r"""(?is)<a[^>]* href=["'']?((?:http|//|https)[^"''>]{0,20}(?:\.m.)?wikipedia\."""
    r"""[^"''>]{0,5}/w(?:iki)?/[^"''>]+)["'']?[^>]*>(.+?)</a>"""
)
_WIKI_LINKS = f"""
SELECT url AS page, lower(trim(translate(unnest(regexp_extract_all(content, '{_WIKI}', 2)),
    chr(10) || chr(13) || chr(9), '   '))) AS href,
  translate(unnest(regexp_extract_all(content, '{_WIKI}', 1)),
    chr(10) || chr(13) || chr(9), '   ') AS link
FROM {_over(inputs.LINKED_PAGES)}
"""

# Another way to the paragraphs: take comments, scripts, styles and titles out, then cut at
# paragraph starts and again at what ends a paragraph.
_BLOCKS = (
    "address|article|aside|blockquote|body|center|dd|details|dir|div|dl|dt|fieldset|figcaption|"
    "figure|footer|form|h1|h2|h3|h4|h5|h6|header|hgroup|hr|html|li|listing|main|menu|nav|ol|p|"
    "plaintext|pre|section|summary|table|tbody|td|tfoot|th|thead|tr|ul"
)
_PARAGRAPHS = rf"""
SELECT page, trim(regexp_replace(
    regexp_replace(piece, '(?is)</?(?:{_BLOCKS})(?:[\s/][^>]*)?>.*$', ''), '\s+', ' ', 'g'))
    AS paragraph
FROM (
  SELECT url AS page, unnest(string_split(regexp_replace(
      regexp_replace(content,
        '(?is)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<title>.*?</title>',
        '', 'g'),
      '(?i)<p(?:\s[^>]*)?>', chr(1), 'g'), chr(1))[2:]) AS piece
  FROM {_over(inputs.LINKED_PAGES)}
) pieces
"""
_LINK_PARAGRAPHS = f"""
SELECT l.page, href, link, paragraph FROM ({_WIKI_LINKS}) l JOIN ({_PARAGRAPHS}) p
ON l.page = p.page AND contains(lower(paragraph), href)
"""

_TWEET = r"""(?is)https?://(?:www\.)?twitter.com/([^\s"''#]*)"""
_TWEETS = f"""
SELECT url AS page, unnest(regexp_extract_all(content, '{_TWEET}', 0)) AS url,
  unnest(regexp_extract_all(content, '{_TWEET}', 1)) AS query
FROM {_over(inputs.LINKED_PAGES)}
"""

# --- the knowledge base, as common table expressions --------------------------------------
_SHOP = f"""
pages_ AS ({for_duckdb(inputs.SHOP_PAGES)}),
annotations_ AS ({for_duckdb(inputs.SHOP_ANNOTATIONS)}),
links_ AS ({for_duckdb(inputs.SHOP_LINKS)}),
dictionary_ AS ({for_duckdb(inputs.SHOP_DICTIONARY)}),
titles_ AS (
  SELECT DISTINCT url, {_title('"wikiLink"')} AS title FROM links_
  WHERE contains("wikiLink", 'wikipedia.org/wiki/')
),
mentions_ AS (
  SELECT url, {_clean("mention")} AS mention, min(titles_.title) AS title
  FROM titles_ JOIN dictionary_ ON titles_.title = dictionary_.title GROUP BY 1, 2
),
names_ AS (
  SELECT url, subject, {_clean("obj")} AS mention FROM annotations_
  WHERE regexp_full_match(lower(predicate), '<http://schema.org(/[^/]+)?/name>')
),
mappings_ AS (
  SELECT p.url AS "pageUrl", subject AS "localEntityUri", title AS "dbPediaUri"
  FROM pages_ p JOIN names_ n ON p.url = n.url
  JOIN mentions_ m ON m.url = n.url AND m.mention = n.mention
),
subjects_ AS (
  SELECT "pageUrl" AS "triplePageUrl", "dbPediaUri" AS subject, url, predicate, obj
  FROM mappings_ JOIN annotations_ ON "pageUrl" = url AND "localEntityUri" = subject
)
"""
_KNOWLEDGE_BASE = f"""
WITH {_SHOP}
SELECT "triplePageUrl", subject, url, predicate, coalesce("dbPediaUri", obj) AS obj
FROM mappings_ RIGHT JOIN subjects_ ON "pageUrl" = "triplePageUrl" AND "localEntityUri" = obj
"""
_BY_TITLE = f"""
WITH {_SHOP}, worded AS (
  SELECT url, {_clean("replace(title, '_', ' ')")} AS mention, min(title) AS title
  FROM titles_ GROUP BY 1, 2
)
SELECT p.url AS "pageUrl", subject AS "localEntityUri", w.title AS "dbPediaUri"
FROM pages_ p JOIN annotations_ a ON p.url = a.url AND ends_with(predicate, '/name>')
JOIN worded w ON w.url = a.url AND w.mention = {_clean("obj")}
"""


def _parts(table: str, fields: str) -> str:
    """Lines of three items each, with a number, by page."""
    line = f"concat_ws(chr(9), {fields}, cast(copies as string))"
    return f"""
SELECT url, part, string_agg(line, chr(10) ORDER BY line) AS lines FROM (
  SELECT url, {line} AS line,
    (row_number() OVER (PARTITION BY url ORDER BY {fields}) - 1) // 3 AS part
  FROM (SELECT url, {fields}, count(*) AS copies FROM {table} GROUP BY ALL) items
) numbered GROUP BY url, part
"""


_TRIPLE_PARTS = _parts("annotations_", "subject, predicate, obj")
_LINK_PARTS = _parts("links_", '"wikiLink"')
_URL_PAGES = f"""
SELECT url AS page FROM pages UNION ALL
SELECT coalesce(page, '') AS page FROM {_over(inputs.EDGE_URLS)}
"""
_EDGE_HOSTS = f"""
SELECT event_id, page, {_hostname("page")} AS hostname FROM {_over(inputs.EDGE_URLS)}
"""
_PAGES = f"SELECT url, content FROM {_over(inputs.LINKED_PAGES)}"
_LINKS = f"""SELECT url, "anchorText", "wikiLink" FROM {_over(inputs.SHOP_LINKS)}"""

ORACLES: dict[str, str] = {
    "hostname_pages": f"""
        SELECT page_id, url AS page, {_hostname("url")} AS hostname FROM pages""",
    "hostname_edge": _EDGE_HOSTS,
    "hostname_counts": f"""
        SELECT hostname, count(*) AS n_pages FROM ({_EDGE_HOSTS}) h GROUP BY hostname""",
    "feed_attrs": _FEEDS,
    "nquads_parse": _QUADS,
    "nquads_errors": f"""
        SELECT {_FAILED} AS failed, count(*) AS n_lines FROM {_over(inputs.QUAD_LINES)}
        GROUP BY 1""",
    "annotation_quads": _ANNOTATIONS,
    "top_private_domain_label": f"""
        WITH urls AS ({for_duckdb(inputs.HOST_URLS)}), domains AS ({_domains("urls")})
        SELECT urls.url, tpd FROM urls JOIN domains ON urls.url = domains.url""",
    "cleaned_names": f"""
        SELECT name, {_clean("name")} AS cleaned FROM {_over(inputs.NAMES)}""",
    "name_annotations": f"""
        SELECT subject, predicate, obj, url FROM ({_QUADS}) q
        WHERE regexp_full_match(lower(predicate), '<http://schema.org(/[^/]+)?/name>')""",
    "wiki_titles": f"""
        SELECT url, "wikiLink", {_title('"wikiLink"')} AS title
        FROM {_over(inputs.SHOP_LINKS)}""",
    "pages_nonempty": f"""
        SELECT page_id, url, length(content) AS n_chars FROM {_over(inputs.SPARSE_PAGES)}
        WHERE content <> '' AND url <> ''""",
    "wiki_page_links": _WIKI_LINKS,
    "page_paragraphs": _PARAGRAPHS,
    "wiki_link_paragraphs": _LINK_PARAGRAPHS,
    "tweet_links": _TWEETS,
    "triples_by_page": f"WITH {_SHOP} {_TRIPLE_PARTS}",
    "wikilinks_by_page": f"WITH {_SHOP} {_LINK_PARTS}",
    "pages_with_lists": f"""
        WITH {_SHOP}, t AS ({_TRIPLE_PARTS}), l AS ({_LINK_PARTS}),
        k AS (SELECT url, part FROM t UNION SELECT url, part FROM l)
        SELECT p.url, CASE WHEN k.part = 0 THEN content END AS content, k.part,
          coalesce(t.lines, '') AS triples, coalesce(l.lines, '') AS links
        FROM pages_ p JOIN k ON p.url = k.url
        LEFT JOIN t ON t.url = k.url AND t.part = k.part
        LEFT JOIN l ON l.url = k.url AND l.part = k.part
        WHERE p.url IN (SELECT url FROM t) AND p.url IN (SELECT url FROM l)""",
    "pages_triples_links": f"""
        WITH {_SHOP}
        SELECT p.url, content, n_triples, n_wikilinks FROM pages_ p
        JOIN (SELECT url, count(*) AS n_triples FROM annotations_ GROUP BY url) t
          ON p.url = t.url
        JOIN (SELECT url, count(*) AS n_wikilinks FROM links_ GROUP BY url) l
          ON p.url = l.url""",
    "page_wiki_titles": f"WITH {_SHOP} SELECT url, title FROM titles_",
    "page_mentions": f"WITH {_SHOP} SELECT url, mention, title FROM mentions_",
    "instance_match": f"""
        WITH {_SHOP} SELECT "pageUrl", "localEntityUri", "dbPediaUri" FROM mappings_""",
    "custom_strategy": _BY_TITLE,
    "custom_strategy_tables": _BY_TITLE,
    "subject_substitution": f"""
        WITH {_SHOP} SELECT "triplePageUrl", subject, url, predicate, obj FROM subjects_""",
    "object_substitution": _KNOWLEDGE_BASE,
    "src_feeds_csv": f"""
        SELECT page, replace(tag, chr(10), ' ') AS tag, type FROM {_over(inputs.FEED_TAGS)}""",
    "src_urls_csv": _URL_PAGES,
    "src_text_lines": f"SELECT value FROM {_over(inputs.QUAD_LINES)}",
    "src_pages_json": _PAGES,
    "src_pages_json_inferred": _PAGES,
    "src_pages_json_drifting": f"""
        SELECT url, content,
          CASE length(url) % 3 WHEN 0 THEN 'BIGINT' WHEN 1 THEN 'STRING' END AS kind,
          CASE length(url) % 3 WHEN 0 THEN cast(length(content) AS varchar)
            WHEN 1 THEN substr(url, 1, 12) END AS mark
        FROM {_over(inputs.LINKED_PAGES)}""",
    "src_pages_jsonl": _PAGES,
    "src_wiki_tsv": _LINKS,
    "compact_parquet": _FEEDS,
    "job_feeds": _FEEDS_ONE_LINE,
    "job_urls": f"SELECT page, {_hostname('page')} AS hostname FROM ({_URL_PAGES}) u",
    "job_anchors": _EDGE_HOSTS,
    "job_raw_pages": _PAGES,
    "job_quads": _ANNOTATIONS,
    "job_wiki_links": _LINKS,
    "job_wiki_paragraphs": _LINK_PARAGRAPHS,
    "job_tweet_links": _TWEETS,
    "job_knowledge_base": _KNOWLEDGE_BASE,
    "sink_overwrite": _URL_PAGES,
}

# The same results in another way.
for _name, _of in {
    "src_text_lines_members": "src_text_lines",
    "job_quads_members": "job_quads",
    "feed_attrs_sql": "feed_attrs",
    "cleaned_names_sql": "cleaned_names",
    "name_annotations_sql": "name_annotations",
    "wiki_titles_sql": "wiki_titles",
    "pages_triples_links_by_page": "pages_triples_links",
    "job_knowledge_base_by_page": "job_knowledge_base",
}.items():
    ORACLES[_name] = ORACLES[_of]
