"""Results depend on these being exactly as written.

Patterns are Java regular expressions, kept as plain text in one place.
"""

# --- fixed values: URL and tag patterns -----------------------------------------------
# First authority-like piece of an address: after the first "//" that is followed by
# something other than "/" or ":".
AUTHORITY = r"//([^/:]+)"

# Attribute value inside a tag; the last occurrence wins because the lead is greedy.
TAG_ATTRIBUTE = r"""\A.*{name}=["']?([^'"]*)["']?.*\z"""

# --- fixed values: quads and names ----------------------------------------------------
# subject predicate object <page> <extractor> .
QUAD = r"\A(\S+)\s+(\S+)\s+(.+)\s+<([^>]+)>\s+(<[^>]+>)\s+\.\z"
QUAD_ERROR_SUBJECT = "match_error"

NAME_PREDICATE = r"\A<http://schema.org(/[^/]+)?/name>\z"
NON_WORD = r"\W+"
WIKI_PREFIX = "wikipedia.org/wiki/"

# --- fixed values: links inside page markup -------------------------------------------
# Group 1 is the link, group 2 the anchor markup.
WIKI_LINK = (
    r"""(?is)<a[^>]* href=["']?((?:http|//|https)[^"'>]{0,20}(?:\.m.)?wikipedia\."""
    r"""[^"'>]{0,5}/w(?:iki)?/[^"'>]+)["']?[^>]*>(.+?)</a>"""
)
# Group 2 is everything after the host, up to white space, a quote or "#".
TWEET_LINK = r"""(?is)https?://(www\.)?twitter.com/([^\s"'#]*)"""

# --- fixed values: markup that hides or ends a paragraph ------------------------------
# Elements whose content is plain text for an HTML reader.
RAW_TEXT_ELEMENTS = (
    "script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes",
)
# Elements whose start or end tag ends an open paragraph.
PARAGRAPH_ENDERS = (
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dir",
    "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2",
    "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "listing", "main",
    "menu", "nav", "ol", "plaintext", "pre", "section", "summary", "table", "tbody", "td",
    "tfoot", "th", "thead", "tr", "ul",
)
