"""Host names out of addresses, without a URL parser that rejects odd input."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelore.fixed_values import AUTHORITY
from pagelore.functions.text import trim_controls

# Schemes with an authority part; user info is skipped, the port must be a number, and
# anything else does not match at all.
_URL_HOST = (
    r"(?i)\A(?:url:)?(?:https?|ftp|file)://(?:[^@/?#]*@)?"
    r"([^:@/?#\[][^:@/?#]*|\[[0-9a-f:.%]+\])(?::[0-9]*)?(?:[/?#]|\z)"
)


def hostname(page: Column) -> Column:
    """Lenient host of an address, its case kept; '' when there is none.

    Only one regular expression runs per row; the rest are plain byte searches.
    """
    authority = F.regexp_extract(page, AUTHORITY, 1)
    host = F.substring_index(F.substring_index(authority, "?", 1), "#", 1)
    return F.coalesce(F.substring_index(host, "@", -1), F.lit(""))


def url_host(url: Column) -> Column:
    """Strict host of a well-formed http, https, ftp or file URL; '' for anything else."""
    return F.coalesce(F.regexp_extract(trim_controls(url), _URL_HOST, 1), F.lit(""))
