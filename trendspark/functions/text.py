"""Text cleaning of scraped and polled values.

Whitespace means Unicode whitespace (``(?U)\\s``), as a Python ``split()`` or
``strip()`` would see it, not only the space that SQL ``trim`` removes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.constants import (EMPTY_PERCENT, EMPTY_TOKEN, NOT_FOUND, SIZE_TEMPLATE,
                                 UNPARSABLE_RANK)

_EDGES = r"(?U)^\s+|\s+$"
_RUN = r"(?U)\s+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """remove leading and trailing whitespace of any kind."""
    return F.regexp_replace(_c(c), _EDGES, "")


def _tokens(c) -> Column:
    # stripping first keeps split() from emitting empty edge tokens;
    # an empty string still splits into one empty token, handled by callers
    return F.split(strip_ws(c), _RUN)


def last_token(c, default: str = EMPTY_TOKEN) -> Column:
    """last whitespace-separated token, ``default`` when there is none.

    ``"2M\\n 2,013,570"`` -> ``"2,013,570"``; ``""`` or null -> ``"0"``.
    """
    tok = F.try_element_at(_tokens(c), F.lit(-1))
    return F.coalesce(F.nullif(tok, F.lit("")), F.lit(default))


def first_token(c, default: str = EMPTY_TOKEN) -> Column:
    """first whitespace-separated token (``"+41,200\\n +3.7 %"`` -> ``"+41,200"``)."""
    tok = F.try_element_at(_tokens(c), F.lit(1))
    return F.coalesce(F.nullif(tok, F.lit("")), F.lit(default))


def percent_token(c, default: str = EMPTY_PERCENT) -> Column:
    """F16: the percentage token.

    A lone trailing ``%`` is joined to the token before it
    (``"+95\\n +12.4\\n %"`` -> ``"+12.4%"``); else the first token that
    holds a ``%``; else the last token; ``default`` when there is no token.
    """
    parts = _tokens(c)
    n = F.size(parts)
    # first token holding a '%' (a regex, not a lambda: stays in codegen)
    with_pct = F.nullif(F.regexp_extract(strip_ws(c), r"(?U)(?:^|\s)([^\s%]*%\S*)", 1), F.lit(""))
    last = F.try_element_at(parts, F.lit(-1))
    joined = F.concat(F.try_element_at(parts, n - 1), F.lit("%"))
    out = (F.when((last == "%") & (n >= 2), joined)
           .when(with_pct.isNotNull(), with_pct)
           .otherwise(last))
    return F.coalesce(F.nullif(out, F.lit("")), F.lit(default))


def rank_score(c, unparsable: int = UNPARSABLE_RANK) -> Column:
    """rank text ``"#12"`` -> 12; anything that is not an integer -> 999."""
    stripped = F.replace(_c(c), F.lit("#"), F.lit(""))
    return F.coalesce(stripped.try_cast("int"), F.lit(unparsable))


def count_or_zero(c) -> Column:
    """count text -> bigint; a missing count is 0."""
    return F.coalesce(_c(c).try_cast("bigint"), F.lit(0).cast("bigint"))


def url_from_id(prefix: str, c) -> Column:
    """URL made of a fixed prefix and an id."""
    return F.concat(F.lit(prefix), _c(c).cast("string"))


def fill_size_template(c, size: str) -> Column:
    """literal (not regex) replacement of ``{width}x{height}``."""
    return F.replace(_c(c), F.lit(SIZE_TEMPLATE), F.lit(size))


def not_found(c, sentinel: str = NOT_FOUND) -> Column:
    """null -> sentinel text."""
    return F.coalesce(_c(c), F.lit(sentinel))


def absolute_url(href, base) -> Column:
    """resolve ``href`` against ``base`` for the common forms.

    absolute (``scheme:``) stays; ``//host/p`` takes the base scheme;
    ``/p`` takes the base origin; anything else is resolved against the
    base's directory. Dot segments and query-only references are not
    normalised.
    """
    h, b = _c(href), _c(base)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    base_dir = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^?#]*/)", 1)
    base_dir = F.when(base_dir == "", F.concat(origin, F.lit("/"))).otherwise(base_dir)
    return (F.when(h.isNull(), F.lit(None).cast("string"))
            .when(h.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), h)
            .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
            .when(h.startswith("/"), F.concat(origin, h))
            .otherwise(F.concat(base_dir, h)))
