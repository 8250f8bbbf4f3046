"""URL, percent-encoding and path functions, all as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kartotek.functions.text import bind, strip

SUBJECT_PREFIX = "kolada:operating_area:"

# Characters left alone in each URL part besides letters, digits and "_.-~".
_SAFE_PATH = "/%:@!$&'()*+,;="
_SAFE_QUERY = "%=&/?@:!$'()*+,;"
_SAFE_FRAGMENT = "%/?@:!$&'()*+,;="
_CLEAN = (
    r"^[a-z][a-z0-9+.\-]*://[A-Za-z0-9_.\-~%/:@!$&'()*+,;=]+"
    r"(?:\?[A-Za-z0-9_.\-~%/:@!$&'()*+,;=?]+)?(?:#[A-Za-z0-9_.\-~%/:@!$&'()*+,;=?]+)?$"
)
_SPLIT = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def pct_encode(c: Column) -> Column:
    """Percent-encode everything except letters, digits and ``_.-~``."""
    out = F.url_encode(c)
    for found, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        out = F.replace(out, F.lit(found), F.lit(wanted))
    return out


def pct_decode(c: Column) -> Column:
    """Decode ``%xx``; a plus sign and a stray per cent sign stay as they are."""
    guarded = F.regexp_replace(
        F.replace(c, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25"
    )
    return F.url_decode(guarded)


def encode_segment(c: Column) -> Column:
    """Encode one path segment without encoding it twice."""
    return pct_encode(pct_decode(c))


def subject_code(label: Column) -> Column:
    return F.when(label.isNotNull(), F.concat(F.lit(SUBJECT_PREFIX), pct_encode(label)))


def url_scheme(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, _SPLIT, 1))


def url_authority(c: Column) -> Column:
    return F.regexp_extract(c, _SPLIT, 2)


def url_path(c: Column) -> Column:
    return F.regexp_extract(c, _SPLIT, 3)


def url_query(c: Column) -> Column:
    return F.regexp_extract(c, _SPLIT, 4)


def url_fragment(c: Column) -> Column:
    return F.regexp_extract(c, _SPLIT, 5)


def url_host(c: Column) -> Column:
    """Lower-cased host without user and port."""
    bare = F.regexp_replace(url_authority(c), "^[^@]*@", "")
    return F.lower(F.regexp_replace(bare, r":\d*$", ""))


def _unsplit(scheme: Column, authority: Column, path: Column, query: Column, frag: Column) -> Column:
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        F.when(authority != "", F.concat(F.lit("//"), authority)).otherwise(""),
        path,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
        F.when(frag != "", F.concat(F.lit("#"), frag)).otherwise(""),
    )


def _quote_keeping(c: Column, safe: str) -> Column:
    out = pct_encode(c)
    for ch in sorted(safe.replace("%", "")):
        out = F.replace(out, F.lit(f"%{ord(ch):02X}"), F.lit(ch))
    return F.replace(out, F.lit("%25"), F.lit("%")) if "%" in safe else out


def encoded_url(c: Column) -> Column:
    """Encode path, query and fragment; escapes and reserved characters are kept. Most
    addresses need no change, and one pattern finds that out."""

    def rebuilt(p: Column) -> Column:
        return _unsplit(
            F.lower(p[0]),
            p[1],
            _quote_keeping(p[2], _SAFE_PATH),
            _quote_keeping(p[3], _SAFE_QUERY),
            _quote_keeping(p[4], _SAFE_FRAGMENT),
        )

    parts = F.split(F.regexp_replace(c, _SPLIT, "$1\x01$2\x01$3\x01$4\x01$5"), "\x01")
    return F.when(c.rlike(_CLEAN), c).otherwise(bind(parts, rebuilt))


def url_root(c: Column) -> Column:
    """Scheme, authority and path without the closing slash."""
    empty = F.lit("")
    return _unsplit(
        url_scheme(c), url_authority(c), F.regexp_replace(url_path(c), "/+$", ""), empty, empty
    )


def _resolve_dots(path: Column) -> Column:
    parts = F.split(path, "/")
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1))))
        .when(x == ".", acc)
        .otherwise(F.concat(acc, F.array(x))),
    )
    closing = F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")
    return F.when(
        F.exists(parts, lambda x: x.isin(".", "..")), F.concat(F.array_join(kept, "/"), closing)
    ).otherwise(path)


def url_join(base: Column, link: Column) -> Column:
    """Resolve a link against its page: absolute, ``//host``, ``/path``, ``?query``,
    ``#part`` or relative."""
    path, authority = url_path(link), url_authority(link)
    folder = F.regexp_extract(url_path(base), r"^(.*/)[^/]*$", 1)
    merged = F.when(folder == "", F.concat(F.lit("/"), path)).otherwise(F.concat(folder, path))
    scheme, base_authority = url_scheme(base), url_authority(base)
    return (
        F.when(F.coalesce(link, F.lit("")) == "", base)
        .when(url_scheme(link) != "", link)
        .when(
            authority != "",
            _unsplit(scheme, authority, path, url_query(link), url_fragment(link)),
        )
        .when(
            path == "",
            _unsplit(
                scheme,
                base_authority,
                url_path(base),
                F.when(url_query(link) != "", url_query(link)).otherwise(url_query(base)),
                url_fragment(link),
            ),
        )
        .otherwise(
            _unsplit(
                scheme,
                base_authority,
                _resolve_dots(F.when(path.startswith("/"), path).otherwise(merged)),
                url_query(link),
                url_fragment(link),
            )
        )
    )


def within_root(url: Column, root: Column) -> Column:
    """Same scheme and authority, and below the root's path; case does not matter."""
    inside = F.lower(pct_decode(url_path(url))).startswith(
        F.concat(F.regexp_replace(F.lower(pct_decode(url_path(root))), "/+$", ""), F.lit("/"))
    )
    return (
        (url_scheme(url) == url_scheme(root))
        & (F.lower(url_authority(url)) == F.lower(url_authority(root)))
        & inside
    )


def _segments(url: Column) -> Column:
    return F.transform(F.filter(F.split(url_path(url), "/"), lambda x: x != ""), pct_decode)


def api_language(url: Column) -> Column:
    """Path segment after the first ``api/v1``."""
    parts = _segments(url)
    at = F.filter(
        F.sequence(F.lit(1), F.greatest(F.size(parts) - 2, F.lit(1))),
        lambda i: (F.lower(F.try_element_at(parts, i)) == "api")
        & (F.lower(F.try_element_at(parts, i + 1)) == "v1"),
    )
    return F.lower(F.try_element_at(parts, F.try_element_at(at, F.lit(1)) + 2))


def web_language(url: Column) -> Column:
    """Path segment after the last ``pxweb``."""
    parts = _segments(url)
    at = F.filter(
        F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
        lambda i: F.lower(F.try_element_at(parts, i)) == "pxweb",
    )
    return F.lower(F.try_element_at(parts, F.try_element_at(at, F.lit(-1)) + 1))


def path_tokens(path: Column) -> Column:
    """``"demo / pop /"`` -> ``[demo, pop]``; tokens are decoded and trimmed."""
    kept = F.filter(F.split(path, "/"), lambda x: strip(x) != "")
    return F.transform(kept, lambda x: strip(pct_decode(x)))


def path_string(tokens: Column) -> Column:
    return F.concat(F.lit("/"), F.array_join(tokens, "/"))


def path_depth(path: Column) -> Column:
    return F.size(F.filter(F.split(path, "/"), lambda x: x != ""))


def route(database: Column, tokens: Column) -> Column:
    """Web route ``db__a__b``."""
    return F.array_join(F.transform(F.concat(F.array(database), tokens), pct_encode), "__")


def ids_from_href(href: Column, depth: Column) -> Column:
    """Table id and the last ``depth`` category ids of a table link; NULL when the link
    holds fewer ids than that."""
    parts = _segments(href)
    tokens = F.flatten(
        F.transform(
            F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0))),
            lambda s: F.filter(F.split(s, "__"), lambda t: t != ""),
        )
    )
    categories = F.when(
        depth > 0, F.slice(tokens, F.greatest(F.size(tokens) - depth + 1, F.lit(1)), depth)
    ).otherwise(F.array().cast("array<string>"))
    return F.when(
        (F.size(parts) > 0) & (depth <= F.size(tokens)),
        F.struct(
            F.element_at(parts, -1).alias("table_id"),
            categories.alias("category_ids"),
        ),
    )


def table_api_url(root: Column, tokens: Column, table_id: Column) -> Column:
    segments = F.transform(F.concat(tokens, F.array(table_id)), pct_encode)
    return F.concat(url_root(root), F.lit("/"), F.array_join(segments, "/"))


def table_web_url(root: Column, tokens: Column, table_id: Column) -> Column:
    bare = url_root(root)
    database = pct_decode(F.element_at(F.split(url_path(bare), "/"), -1))
    return F.concat(
        bare, F.lit("/"), route(database, tokens), F.lit("/"), pct_encode(table_id), F.lit("/")
    )
