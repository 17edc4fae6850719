"""Pieces of SQL that say the same as the column functions, for the equivalent queries."""

from __future__ import annotations

from raqim.functions import admission, text, urls

WS = text.SPACE


def q(s: str) -> str:
    """A string literal."""
    return "'" + s.replace("'", "''") + "'"


def sub(c: str, pattern: str, to: str = "") -> str:
    return f"regexp_replace({c}, {q(pattern)}, {q(to)}, 'g')"


def trim(c: str) -> str:
    return sub(c, f"^{WS}+|{WS}+$")


def collapse(c: str, most: int = 0) -> str:
    out = trim(sub(f"coalesce({c}, '')", f"{WS}+", " "))
    return f"substr({out}, 1, {most})" if most else out


def tidy(c: str) -> str:
    out = sub(f"replace(coalesce({c}, ''), chr(160), ' ')", r"[ \t]+", " ")
    return trim(sub(out, f"{WS}*\\n{WS}*", "\n"))


def strip_tags(c: str) -> str:
    return tidy(sub(f"replace(coalesce({c}, ''), chr(160), ' ')", "<[^>]*>", " "))


def searchable(c: str) -> str:
    out = sub(f"lower(coalesce({c}, ''))", text.DIACRITICS)
    out = f"translate({out}, 'أإآٱةۀىئؤ', 'ااااههييو')"
    return collapse(sub(out, r"[^\x{0600}-\x{06FF}a-z0-9\t\n\x0B\f\r \x{A0}\x{2000}-\x{200A}\x{202F}\x{3000}]", " "))


def url_parts(source: str, url: str, columns: str) -> str:
    """CTEs ending in ``parts`` with the columns and scheme, host, bare, port, path, query, asked of the address."""
    return f"""
    raw AS (SELECT {columns}, {trim(f"coalesce({url}, '')")} AS u FROM {source}),
    cut AS (SELECT *, lower(regexp_extract(u, {q(urls.SCHEME)}, 1)) AS scheme, regexp_extract(u, {q(urls.AUTHORITY)}, 1) AS auth, regexp_extract(u, {q(urls.PATH)}, 1) AS p0, regexp_extract(u, {q(urls.QUERY)}, 1) AS query, regexp_matches(u, '^[^#?]*\\?') AS asked FROM raw),
    named AS (SELECT *, lower(regexp_extract(auth, {q(urls.HOST)}, 1)) AS host, regexp_extract(auth, {q(urls.PORT)}, 1) AS port0, CASE WHEN p0 = '' THEN '/' ELSE p0 END AS path FROM cut),
    parts AS (SELECT * EXCLUDE (auth, p0, port0), regexp_replace(host, '^www\\.', '') AS bare, CASE WHEN (scheme = 'https' AND port0 = '443') OR (scheme = 'http' AND port0 = '80') THEN '' ELSE port0 END AS port FROM named)"""


INDEX_PATH = f"coalesce(nullif(CASE WHEN length(regexp_replace(path, {q(urls.INDEX)}, '/')) > 1 THEN regexp_replace(regexp_replace(path, {q(urls.INDEX)}, '/'), '/+$', '') ELSE regexp_replace(path, {q(urls.INDEX)}, '/') END, ''), '/')"
AT = "CASE WHEN port = '' THEN '' ELSE ':' || port END"
WEB = "(scheme IN ('http', 'https') AND host <> '' AND NOT regexp_matches(host, '[\\s<>\\[\\]^|%]'))"


def kept_query(drop: str | None, ordered: bool) -> str:
    items = "list_filter(string_split(query, '&'), lambda x: x <> ''" + (f" AND NOT regexp_matches(regexp_replace(x, '=.*$', ''), {q(drop)})" if drop else "") + ")"
    items = f"list_transform({items}, lambda x: CASE WHEN contains(x, '=') THEN x ELSE x || '=' END)"
    return f"array_to_string({'list_sort(' + items + ')' if ordered else items}, '&')"


def built(host: str, path: str, query: str) -> str:
    return f"scheme || '://' || {host} || {AT} || {path} || CASE WHEN {query} = '' THEN '' ELSE '?' || {query} END"


def canonical_crawl() -> str:
    tracks = f"list_has_any(list_transform(string_split(query, '&'), lambda x: regexp_matches(x, {q(urls.TRACKING_PREFIX)})), [true])"
    query = f"(CASE WHEN query = '' THEN '' WHEN {tracks} THEN {kept_query(urls.TRACKING_PREFIX, False)} ELSE query END)"
    return f"CASE WHEN scheme <> '' AND host <> '' THEN {built('bare', INDEX_PATH, query)} ELSE '' END"


def canonical_discovery() -> str:
    return f"CASE WHEN {WEB} THEN {built('bare', INDEX_PATH, kept_query(urls.TRACKING_KEY, True))} ELSE '' END"


def canonical_seed() -> str:
    path = f"(CASE WHEN bare = 'quran.com' AND {INDEX_PATH} = '/' THEN '/ar' ELSE {INDEX_PATH} END)"
    return f"CASE WHEN {WEB} THEN {built('bare', path, kept_query(urls.TRACKING_PREFIX, True))} ELSE '' END"


def sitemap_form() -> str:
    return f"CASE WHEN {WEB} THEN {built('bare', 'path', kept_query(None, True))} ELSE '' END"


def reason(path: str = "lower(path)", first: str = "split_part(path, '/', 2)") -> str:
    """The admission cascade over parts of the canonical URL, with site_bare and site_port of the site."""
    like = lambda c, p: f"regexp_matches({c}, {q(p)})"
    language = " OR ".join(f"(regexp_extract(query, '(?:^|&){k}=([^&]*)', 1) <> '' AND NOT regexp_matches(regexp_extract(query, '(?:^|&){k}=([^&]*)', 1), {q(admission.ARABIC_VALUE)}))" for k in ("lang", "locale", "language"))
    suffix = f"len(list_filter(string_split(path, '/'), lambda x: regexp_matches(x, {q(admission.SUFFIX)}))) > 0"
    return f"""CASE WHEN u = '' OR site_bare = '' OR scheme = '' THEN 'invalid_url' WHEN scheme NOT IN ('http', 'https') THEN 'unsupported_scheme'
      WHEN bare <> site_bare THEN 'external_host' WHEN port <> site_port THEN 'different_port' WHEN {path} = '/robots.txt' THEN 'robots_file'
      WHEN {like(path, admission.ASSET)} THEN 'asset_file' WHEN {like(path, admission.ADMIN)} THEN 'administrative_or_feed_path' WHEN {like(path, admission.INFORMATION)} THEN 'noncontent_information_path'
      WHEN {like(path, admission.SITEMAP)} THEN 'sitemap_or_feed_path' WHEN {like(path, admission.SEARCH)} THEN 'search_results_path' WHEN {like(first, admission.PREFIX)} THEN 'non_arabic_language'
      WHEN {suffix} THEN 'non_arabic_language_suffix' WHEN {language} THEN 'non_arabic_language_parameter' END"""
