"""URLs as column expressions, after the WHATWG rules as far as crawl tables need them.

Covered natively: scheme and host in lower case, user info and fragment dropped, default ports, dot segments, percent
encoding of spaces and non-ASCII characters in paths, form encoding of queries.  Host names outside ASCII stay as they are
in lower case.  An invalid or null URL gives the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from raqim.functions.text import trim

SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#\\]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#\\]*([^?#]*)"
QUERY = r"^[^?#]*\?([^#]*)"
HOST = r"^(?:.*@)?([^:@]*)(?::\d*)?$"
PORT = r":(\d+)$"
INDEX = r"(?i)/index\.(?:html?|php)$"
#: Query parameters that track, as a prefix (crawler) and as the whole key (discovery).
TRACKING_PREFIX = r"(?i)^(?:utm_|fbclid|gclid)"
TRACKING_KEY = r"(?i)^(?:utm_.+|fbclid|gclid|dclid|msclkid|yclid|igshid|_ga|_gl|mc_cid|mc_eid|_hsenc|_hsmi|vero_id|oly_anon_id)$"
#: Hosts of social networks.
SOCIAL = ("facebook.com", "fb.com", "youtube.com", "youtu.be", "x.com", "twitter.com", "instagram.com", "tiktok.com", "linkedin.com", "telegram.me", "t.me")
#: Codes of a path that only names a language.
LANGUAGE_ONLY = r"(?i)^/(?:ar|en|fr|de|es|it|ru|zh)/?$"
#: Characters that a path keeps though form encoding would escape them.
_KEPT = (("%2F", "/"), ("%3A", ":"), ("%40", "@"), ("%21", "!"), ("%24", "$"), ("%26", "&"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%2C", ","), ("%3B", ";"), ("%3D", "="), ("%7E", "~"), ("%7C", "|"), ("%5B", "["), ("%5D", "]"), ("%5E", "^"), ("%2B", "+"), ("%25", "%"))


def let(value: Column, f) -> Column:
    """``f(value)`` with the value computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def encode_path(p: Column) -> Column:
    """Spaces, quotes and non-ASCII characters percent-encoded; what is encoded stays."""
    encoded = F.replace(F.url_encode(p), F.lit("+"), F.lit("%20"))
    for code, char in _KEPT:
        encoded = F.replace(encoded, F.lit(code), F.lit(char))
    return F.when(F.rlike(p, F.lit(r'[^\x21-\x7E]|["<>`{}]')), encoded).otherwise(p)


def resolve_dots(p: Column) -> Column:
    """The path without ``.`` and ``..`` segments."""
    empty = F.array().cast("array<string>")
    step = lambda acc, x: F.when(x == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc)).when(x == ".", acc).otherwise(F.concat(acc, F.array(x)))
    kept = F.aggregate(F.split(p, "/"), empty, step)
    end = F.when(F.rlike(p, F.lit(r"(^|/)\.\.?$")), "/").otherwise("")
    return F.when(F.rlike(p, F.lit(r"(^|/)\.\.?(/|$)")), F.regexp_replace(F.concat(F.array_join(kept, "/"), end), "^/?/+|/+$", "/")).otherwise(p)


def parts(raw: Column) -> Column:
    """struct(scheme, host, bare, port, path, query, asked): host in lower case, bare without ``www.``, the scheme's own port as '',
    ``asked`` whether there is a question mark.  All are '' where the address has no scheme."""

    def read(u: Column) -> Column:
        name = F.lower(F.regexp_extract(u, SCHEME, 1))
        authority = F.regexp_extract(u, AUTHORITY, 1)
        return let(F.struct(name.alias("scheme"), F.lower(F.regexp_extract(authority, HOST, 1)).alias("host"), F.regexp_extract(authority, PORT, 1).alias("port"), F.replace(F.regexp_extract(u, PATH, 1), F.lit("\\"), F.lit("/")).alias("path"), F.regexp_extract(u, QUERY, 1).alias("query"), F.rlike(u, F.lit(r"^[^#?]*\?")).alias("asked")), finish)

    def finish(p: Column) -> Column:
        own = ((p["scheme"] == "https") & (p["port"] == "443")) | ((p["scheme"] == "http") & (p["port"] == "80"))
        path_ = let(resolve_dots(F.when(p["path"] == "", "/").otherwise(p["path"])), encode_path)
        return F.struct(p["scheme"].alias("scheme"), p["host"].alias("host"), F.regexp_replace(p["host"], r"^www\.", "").alias("bare"), F.when(own, "").otherwise(p["port"]).alias("port"), path_.alias("path"), p["query"].alias("query"), p["asked"].alias("asked"))

    return let(trim(F.coalesce(raw, F.lit(""))), read)


def scheme(u: Column) -> Column:
    return parts(u)["scheme"]


def host(u: Column) -> Column:
    """Lower case, with ``www.`` if there."""
    return parts(u)["host"]


def bare_host(u: Column) -> Column:
    """The host without a leading ``www.``."""
    return parts(u)["bare"]


def _pairs(q: Column) -> Column:
    """(key, position, value) of each parameter, decoded as a form."""
    decode = lambda x: F.coalesce(F.try_url_decode(x), x)
    pair = lambda x, i: F.struct(decode(F.substring_index(x, "=", 1)).alias("key"), i.alias("at"), F.when(F.instr(x, "=") > 0, decode(F.substr(x, F.instr(x, "=") + 1))).otherwise("").alias("value"))
    return F.transform(F.filter(F.split(q, "&"), lambda x: x != ""), pair)


def _form(pairs: Column) -> Column:
    return F.array_join(F.transform(pairs, lambda p: F.concat(F.url_encode(p["key"]), F.lit("="), F.url_encode(p["value"]))), "&")


def sorted_query(q: Column, drop: str | None = None) -> Column:
    """Parameters without the dropped keys, sorted by key (equal keys in their order), form-encoded."""
    pairs = _pairs(q)
    if drop:
        pairs = F.filter(pairs, lambda p: ~F.rlike(p["key"], F.lit(drop)))
    return F.when(q == "", "").otherwise(_form(F.array_sort(pairs)))


def _index_path(p: Column) -> Column:
    short = let(F.regexp_replace(p, INDEX, "/"), lambda x: F.when(F.length(x) > 1, F.regexp_replace(x, "/+$", "")).otherwise(x))
    return F.coalesce(F.nullif(short, F.lit("")), F.lit("/"))


def _built(p: Column, host_: Column, path_: Column, q: Column) -> Column:
    at = F.when(p["port"] == "", "").otherwise(F.concat(F.lit(":"), p["port"]))
    return F.concat(p["scheme"], F.lit("://"), host_, at, path_, let(q, lambda x: F.when(x == "", "").otherwise(F.concat(F.lit("?"), x))))


def _web(p: Column) -> Column:
    return p["scheme"].isin("http", "https") & (p["host"] != "") & ~F.rlike(p["host"], F.lit(r"[\s<>\[\]^|%]"))


def canonical_crawl(raw: Column) -> Column:
    """The crawler's form: parameters stay as they are unless one tracks."""

    def build(p: Column) -> Column:
        tracks = F.exists(_pairs(p["query"]), lambda x: F.rlike(x["key"], F.lit(TRACKING_PREFIX)))
        kept = _form(F.filter(_pairs(p["query"]), lambda x: ~F.rlike(x["key"], F.lit(TRACKING_PREFIX))))
        q = F.when(p["query"] == "", "").when(tracks, kept).otherwise(p["query"])
        return F.when((p["scheme"] != "") & (p["host"] != ""), _built(p, p["bare"], _index_path(p["path"]), q)).otherwise("")

    return let(parts(raw), build)


def canonical_discovery(raw: Column) -> Column:
    """The discovery form: web schemes only, fifteen tracking keys dropped, parameters sorted."""
    return let(parts(raw), lambda p: F.when(_web(p), _built(p, p["bare"], _index_path(p["path"]), sorted_query(p["query"], TRACKING_KEY))).otherwise(""))


def canonical_seed(raw: Column, arabic_first: tuple[str, ...] = ("quran.com",)) -> Column:
    """The seed form: as discovery, dropping by prefix; the root of an Arabic-first host leads to its Arabic pages."""

    def build(p: Column) -> Column:
        own = _index_path(p["path"])
        routed = let(own, lambda x: F.when(p["bare"].isin(*arabic_first) & (x == "/"), "/ar").otherwise(x)) if arabic_first else own
        return F.when(_web(p), _built(p, p["bare"], routed, sorted_query(p["query"], TRACKING_PREFIX))).otherwise("")

    return let(parts(raw), build)


def sitemap_form(raw: Column) -> Column:
    """A sitemap's address: path and tracking parameters stay, parameters are sorted."""
    return let(parts(raw), lambda p: F.when(_web(p), _built(p, p["bare"], p["path"], sorted_query(p["query"]))).otherwise(""))


def same_host(a: Column, b: Column) -> Column:
    """Hosts without ``www.`` and explicit ports agree; the scheme doesn't matter."""
    return let(F.struct(parts(a).alias("a"), parts(b).alias("b")), lambda x: (x["a"]["bare"] == x["b"]["bare"]) & (x["a"]["port"] == x["b"]["port"]) & (x["a"]["bare"] != ""))


def sitemap_url(raw: Column, site: Column, any_path: bool = False) -> Column:
    """The sitemap's address if it lies on the site and looks like a sitemap (or ``any_path``), else ''."""

    def judge(u: Column) -> Column:
        looks = F.lit(True) if any_path else F.rlike(F.regexp_replace(F.lower(u), r"[?#].*$", ""), F.lit(r"(?:sitemap|\.xml)(?:\.gz)?$"))
        return F.when((u != "") & same_host(u, site) & looks, u).otherwise("")

    return let(sitemap_form(raw), judge)


def resolve(raw: Column, base: Column) -> Column:
    """A reference against the address of its page; '' where either is empty."""

    def join(x: Column) -> Column:
        r, b = x["r"], x["b"]
        root = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#\\]*)", 1)
        folder = F.coalesce(F.nullif(F.regexp_replace(F.regexp_extract(b, PATH, 1), r"[^/]*$", ""), F.lit("")), F.lit("/"))
        joined = (
            F.when(F.rlike(r, F.lit(SCHEME)), r).when(F.startswith(r, F.lit("//")), F.concat(F.regexp_extract(b, SCHEME, 1), F.lit(":"), r)).when(F.startswith(r, F.lit("/")), F.concat(root, r))
            .when(F.startswith(r, F.lit("?")), F.concat(F.regexp_replace(b, "[?#].*$", ""), r)).when(F.startswith(r, F.lit("#")), F.concat(F.regexp_replace(b, "#.*$", ""), r)).otherwise(F.concat(root, folder, r))
        )
        return F.when((r == "") | (b == ""), b).otherwise(let(joined, normal))

    def normal(u: Column) -> Column:
        path_ = let(F.replace(F.regexp_extract(u, PATH, 1), F.lit("\\"), F.lit("/")), lambda p: encode_path(resolve_dots(F.when(p == "", "/").otherwise(p))))
        front = F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#\\]*)", 1)
        return F.when(front != "", F.concat(front, path_, F.regexp_extract(u, r"^[^?#]*(.*)$", 1))).otherwise(u)

    ok = raw.isNotNull() & base.isNotNull()
    return F.when(ok, let(F.struct(trim(F.coalesce(raw, F.lit(""))).alias("r"), trim(F.coalesce(base, F.lit(""))).alias("b")), join)).otherwise("")


def _assumed(r: Column) -> Column:
    """A trimmed address, with https where it names no scheme."""
    return F.when(F.rlike(r, F.lit(r"(?i)^[a-z][a-z\d+.\-]*://")), r).otherwise(F.concat(F.lit("https://"), r))


def site_domain(raw: Column) -> Column:
    """Host in lower case without ``www.``; https is assumed where no scheme is given."""
    return let(trim(F.coalesce(raw, F.lit(""))), lambda r: F.when(r == "", "").otherwise(parts(_assumed(r))["bare"]))


def page_url(raw: Column) -> Column:
    """A page's address for the index: web schemes only, https assumed, no fragment; host, slashes and parameters stay."""

    def build(p: Column) -> Column:
        at = F.when(p["port"] == "", "").otherwise(F.concat(F.lit(":"), p["port"]))
        return F.when(_web(p), F.concat(p["scheme"], F.lit("://"), p["host"], at, p["path"], F.when(p["asked"], F.concat(F.lit("?"), p["query"])).otherwise(""))).otherwise("")

    return let(trim(F.coalesce(raw, F.lit(""))), lambda r: F.when(r == "", "").otherwise(let(parts(_assumed(r)), build)))


def safe_url(raw: Column) -> Column:
    """For logs: origin and path, the query hidden."""

    def build(p: Column) -> Column:
        at = F.when(p["port"] == "", "").otherwise(F.concat(F.lit(":"), p["port"]))
        return F.when(_web(p), F.concat(p["scheme"], F.lit("://"), p["host"], at, p["path"], F.when(p["query"] != "", "?[redacted]").otherwise(""))).otherwise("")

    return let(parts(raw), build)


def is_language_only(raw: Column) -> Column:
    return F.rlike(parts(raw)["path"], F.lit(LANGUAGE_ONLY))


def page_limit(site: Column, default: int, special: dict[str, int] | None = None) -> Column:
    """The number of pages kept of a site: the default, or a host's own."""
    out = F.lit(default)
    for name, limit in (special or {}).items():
        out = F.when(bare_host(site) == name, F.lit(limit)).otherwise(out)
    return out


def clean_candidate(raw: Column, base: Column) -> Column:
    """A link as written on a page, cleaned; '' for mail, script, data and feed links and for two addresses in one."""
    r = F.regexp_replace(trim(F.coalesce(raw, F.lit(""))), r"""^['"\s]+|['"\s]+$""", "")
    embedded = F.regexp_extract(r, r"""(?i)(https?://[^\s"'<>]+)""", 1)
    value = F.coalesce(F.nullif(embedded, F.lit("")), r)
    bad = F.rlike(F.coalesce(raw, F.lit("#")), F.lit(r"(?i)^(mailto:|tel:|javascript:|#|data:)")) | (r == "") | F.rlike(value, F.lit(r"(?i)https?://.*https?://"))
    feed = r"(?i)/feeds(?:/|$)|comments/default|(?:^|/)(?:atom|rss)(?:\.xml)?$"
    judge = lambda u: let(parts(u), lambda p: F.when(_web(p) & ~F.rlike(p["path"], F.lit(feed)), u).otherwise(""))
    return F.when(bad, "").otherwise(let(resolve(value, base), judge))


def is_social(name: Column) -> Column:
    """A host that is a social network or below one."""
    h = F.regexp_replace(F.lower(name), r"^www\.", "")
    return F.rlike(h, F.lit(r"(?:^|\.)(?:" + "|".join(x.replace(".", r"\.") for x in SOCIAL) + ")$"))


def icon_url(declared: Column, base: Column) -> Column:
    """The page's icon: as declared, ``/favicon.ico`` by default; a bare favicon lies at the root."""
    d = F.coalesce(F.nullif(trim(F.coalesce(declared, F.lit(""))), F.lit("")), F.lit("/favicon.ico"))
    rooted = F.when(d.rlike(r"(?i)^(?:\./)?favicon\.ico(?:[?#]|$)"), F.regexp_replace(d, r"(?i)^(?:\./)?favicon\.ico", "/favicon.ico")).otherwise(d)
    return resolve(rooted, base)
