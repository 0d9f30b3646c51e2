"""URL and host functions as Columns. A null or unparsable URL gives null (or an empty host, where said)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _full(url: Column) -> Column:
    u = F.trim(url)
    return F.when(F.lower(u).startswith("http"), u).otherwise(F.concat(F.lit("https://"), u))


def host_of(url: Column) -> Column:
    """Lower-case host without one leading "www."; empty for null, blank or hostless input."""
    return F.coalesce(F.regexp_replace(F.lower(F.try_parse_url(_full(url), F.lit("HOST"))), r"^www\.", ""), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.try_parse_url(_full(url), F.lit("PATH")), F.lit(""))


def site_key(url: Column) -> Column:
    """Authority without www plus the path without closing slashes, lower case."""
    authority = F.regexp_replace(F.coalesce(F.try_parse_url(_full(url), F.lit("AUTHORITY")), F.lit("")), r"^www\.", "")
    return F.lower(F.concat(authority, F.regexp_replace(path_of(url), "/+$", "")))


def page_key(url: Column) -> Column:
    """Host and path of a page below a site's root; null for homepages and files (.pdf, .jpg, .png)."""
    path = F.regexp_replace(F.lower(path_of(url)), "/+$", "")
    return F.when((path != "") & ~path.rlike(r"\.(pdf|jpg|png)$") & (host_of(url) != ""), F.concat(host_of(url), path))


def registrable(name: Column, second_levels: tuple[str, ...] = ("co", "com", "net", "org", "gov", "edu", "ac")) -> Column:
    """The registrable domain: two labels, or three below a two-letter top level whose second level is a known one."""
    clean = F.regexp_replace(F.lower(name), r"^\*\.", "")
    labels = F.split(clean, r"\.")
    n = F.size(labels)
    three = (n >= 3) & (F.length(F.element_at(labels, -1)) == 2) & F.try_element_at(labels, F.lit(-2)).isin(*second_levels)
    return F.when(three, F.substring_index(clean, ".", -3)).otherwise(F.substring_index(clean, ".", -2))


def last_labels(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def same_page(url: Column) -> Column:
    """A key of equal pages: host, path without closing slashes, query."""
    query = F.try_parse_url(_full(url), F.lit("QUERY"))
    return F.concat(host_of(url), F.regexp_replace(path_of(url), "/+$", ""), F.coalesce(F.concat(F.lit("?"), query), F.lit("")))


def clean_query(url: Column, tracking: tuple[str, ...]) -> Column:
    """The URL without query parameters whose lower-cased name starts with a tracking prefix; order kept."""
    head = F.substring_index(F.substring_index(url, "#", 1), "?", 1)
    query = F.regexp_extract(F.substring_index(url, "#", 1), r"\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.lower(p).rlike("^(" + "|".join(tracking) + ")"))
    return F.concat(head, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")))


def address_variants(url: Column) -> Column:
    """Distinct addresses to try, in order: as listed, then https and http, with and without www."""
    host, rest = F.lower(F.coalesce(F.try_parse_url(_full(url), F.lit("HOST")), F.lit(""))), F.try_parse_url(_full(url), F.lit("FILE"))
    toggled = F.when(host.startswith("www."), F.substring(host, 5, 1000)).otherwise(F.concat(F.lit("www."), host))
    tail = F.coalesce(rest, F.lit(""))
    return F.array_distinct(F.array(_full(url), *[F.concat(F.lit(s), h, tail) for s in ("https://", "http://") for h in (host, toggled)]))


def under(host: Column, domain: Column) -> Column:
    """The host is the domain or a subdomain of it."""
    return (host == domain) | host.endswith(F.concat(F.lit("."), domain))


def names_dish(domain: Column, dish: str, look_alikes: tuple[str, ...], followers: tuple[str, ...], endings: tuple[str, ...]) -> Column:
    """A domain under an accepted ending whose label has the dish at its start or end, after a digit or hyphen, or before a plain word;
    look-alikes are taken out first."""
    label = F.substring_index(F.lower(domain), ".", 1)
    for x in look_alikes:
        label = F.regexp_replace(label, x, "")
    after = "|".join(followers)
    return F.substring_index(domain, ".", -1).isin(*endings) & label.rlike(f"^{dish}|[-0-9]{dish}|{dish}$|{dish}(?=[-0-9]|{after})")


def _given(url: Column, key: str) -> Column:
    return F.trim(F.try_url_decode(F.coalesce(F.try_parse_url(url, F.lit("QUERY"), F.lit(key)), F.lit(""))))


def shared_place(url: Column) -> Column:
    """struct(name, lat, lon, address, site) of a shared link; null without a name or a spot on earth. Sites that are no host are
    empty."""
    name, lat, lon = F.substring(_given(url, "n"), 1, 80), _given(url, "la").try_cast("double"), _given(url, "lo").try_cast("double")
    site = _given(url, "w")
    site = F.when(site.rlike(r"^[a-z0-9.-]+\.[a-z]{2,}$"), site).otherwise(F.lit(""))
    ok = (name != "") & lat.between(-90, 90) & lon.between(-180, 180)
    return F.when(ok, F.struct(name.alias("name"), lat.alias("lat"), lon.alias("lon"), F.substring(_given(url, "a"), 1, 120).alias("address"), site.alias("site")))


def encoded(text: Column) -> Column:
    """Percent-encoding with %20 for spaces."""
    return F.regexp_replace(F.url_encode(text), r"\+", "%20")


def store_link(link: Column, medium: Column) -> Column:
    """A store's link with the source in its referrer."""
    return F.concat(link, F.lit("&referrer="), encoded(F.concat(F.lit("utm_source=web&utm_medium="), F.substring(medium, 1, 32))))
