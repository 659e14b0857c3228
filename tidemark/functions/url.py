"""Addresses as identities: Column expressions that stay in the JVM.

Normal form: host and path, and the query where one is left. Scheme, one archive prefix, one `www.`, the default port,
the trailing slash, the fragment, blank query values and tracking keys are dropped; the rest of the query is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hosts of web archives whose addresses wrap another one, and query keys that only track.
ARCHIVE_HOSTS = ("web.archive.org", "arquivo.example")
TRACKING_PREFIXES = ("utm_", "mc_")
TRACKING_KEYS = ("fbclid", "gclid", "ref", "amp", "igshid", "_ga")

SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def _archive(hosts: tuple[str, ...]) -> str:
    return r"(?s)^https?://(?:" + "|".join(h.replace(".", r"\.") for h in hosts) + r")/web/\d+[a-z_]*/([^\n]+)\n?$"


def _trim(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def unarchived(url: Column, hosts: tuple[str, ...] = ARCHIVE_HOSTS) -> Column:
    """The address behind an archive's, or the address itself."""
    t = _trim(url)
    inner = F.regexp_extract(t, _archive(hosts), 1)
    return F.when(inner != "", inner).otherwise(url)


def _form(c: Column) -> Column:
    """Percent-encoding of a query part: unreserved characters stay, a space becomes a plus."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _query(q: Column) -> Column:
    """Query parts that have a value and don't track, decoded, sorted by key and value, and encoded again."""
    plain = lambda c: F.coalesce(F.try_url_decode(c), c)  # noqa: E731  # a broken escape stays as it is
    part = F.transform(
        F.filter(F.split(q, "&"), lambda p: p.rlike("^[^=]*=.")),
        lambda p: F.struct(plain(F.regexp_extract(p, "^([^=]*)=", 1)).alias("k"), plain(F.regexp_extract(p, "(?s)^[^=]*=(.*)$", 1)).alias("v")),
    )
    tracks = "^(?:" + "|".join([*TRACKING_PREFIXES, *(f"{k}$" for k in TRACKING_KEYS)]) + ")"
    kept = F.array_sort(F.filter(part, lambda x: ~F.lower(x["k"]).rlike(tracks)))
    return F.array_join(F.transform(kept, lambda x: F.concat(_form(x["k"]), F.lit("="), _form(x["v"]))), "&")


def normalized(url: Column, hosts: tuple[str, ...] = ARCHIVE_HOSTS) -> Column:
    """Normal form of an address; null stays null."""
    t = unarchived(_trim(url), hosts)
    full = F.regexp_replace(F.when(F.contains(t, F.lit("://")), t).otherwise(F.concat(F.lit("http://"), t)), r"[\t\r\n]", "")
    rest = F.regexp_replace(F.regexp_replace(full, r"(?s)#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.\-]*:", "")
    net = F.regexp_extract(rest, r"^//([^/?]*)", 1)
    host = F.regexp_replace(F.regexp_replace(F.lower(net), r"^www\.", ""), r":(?:80|443)$", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_replace(rest, r"^//[^/?]*", ""), r"(?s)\?.*$", ""), "/+$", "")
    query = F.when(F.contains(rest, F.lit("?")), _query(F.regexp_extract(rest, r"(?s)\?(.*)$", 1))).otherwise("")
    tail = F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")
    return F.concat(host, F.when(path == "", "/").otherwise(path), tail)


def identity(url: Column, hosts: tuple[str, ...] = ARCHIVE_HOSTS) -> Column:
    """16 hex digits that all spellings of one page share."""
    return F.substring(F.sha2(normalized(url, hosts), 256), 1, 16)


def domain(url: Column, hosts: tuple[str, ...] = ARCHIVE_HOSTS) -> Column:
    return F.split_part(normalized(url, hosts), F.lit("/"), F.lit(1))


def registrable(host: Column) -> Column:
    """Approximate registrable domain: the last two labels, or three where the last but one has at most three letters."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    last = lambda k: F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), F.lit(k)), ".")
    return F.when((n > 2) & (F.length(F.element_at(labels, -2)) <= 3), last(3)).otherwise(last(2))


def snapshot(stamp: Column, url: Column, host: str = ARCHIVE_HOSTS[0]) -> Column:
    return F.concat(F.lit(f"https://{host}/web/"), stamp, F.lit("id_/"), url)


def snapshot_stamp(snap: Column) -> Column:
    """The time stamp inside an archive address, without its flags; null where there is none."""
    got = F.regexp_extract(snap, r"/web/([^/]*)/", 1)
    return F.nullif(F.regexp_replace(got, "[a-z_]+$", ""), F.lit(""))
