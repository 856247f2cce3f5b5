"""Links as they stand in pages, made absolute: the rules of RFC 3986 as columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadspark.functions.text import decode_entities

# Scheme, authority, path and query of a reference without fragment.
PARTS = {
    "scheme": r"^([A-Za-z][A-Za-z0-9+.-]*):",
    "authority": r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?]*)",
    "path": r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?]*)?([^?]*)",
    "query": r"^[^?]*(\?.*)$",
}
HAS_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"
# What browsers leave out of an address.
SURROUNDING, WITHIN = r"^[\x00-\x20]+|[\x00-\x20]+$", r"[\t\n\r]"

WEB = ("http", "https")

# Comments and scripts hold no links; a tag's attributes may hold ">" in quotes.
SILENT_PATTERN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
ANCHOR_PATTERN = r"""(?is)<a(?:[\s/](?:[^>"']++|"[^"]*+"|'[^']*+')*+)?>"""
BASE_PATTERN = r"""(?is)<base[\s/](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s"'>]++)"""
HREF_PATTERN = (
    rf"""(?is)^<\w+(?:[\s/]+(?!href[\s=])[^\s=>"'/]++(?:\s*+=\s*+{VALUE})?+)*+"""
    rf"""[\s/]+href\s*+=\s*+({VALUE})"""
)


def _part(name: str, url: Column) -> Column:
    return F.regexp_extract(url, PARTS[name], 1)


def without_dots(path: Column) -> Column:
    """A path without "." and ".." segments; those above the root go."""
    segments = F.split(path, "/")
    last = F.element_at(segments, -1)

    def onward(kept: Column, segment: Column) -> Column:
        shorter = F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(segment == "..", shorter).when(segment == ".", kept).otherwise(F.array_append(kept, segment))

    folded = F.aggregate(
        F.slice(segments, 2, F.size(segments)), F.slice(segments, 1, 1), onward
    )
    ended = F.when(last.isin(".", ".."), F.array_append(folded, F.lit(""))).otherwise(folded)
    return F.array_join(ended, "/")


def resolved(base: Column, reference: Column) -> Column:
    """The absolute URL that a reference in a document at `base` names, without fragment.

    The reference is text as it stands in an attribute, entities and all. NULL for what
    leads nowhere else or is no web address: fragments alone, mail, scripts.
    """
    plain = F.regexp_replace(F.regexp_replace(decode_entities(reference), SURROUNDING, ""), WITHIN, "")
    pair = F.struct(F.regexp_replace(base, r"#.*$", "").alias("base"), F.regexp_replace(plain, r"(?s)#.*$", "").alias("ref"))
    # The one-element array computes both once.
    return F.get(F.transform(F.array(pair), lambda x: _joined(x["base"], x["ref"])), F.lit(0))


def _joined(base: Column, ref: Column) -> Column:
    scheme, own_scheme = F.lower(_part("scheme", base)), F.lower(_part("scheme", ref))
    host, own_host = _part("authority", base), _part("authority", ref)
    path, query = _part("path", ref), _part("query", ref)
    base_path = _part("path", base)
    folder = F.when(base_path == "", "/").otherwise(F.regexp_replace(base_path, "[^/]*$", ""))
    rooted = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path))

    def made(scheme_: Column, host_: Column, path_: Column, query_: Column) -> Column:
        return F.concat(scheme_, F.lit("://"), host_, path_, query_)

    absolute = made(own_scheme, own_host, without_dots(F.when(path == "", path).otherwise(rooted)), query)
    of_host = made(scheme, own_host, without_dots(F.when(path == "", path).otherwise(rooted)), query)
    target = (
        F.when((own_scheme != "") & ~own_scheme.isin(*WEB), F.lit(None))
        .when((own_scheme != "") & (own_host != ""), absolute)
        .when((own_scheme != "") & (own_scheme != scheme), F.lit(None))  # a web address needs a host
        .when(ref.rlike(HAS_AUTHORITY), F.when(own_host != "", of_host))
        .when((path == "") & (query == ""), F.lit(None))
        .when(path == "", made(scheme, host, base_path, query))
        .when(path.startswith("/"), made(scheme, host, without_dots(path), query))
        .otherwise(made(scheme, host, without_dots(F.concat(folder, path)), query))
    )
    return F.when(scheme.isin(*WEB) & (host != "") | (own_host != ""), target)


def _href(tag: Column) -> Column:
    """Value of the first href attribute of a tag, NULL without one."""
    quoted = F.regexp_extract(tag, HREF_PATTERN, 1)
    value = F.when(quoted.rlike("""^["']"""), F.substring(quoted, F.lit(2), F.length(quoted) - 2)).otherwise(quoted)
    return F.when(quoted != "", value)


def hrefs(html: Column) -> Column:
    """Values of the href attributes of a page's links, in order, as they stand."""
    spoken = F.regexp_replace(html, SILENT_PATTERN, "")
    tags = F.regexp_extract_all(spoken, F.lit(f"({ANCHOR_PATTERN})"), F.lit(1))
    return F.array_compact(F.transform(tags, _href))


def document_base(url: Column, html: Column) -> Column:
    """Address that the links of a page are relative to: its <base>, or its own."""
    tag = F.regexp_extract(F.regexp_replace(html, SILENT_PATTERN, ""), f"({BASE_PATTERN})", 1)
    return F.coalesce(F.when(tag != "", resolved(url, _href(tag))), url)


def links(url: Column, html: Column) -> Column:
    """Absolute web addresses that a page links to, in order."""
    pair = F.struct(document_base(url, html).alias("base"), hrefs(html).alias("hrefs"))

    def every(page: Column) -> Column:
        return F.array_compact(F.transform(page["hrefs"], lambda ref: resolved(page["base"], ref)))

    return F.get(F.transform(F.array(pair), every), F.lit(0))
