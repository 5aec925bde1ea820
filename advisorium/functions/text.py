"""Scalar text, number and time expressions (all JVM-side built-ins)."""

from pyspark.sql import Column, functions as F

# Everything Python's str.strip() removes; given to trim() so that no regex runs per row.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Spelling variants of a category.
CATEGORY_NAMES = {
    "compute": "compute",
    "networking": "networking",
    "network": "networking",
    "database": "database",
    "storage": "storage",
    "security": "security",
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.trim(_col(c), F.lit(WHITESPACE))


def is_blank(c) -> Column:
    """True for null, empty and white-space-only values."""
    return F.coalesce(strip(c), F.lit("")) == ""


def clean_text(c) -> Column:
    """Stripped value; blank and the placeholder TK (any case) become null."""
    value = strip(c)
    return F.when((value != "") & (F.upper(value) != "TK"), value)


def safe_int(c) -> Column:
    """Integer value of a cleaned text, null when it is not one."""
    return clean_text(c).try_cast("int")


def storage_key(c) -> Column:
    """Name made safe for use as a partition value."""
    name = F.coalesce(_col(c), F.lit(""))
    dashed = F.translate(name, "/\\ ", "---")
    kept = F.lower(F.regexp_replace(dashed, "[^\\p{L}\\p{N}_.-]", ""))
    return F.when(name == "", F.lit("unknown")).otherwise(kept)


def risks_of(c) -> Column:
    """The comma-separated risks of a row as an array of trimmed names."""
    return F.transform(F.split(_col(c), ","), strip)


def normalise_risk(c) -> Column:
    value = _col(c)
    joined = F.array_join(F.transform(F.split(F.lower(strip(value)), ","), strip), ", ")
    return F.when(F.coalesce(value, F.lit("")) == "", F.lit("operations")).otherwise(joined)


def first_risk(c) -> Column:
    return F.try_element_at(risks_of(c), F.lit(1))


def normalise_category(c) -> Column:
    value = strip(c)
    lowered = F.lower(value)
    known = F.lit(None).cast("string")
    for name, target in CATEGORY_NAMES.items():
        known = F.coalesce(F.when(lowered == name, F.lit(target)), known)
    return F.when(F.coalesce(_col(c), F.lit("")) != "", F.coalesce(known, value))


def http_links(*columns) -> Column:
    """The http(s) links among several columns, in column order."""
    cleaned = F.array(*[clean_text(c) for c in columns])
    return F.filter(cleaned, lambda link: F.coalesce(link.startswith("http"), F.lit(False)))


def content_hash(title, body) -> Column:
    """SHA-256 of the normalised title and body."""
    part = lambda c: F.lower(strip(F.coalesce(_col(c), F.lit(""))))
    digest = F.sha2(F.concat(part(title), F.lit("|"), part(body)), 256)
    # Never null, so that a join on it adds no filter that hashes the text a second time.
    return F.coalesce(digest, F.lit(""))


def stable_id(*columns) -> Column:
    """Identifier in UUID layout derived from natural key columns, the same on every run."""
    digest = F.sha2(F.concat_ws("\x1f", *[F.coalesce(_col(c).cast("string"), F.lit("")) for c in columns]), 256)
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in cuts])


def replace_known_entities(c) -> Column:
    """Decode the markup entities that occur in prose pages, also where the semicolon is missing
    before a character that cannot continue a name. The ampersand goes last."""
    # Entity names and their characters.
    known = (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">"), ("nbsp", "\u00a0"), ("#39", "'"))
    open_end = "(?![A-Za-z0-9;])"
    value = _col(c)
    for name, char in known:
        value = F.replace(value, F.lit(f"&{name};"), F.lit(char))
    repaired = value
    for name, char in known:
        repaired = F.regexp_replace(repaired, f"&{name}{open_end}", char)
    broken = value.rlike(f"&(?:{'|'.join(name for name, _ in known)}){open_end}")
    return F.regexp_replace(F.when(broken, repaired).otherwise(value), f"&amp(?:;|{open_end})", "&")


def strip_html(c, decode=replace_known_entities) -> Column:
    """Text of a markup fragment: tags become spaces, entities are decoded, space collapses.

    ``decode`` is the entity step; pass ``html_unescape()`` for the full entity table.
    """
    untagged = F.regexp_replace(F.coalesce(_col(c), F.lit("")), "<[^>]+>", " ")
    return strip(F.regexp_replace(decode(untagged), "(?U)\\s+", " "))


def html_unescape():
    """Arrow-batched decoder for the full entity table, for texts the known list cannot cover."""

    @F.pandas_udf("string")
    def unescape(values):
        import html

        return values.map(html.unescape, na_action="ignore")

    return unescape


def iso_timestamp(ts) -> Column:
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def parse_iso(c) -> Column:
    """Timestamp of an ISO text, with Z or an offset; null when it cannot be parsed."""
    return _col(c).try_cast("timestamp")


def age_days(ts, as_of) -> Column:
    """Whole elapsed days (24-hour periods) up to ``as_of``."""
    elapsed = F.unix_micros(_col(as_of).cast("timestamp")) - F.unix_micros(_col(ts).cast("timestamp"))
    return F.floor(elapsed / F.lit(86_400_000_000)).cast("long")


def feed_date(c) -> Column:
    """Publication date of a feed entry; the weekday name is not parsed."""
    rest = F.regexp_replace(strip(c), "^[A-Za-z]{3},\\s*", "")
    return F.coalesce(
        F.try_to_timestamp(rest, F.lit("d MMM yyyy HH:mm:ss z")),
        F.try_to_timestamp(rest, F.lit("d MMM yyyy HH:mm:ss Z")),
        parse_iso(rest),
    )


def shorten(c, width: int, suffix: str = "..") -> Column:
    """Display text cut to ``width`` characters, marked when something was cut."""
    value = _col(c)
    return F.when(F.length(value) > width, F.concat(F.left(value, F.lit(width)), F.lit(suffix))).otherwise(value)


def base_name(path) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def non_empty(c) -> Column:
    """True for a non-empty string."""
    return F.coalesce(_col(c), F.lit("")) != ""


def has_items(c) -> Column:
    """True for an array with at least one element."""
    return F.coalesce(F.size(_col(c)), F.lit(0)) > 0
