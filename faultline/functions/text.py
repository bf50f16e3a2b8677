"""Text, key, URL and hash expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from faultline.functions.temporal import col


@F.pandas_udf(StringType())
def _decompose(values: pd.Series) -> pd.Series:
    """NFKD for the rows that are not plain ASCII; Spark has no builtin for it."""
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFKD", v))


def slug(c: Column | str) -> Column:
    """Lower case, marks stripped, everything else to single hyphens; '' becomes null."""
    lowered = F.lower(col(c))
    ascii_only = ~lowered.rlike(r"[^\x00-\x7F]")
    plain = F.when(ascii_only, lowered).otherwise(_decompose(F.when(~ascii_only, lowered)))
    stripped = F.regexp_replace(plain, "[\\u0300-\\u036f]", "")
    hyphened = F.regexp_replace(F.regexp_replace(stripped, "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(hyphened != "", hyphened)


# Fixed value: form of an issue id.
ISSUE_ID_PATTERN = r"^(\d{4})-(\d{2})-(\d{2})-[a-z0-9]+(?:-[a-z0-9]+)*$"


def issue_id_valid(c: Column | str) -> Column:
    c = col(c)
    real = F.try_to_timestamp(F.substring(c, 1, 10), F.lit("yyyy-MM-dd")).isNotNull()
    return F.coalesce(c.rlike(ISSUE_ID_PATTERN) & real, F.lit(False))


def issue_id(date: Column, title: Column | str) -> Column:
    built = F.concat_ws("-", F.date_format(date, "yyyy-MM-dd"), slug(title))
    return F.when(issue_id_valid(built), built)


def issue_path(c: Column | str) -> Column:
    """issue/YYYY/MM/<id>, null for an invalid id."""
    c = col(c)
    return F.when(
        issue_id_valid(c),
        F.concat_ws("/", F.lit("issue"), F.substring(c, 1, 4), F.substring(c, 6, 2), c),
    )


def fold_alias(c: Column | str) -> Column:
    return F.lower(F.regexp_replace(F.trim(col(c)), r"\s+", " "))


def station_name_key(c: Column | str) -> Column:
    """Station name without the trailing kind words, for matching across sources."""
    return F.lower(F.trim(F.regexp_replace(col(c), r"(?i)\s+(?:MRT|LRT) STATION$", "")))


# Fixed value: the word before an exit's label.
EXIT_WORD = r"(?i)^Exit\s+"


def exit_label(c: Column | str) -> Column:
    label = F.trim(F.regexp_replace(col(c), EXIT_WORD, ""))
    return F.when(label != "", label)


def natural_key(c: Column | str) -> Column:
    """K4 sort key: each digit run as its length without leading zeros and its digits, case folded ('Exit 2' < 'Exit 10')."""
    def part(p: Column) -> Column:
        digits = F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.when(p.rlike("^[0-9]"), F.concat(F.lpad(F.length(digits).cast("string"), 10, "0"), digits)).otherwise(p)

    return F.array_join(F.transform(F.regexp_extract_all(F.lower(col(c)), F.lit("([0-9]+|[^0-9]+)"), F.lit(1)), part), "")


def truncate(c: Column | str, limit: int) -> Column:
    c = col(c)
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(F.substring(c, 1, limit - 3), F.lit("...")))


def labelled(label: str, c: Column | str) -> Column:
    """'Label: value', null when the value is blank, so `concat_ws` skips it."""
    value = F.trim(col(c))
    return F.when(value != "", F.concat(F.lit(f"{label}: "), value))


def fill_template(template: Column | str, name: str, value: Column | str) -> Column:
    return F.replace(col(template), F.lit("{" + name + "}"), F.coalesce(col(value), F.lit("")))


def entity_key(entity: Column | str) -> Column:
    """Stable key of an affected entity."""
    e = col(entity)
    facility = F.concat_ws(":", F.lit("facility"), e["station_id"], e["line_id"], e["kind"])
    return F.when(e["type"] == "service", F.concat_ws(":", F.lit("service"), e["service_id"])).when(
        e["type"] == "facility", facility
    )


def pair_key(a: Column | str, b: Column | str) -> Column:
    """Key of an undirected pair."""
    a, b = col(a), col(b)
    return F.concat_ws(":", F.least(a, b), F.greatest(a, b))


#: Instants to the microsecond and in UTC, whatever the session says; nulls written out.
JSON_OPTIONS = {
    "ignoreNullFields": "false", "timeZone": "UTC", "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def stable_json(*names: str) -> Column:
    """Canonical text of a record: columns sorted by name, nulls written out, instants exact and in UTC."""
    return F.to_json(F.struct(*sorted(names)), JSON_OPTIONS)


def digest(*names: str) -> Column:
    return F.sha2(stable_json(*names), 256)


def digest_key(*names: str) -> Column:
    """The first 128 bits of `digest` as bytes: a quarter of its text, for grouping."""
    return F.substring(F.unhex(digest(*names)), 1, 16)


# --- URLs --------------------------------------------------------------------

_HTTP = r"(?i)^[a-z][a-z0-9+.-]*://[^\s/?#]+"


def url_ok(c: Column | str) -> Column:
    c = col(c)
    return F.coalesce(c.rlike(_HTTP) & F.try_parse_url(c, F.lit("HOST")).isNotNull(), F.lit(False))


def url_host(c: Column | str) -> Column:
    c = col(c)
    return F.when(url_ok(c), F.lower(F.try_parse_url(c, F.lit("HOST"))))


def url_path(c: Column | str) -> Column:
    c = col(c)
    path = F.try_parse_url(c, F.lit("PATH"))
    return F.when(url_ok(c), F.when(path == "", F.lit("/")).otherwise(path))


# Fixed value: path of a web archive's copy.
ARCHIVE_PATH = r"^/web/[^/]+/(.+)$"


def archived_url(c: Column | str) -> Column:
    """Address a web-archive copy was made of, plain or percent-encoded."""
    c = col(c)
    tail = F.regexp_extract(url_path(c), ARCHIVE_PATH, 1)
    inner = F.when(url_ok(tail), tail).otherwise(F.try_url_decode(F.replace(tail, F.lit("+"), F.lit("%2B"))))
    return F.when((url_host(c) == "web.archive.org") & (tail != "") & url_ok(inner), inner)
