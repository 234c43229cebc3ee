"""Column expressions: hashes, tags, runtime strings, node families, cleaning, durations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY, TOTAL = "decimal(18,6)", "decimal(28,6)"
#: The tags that usage carries, and what a missing or blank one counts as.
TAG_DEFAULTS = {
    "line_of_business": "Unknown", "department": "general", "cost_center": "unallocated", "environment": "dev", "use_case": "Unknown",
    "pipeline_name": "system", "workflow_level": "STANDALONE", "parent_workflow_name": "None",
}
TAGS = tuple(TAG_DEFAULTS)
#: Spellings of the environments; others only become lower case.
ENVIRONMENTS = {"prod": ("production", "prod"), "stage": ("staging", "stage"), "uat": ("user_acceptance", "uat"), "dev": ("development", "dev")}
#: Node families by pattern, first match wins.
NODE_FAMILIES = (
    ("%Standard_DS%", "General Purpose (DS)"), ("%Standard_E%", "Memory Optimized (E)"), ("%Standard_F%", "Compute Optimized (F)"),
    ("%Standard_L%", "Storage Optimized (L)"), ("%Standard_N%", "GPU Enabled (N)"), ("%Standard_M%", "Memory Optimized (M)"),
    ("c%", "Compute Optimized (C-family)"), ("m%", "General Purpose (M-family)"), ("r%", "Memory Optimized (R-family)"),
    ("i%", "Storage Optimized (I-family)"), ("g%", "GPU Enabled (G-family)"), ("p%", "GPU Enabled (P-family)"), ("t%", "Burstable (T-family)"),
)


def first_of(cases, otherwise) -> Column:
    """The value of the first (condition, value) that holds."""
    out = F.lit(otherwise) if not isinstance(otherwise, Column) else otherwise
    for condition, value in reversed(list(cases)):
        out = F.when(condition, value).otherwise(out)
    return out


def environment(c: Column) -> Column:
    spellings = F.create_map(*[F.lit(x) for name, names in ENVIRONMENTS.items() for spelling in names for x in (spelling, name)])
    return F.coalesce(F.try_element_at(spellings, F.lower(c)), F.lower(c))


def node_family(c: Column) -> Column:
    return first_of(((c.like(pattern), family) for pattern, family in NODE_FAMILIES), "Other")


def tag(tags: Column, name: str) -> Column:
    """A raw tag; null where the map or the key is missing."""
    return F.try_element_at(tags, F.lit(name))


def defaulted(c: Column, name: str) -> Column:
    """The tag's value, or its declared default where it is missing or blank."""
    value = F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(TAG_DEFAULTS[name]))
    return environment(value) if name == "environment" else value


def is_missing(c: Column, name: str) -> Column:
    """Missing in one sense everywhere: null, blank or the declared default."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit(TAG_DEFAULTS[name])) == TAG_DEFAULTS[name]


def is_absent(raw: Column, name: str) -> Column:
    """is_missing() of defaulted(raw), read from the raw tag: neither default nor spelling is put in only to be compared."""
    value = F.trim(raw)
    if name == "environment":
        return F.coalesce(F.lower(value).isin("", *ENVIRONMENTS[TAG_DEFAULTS[name]]), F.lit(True))
    return F.coalesce(value.isin("", TAG_DEFAULTS[name]), F.lit(True))


def absent_tags(tags: Column) -> Column:
    """is_absent() of every tag, in the order of TAGS, as one array.

    One lambda for all tags: written out eight times beside the joins, they make a generated method that is too long to be compiled.
    """
    spelled = lambda k, v: ["", *(ENVIRONMENTS[v] if k == "environment" else [v])]
    of = F.array(*[F.struct(F.lit(k).alias("name"), F.array(*map(F.lit, spelled(k, v))).alias("missing"), F.lit(k == "environment").alias("any_case")) for k, v in TAG_DEFAULTS.items()])

    def absent(t: Column) -> Column:
        value = F.trim(F.try_element_at(tags, t["name"]))
        return F.coalesce(F.array_contains(t["missing"], F.when(t["any_case"], F.lower(value)).otherwise(value)), F.lit(True))

    return F.transform(of, absent)


def last_days(key: str, as_of: str, days: int) -> str:
    """The condition on a date key for the last so many days up to a day, that day included; no query reads the clock."""
    last = dt.date.fromisoformat(as_of)
    return f"{key} BETWEEN {last - dt.timedelta(days=days - 1):%Y%m%d} AND {last:%Y%m%d}"


def runtime(version: Column) -> dict[str, Column]:
    number = lambda k: F.regexp_extract(version, r"^(?:dlt:)?(\d+)\.(\d+)", k).try_cast("int")
    lower = F.lower(version)
    return {"major_version": number(1), "minor_version": number(2), "is_photon": F.contains(lower, F.lit("photon")), "is_ml": F.contains(lower, F.lit("-ml"))}


def row_hash(*columns: Column) -> Column:
    """SHA-256 over all payload columns as strings, null as empty."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]), 256)


def date_key(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd").cast("int")


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def percent(part: Column, whole: Column) -> Column:
    """100 * part / whole as a double with two decimals; null over zero."""
    return F.round(part.cast("double") * 100.0 / F.nullif(whole, F.lit(0)).cast("double"), 2)


def total(c: Column) -> Column:
    return F.sum(c).cast(TOTAL)


def mean(c: Column) -> Column:
    """An exact sum over a count, as a double."""
    return F.sum(c).cast("double") / F.count(c)


def surrogate(*natural: str) -> Column:
    return F.xxhash64(*natural)


def joined(columns: Sequence[Column], by: str = "|") -> Column:
    return F.concat_ws(by, *columns)
