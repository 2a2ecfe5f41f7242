"""Links, tiers and keys of crawled pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text in a category link that tells its tier, checked in this order.
TIER_MARKS = {"tier4": "DgrpCategory", "tier3": "MgrpCategory", "tier2": "LgrpCategory"}
# End of fixed values.


def link_key(link: Column) -> Column:
    """Key of a link: its SHA-256 in hex."""
    return F.sha2(link, 256)


def link_tier(link: Column, marks: dict[str, str] | None = None) -> Column:
    """Tier named by the first mark found in the link, else null."""
    tests = [F.when(link.contains(text), tier) for tier, text in (marks or TIER_MARKS).items()]
    return F.coalesce(*tests)


def absolute_link(link: Column, host: str) -> Column:
    """Prefix the host where the link does not name it; ``..`` starts a path below the host.

    A script link becomes an empty text.
    """
    name = host.split("//")[-1].split("/")[0].removeprefix("www.")
    path = F.when(link.startswith(".."), F.substring(link, 3, 1 << 30)).otherwise(link)
    joined = F.when(path.startswith("/"), F.concat(F.lit(host), path)).otherwise(
        F.concat(F.lit(host + "/"), path)
    )
    return (
        F.when(link.contains("javascript"), "").when(link.contains(name), link).otherwise(joined)
    )


def rename_host(link: Column, old: str, new: str) -> Column:
    return F.replace(link, F.lit(old), F.lit(new))


def single_slashes(link: Column) -> Column:
    """Collapse repeated slashes of the path; the scheme keeps its two."""
    return F.regexp_replace(link, "(?<!:)/{2,}", "/")


def is_category_link(link: Column, marks: tuple[str, ...] = ("https", "category")) -> Column:
    """Whether the link holds all marks."""
    condition = F.lit(True)
    for mark in marks:
        condition = condition & link.contains(mark)
    return condition


def page_number(link: Column) -> Column:
    """Number after ``page=``, else 1."""
    found = F.regexp_extract(link, r"page=(\d+)", 1)
    return F.when(found == "", 1).otherwise(found.try_cast("int"))


def breadcrumb(texts: Column) -> Column:
    """Tiers of a breadcrumb: blanks and single empty entries go, the first entry (home) is dropped."""
    joined = F.array_join(texts, "|")
    squeezed = F.regexp_replace(F.regexp_replace(joined, "[ \\n]", ""), "\\|\\|", "|")
    parts = F.split(squeezed, "\\|")
    return F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0)))


def tier_path(tiers: Column, base: str = "content") -> Column:
    """Storage path of a tier list; empty tiers are left out and slashes trimmed."""
    names = F.transform(tiers, lambda t: F.btrim(t, F.lit("/")))
    return F.concat_ws("/", F.lit(base), F.filter(names, lambda t: t != ""))


def tier_columns(tiers: Column, depth: int) -> dict[str, Column]:
    """``tier1 .. tier<depth>`` of a tier list, null where it is shorter."""
    return {f"tier{i + 1}": F.get(tiers, i) for i in range(depth)}


def deepest_tier(columns: list[str]) -> Column:
    """Name of the last tier column that is filled."""
    tests = [
        F.when(F.col(c).isNotNull() & (F.col(c) != ""), c) for c in reversed(columns)
    ]
    return F.coalesce(*tests)


def without_constant(values: Column, constant: str) -> Column:
    return F.array_remove(values, constant)


def image_rating(source: Column) -> Column:
    """Rating in an image name such as ``star_5.png``."""
    return F.regexp_extract(source, r"_(\d+)\.[^./]*$", 1).try_cast("int")


def date_stamp(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd")
