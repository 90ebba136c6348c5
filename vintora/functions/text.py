"""Column functions on addresses, titles, codes and listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HREF = r'(?i)href="([^"?]+)"'
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")


def listing(pages: DataFrame, key: str, html: str, prefix: str) -> DataFrame:
    """(key, name, pos): last path parts of a page's links that begin with a prefix, each at its first place."""
    links = pages.select(key, F.posexplode(F.regexp_extract_all(html, F.lit(HREF), F.lit(1))).alias("pos", "href"))
    name = F.element_at(F.split(F.regexp_replace("href", "/+$", ""), "/"), -1)
    found = links.select(key, name.alias("name"), F.col("pos").cast("long").alias("pos")).where(F.startswith("name", F.lit(prefix)))
    return found.groupBy(key, "name").agg(F.min("pos").alias("pos"))


def feeds(pages: DataFrame, key: str, html: str, root: str) -> DataFrame:
    """(key, url): the feeds a page links to, relative ones made absolute."""
    links = F.filter(F.regexp_extract_all(html, F.lit(HREF), F.lit(1)), lambda h: F.contains(h, F.lit("/feed/")) & F.endswith(h, F.lit(".rss")))
    whole = F.transform(links, lambda h: F.when(F.startswith(h, F.lit("http")), h).otherwise(F.concat(F.lit(root), h)))
    return pages.select(key, F.explode(F.array_distinct(whole)).alias("url"))


def number(raw: Column) -> Column:
    """A padded cell as a number; suppression marks and other text are null."""
    return F.trim(raw).try_cast("double")


def composed(*parts: Column) -> Column:
    """A key of several codes; null parts stay visible, so keys of different parts never meet."""
    return F.concat_ws("|", *(F.coalesce(p, F.lit("~")) for p in parts))


def href_date(href: Column) -> Column:
    stamp = F.regexp_extract(href, r"_(\d{8})\.", 1)
    return F.to_date(F.try_to_timestamp(stamp, F.lit("MMddyyyy")))


def title_month(title: Column, released: Column) -> Column:
    """First day of the month a title names: its latest occurrence before the release."""
    found = F.regexp_extract(title, "(" + "|".join(MONTHS) + ")", 1)
    month = F.array_position(F.array(*map(F.lit, MONTHS)), found).cast("int")
    year = F.year(released) - F.when(month >= F.month(released), 1).otherwise(0)
    return F.when(month > 0, F.make_date(year, month, F.lit(1)))
