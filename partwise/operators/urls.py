"""Addresses: what may be kept of them, and which are allowed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://(?:[^/?#@]*@)*(\[[^\]/?#]*\]|[^/?#@:]*)(?::[^/?#]*)?([^?#]*)"


def redacted(url: Column) -> Column:
    """struct(scheme, host, path, https): no user, password, port, query or fragment; the path is / if empty."""
    part = lambda k: F.regexp_extract(url, _URL, k)
    path = F.when(part(3) == "", "/").otherwise(part(3))
    return F.struct(F.lower(part(1)).alias("scheme"), F.lower(part(2)).alias("host"), path.alias("path"), (F.lower(part(1)) == "https").alias("https"))


def authorized(entries: DataFrame, collection: str, url: str, order: str, insecure: DataFrame | None = None) -> DataFrame:
    """Adds verdict to entries in order: url_invalid, duplicate_url, insecure_http_not_authorized, else authorized.

    insecure names the collections that allow http; each gets exactly one http entry, its first.
    """
    rows = entries.withColumn("_u", redacted(F.col(url)))
    valid = F.col("_u.scheme").isin("http", "https") & (F.col("_u.host") != "")
    rows = rows.withColumn("_valid", valid)
    rows = rows.join(insecure.select(collection).distinct().withColumn("_allows", F.lit(True)), collection, "left") if insecure is not None else rows.withColumn("_allows", F.lit(False))
    again = F.row_number().over(Window.partitionBy(collection, url).orderBy(order)) > 1
    rows = rows.withColumn("_again", again)
    fresh = F.col("_valid") & ~F.col("_again") & (F.col("_u.scheme") == "http")
    nth = F.sum(fresh.cast("int")).over(Window.partitionBy(collection).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    verdict = F.when(~F.col("_valid"), "url_invalid").when(F.col("_again"), "duplicate_url").when(fresh & (~F.coalesce("_allows", F.lit(False)) | (nth > 1)), "insecure_http_not_authorized").otherwise("authorized")
    return rows.withColumn("verdict", verdict).drop("_u", "_valid", "_allows", "_again")


def destinations(visits: DataFrame, authority: str, url: str, confirmed: DataFrame, plan: str) -> DataFrame:
    """Adds verdict to visits (plan, authority, url): host_escalation, https_downgrade, else allowed.

    A host must be the authority's or one that the plan has confirmed (plan, host); neither allows http after https.
    """
    rows = visits.withColumn("_a", redacted(F.col(authority))).withColumn("_d", redacted(F.col(url)))
    known = confirmed.select(F.col(plan).alias("_plan"), F.lower("host").alias("_host")).distinct().withColumn("_ok", F.lit(True))
    rows = rows.join(known, (F.col(plan) == F.col("_plan")) & (F.col("_d.host") == F.col("_host")), "left")
    verdict = F.when((F.col("_a.host") != F.col("_d.host")) & F.col("_ok").isNull(), "host_escalation").when(F.col("_a.https") & ~F.col("_d.https"), "https_downgrade").otherwise("allowed")
    return rows.withColumn("verdict", verdict).drop("_a", "_d", "_plan", "_host", "_ok")
