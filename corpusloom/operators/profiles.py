"""Publisher profile attached to the records of its site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.urls import authority


def with_profile(pages: DataFrame, profiles: DataFrame, url: str = "url") -> DataFrame:
    """Add ``profile``, the JSON text ``profiles(host, profile)`` holds for the host of ``url``.

    No broadcast is forced: Spark broadcasts the profiles when their size is below
    its threshold, and otherwise joins by shuffle with skewed hosts split. Repeated rows
    of a host count once; two different profiles of one host are an error.
    """
    least, most = F.min("profile"), F.max("profile")
    clash = F.raise_error(F.concat(F.lit("different profiles for host "), F.col("_host")))
    one = (profiles.groupBy(F.lower("host").alias("_host")).agg(least.alias("profile"), most.alias("_most"))
           .select("_host", F.when(F.col("profile").eqNullSafe(F.col("_most")), F.col("profile")).otherwise(clash).alias("profile")))
    return pages.withColumn("_host", F.expr(authority(url))).join(one, "_host", "left").drop("_host")


def attach_profile(records: DataFrame, profiles: DataFrame, url: str = "url") -> DataFrame:
    """Fill ``company_fixed`` of finished records."""
    order = records.columns if "company_fixed" in records.columns else [*records.columns, "company_fixed"]
    joined = with_profile(records.drop("company_fixed"), profiles, url)
    return joined.withColumn("company_fixed", F.try_parse_json("profile")).select(*order)
