"""Fetched responses: a table of (url, status, final_url, body), by default read, optionally fetched by the workers."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shared import shared_folder
from .responses import responses

# --- fixed values: cookies that say of age ---------------------------------------------------------------------------
AGE_COOKIES = {"is_adult": "1", "adult": "1", "age_verified": "1", "confirm18": "1", "age": "18"}
# ------------------------------------------------------------------------------------------------------------------


def fetch(urls: DataFrame, *, landing: str | None = None, url: str = "url", **settings) -> DataFrame:
    """S1-S3. Rows of responses.SCHEMA for each url, fetched where the tasks run, each once whatever runs again.

    landing: the folder of the run's responses; without one, a new one in the shared folder. settings as responses.Session has them.
    """
    where = landing or f"{shared_folder(urls.sparkSession)}/responses-{uuid.uuid4().hex}"
    return responses(urls.select(F.col(url).alias("url")), where, **settings)


def severity(status: Column, scope: Column, default: str = "WARNING") -> Column:
    """P10, E6. Log level of a failed request: a missing page of a city is expected; no status, or the server's own failure, is an error."""
    worse = "ERROR" if default in ("WARNING", "ERROR") else default
    return F.when((status == 404) & (scope == "city/pagination page"), "WARNING").when(status.isNull() | (status >= 500), worse).otherwise(default)


def issues(asked: DataFrame, got: DataFrame, scope: str, default: str = "WARNING") -> DataFrame:
    """(scope, url, status, level) of the urls that were asked for and not read."""
    bad = asked.select("url").distinct().join(got.select("url", "status", "body"), "url", "left").where("body is null or status >= 400")
    return bad.select(F.lit(scope).alias("scope"), "url", F.col("status").cast("int").alias("status")).withColumn("level", severity(F.col("status"), F.col("scope"), default))


def rejected(asked: DataFrame, got: DataFrame) -> DataFrame:
    """S4, E4. (url, reason) of the urls without a response and of bodies that aren't JSON."""
    j = asked.select("url").distinct().join(got.select("url", "body"), "url", "left")
    reason = F.when(F.col("body").isNull(), "no response").when(F.try_parse_json("body").isNull(), "invalid json")
    return j.select("url", reason.alias("reason")).where("reason is not null")
