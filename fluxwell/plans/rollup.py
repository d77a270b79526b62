"""A day rollup that answers reports without a time bound, and sketches that count pumps over any range.

One row per day, pump, region, status and error code: how many readings, and the newest one's time. Rows merge by adding
counts and taking the later time, so a report over all history reads the rollup and never the readings. A build
replaces whole days, so building a day again after late readings leaves nothing behind and needs no other day.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxwell.functions.instants import as_timestamp
from fluxwell.plans import analytics, quality
from fluxwell.schema import VALID
from fluxwell.sources.tables import files_of, load, time_range

KEY = ["pump_id", "region", "status", "error_code"]
ROLLUP = "pump_id string, region string, status string, error_code int, n bigint, time timestamp, covered timestamp, date date"


def rollup(raw: DataFrame) -> DataFrame:
    """Readings to rollup rows. ``time`` is the newest of a row, so reports that ask for it read a rollup as they read readings."""
    dated = raw if "date" in raw.columns else raw.withColumn("date", F.to_date("time"))
    return dated.groupBy("date", *KEY).agg(F.count(F.lit(1)).alias("n"), F.max("time").alias("time"))


def stale_days(spark: SparkSession, landed: str, path: str) -> dict:
    """Days with landed files that their rollup does not cover, each with the time of its newest file.

    Reads the listing of the landed files and one column of the rollup; a row per day reaches the driver.
    """
    new = files_of(spark, landed).where(F.col("outcome") == VALID).groupBy("date").agg(F.max("modificationTime").alias("at"))
    try:
        known = spark.read.schema(ROLLUP).parquet(path).groupBy("date").agg(F.max("covered").alias("covered"))
        new = new.join(known, "date", "left").where("covered IS NULL OR covered < at")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    return {r["date"]: r["at"] for r in new.collect()}


def build(spark: SparkSession, landed: str, path: str) -> list:
    """Bring the rollup up to date for the days that changed. Returns the days built.

    Other days are neither read nor written. Files are listed before they are read, so what lands in between makes
    its day stale again at worst. Running it twice, or again after a failure, gives the same rows.
    """
    days = stale_days(spark, landed, path)
    if days:
        raw = load(spark, landed).raw.where(F.col("date").isin(*days))
        covered = F.create_map(*(F.lit(x) for pair in days.items() for x in pair))
        rows = rollup(raw).withColumn("covered", F.try_element_at(covered, "date"))
        rows = rows.hint("rebalance", "date").sortWithinPartitions("date", "pump_id")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    return sorted(days)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROLLUP).parquet(path)


def offline_pumps(rolled: DataFrame, as_of=None, silent_for: str = "5 minutes") -> DataFrame:
    """``analytics.offline_pumps`` from the rollup: it only asks for each pump's newest time."""
    return analytics.offline_pumps(rolled, as_of, silent_for)


def freshness(rolled: DataFrame, as_of=None) -> DataFrame:
    """``quality.freshness`` from the rollup: maxima of rows are maxima of readings."""
    return quality.freshness(rolled, as_of)


def error_code_analysis(rolled: DataFrame, samples: int = 5) -> DataFrame:
    """``analytics.error_code_analysis`` from the rollup; occurrences are sums of its counts."""
    return analytics.error_code_analysis(rolled, samples, count=F.sum("n"))


def pump_sketches(raw: DataFrame) -> DataFrame:
    """One HyperLogLog sketch of pump ids per minute: ``minute``, ``pumps`` (binary)."""
    return raw.groupBy(F.date_trunc("minute", "time").alias("minute")).agg(F.hll_sketch_agg("pump_id", F.lit(14)).alias("pumps"))


def pumps_between(sketches: DataFrame, start=None, end=None, every: str | None = None) -> DataFrame:
    """Distinct pumps with a reading in ``[start, end)``, from sketches of whole minutes; per ``every`` hour or day if asked.

    Sketches merge, so a range of any length costs a sketch a minute and no reading. 2^14 registers err by about 0.8 %.
    """
    picked = time_range(sketches, "minute", start)
    if end is not None:
        picked = picked.where(F.col("minute") < as_timestamp(end))
    grouped = picked.groupBy(F.date_trunc(every, "minute").alias("time")) if every else picked.groupBy()
    return grouped.agg(F.hll_sketch_estimate(F.hll_union_agg("pumps")).alias("pumps"))
