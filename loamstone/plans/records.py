"""Queries over the archive's records that belong to the core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamstone.functions.domains import plain_domain
from loamstone.operators.timestamps import FORMATS, normalised, order_mixture, parsed
from loamstone.sources.tables import table


def _values(spark: SparkSession, folder: str) -> DataFrame:
    """(id, domain, field, value, tz, date_order): every timestamp value of the records, one row per row and field."""
    registry = table(spark, folder, "source_registry").select(
        plain_domain(F.col("domain")).alias("_domain"), "tz", "date_order"
    )
    fields = F.array(
        F.struct(F.lit("published_at").alias("field"), F.col("source.published_at").alias("value")),
        F.struct(F.lit("created_at").alias("field"), F.col("created_at").alias("value")),
    )
    return (
        table(spark, folder, "research_record")
        .select("id", plain_domain(F.col("source.domain")).alias("domain"), F.inline(fields))
        .where(F.col("value").isNotNull())
        .join(registry, F.col("domain") == F.col("_domain"), "left")
        .drop("_domain")
        .withColumn("date_order", F.coalesce("date_order", F.lit("dmy")))
    )


def record_instants(spark: SparkSession, folder: str) -> DataFrame:
    """Every timestamp value of the records with its instant, status and posterior."""
    return normalised(_values(spark, folder), "value", "domain", "tz", "date_order")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return record_instants(spark, folder).where(F.col("utc_us").isNotNull()).select("id", "field", "utc_us").distinct()


def p5_status(spark: SparkSession, folder: str) -> DataFrame:
    """How many values of each source and field were resolved, ambiguous, invalid or not timestamps at all."""
    return record_instants(spark, folder).groupBy("domain", "field", "ts_status").agg(F.count("*").alias("n"))


def p5_inferred(spark: SparkSession, folder: str) -> DataFrame:
    """What the mixture finds of each source without being told its order: the order, `ambiguous` where its dates do not
    tell, whether that agrees with the declared one, and how many of its values would stay ambiguous. Values of records
    without a source have no common order and are left out."""
    values = _values(spark, folder).where("domain IS NOT NULL")
    blind = parsed(values.withColumn("_none", F.lit(None).cast("string")), "value")
    fitted = order_mixture(blind, "domain", "_none")
    order = F.when(F.col("p_dmy") >= 0.8, "dmy").when(F.col("p_dmy") <= 0.2, "mdy").otherwise("ambiguous")
    told = values.groupBy("domain").agg(F.max("date_order").alias("declared"))
    out = fitted.withColumn("inferred", order).join(told, "domain")
    return out.select(
        "domain", "declared", "inferred", F.when(F.col("inferred") != "ambiguous", F.col("inferred") == F.col("declared")).alias("agrees"), "n_dmy_only", "n_mdy_only", "n_both",
        F.when(F.col("inferred") == "ambiguous", F.col("n_both")).otherwise(0).alias("ambiguous_values"),
    )


def p5_formats(spark: SparkSession, folder: str) -> DataFrame:
    """The fitted weight of every format in each source."""
    fitted = order_mixture(parsed(_values(spark, folder), "value"), "domain", "date_order", prior_weight=0.0)
    pairs = F.arrays_zip(F.array(*[F.lit(x) for x in FORMATS]).alias("format"), F.col("weights").alias("weight"))
    return fitted.select("domain", F.inline(pairs)).toDF("domain", "format", "weight")


QUERIES = {"p5_found": p5_found, "p5_status": p5_status, "p5_inferred": p5_inferred, "p5_formats": p5_formats}
