"""The envelope of a degree box computes each term once for a point, and bbox_to_utm's work isn't tied to the scan's splits."""

from pyspark.sql import functions as F
from scales import SF_SMALL

from fieldstack.functions import geo as GE
from fieldstack.plans import catalog as C

BOXES = [(1, 70.0, 40.0, 70.1, 40.1, 43), (2, -3.05, -0.05, 3.05, 0.05, 31), (3, 5.9, 84.0, 6.1, 84.0, 31), (3, 5.9, 84.0, 6.1, 84.0, 31),
         (4, None, 40.0, 70.1, 40.1, 43)]


def envelopes(spark):
    df = spark.createDataFrame(BOXES, "id long, w double, s double, e double, n double, zone int")
    return GE.with_envelope(df, F.col("w"), F.col("s"), F.col("e"), F.col("n"), F.col("zone"), "env")


def test_envelope_is_that_of_the_points(spark):
    df = envelopes(spark)
    box = F.struct(F.col("w").alias("west"), F.col("s").alias("south"), F.col("e").alias("east"), F.col("n").alias("north"))
    for north in (True, False):
        both = GE.with_envelope(df.drop("env"), F.col("w"), F.col("s"), F.col("e"), F.col("n"), F.col("zone"), "env", north_hemisphere=north).select(
            "id", "env", GE.bbox_to_utm(box, F.col("zone"), north).alias("want")).collect()
        assert len(both) == len(BOXES) and all(r.env == r.want for r in both)


def test_terms_are_named_once(spark):
    text = envelopes(spark)._jdf.queryExecution().optimizedPlan().toString()
    # one for each of the latitudes along a meridian and the two ends, and three terms of the series for x
    assert text.count("SINH(") <= 2 + 3


def test_projection_is_dealt_out(spark):
    text = C.QUERIES["bbox_to_utm"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(polygon_number" in text
