"""The bins of a search multiply its rows, so neither side is sent whole through the driver, however small its table looks."""

import re

from pyspark.sql import functions as F

from fieldstack.operators import search as SR
from test_first_pairs import GRANULE, REQUEST, tables


def test_the_range_join_deals_out_both_sides(spark, tmp_path):
    reqs, grans = tables(8, 30, 400)
    for name, rows, schema in (("r", reqs, REQUEST), ("g", grans, GRANULE)):      # files, so that their size is known
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
    r, g = spark.read.parquet(f"{tmp_path}/r"), spark.read.parquet(f"{tmp_path}/g")
    every = SR.search_granules(r, g, cell=1.0)
    listed = SR.search_granules(r, g, cell=1.0, max_results=5, windows=[30])
    same = SR.alike(r, g, 30, 1.0)
    for found in (every, listed, same):
        joins = re.findall(r"(\w+Join) \[tbin#\d+L, cx#\d+L, cy#\d+L, salt#\d+\]", found._jdf.queryExecution().executedPlan().toString())
        assert joins == ["SortMergeJoin"]
    cross = [(q, k) for q in reqs for k in grans if q[2] and k[2] and abs((k[2] - q[2]).days) <= 30 and k[4] <= 30
             and q[3] <= k[7] and k[5] <= q[5] and q[4] <= k[8] and k[6] <= q[6]]
    assert every.agg(F.count("*")).first()[0] == len(cross) > 50
