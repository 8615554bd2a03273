"""Tables that are stored once and read in part: value counts, chunk stacks, the granule catalogue."""

import os
import random
import uuid

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fieldstack.operators import assemble as AS
from fieldstack.operators import increments as IN
from fieldstack.operators import search as SR
from fieldstack.operators import stats as ST
from fieldstack.sinks import writers as WR
from fieldstack.sources import granule_store as GS

# ---- value counts


def pixels(spark, seed, n=400, top=300):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(3), rnd.randrange(2), rnd.choice(["B02", "B03"]), rnd.choice([0, rnd.randrange(top), 65535])) for _ in range(n)]
    return spark.createDataFrame(rows, "field_id long, time_idx int, band string, value int")


def arrive(df, path, batch):
    df.withColumn("batch", F.lit(batch)).write.mode("append").partitionBy("batch").parquet(path)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def same_as_whole(store, whole):
    counts = store.counts()
    assert rows(IN.stats_of_counts(counts)) == rows(ST.band_stats(whole))
    assert rows(IN.percentiles_of_counts(counts)) == rows(ST.band_percentiles(whole))
    assert rows(IN.histogram_of_counts(counts)) == rows(ST.band_histogram(whole))


def test_counts_of_batches_are_those_of_the_whole(spark, tmp_path):
    src, store = str(tmp_path / "px"), IN.BandCounts(spark, str(tmp_path / "counts"), every=3, fan=2)
    assert store.counted() == -1 and store.counts().count() == 0
    whole = None
    for b in range(9):
        df = pixels(spark, b)
        whole = df if whole is None else whole.unionByName(df)
        arrive(df, src, b)
        assert store.update(src) == [b]
    assert store.update(src) == [] and store.counted() == 8
    same_as_whole(store, whole)
    assert len(store.table.partitions()) <= 3 + 2 * 4


def test_counted_pixels_are_not_read_again(spark, tmp_path):
    src, store = str(tmp_path / "px"), IN.BandCounts(spark, str(tmp_path / "counts"))
    arrive(pixels(spark, 1), src, 0)
    store.update(src)
    before = rows(store.counts())
    arrive(pixels(spark, 2), src, 0)        # against the rule: what was counted stays so, because it isn't looked at
    assert store.update(src) == [] and rows(store.counts()) == before
    arrive(pixels(spark, 3).limit(0), src, 5)
    plan = spark.read.parquet(src).where(F.col("batch").between(3, 3))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch" in plan


@pytest.mark.parametrize("wrote", [False, True])
def test_interrupted_update(spark, tmp_path, wrote):
    """A stopped update leaves no folder or one without its mark; the next one repeats it up to the same batch, then goes on."""
    src, store = str(tmp_path / "px"), IN.BandCounts(spark, str(tmp_path / "counts"))
    parts = [pixels(spark, b) for b in range(5)]
    arrive(parts[0], src, 0)
    store.update(src)
    for b in (1, 2):
        arrive(parts[b], src, b)
    if wrote:
        store.table.write(IN.merge_counts(IN.band_counts(parts[1])), 2)
        os.replace(tmp_path / "counts" / "tail-0" / "epoch=2" / "_SUCCESS", tmp_path / "mark")
    assert store.counted() == 0
    same_as_whole(store, parts[0])          # a reader in between sees the last whole state
    for b in (3, 4):
        arrive(parts[b], src, b)
    assert store.update(src) == [1, 2, 3, 4]
    same_as_whole(store, parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(parts[4]))


def test_counts_of_chunks_and_large_sums(spark):
    chunk = spark.createDataFrame([(1, 0, "B02", [5, 5, None, 7]), (1, 0, "B02", [])], "field_id long, time_idx int, band string, values array<int>")
    assert sorted((r.value if r.value is not None else -1, r.n) for r in IN.band_counts(chunk).collect()) == [(-1, 1), (5, 2), (7, 1)]
    many = spark.createDataFrame([(1, 0, "B02", 65535, 6 * 10**12), (1, 0, "B02", 65533, 6 * 10**12)], IN.SCHEMA)
    r = IN.stats_of_counts(many).first()
    assert (r.n, r["mean"], r["std"]) == (12 * 10**12, 65534.0, 1.0)


# ---- chunk stacks

LABELS = ["t0_B02", "t0_B03"]


def wide(spark, n_fields=6, side=16, chunk=4):
    rows = [(f, r, c, [f * 10_000 + (r * chunk + i // chunk) * 100 + c * chunk + i % chunk for i in range(chunk * chunk)], [7] * chunk * chunk)
            for f in range(n_fields) for r in range(side) for c in range(side)]
    return spark.createDataFrame(rows, "field_id long, crow long, ccol long, t0_B02 array<int>, t0_B03 array<int>")


def test_window_of_a_chunk_stack(spark, tmp_path):
    path = str(tmp_path / "stack")
    WR.write_chunk_stack(wide(spark), path, 4, n_buckets=2)
    got = AS.read_window(spark, path, 4, (5, 9), (30, 33), LABELS)
    want = {(f, r, c, f * 10_000 + r * 100 + c, 7) for f in range(6) for r in range(5, 10) for c in range(30, 34)}
    assert {tuple(r) for r in got.select("field_id", "row", "col", *LABELS).collect()} == want and got.count() == len(want)
    assert AS.read_window(spark, path, 4, (64, 70), (0, 3), LABELS).count() == 0
    assert AS.read_window(spark, path, 4, (0, 63), (0, 63), ["t0_B03"], [3], 2).count() == 64 * 64


def test_window_reads_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "stack")
    WR.write_chunk_stack(wide(spark, n_fields=2, side=64, chunk=4).coalesce(1), path, 4, n_buckets=1, group_bytes=64 << 10)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")      # pushed filters in full
    plan = AS.read_window(spark, path, 4, (5, 9), (30, 33), ["t0_B02"], [1], 1)._jdf.queryExecution().executedPlan().toString()
    for part in ("GreaterThanOrEqual(row_last,5)", "LessThanOrEqual(row_first,9)", "GreaterThanOrEqual(col_last,30)",
                 "LessThanOrEqual(col_first,33)", "PartitionFilters: [isnotnull(bucket"):
        assert part in plan, part
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "t0_B03" not in plan
    groups = met = 0
    for folder, _, names in os.walk(path):
        for name in (n for n in names if n.endswith(".parquet")):
            meta = pq.ParquetFile(os.path.join(folder, name)).metadata
            at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
            for g in range(meta.num_row_groups):
                s = {c: meta.row_group(g).column(at[c]).statistics for c in ("field_id", "row_first", "row_last", "col_first", "col_last")}
                groups += 1
                met += (s["field_id"].min <= 1 <= s["field_id"].max and s["row_last"].max >= 5 and s["row_first"].min <= 9
                        and s["col_last"].max >= 30 and s["col_first"].min <= 33)
    assert groups >= 8 and met <= groups // 4, (groups, met)


# ---- granule catalogue

LAYOUT = GS.Layout(cell=1.0, bin_days=20, slab_bins=2, block_cells=12, buckets=4)


def world(spark, seed, n_granules=1500, n_requests=120):
    rnd = random.Random(seed)
    g = []
    for i in range(n_granules):
        w, s = rnd.uniform(-12, 12), rnd.uniform(-8, 8)
        g.append((i, f"g{i:04d}", rnd.randrange(200), rnd.randrange(101), w, s, w + rnd.choice([0.0, 1.0, 2.5]), s + rnd.choice([0.3, 1.0])))
    gran = spark.createDataFrame(g, "granule_key long, granule_id string, d int, cloud_pct int, west double, south double, east double, north double")
    gran = gran.withColumn("acquired", F.date_add(F.lit("1969-10-01").cast("date"), F.col("d"))).withColumn(
        "acquired_at", F.col("acquired").cast("timestamp_ntz")).drop("d")
    r = []
    for i in range(n_requests):
        w, s = (0.2, 0.2) if i % 3 == 0 else (rnd.uniform(-12, 12), rnd.uniform(-8, 8))      # a third in one place
        r.append((i, 0, 100 if i % 3 == 0 else rnd.randrange(200), w, s, w + 0.4, s + rnd.choice([0.0, 1.7])))
    req = spark.createDataFrame(r, "polygon_number long, time_idx int, d int, west double, south double, east double, north double")
    return req.withColumn("t_date", F.date_add(F.lit("1969-10-01").cast("date"), F.col("d"))).drop("d"), gran


@pytest.fixture
def stored(spark, tmp_path):
    def make(gran):
        name = f"catalogue_{uuid.uuid4().hex}"
        GS.write_catalogue(gran, name, LAYOUT, str(tmp_path / name))
        return name
    return make


@pytest.mark.parametrize("hot", [None, 5, 1_000_000])
def test_stored_search_is_the_search(spark, stored, hot):
    req, gran = world(spark, 4)
    name = stored(gran)
    got = GS.search_catalogue(req, spark, name, LAYOUT, window_days=30, hot_key_rows=hot)
    want = SR.search_granules(req, gran, window_days=30)
    assert got.columns == want.columns and rows(got) == rows(want) and got.count() > 50
    assert rows(GS.search_catalogue(req, spark, name, LAYOUT, window_days=7, cloud_max=60, hot_key_rows=hot)) == rows(
        SR.search_granules(req, gran, window_days=7, cloud_max=60))


def test_granules_are_pruned_and_not_shuffled(spark, stored):
    req, gran = world(spark, 5)
    name = stored(gran)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = req.where("west < -6")
        df = GS.search_catalogue(few, spark, name, LAYOUT, hot_key_rows=None)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in plan and "SortMergeJoin" in plan
        # from the catalogue's scan up to the join there is a sort at the most
        lines = plan.split("\n")
        scan = next(i for i, x in enumerate(lines) if "FileScan parquet" in x and "granule_key" in x)
        join = max(i for i, x in enumerate(lines[:scan]) if "SortMergeJoin" in x)
        side = [x for x in lines[join:scan] if "Exchange" in x and "Broadcast" not in x]
        assert len(side) == 1 and "REPARTITION_BY_NUM" in side[0], plan      # the requests' own
        assert rows(df) == rows(SR.search_granules(few, gran))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_empty_and_odd_catalogues(spark, stored):
    req, gran = world(spark, 6, 20, 10)
    assert GS.search_catalogue(req, spark, stored(gran.limit(0)), LAYOUT).count() == 0
    assert GS.search_catalogue(req.limit(0), spark, stored(gran), LAYOUT).count() == 0
    odd = gran.withColumn("acquired", F.when(F.col("granule_key") > 5, F.col("acquired"))).withColumn(
        "west", F.when(F.col("granule_key") != 9, F.col("west")))
    assert rows(GS.search_catalogue(req, spark, stored(odd), LAYOUT)) == rows(
        SR.search_granules(req, gran.where("granule_key > 5 and granule_key <> 9")))
    with pytest.raises(ValueError):
        GS.search_catalogue(req, spark, "any", LAYOUT, cloud_min=50, cloud_max=10)
