"""Monthly refresh as an availableNow stream."""

from portmart import schemas
from portmart.streaming.monthly import run_monthly_refresh, start_monthly_refresh
from test_jobs import arrival


def test_stream_rebuilds_only_touched_months(spark, tmp):
    land, fact, ck = f"{tmp}/landing", f"{tmp}/fact", f"{tmp}/ck"
    mk = lambda rows: spark.createDataFrame(rows, schemas.RAW_ARRIVALS)
    mk([arrival(cicid=1.0, i94mon=3.0, i94addr="NY", arrdate=20500.0, gender="M"),
        arrival(cicid=2.0, i94mon=4.0, i94addr="NY", arrdate=20530.0, gender="F")]).coalesce(1) \
        .write.mode("append").parquet(land)
    run_monthly_refresh(spark, land, fact, checkpoint=ck)
    first = sorted((r["month"], r["cic_id"]) for r in spark.read.parquet(f"{fact}/fact_immigration").collect())
    assert first == [(3.0, 1.0), (4.0, 2.0)]
    # a second file for April lands: April is rebuilt from both files, March is untouched
    mk([arrival(cicid=3.0, i94mon=4.0, i94addr="CA", arrdate=20531.0, gender="M")]).coalesce(1) \
        .write.mode("append").parquet(land)
    run_monthly_refresh(spark, land, fact, checkpoint=ck)
    second = sorted((r["month"], r["cic_id"]) for r in spark.read.parquet(f"{fact}/fact_immigration").collect())
    assert second == [(3.0, 1.0), (4.0, 2.0), (4.0, 3.0)]


def test_default_checkpoint_resumes(spark, tmp):
    # no checkpoint given: a second start of the same job finds its progress and reads nothing
    land, fact = f"{tmp}/landing2", f"{tmp}/fact2"
    spark.createDataFrame([arrival(cicid=1.0, i94mon=3.0, i94addr="NY", arrdate=20500.0, gender="M")],
                          schemas.RAW_ARRIVALS).coalesce(1).write.parquet(land)

    def rows_read():
        q = start_monthly_refresh(spark, land, fact)
        q.awaitTermination()
        return sum(p["numInputRows"] for p in q.recentProgress)

    assert rows_read() == 1
    assert rows_read() == 0
    assert [r["cic_id"] for r in spark.read.parquet(f"{fact}/fact_immigration").collect()] == [1.0]
