"""The export chain on a file stream equals the batch export."""

from pyspark.sql import functions as F

from claimwise.operators import enrich as E
from claimwise.operators import rowfilters as RF
from claimwise.operators.extract import ExtractSpec, Where, YearSlice, extract
from claimwise.plans.q_enrich import AM_EVO, prescriptions
from claimwise.session import scratch_path
from claimwise.streaming.export import start_export_stream
from conftest import SF0001, rows


def test_stream_equals_batch(spark):
    rx = prescriptions(spark, SF0001).withColumn("bezugsjahr", F.year(F.col("verordnungsdatum").cast("date")))
    src = scratch_path(spark, "stream-src")
    rx.repartition(3).write.parquet(src)
    spec = ExtractSpec(where=(Where("bezugsjahr", (1995,), ">", "NUMERIC"),),
                       year_slice=YearSlice("bezugsjahr", 1996, 2000))
    filters = [RF.RowFilter("pzn", RF.RegexStrategy("0000[0-9]{2}"), "EXCLUDE")]
    steps = [E.StaticColumn("h2ik", "1", first=True, table="am_evo"), E.RegionFromPractice(),
             E.PharmacyType(table="am_evo")]
    out = scratch_path(spark, "stream-out")
    q = start_export_stream(spark, src, spark.read.parquet(src).schema, spec, out, filters, steps, AM_EVO,
                            slice_col="bezugsjahr", checkpoint=scratch_path(spark, "stream-checkpoint"))
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    batch = E.run_chain(RF.apply_filters(extract(spark.read.parquet(src), spec), filters, AM_EVO), steps, AM_EVO)
    cols = ["h2ik", "l_orderkey", "l_linenumber", "pzn", "kv", "apo_typ", "bezugsjahr"]
    assert rows(got, *cols) == rows(batch, *cols)
    assert got.count() > 0
