"""The job-level functions compose the operators as the registered queries do."""

from pyspark.sql import functions as F

from claimwise.operators import enrich as E
from claimwise.operators import rowfilters as RF
from claimwise.operators.extract import ExtractSpec, YearSlice
from claimwise.plans import commands as C
from claimwise.plans import q_decode, q_person, q_score, q_stats, standins as S
from claimwise.plans.q_enrich import AM_EVO, prescriptions
from claimwise.session import scratch_path
from claimwise.sources import readers as R
from conftest import SF0001, rows


def test_export_writes_slices_and_merge_reads_them_back(spark):
    view = prescriptions(spark, SF0001).withColumn("bezugsjahr", F.year(F.col("verordnungsdatum").cast("date")))
    root = scratch_path(spark, "export")
    out = C.export(view, ExtractSpec(year_slice=YearSlice("bezugsjahr", 1996, 1997)), AM_EVO,
                   steps=[E.RegionFromPractice()], root=root, dataset="ds", slice_col="bezugsjahr")
    back = R.read_slices(spark, f"{root}/ADB/ds/AVK_ADB_T_AM_EVO")
    assert back.count() == out.count() > 0
    merged = C.merge([back.filter("bezugsjahr = 1996"), back.filter("bezugsjahr = 1997")])
    assert merged.count() == out.count()


def test_stats_command(spark):
    slices = q_stats._slices(spark, SF0001)
    res = C.stats(slices, 1995, 2001, "outpatient", S.outpatient_cases(spark, SF0001).join(S.person_regions(spark, SF0001), "o_custkey"), S.region_lookup(spark, SF0001),
                  year="bezugsjahr", quarter="behandl_quartal", case_id="efn_id", region="kv",
                  contract_col="vertrags_id")
    assert res.overview.count() == 5 * 7 * 4
    assert res.report.count() == 7 * 4
    assert res.reference.count() == 1
    assert rows(res.regional, "kv") == rows(q_stats.regional_ratio(spark, SF0001), "kv")


def test_makedecode_command(spark):
    ids = q_decode.id_rows(spark, SF0001)
    out = scratch_path(spark, "decode")
    mapping, loss = C.makedecode(ids, q_decode.membership(spark, SF0001), q_decode.INSURERS, ["seen", "row_id"],
                                 out=out)
    back = R.read_delimited_strict(spark, out, ["h2ik", "egk_nr", "kv_nummer", "pid"])
    assert rows(back) == rows(mapping)
    assert loss.first()["n_valid"] == mapping.count()


def test_fingerprint_command(spark):
    master = q_person.base_rows(spark, SF0001)
    out = C.fingerprint(master, q_person.region_rows(spark, SF0001), q_person.diagnosis_rows(spark, SF0001),
                        q_person.drug_rows(spark, SF0001), RF.FrameMeta("ADB", "Vers_Stamm"))
    assert "pid_hash" in out.columns and out.filter(F.col("pid_hash") == "").count() == 0


def test_scores_command(spark):
    facts = q_score.diagnosis_facts(spark, SF0001)
    got = C.scores(facts, q_score.patterns(spark), 1995, 2001, S.AS_OF, insurers=q_score.INSURERS)
    assert rows(got) == rows(q_score.score_sliding(spark, SF0001))


def test_fingerprint_command_writes_versions(spark):
    from claimwise.sources import versions as V

    master = q_person.customer_rows(spark, SF0001).withColumn("bezugsjahr", F.lit(2015))
    frames = (q_person.region_rows(spark, SF0001), q_person.diagnosis_rows(spark, SF0001), q_person.drug_rows(spark, SF0001))
    out = scratch_path(spark, "master")
    first = C.fingerprint(master, *frames, out=out)
    assert rows(first, "pid", "pid_hash") == rows(C.fingerprint(master, *frames), "pid", "pid_hash")
    assert V.newest(spark, out).number == 2
    C.fingerprint(master, *frames, out=out)
    assert V.newest(spark, out).number == 2  # nothing changed
