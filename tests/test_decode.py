"""Id decode (FIXTURES.md G9) and the exclusion list."""

import random

from pyspark.sql import functions as F

from claimwise.operators import decode as D
from conftest import rows


def test_golden_decode(spark):
    data = [("1", "12", "12", "0000001234"), ("1", "12", "12", "0000001234"), ("1", "", "12", "0000001233"),
            ("1", "34", "", "0000001233"), ("1", "", "", "0000005678"), ("1", "22", "", "0000005677")]
    ids = spark.createDataFrame([d + (i,) for i, d in enumerate(data)],
                                "h2ik string, egk_nr string, kv_nummer string, pid string, seq int")
    unwanted = spark.createDataFrame([("0000001234",), ("0000005678",)], "pid string")
    out = D.clean_ids(ids, unwanted, ["seq"])
    assert rows(out) == [("1", "", "12", "0000001233"), ("1", "22", "", "0000005677")]


def sequential(data, unwanted):
    """The original single-pass loop, for comparison."""
    seen_p, seen_e, seen_k, out = set(), set(), set(), []
    for h, e, k, p in data:
        if not h or not p:
            continue
        p = p.rjust(10, "0")
        if p in unwanted or p in seen_p:
            continue
        seen_p.add(p)
        if e and e in seen_e:
            continue
        seen_e.add(e)
        if k and k in seen_k:
            continue
        seen_k.add(k)
        out.append((h, e, "" if e else k, p))
    return sorted(out)


def test_three_passes_equal_sequential_loop(spark):
    rnd = random.Random(7)
    for _ in range(3):
        data = [(rnd.choice(["1", "2", ""]), rnd.choice(["", "e1", "e2", "e3", "e4"]),
                 rnd.choice(["", "k1", "k2", "k3"]), rnd.choice(["", "1", "2", "3", "4", "5", "6"]))
                for _ in range(80)]
        ids = spark.createDataFrame([d + (i,) for i, d in enumerate(data)],
                                    "h2ik string, egk_nr string, kv_nummer string, pid string, seq int")
        unwanted = {"0000000003"}
        un = spark.createDataFrame([(u,) for u in unwanted], "pid string")
        assert rows(D.clean_ids(ids, un, ["seq"])) == sequential(data, unwanted)


def test_outdated_card_holders(spark):
    ids = spark.createDataFrame([
        ("1", "E1", "12345"), ("1", "E1", "23456"), ("1", "E2", "34567"), ("1", "E3", "45678"),
        ("1", "E3", "56789"), ("1", "E3", "1234567890"), ("2", "E4", "11111"), ("2", "E4", "22222")],
        "h2ik string, egk_nr string, pid string")
    mem = spark.createDataFrame([
        ("1", "E1", "12345", "2010-01-01"), ("1", "E1", "23456", "2012-01-01"),
        ("1", "E3", "45678", "2011-01-01"), ("1", "E3", "56789", "2011-01-01")],
        "h2ik string, egk_nr string, k_mensch_id string, d string").withColumn("max_gueltig_bis", F.to_date("d"))
    out = D.outdated_card_holders(ids, mem, ["1"])
    # E1: earliest is 12345; E3: 1234567890 has no membership (NULL sorts first)
    got = [r[0] for r in out.collect()]
    # E1 -> 12345; E3 -> only the NULL holder 1234567890, which has 10 characters -> no padded id
    assert sorted(got) == ["0000012345"]
    mem2 = mem.filter(F.col("egk_nr") != "E3")
    got2 = sorted(r[0] for r in D.outdated_card_holders(ids, mem2, ["1"]).collect())
    # E1 -> 12345 ; E3: all NULL -> ties: 45678, 56789 (1234567890 dropped: 10 chars)
    assert got2 == ["0000012345", "0000045678", "0000056789"]


def test_loss_ratio(spark):
    a = spark.createDataFrame([(i,) for i in range(21)], "pid int")
    b = spark.createDataFrame([(i,) for i in range(20)], "pid int")
    r = D.loss_ratio(a, b).first()
    assert (r["n_input"], r["n_valid"], r["n_duplicates"], r["warn"]) == (21, 20, 1, False)
    assert abs(r["loss"] - 0.05) < 1e-12


def test_first_ranked_with_hot_key(spark):
    data = [("hot", i % 5, i) for i in range(60)] + [("cold", 3, 100), ("cold", 2, 101), ("cold", 2, 102),
                                                     ("nul", None, 200), ("nul", 1, 201)]
    df = spark.createDataFrame(data, "k string, v int, id int")
    plain = D.first_ranked(df, "k", "v")
    salted = D.first_ranked(df.repartition(7), "k", "v")
    want = sorted([("hot", 0, i) for i in range(0, 60, 5)] + [("cold", 2, 101), ("cold", 2, 102), ("nul", None, 200)],
                  key=str)
    assert sorted((tuple(r) for r in plain.collect()), key=str) == want
    assert sorted((tuple(r) for r in salted.collect()), key=str) == want


def test_all_decodings_at_once_are_those_one_by_one(spark):
    rng = random.Random(5)
    data = [(rng.choice(["1", "2", "3", ""]), rng.choice(["", "E1", "E2", "E3", "E4"]), rng.choice(["", "K1", "K2", "K3"]),
             str(10000 + rng.randrange(25)), i) for i in range(150)]
    ids = spark.createDataFrame(data, "h2ik string, egk_nr string, kv_nummer string, pid string, n int")
    members = ids.groupBy("h2ik", "egk_nr", F.col("pid").alias("k_mensch_id")).agg(F.max("n").alias("max_gueltig_bis"))
    sets = [D.Decoding("a", ("1", "2")), D.Decoding("b", ("2", "3")), D.Decoding("none", ("7",))]
    got = {}
    for r in D.decode_all(ids, members, sets, ["n"]).collect():
        got.setdefault(r.dataset, []).append(tuple(r)[1:])
    for s in sets:
        own = ids.filter(F.col("h2ik").isin(list(s.insurers)))
        alone = D.clean_ids(own, D.outdated_card_holders(ids, members, list(s.insurers)), ["n"])
        assert sorted(got.get(s.name, [])) == sorted(map(tuple, alone.collect()))
    assert len(got["a"]) >= 3 and "none" not in got
    assert D.decode_all(ids, members, [], ["n"]).count() == 0
