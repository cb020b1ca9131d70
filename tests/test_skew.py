"""A hot key holding a third of all rows: results stay whole and exact."""

from pyspark.sql import functions as F

from indicast.operators import harmonize as H
from indicast.operators import quality as Q


def skewed(spark, n=3000):
    hot = [("CR.1", "MDG", 2010, float(i % 97), "UIS_SDMX" if i % 3 else "UIS_API", i) for i in range(n // 3)]
    cold = [("CR.2", ["GHA", "KEN", "FRA"][i % 3], 2000 + i % 20, float(i), "UIS_API", i)
            for i in range(n - n // 3)]
    df = spark.createDataFrame(hot + cold, "INDICATOR_ID string, ISO3 string, YEAR int, VALUE double, "
                                            "SOURCE string, T int").repartition(7)
    return H.enforce_schema(df, extra_cols=["T"]), hot, cold


def test_dedup_hot_key(spark):
    df, hot, cold = skewed(spark)
    d = H.dedup_by_priority(df, ["SOURCE", "T"])
    got = {(r["INDICATOR_ID"], r["ISO3"], r["YEAR"]): (r["SOURCE"], r["T"]) for r in d.collect()}
    best_hot = min((s, t) for *_, s, t in [(r[0], r[1], r[2], r[4], r[5]) for r in hot])
    assert got[("CR.1", "MDG", 2010)] == best_hot
    assert len(got) == 1 + len({(r[0], r[1], r[2]) for r in cold})


def test_duplicates_hot_key_whole(spark):
    df, hot, cold = skewed(spark)
    flagged = Q.check_duplicates(df)
    n_hot = flagged.where(F.col("ISO3") == "MDG").count()
    assert n_hot == len(hot)
    assert flagged.count() == len(hot) + len(cold)  # every cold key repeats too


def test_drop_counters_hot_key(spark):
    df, hot, cold = skewed(spark)
    c = H.drop_counters(df).first()
    assert c["N_RAW"] == len(hot) + len(cold)
    assert c["DROPPED_DUPLICATES"] == len(hot) + len(cold) - (1 + len({(r[1], r[2]) for r in cold}))
