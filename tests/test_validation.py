"""Exact grouped AUC, walk-forward folds, models as tables of nodes."""
import datetime as dt
import random

import pytest
from conftest import SF_SMALL, D
from pyspark.sql import functions as F

from tickwise.operators.ranking import grouped_auc
from tickwise.plans import model as ML
from tickwise.plans import registry as R
from tickwise.plans import tree_table as TT
from tickwise.plans import walk_forward as WF


def slow_auc(rows):
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    if not pos or not neg:
        return None
    key = lambda s: (s != s, s if s == s else 0)
    return sum(1.0 if key(p) > key(n) else 0.5 if key(p) == key(n) else 0.0 for p in pos for n in neg) / (len(pos) * len(neg))


def test_grouped_auc_brute_force(spark):
    """Ties, one large group over all partitions, one-class groups, nulls and NaN."""
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None, "hot", "hot", "hot"]), rng.choice([rng.random(), round(rng.random(), 1), 0.5]), rng.randint(0, 1)) for _ in range(900)]
    rows += [("one", 0.1, 1), ("one", 0.2, 1), ("gap", None, 1), ("gap", 0.3, None), ("nan", float("nan"), 1), ("nan", 9.0, 0), ("nan", float("nan"), 0)]
    df = spark.createDataFrame(rows, "g string, s double, y int").repartition(6)
    got = {r["g"]: r for r in grouped_auc(df, ["g"], "s", "y").collect()}
    by = {}
    for g, s, y in rows:
        if s is not None and y is not None:
            by.setdefault(g, []).append((s, y))
    assert set(got) == set(by)
    for g, own in by.items():
        want = slow_auc(own)
        assert (got[g]["rows"], got[g]["positives"]) == (len(own), sum(y for _, y in own))
        assert got[g]["auc"] is want is None or abs(got[g]["auc"] - want) < 1e-12
    assert grouped_auc(df.filter("false"), ["g"], "s", "y").collect() == []


def test_a_large_group_is_spread(spark):
    """A group of all rows: its scores lie in many partitions, and no window holds them all."""
    own = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select(F.lit("all").alias("g"), F.xxhash64("id").alias("s"), (F.xxhash64("id", F.lit(1)) % 2 == 0).cast("int").alias("y"))
        plan = grouped_auc(df, ["g"], "s", "y")
        laid = df.repartitionByRange("g", "s").select(F.spark_partition_id().alias("p")).distinct().count()
        rows = [(r["s"], r["y"]) for r in df.collect()]
        assert laid > 4 and abs(plan.first()["auc"] - slow_auc(rows)) < 1e-12
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", own)


def dated(spark, n):
    return spark.range(n).select(F.lit("A").alias("ticker"), F.date_add(F.lit(D("2020-01-01")), F.col("id").cast("int")).alias("date"),
                                 (F.col("id") % 2).cast("int").alias("next_day_up"), F.rand(3).alias("x"))


@pytest.mark.parametrize("n, k, embargo", [(100, 3, 10), (37, 5, 0), (6, 5, 0)])
def test_folds_expand_and_do_not_touch(spark, n, k, embargo):
    bounds = WF.fold_bounds(dated(spark, n), k, embargo).orderBy("fold").collect()
    assert [b["fold"] for b in bounds] == list(range(k)) and bounds[-1]["valid_end"] == D("2020-01-01") + dt.timedelta(days=n - 1)
    for a, b in zip(bounds, bounds[1:]):
        assert b["valid_start"] == a["valid_end"] + dt.timedelta(days=1) and b["train_end"] >= a["train_end"]
    assert all((b["valid_start"] - b["train_end"]).days == embargo + 1 for b in bounds)


def test_walk_forward_trains_on_the_past_only(spark):
    seen = []

    def fit(train):
        last, rows = train.agg(F.max("date"), F.count(F.lit(1))).first()
        seen.append((last, rows))
        return lambda valid: valid.withColumns({"prediction": F.lit(1.0), "score": F.col("x"), "last": F.lit(last)})

    out = WF.walk_forward(dated(spark, 120), fit, k=4, embargo=7).cache()
    assert out.filter(F.datediff("date", "last") <= 7).count() == 0 and out.count() == 96
    got = {r["fold"]: r for r in WF.fold_metrics(out).collect()}
    assert [got[f]["train_rows"] for f in range(4)] == sorted(n for _, n in seen) == [17, 41, 65, 89]
    assert all(got[f]["valid_rows"] == 24 and got[f]["accuracy"] == 0.5 for f in range(4))
    assert WF.walk_forward(dated(spark, 30), fit, k=4, embargo=10).select("fold").distinct().count() < 4  # the first has nothing to train on
    with pytest.raises(ValueError):
        WF.walk_forward(dated(spark, 30), fit, k=2, embargo=300)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 1 and out.unpersist()


def test_walk_forward_with_a_model(spark):
    rows = R.labeled(spark, SF_SMALL).filter("ticker in ('S1', 'S2', 'S3')")
    out = WF.walk_forward(rows, WF.fit_classifier("rf", numTrees=3, maxDepth=2), k=2, embargo=30)
    assert {r["fold"] for r in out.select("fold").distinct().collect()} == {0, 1}
    assert out.filter("prediction not in (0, 1) or score not between 0 and 1").count() == 0


@pytest.mark.parametrize("kind", ["rf", "gbt"])
def test_node_table(spark, scratch, kind):
    """Every tree is a tree: one root, each inner node's children follow it and are there; leaves' rows add up."""
    res, _ = R._trained(spark, SF_SMALL, kind)
    res.model.write().save(f"{scratch}/m")
    nodes = TT.node_table(spark, f"{scratch}/m").collect()
    by = {(r["tree"], r["node"]): r for r in nodes}
    assert len({r["tree"] for r in nodes}) == (15 if kind == "rf" else 10)
    for r in nodes:
        if r["is_leaf"]:
            assert r["feature"] is None and r["threshold"] is None and r["left_node"] is None
        else:
            left, right = by[r["tree"], r["left_node"]], by[r["tree"], r["right_node"]]
            assert r["feature"] in ML.FEATURE_COLUMNS and left["rows"] + right["rows"] == r["rows"]
    rows = R.labeled(spark, SF_SMALL).limit(50).withColumn("momentum", F.when(F.col("date") < D("1996-01-01"), F.col("momentum")))
    scored = TT.score_with_table(spark, f"{scratch}/m", rows)
    assert scored.columns == [*rows.columns, "prediction", "probability_up"]
    assert scored.filter("momentum is null and (prediction is not null or probability_up is not null)").count() == 0


@pytest.mark.parametrize("n", [1, 2, 7, 60_000])
def test_selected_quartiles(spark, n, monkeypatch):
    """Exact quartiles of large and small groups, with ties, nulls and a hot value, against numpy."""
    import numpy as np

    from tickwise.operators import profile as PR
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise("b").alias("g"), F.when(F.col("id") % 11 != 5, F.xxhash64("id") / 1e15).alias("x"),
                               F.when(F.col("id") % 2 == 0, 7.0).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(50)).cast("double")).alias("y"))
    monkeypatch.setattr(PR, "SKETCH_ACCURACY", 100)
    rows = df.collect()
    for groups in ([], ["g"]):
        got = PR.summary_selected(df, ["x", "y"], groups).collect()
        for r in got:
            own = [v[r["feature"]] for v in rows if not groups or v["g"] == r["g"]]
            own = [v for v in own if v is not None]
            assert r["count"] == len(own)
            if own:
                assert np.allclose([r["min"], r["p25"], r["p50"], r["p75"], r["max"]], np.quantile(own, [0, .25, .5, .75, 1]), rtol=1e-12)


def test_profile_recomputes_changed_partitions_only(spark, scratch):
    from tickwise.plans import profile_state as PS
    from tickwise.sources import published as PB
    from tickwise.sources import sinks as SK
    feats = R.features_c2c(spark, SF_SMALL)
    path, profile = f"{scratch}/f", f"{scratch}/p"
    PB.append(SK.located(feats, 2), path, [SK.MONTH, SK.BUCKET])
    assert len(PS.refresh_profile(spark, path, profile)) == len(PB.current(spark, path).parts)
    assert PS.refresh_profile(spark, path, profile) == []
    more = feats.filter("ticker = 'S1' and date between '1997-03-01' and '1997-03-31'").withColumn("daily_return", F.lit(9.0))
    PB.append(SK.located(more, 2), path, [SK.MONTH, SK.BUCKET])
    assert [p.split("/")[0] for p in PS.refresh_profile(spark, path, profile)] == ["month=1997-03"]
    got = {r["feature"]: r["max_val"] for r in PS.feature_ranges(PS.read_profile(spark, profile)).filter("ticker = 'S1'").collect()}
    assert got["daily_return"] >= 9.0
