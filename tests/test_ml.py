import datetime as dt
import math
import random
import statistics

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from aerolith.ml import boosting, encoding, features, importance, metrics, models, runs, training, trees
from aerolith.operators import gold, ranking
from aerolith.session import materialise
from aerolith.sources import tables
from tests.conftest import rows_of

FEATURE_SCHEMA = (
    "flight_key string, flight_date date, year int, month int, hour int, day_of_week tinyint, "
    "season string, carrier string, origin string, dest string, route string, dep_delay double, "
    "arr_delay double, is_delayed_15 tinyint"
)


def feature_rows(n, seed=1, routes=70):
    """Delays that follow the departure delay and the carrier, plus noise."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        day = dt.date(2018, 1, 1) + dt.timedelta(days=i // 4)
        carrier = rng.choice(["AA", "BB", "CC"])
        dep = float(rng.randrange(-10, 60))
        arr = dep + {"AA": 0.0, "BB": 10.0, "CC": 20.0}[carrier] + rng.gauss(0, 3)
        route = f"R{min(int(rng.expovariate(0.05)), routes)}"
        rows.append(
            (
                f"k{i:05d}", day, day.year, day.month, rng.randrange(24), day.isoweekday(), "winter",
                carrier, "JFK", "LAX", route, dep, arr, int(arr > 15.0),
            )
        )
    return rows


@pytest.fixture(scope="module")
def feature_df(spark):
    return materialise(spark.createDataFrame(feature_rows(600), FEATURE_SCHEMA).repartition(4))


@pytest.fixture(scope="module")
def parts(feature_df):
    return ranking.time_split(feature_df)


def test_medians_match_python(spark):
    rng = random.Random(4)
    columns = {name: [rng.choice([None, *range(20)]) for _ in range(101)] for name in "abc"}
    columns["d"] = [7] * 101  # one value holds everything
    columns["e"] = [i if i < 2 else None for i in range(101)]
    df = spark.createDataFrame(list(zip(*columns.values())), "a int, b int, c int, d int, e int")
    got = {row["column"]: row["median"] for row in encoding.medians(df, list(columns)).collect()}
    assert got == {
        name: statistics.median(v for v in values if v is not None) for name, values in columns.items()
    }


def test_modes_and_slots(spark):
    values = ["b"] * 5 + ["a"] * 5 + [f"v{i:02d}" for i in range(60)] + [None] * 9
    df = spark.createDataFrame([(v, "x") for v in values], "many string, one string")
    categories = encoding.ranked_categories(df, ["many", "one"])
    assert rows_of(encoding.modes(categories)) == [("many", "a"), ("one", "x")]
    slots = {(r["column"], r.value): r.slot for r in encoding.one_hot_slots(categories).collect()}
    assert slots["one", "x"] == "x"
    kept = [value for (column, value), slot in slots.items() if column == "many" and slot == value]
    assert sorted(kept) == ["a", "b", *[f"v{i:02d}" for i in range(47)]]
    assert slots["many", "v47"] == slots["many", "v59"] == encoding.RARE


@pytest.mark.parametrize("distinct, rare", [(50, False), (51, True)])
def test_rare_slot_needs_more_than_fifty_values(spark, distinct, rare):
    df = spark.createDataFrame([(f"v{i}",) for i in range(distinct)], "c string")
    slots = encoding.one_hot_slots(encoding.ranked_categories(df, ["c"])).collect()
    assert (encoding.RARE in {row.slot for row in slots}) == rare
    assert len({row.slot for row in slots}) == 50


def test_encoder_tells_rare_from_unseen(spark, parts, tmp_path):
    train, _ = parts
    encoder = encoding.FeatureEncoder.fit(train)
    rare = encoder.known.filter("column = 'route'").first().value
    base = train.limit(1).drop("route", "carrier")
    probe = base.crossJoin(
        spark.createDataFrame([(rare, None), ("R0", "ZZ"), ("never", "AA")], "route string, carrier string")
    )
    again = encoding.FeatureEncoder.load(spark, _saved(encoder, tmp_path))
    for one in (encoder, again):
        got = rows_of(one.prepare(probe), "route", "route_slot", "carrier_slot")
        assert got == sorted(
            [
                (rare, encoding.RARE, encoder.modes["carrier"]),
                ("R0", "R0", None),
                ("never", None, "AA"),
            ],
            key=repr,
        )


def _saved(encoder, tmp_path):
    path = str(tmp_path / "encoder")
    encoder.save(path)
    return path


def test_least_squares_matches_numpy(parts):
    train, test = (materialise(part) for part in parts)
    encoder = encoding.FeatureEncoder.fit(train)
    model = models.DelayModel.fit(
        "linear_regression", encoder.prepare(train), encoder, train_rows=train.count()
    )

    def design(part):
        rows = encoder.prepare(part).orderBy("flight_key").collect()
        matrix = [
            [float(row[name]) for name in features.NUMERIC_FEATURES]
            + [
                float(row[f"{name}_slot"] == slot)
                for name in features.CATEGORICAL_FEATURES
                for slot in encoder.slots[name]
            ]
            for row in rows
        ]
        return np.array(matrix), np.array([row.arr_delay for row in rows])

    x, y = design(train)
    weights = np.linalg.lstsq(x - x.mean(0), y - y.mean(), rcond=None)[0]
    expected = (design(test)[0] - x.mean(0)) @ weights + y.mean()
    got = [row.predicted for row in model.score(test).orderBy("flight_key").collect()]
    off = np.abs(np.array(got) - expected)
    assert np.median(off) < 1e-3 and off.max() < 2e-2  # most off for values never seen in training


def test_regression_metrics(spark):
    rows = [(1.0, 2.0), (2.0, 2.0), (4.0, 1.0)]
    df = spark.createDataFrame(rows, "actual double, predicted double")
    row = metrics.regression_metrics(df).first()
    assert row.mae == pytest.approx(4 / 3)
    assert row.rmse == pytest.approx(math.sqrt(10 / 3))
    assert row.r2 == pytest.approx(1 - 10 / (14 / 3))
    flat = df.withColumn("actual", F.lit(2.0))
    assert metrics.regression_metrics(flat).first().r2 == 0.0
    assert metrics.regression_metrics(flat.withColumn("predicted", F.lit(2.0))).first().r2 == 1.0


@pytest.mark.parametrize("levels", [3, 50, 100_000])
def test_classification_metrics_match_brute_force(spark, levels):
    rng = random.Random(levels)
    data = [(rng.randrange(2), rng.randrange(levels) / levels) for _ in range(400)]
    data += [(i % 2, 0.25) for i in range(200)]  # a third of the rows share one score
    pos = [p for y, p in data if y]
    neg = [p for y, p in data if not y]
    auc = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / len(pos) / len(neg)
    precision, seen = 0.0, 0
    for score in sorted({p for _, p in data}, reverse=True):
        at = sum(p == score for p in pos)
        seen += at
        above = seen + sum(q >= score for q in neg)
        precision += at / len(pos) * seen / above
    tp, called = sum(p >= 0.5 for p in pos), sum(p >= 0.5 for _, p in data)
    df = spark.createDataFrame(data, "actual int, probability double").repartition(5)
    row = metrics.classification_metrics(df).first()
    assert row.roc_auc == pytest.approx(auc)
    assert row.pr_auc == pytest.approx(precision)
    assert row.f1 == pytest.approx(2 * tp / (called + len(pos)))


def test_one_class_only(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "actual int, probability double")
    assert tuple(metrics.classification_metrics(df).first()) == (None, 0.0, 0.0)


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(0.5,), (0.49,), (1.0,)], "p double").coalesce(1)
    assert [r[0] for r in df.select(metrics.predicted_label(F.col("p"))).collect()] == [1, 0, 1]


def test_blocks_stay_small_and_all_rows_take_part(spark, feature_df, monkeypatch):
    assert [importance.block_digits(n) for n in (0, 4096, 4097, 65_536, 65_537)] == [0, 0, 1, 1, 2]
    seen = []

    def rule(rows):
        seen.append(rows.groupBy("feature", "places").agg(F.count("*").alias("n"), F.sum("dep_delay").alias("s")))
        return rows.withColumn("predicted", F.col("dep_delay"))

    monkeypatch.setattr(importance, "BLOCK_ROWS", 50)
    got = importance.permutation_importance(rule, feature_df, "arr_delay").collect()
    per_trial = seen[0].collect()
    total = feature_df.agg(F.sum("dep_delay")).first()[0]
    assert len(per_trial) == 51 and {(r.n, r.s) for r in per_trial} == {(600, total)}
    assert got[0].feature == "dep_delay" and got[0].importance > 1.0
    assert all(row.importance == 0.0 for row in got[1:])
    assert importance.permutation_importance(rule, feature_df.limit(0), "arr_delay").count() == 0


def test_importance_finds_what_matters(parts):
    train, test = parts
    encoder = encoding.FeatureEncoder.fit(train)
    model = models.DelayModel.fit(
        "linear_regression", encoder.prepare(train), encoder, train_rows=train.count()
    )
    got = importance.permutation_importance(model.score, test, model.target).collect()
    assert [row.feature for row in got[:2]] == ["dep_delay", "carrier"]
    assert {row.feature for row in got} == set(features.FEATURES)
    assert got[0].importance > 1.0
    constant = {row.feature: row.importance for row in got}
    assert constant["origin"] == pytest.approx(0.0) and constant["season"] == pytest.approx(0.0)


def test_training_runs(spark, feature_df, folder):
    path, runs_path = folder("features"), folder("runs")
    tables.overwrite_table(feature_df, path, ("year", "month"))
    logged = training.train_regression(spark, path, runs_path, rounds=5, max_rows=100)
    assert logged.count() == 2
    training.train_classification(spark, path, runs_path, rounds=5, max_rows=300)
    everything = {row.run_name: row for row in runs.read_runs(spark, runs_path).collect()}
    assert set(everything) == {
        "regression_linear_regression",
        "regression_hgb_regressor",
        "classification_logistic_regression",
        "classification_gb_classifier",
    }
    linear = everything["regression_linear_regression"]
    assert linear.params["ml_max_rows"] == "all"  # regression is never bounded
    assert (linear.params["train_rows"], linear.params["test_rows"]) == ("480", "120")
    assert linear.metrics["r2"] > 0.9
    logistic = everything["classification_logistic_regression"]
    assert (logistic.params["ml_max_rows"], logistic.params["train_rows"]) == ("300", "300")
    assert logistic.params["test_rows"] == "120"
    assert logistic.params["threshold_minutes"] == "15"
    assert logistic.metrics["roc_auc"] > 0.95
    assert everything["classification_gb_classifier"].metrics["roc_auc"] > 0.9

    model = models.DelayModel.load(spark, linear.model_path, "arr_delay")
    assert model.score(feature_df).filter("predicted IS NULL").isEmpty()
    lineage = runs.feature_lineage(spark, runs_path, path)
    assert lineage.filter("features_committed_at IS NOT NULL AND feature_table_version = 0").count() == 4


def test_no_default_cap_and_the_version_asked_for(spark, folder):
    path = folder("features")
    base = spark.createDataFrame(feature_rows(20), FEATURE_SCHEMA)
    many = base.crossJoin(spark.range(15_100)).withColumn("flight_key", F.concat("flight_key", F.lit("-"), "id")).drop("id")
    tables.overwrite_table(base, path, ("year", "month"))
    tables.overwrite_table(many, path, ("year", "month"))
    old, new = (features.load_features(spark, path, v).count() for v in (0, None))
    assert (old, new) == (20, 302_000)
    train, test = ranking.time_split(features.load_features(spark, path))
    assert train.count() + test.count() == 302_000


def test_boosted_rounds_end_early_on_many_rows(spark, feature_df):
    assert models.boosted_regressor(10_001, 100).isSet("validationIndicatorCol")
    assert not models.boosted_regressor(10_000, 100).isSet("validationIndicatorCol")


def test_stacked_columns_go_by_name(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([(2.5, "y")], "v double, k string")
    assert rows_of(gold.union_relaxed(a, b)) == [("x", 1.0), ("y", 2.5)]
    with pytest.raises(ValueError, match="differ"):
        gold.union_relaxed(a, a.withColumnRenamed("v", "w"))


def test_analytics_equals_stacked_aggregates_with_null_dimensions(spark, feature_df):
    holes = feature_df.withColumn("carrier", F.when(F.col("carrier") != "AA", F.col("carrier")))
    stacked = gold.union_relaxed(*[gold.delay_by(holes, kind) for kind in gold.METRIC_DIMENSIONS])
    rounded = [F.round(c, 9) for c in ("avg_arr_delay", "avg_dep_delay", "share_delayed_15")]
    columns = ("metric_type", "metric_key", "flights_cnt", *rounded)
    got = rows_of(gold.analytics(holes), *columns)
    assert got == rows_of(stacked, *columns)
    assert ("carrier", None) in {row[:2] for row in got}


def test_feature_frame_fills_and_prunes(spark, feature_df):
    silver = feature_df.withColumns({"day_of_month": F.lit(1), "flight_num": F.lit("1")})
    holes = silver.withColumns(
        {name: F.lit(None).cast("string") for name in ("carrier", "origin", "dest", "route")}
        | {"dep_delay": F.lit(None).cast("double")}
    ).limit(1)
    row = gold.feature_frame(holes).first()
    assert (row.carrier, row.origin, row.dest, row.route) == ("UNK", "UNK", "UNK", "UNK_UNK")
    assert row.dep_delay == 0.0
    assert gold.feature_frame(silver).columns == list(gold.FEATURE_COLUMNS)
    assert gold.feature_frame(silver.withColumn("arr_delay", F.lit(None).cast("double"))).isEmpty()


def test_training_rows_are_dealt_to_more_tasks(feature_df, monkeypatch):
    """However many rows a scan split holds, a task learns from a bounded number of them."""
    parts, fit = [], models.Pipeline.fit

    def watched(pipeline, data):
        parts.append(data.rdd.getNumPartitions())
        return fit(pipeline, data)

    monkeypatch.setattr(models.Pipeline, "fit", watched)
    monkeypatch.setattr(models, "TASK_ROWS", 20, raising=False)
    rows = feature_df.coalesce(1)
    encoder = encoding.FeatureEncoder.fit(rows)
    prepared = materialise(encoder.prepare(rows))
    n = prepared.count()
    models.DelayModel.fit("gb_classifier", prepared, encoder, train_rows=n, rounds=1)
    assert parts == [-(-n // 20)]


def test_importance_of_prepared_rows_looks_up_no_slot_again(spark, feature_df, folder, monkeypatch):
    """Test rows are prepared once; their shuffled copies are scored as they are, with the same result."""
    train, test = ranking.time_split(feature_df)
    encoder = encoding.FeatureEncoder.fit(train)
    assert encoding.RARE in encoder.slots["route"]
    model = models.DelayModel.fit("linear_regression", encoder.prepare(train), encoder, train_rows=train.count())
    prepared = materialise(encoder.prepare(test))
    again = importance.permutation_importance(model.score, prepared.select(test.columns), model.target).collect()
    once = importance.permutation_importance(model.score_prepared, prepared, model.target).collect()
    assert {r.feature for r in once} == set(features.FEATURES)
    wanted = {r.feature: r.importance for r in again}
    assert {r.feature: r.importance for r in once} == pytest.approx(wanted, abs=1e-12)
    assert abs(wanted["route"]) > 0

    path, calls, prepare = folder("features"), [], encoding.FeatureEncoder.prepare
    tables.overwrite_table(feature_df, path, ("year", "month"))
    monkeypatch.setattr(encoding.FeatureEncoder, "prepare", lambda *a: calls.append(a) or prepare(*a))
    logged = training.train(spark, path, folder("runs"), models=["linear_regression"], experiment="once")
    assert logged.count() == 1 and len(calls) == 2  # training rows, test rows


def _spark_boosting(estimator, prepared, encoder):
    """Predictions of Spark's own boosting with the same settings."""
    own = (GBTRegressor if isinstance(estimator, GBTRegressor) else GBTClassifier)()
    for param, value in estimator.extractParamMap().items():
        if estimator.isSet(param):
            own.set(own.getParam(param.name), value)
    return Pipeline(stages=[*encoder.vector_stages(), own]).fit(prepared).transform(prepared)


@pytest.mark.parametrize("held", [0, 131_072])
@pytest.mark.parametrize("name", ["hgb_regressor", "gb_classifier"])
def test_boosting_gives_the_trees_of_spark(spark, feature_df, monkeypatch, name, held, tmp_path):
    """With few values per column, where Spark samples nothing; counted by tasks and by the driver."""
    monkeypatch.setattr(boosting, "HELD_ROWS", held)
    monkeypatch.setattr(boosting, "REBASE_ROUNDS", 2)
    monkeypatch.setattr(models, "EARLY_STOP_ROWS", 100)
    encoder = encoding.FeatureEncoder.fit(feature_df)
    prepared = materialise(encoder.prepare(feature_df))
    n = prepared.count()
    model = models.DelayModel.fit(name, prepared, encoder, train_rows=n, rounds=5)
    watching = F.pmod(F.xxhash64(F.lit(models.SEED), *features.FEATURES, model.target), F.lit(10)) == 0
    rows = prepared.withColumns({models.WATCHING: watching, model.target: F.col(model.target).cast("double")})
    estimator = (models.REGRESSORS | models.CLASSIFIERS)[name](n, 5)
    wanted = _spark_boosting(estimator, rows, encoder).select("flight_key", F.col("prediction").alias("wanted"))
    wanted = {r.flight_key: r.wanted for r in wanted.collect()}
    got = {r.flight_key: float(r.predicted) for r in model.score_prepared(prepared).collect()}
    assert got == pytest.approx(wanted, abs=1e-9) and len(set(got.values())) > 1
    model.save(str(tmp_path / "model"))
    again = models.DelayModel.load(spark, str(tmp_path / "model"), model.target)
    assert {r.flight_key: float(r.predicted) for r in again.score(feature_df).collect()} == got


def test_boosting_ends_where_watching_rows_gain_no_more(spark, feature_df, monkeypatch):
    monkeypatch.setattr(models, "EARLY_STOP_ROWS", 100)
    noise = feature_df.withColumn("arr_delay", F.rand(3))
    encoder = encoding.FeatureEncoder.fit(noise)
    prepared = materialise(encoder.prepare(noise))
    model = models.DelayModel.fit("hgb_regressor", prepared, encoder, train_rows=600, rounds=40)
    assert 1 <= model.pipeline.stages[-1].getNumTrees < 40


def test_numbers_are_split_between_values_or_even_stretches(spark):
    rows = [(float(i % 3), float(i), 7.0, None if i % 2 else 0.5) for i in range(1000)]
    df = spark.createDataFrame(rows, "few double, many double, one double, holes double").repartition(3)
    got = boosting.number_thresholds(df, ["few", "many", "one", "holes"], 10)
    assert list(got["few"]) == [0.5, 1.5] and not len(got["one"]) and not len(got["holes"])
    assert list(got["many"]) == [99.5 + 100 * i for i in range(9)]


def test_boosted_rows_stay_small():
    """A training row is a byte per feature, a label and a prediction, where Spark keeps a number per slot."""
    layout = trees.Layout(["a"], {"c": ["x", "y"]})
    n = trees.CHUNK_ROWS + 10
    batch = pa.RecordBatch.from_pydict(
        {"a": [float(i % 5) for i in range(n)], "c_slot": [("x", "y", None)[i % 3] for i in range(n)], "late": [i % 2 for i in range(n)]}
    )
    chunks = list(trees.chunks_of(iter([batch]), layout, [np.array([0.5, 2.5])], "late", None, "logistic"))
    assert [len(y) for _, y, _, _ in chunks] == [trees.CHUNK_ROWS, 10]
    bins, y, predicted, n_train = chunks[1]
    start = trees.CHUNK_ROWS
    assert bins.tolist() == [[(0, 1, 1, 2, 2)[i % 5] for i in range(start, n)], [i % 3 for i in range(start, n)]]
    assert y.tolist() == [2 * (i % 2) - 1 for i in range(start, n)] and n_train == 10
    assert bins.nbytes + y.nbytes + predicted.nbytes == 10 * (2 + 1 + 8)
    hole = pa.RecordBatch.from_pydict({"a": [None, 1.0], "c_slot": ["x", "x"], "late": [0, 1]})
    with pytest.raises(ValueError, match="Feature a"):
        list(trees.chunks_of(iter([hole]), layout, [np.array([0.5])], "late", None, "logistic"))


@pytest.mark.parametrize("name", ["linear_regression", "logistic_regression", "hgb_regressor", "gb_classifier"])
def test_importance_of_arrays_equals_that_of_scored_copies(spark, feature_df, monkeypatch, name):
    """Blocks of 50 rows, some cut by the batches in which they come; a number that is null is filled before."""
    monkeypatch.setattr(importance, "BLOCK_ROWS", 50)
    holes = feature_df.withColumn("hour", F.when(F.col("hour") > 2, F.col("hour")))
    train, test = ranking.time_split(holes, 0.4)
    encoder = encoding.FeatureEncoder.fit(train)
    model = models.DelayModel.fit(name, encoder.prepare(train), encoder, train_rows=train.count(), rounds=4)
    prepared = materialise(encoder.prepare(test))
    copies = importance.permutation_importance(model.score_prepared, prepared, model.target).collect()
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        arrays = importance.permutation_importance(None, prepared, model.target, terms=model.terms()).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    wanted = {r.feature: r.importance for r in copies}
    assert {r.feature: r.importance for r in arrays} == pytest.approx(wanted, abs=1e-12)
    assert any(wanted.values())
    nothing = importance.permutation_importance(None, prepared.limit(0), model.target, terms=model.terms())
    assert nothing.count() == 0


def test_training_scores_no_shuffled_copies(spark, feature_df, folder, monkeypatch):
    path, scored = folder("features"), []
    tables.overwrite_table(feature_df, path, ("year", "month"))
    score = models.DelayModel.score_prepared
    monkeypatch.setattr(models.DelayModel, "score_prepared", lambda *a: scored.append(a) or score(*a))
    logged = training.train(spark, path, folder("runs"), models=["gb_classifier"], experiment="arrays", rounds=1)
    assert logged.count() == 1 and len(scored) == 1  # the test rows, once
