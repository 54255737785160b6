"""Training pipeline, out-of-fold scores, early stopping and resumable trials against plain Python."""

import collections
import random
import statistics as st
import threading

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from roadframe.operators import boosting, training, trials
from roadframe.operators.models import describe_model, predict_proba, transform_without_classifier
from roadframe.operators.training import Moments, Part, TrainingPipeline, components_for, out_of_fold, statistics
from roadframe.session import scratch_path

NUMERIC, TEXT = ["a", "b", "const", "void", "big"], ["c", "o'd.d", "none"]


def rows(n=300, seed=1):
    r = random.Random(seed)
    out = []
    for i in range(n):
        y = int(r.random() < 0.3)
        out.append((r.choice([None, -1.0, float("nan"), 10.0 * y + r.gauss(0, 3), r.gauss(5, 2)]), r.choice([None, -1, r.randrange(50)]), 7.0, None, 1e9 + r.random(),
                    r.choice([None, "-1", "x", "x", "y", "z'q\\"]), r.choice(["u", "v", None]), None, y, i % 4, i))
    return out


SCHEMA = "a double, b long, const double, void double, big double, c string, `o'd.d` string, none string, y int, fold int, id int"


@pytest.fixture(scope="module")
def table(spark):
    path = scratch_path(spark, "training-test")
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def known(v):
    return [x for x in v if x is not None and x == x and x not in (-1, "-1")]


def test_encoding_of_every_fold(spark, table):
    pipeline = TrainingPipeline("y", NUMERIC, TEXT)
    parts = statistics(table, NUMERIC, TEXT, F.col("fold"))
    for f in range(4):
        e = pipeline.encode(sum((p for g, p in parts.items() if g != f), Part()))
        train = [r for r in rows() if r[9] != f]
        for i, c in enumerate(NUMERIC):
            x = known([r[i] for r in train])
            if not x:
                assert e.means[c] is None and e.ranges[c] is None and e.variances[c] == 0
                continue
            assert e.means[c] == pytest.approx(sum(x) / len(x), rel=1e-12) and e.ranges[c] == (min(x), max(x))
            if max(x) > min(x):
                scaled = [((v if v in known([v]) else e.means[c]) - min(x)) / (max(x) - min(x)) for v in (r[i] for r in train)]
                assert e.variances[c] == pytest.approx(st.pvariance(scaled), rel=1e-6)
        for i, c in enumerate(TEXT, 5):
            counts = collections.Counter(known([r[i] for r in train]))
            assert e.categories[c] == sorted(counts)
            if not counts:
                assert e.modes[c] is None
                continue
            assert e.modes[c] == min(counts, key=lambda v: (-counts[v], v))
            for v in sorted(counts)[1:]:
                filled = [(r[i] if r[i] in counts else e.modes[c]) == v for r in train]
                assert e.variances[f"{c}_{v}"] == pytest.approx(st.pvariance(map(float, filled)), rel=1e-9)
        assert "const" not in e.kept and "void" not in e.kept and "big" in e.kept
        # the fitted stages give those columns, on rows with values that training has not seen too
        strange = spark.createDataFrame([(None, None, None, None, None, "never seen", None, "w", 0, 0, -1)], SCHEMA)
        both = table.unionByName(strange)
        vectors = {r.id: r.encoded.toArray() for r in PipelineModel(stages=e.stages()).transform(both).select("id", "encoded").collect()}
        assert len(vectors) == 301 and all(len(v) == len(e.kept) for v in vectors.values())
        assert all(vectors[-1][e.kept.index(n)] == 0 for n in e.kept if n.startswith("c_"))
        for j, name in enumerate(e.kept):
            assert st.pvariance([float(vectors[r[10]][j]) for r in train]) == pytest.approx(e.variances[name], rel=1e-6)


def test_moments_merge_like_one_pass():
    r = random.Random(0)
    x = [1e8 + r.random() for _ in range(100)]
    pieces = [x[:1], x[1:40], [], x[40:]]
    total = sum((Moments(len(p), sum(p) / len(p), sum((v - sum(p) / len(p)) ** 2 for v in p), min(p), max(p)) if p else Moments() for p in pieces), Moments())
    assert total.n == 100 and (total.lo, total.hi) == (min(x), max(x)) and total.m2 / 100 == pytest.approx(st.pvariance(x), rel=1e-6)


def test_fit_balances_and_models_do_not(spark, table):
    pipeline = TrainingPipeline("y", NUMERIC, TEXT, "logistic_regression", {"regParam": 0.01})
    sizes = {r.y: r["count"] for r in pipeline.training_rows(table).groupBy("y").count().collect()}
    minority = sum(r[8] for r in rows())
    assert sizes == {0: minority, 1: minority}
    model = pipeline.fit(table)
    scored = predict_proba(model, table)
    assert scored.count() == 300 and "encoded" not in scored.columns and set(table.columns) <= set(scored.columns)
    path = scratch_path(spark, "saved-pipeline")
    model.write().save(path)
    again = {r.id: r.p1 for r in predict_proba(PipelineModel.load(path), table).select("id", "p1").collect()}
    assert again == {r.id: r.p1 for r in scored.select("id", "p1").collect()}
    prepared = transform_without_classifier(PipelineModel.load(path), table)
    assert "features" in prepared.columns and "probability" not in prepared.columns
    assert any(c.startswith("enc_c_") for c in describe_model(model)["inputCols"])


def test_components():
    assert [components_for(s, 0.9) for s in ([1.0], [0.5, 0.4, 0.1], [0.5, 0.45, 0.05], [0.2, 0.2])] == [1, 3, 2, 2]


def test_every_row_is_scored_by_a_model_that_has_not_seen_it(spark, table):
    pipeline = TrainingPipeline("y", NUMERIC, TEXT, "decision_tree", {"maxDepth": 3}, pca_share=None)
    scored = out_of_fold(table, "fold", pipeline)
    got = {r.id: (r.p1, r.prediction) for r in scored.select("id", "p1", "prediction").collect()}
    assert scored.count() == 300 and len(got) == 300
    (part,) = statistics(table.where("fold <> 2"), NUMERIC, TEXT).values()
    alone = pipeline.fit_encoded(table.where("fold <> 2"), pipeline.encode(part))
    for r in predict_proba(alone, table.where("fold = 2")).select("id", "p1").collect():
        assert got[r.id] == (pytest.approx(r.p1, abs=1e-9), int(r.p1 >= 0.5))


def test_folds_are_fitted_side_by_side(table):
    met, seen = threading.Barrier(4), []

    class Waiting(TrainingPipeline):
        def fit_encoded(self, df, encoding):
            met.wait(30)  # broken, if one fold is fitted after the other
            return df.agg(F.sum("fold")).first()[0]

    fitted = Waiting("y", NUMERIC, TEXT).fit_folds(table, "fold", lambda f, e, m: seen.append((f, e.means["b"], m)))
    total = sum(r[9] for r in rows())
    assert fitted == {f: total - sum(r[9] for r in rows() if r[9] == f) for f in range(4)}
    assert [f for f, _, _ in seen] == [0, 1, 2, 3] and len({m for _, m, _ in seen}) == 4


def test_large_folds_are_fitted_one_after_the_other(table, monkeypatch):
    busy, most = [], []

    class Counting(TrainingPipeline):
        def fit_encoded(self, df, encoding):
            busy.append(1)
            most.append(len(busy))
            threading.Event().wait(0.2)
            busy.pop()

    for rows_at_a_time, want in ((300, 1), (600, 2), (10**9, 4)):
        monkeypatch.setattr(training, "SIDE_BY_SIDE_ROWS", rows_at_a_time)
        most.clear()
        Counting("y", NUMERIC, TEXT).fit_folds(table, "fold")
        assert max(most) == want and len(most) == 4


def test_components_are_fitted_one_at_a_time_and_kept_off_the_disk(spark, table, monkeypatch):
    busy, most, levels, pca, made = [], [], [], training.PCA.fit, training.make_estimator

    def looking(self, df, params=None):
        busy.append(1)
        most.append(len(busy))
        levels.append(df.storageLevel)
        threading.Event().wait(0.3)
        try:
            return pca(self, df)
        finally:
            busy.pop()

    class Looking:
        def __init__(self, *a, **k):
            self.inner = made(*a, **k)

        def fit(self, df):
            levels.append(df.storageLevel)
            return self.inner.fit(df)

    monkeypatch.setattr(training.PCA, "fit", looking)
    monkeypatch.setattr(training, "make_estimator", Looking)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    TrainingPipeline("y", NUMERIC, TEXT, "decision_tree", {"maxDepth": 2}).fit_folds(table, "fold")
    assert max(most) == 1 and len(most) == 4  # the decomposition isn't safe for threads
    assert len(levels) == 8 and all(x.useMemory and not x.useDisk for x in levels)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_classifiers_read_kept_rows(spark, table, monkeypatch):
    kept, made = [], training.make_estimator

    class Looking:
        def __init__(self, *a, **k):
            self.inner = made(*a, **k)

        def fit(self, df):
            kept.append(df.storageLevel.useMemory)
            return self.inner.fit(df)

    monkeypatch.setattr(training, "make_estimator", Looking)
    for share in (0.9, None):
        TrainingPipeline("y", NUMERIC, TEXT, "decision_tree", {"maxDepth": 2}, pca_share=share).fit(table)
    assert kept == [True, True]


def test_batch_scoring_reads_kept_rows(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier

    from roadframe.plans import queries_etl, queries_ml
    kept, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, params=None: (kept.append(df.storageLevel.useMemory), fit(self, df))[1])
    users = spark.createDataFrame([(i % 2, str(i % 3), str(i % 4), 30.0 + i % 5) for i in range(60)], "grav int, lum string, atm string, vma double")
    monkeypatch.setattr(queries_etl, "user_feature_table", lambda *_: users)
    out = queries_ml.batch_scoring(spark, "").collect()
    assert kept == [True] and len(out) == 60 and all(0.5 <= r.confidence <= 1 for r in out)


def test_batch_scoring_keeps_no_rows_on_disk(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier

    from roadframe.plans import queries_etl, queries_ml
    levels, fit = [], RandomForestClassifier.fit
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, params=None: (levels.append(df.storageLevel), fit(self, df))[1])
    users = spark.createDataFrame([(i % 2, str(i % 3), str(i % 4), 30.0 + i % 5) for i in range(60)], "grav int, lum string, atm string, vma double")
    monkeypatch.setattr(queries_etl, "user_feature_table", lambda *_: users)
    assert queries_ml.batch_scoring(spark, "").count() == 60
    assert [(x.useMemory, x.useDisk) for x in levels] == [(True, False)]


def test_rounds_grow_to_all_in_three_fits():
    many, fits = 32, [32]
    while many < 300:
        many = boosting.next_rounds(many, 300)
        fits.append(many)
    assert fits == [32, 128, 300] and boosting.next_rounds(16, 40) == 40 and boosting.next_rounds(4, 40) == 16


def test_stopping_round():
    assert boosting.stopping_round([3, 2, 1, 2, 2, 2, 0], 3) == (3, 6)
    assert boosting.stopping_round([3, 2, 1, 2, 2], 3) == (3, 5)
    assert boosting.stopping_round([1, 1, 1], 5) == (1, 3) and boosting.stopping_round([2], 1) == (1, 1)
    assert boosting.stopping_round([5, 4, 3, 2, 1], 2) == (5, 5)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100, 333])
def test_exact_split(spark, n):
    df = spark.range(n).select((F.col("id") % 5).alias("x"))  # repeated rows: ties of the row hash
    got = {r.part: r["count"] for r in boosting.exact_split(df).groupBy("part").count().collect()}
    train, validation, test = boosting.split_sizes(n)
    assert got == {k: v for k, v in (("train", train), ("validation", validation), ("test", test)) if v}
    assert n != 100 or (train, validation, test) == (70, 10, 20)


def test_boosting_stops_at_the_best_round(spark):
    from pyspark.ml.feature import VectorAssembler
    r = random.Random(4)
    data = [(float(x := r.random()), float(r.random()), float((x > 0.5) != (r.random() < 0.2))) for _ in range(600)]
    df = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(spark.createDataFrame(data, "x double, z double, label double"))
    path = scratch_path(spark, "boosting-test")
    df.withColumn("part", (F.xxhash64("x") % 3 == 0)).select("part", "features", "label").write.parquet(path)
    parts = spark.read.parquet(path)
    train, validation = parts.where("NOT part").coalesce(1).persist(), parts.where("part").coalesce(1).persist()
    b = boosting.fit_early_stopped(train, validation, rounds=40, patience=5, first=4, maxDepth=3, stepSize=0.3)
    best, last = boosting.stopping_round(b.validation_loss, 5)
    assert b.chosen == best == b.model.getNumTrees and len(b.validation_loss) == len(b.train_loss) == last
    assert b.model.evaluateEachIteration(validation) == pytest.approx(b.validation_loss[:best])
    table = b.table(spark)
    assert [x["round"] for x in table.where("chosen").collect()] == [best] and table.count() == last
    few = boosting.fit_early_stopped(train, validation, rounds=2, patience=5, maxDepth=2)
    assert len(few.validation_loss) == 2


def test_a_boosted_model_is_cut_not_fitted_again(spark, monkeypatch):
    from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    r = random.Random(4)
    data = [(float(x := r.random()), float(r.random()), float((x > 0.5) != (r.random() < 0.2)), i % 3 == 0) for i in range(600)]
    df = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(spark.createDataFrame(data, "x double, z double, label double, held boolean")).coalesce(1).persist()
    train, validation = df.where("NOT held"), df.where("held")
    fits, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, d, params=None: (fits.append(self.getMaxIter()), fit(self, d))[1])
    b = boosting.fit_early_stopped(train, validation, rounds=60, patience=5, first=6, maxDepth=3, stepSize=0.1)
    assert b.chosen < fits[-1] and b.chosen == b.model.getNumTrees and fits[0] == 6 and len(fits) == 2
    again = fit(GBTClassifier(maxIter=b.chosen, seed=42, maxDepth=3, stepSize=0.1), train)
    path = scratch_path(spark, "cut-model")
    b.model.write().save(path)
    want = [tuple(x.probability) for x in again.transform(df).select("probability").collect()]
    for m in (b.model, GBTClassificationModel.load(path)):
        assert [tuple(x.probability) for x in m.transform(df).select("probability").collect()] == want
        assert m.numFeatures == 2 and m.featureImportances == again.featureImportances and m.getMaxIter() == b.chosen
        assert m.evaluateEachIteration(validation) == again.evaluateEachIteration(validation) and m.treeWeights == again.treeWeights


def test_draws():
    space = trials.RANGES["gbt"]
    drawn = [trials.draw(space, t) for t in range(200)]
    assert drawn == [trials.draw(space, t) for t in range(200)] and drawn[7] != trials.draw(space, 7, seed=1)
    assert all(space[k].holds(v) for d in drawn for k, v in d.items()) and len({d["stepSize"] for d in drawn}) == 200
    assert {d["maxDepth"] for d in drawn} == set(range(3, 11))
    logs = [trials.LogUniform(0.01, 10).draw(random.Random(i)) for i in range(2000)]
    assert 0.25 < sum(x < 0.1 for x in logs) / 2000 < 0.42 and all(0.01 <= x <= 10 for x in logs)
    assert trials.estimator_params({"C": 0.5, "colsample": 0.75, "maxIter": 60}, 200) == {"regParam": 0.01, "featureSubsetStrategy": "0.75", "maxIter": 60}


def test_models_of_a_search_share_their_balanced_rows(spark, tmp_path, monkeypatch):
    from pyspark.ml.classification import DecisionTreeClassifier

    from roadframe.operators import models
    from roadframe.plans.queries_ml import SEARCH_FOLDS, severity_model_search
    r, balanced, fitted, undersample = random.Random(3), [], [], models.undersample

    def tree(name, features, label, seed, **params):
        fitted.append(name)
        return DecisionTreeClassifier(featuresCol=features, labelCol=label, maxDepth=2, seed=seed)

    monkeypatch.setattr(models, "make_estimator", tree)
    monkeypatch.setattr(models, "undersample", lambda df, *a: balanced.append(1) or undersample(df, *a))
    docs = [(i, r.choice(["en", "de"]), r.choice(["a", "b", "c"]), r.randrange(1, 900)) for i in range(200)]
    spark.createDataFrame(docs, "doc_id long, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d[0], int(d[3] > 300), d[0] % 2) for d in docs], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    found = {(x.model, x.metric): x.value for x in severity_model_search(spark, str(tmp_path)).collect()}
    assert len(balanced) == SEARCH_FOLDS + 1  # once for each fold and once for the refits, not again for every model
    assert {n: fitted.count(n) for n in set(fitted)} == {"random_forest": 11, "logistic_regression": 11, "gbt": 11, "decision_tree": 6}
    assert len(found) == 12 and all(found[n, "cv_accuracy"] > 0.9 for n in set(fitted))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_rows_are_gathered_from_tasks_of_their_own(spark):
    from pyspark import TaskContext

    from roadframe.plans.queries_training import gathered

    def with_task(batches):
        for b in batches:
            yield b.assign(task=TaskContext.get().taskAttemptId())

    made = spark.range(0, 600, 1, 6).mapInPandas(with_task, "id long, task long")
    out = gathered(made, 600)
    assert out.rdd.getNumPartitions() == 1
    got = out.collect()
    assert sorted(r.id for r in got) == list(range(600)) and len({r.task for r in got}) == 6  # one task, if they are merged without a shuffle
    assert gathered(made, 250_000).rdd.getNumPartitions() == 3


def test_a_stopped_search_resumes_from_its_log(spark):
    log, space, seen = scratch_path(spark, "trial-log"), {"x": trials.Uniform(0, 1)}, []

    def score(params, fold):
        if len(seen) >= 7:
            raise RuntimeError("the driver dies")
        seen.append((params["x"], fold))
        return params["x"] + fold / 100

    assert trials.read_log(spark, log).count() == 0
    with pytest.raises(RuntimeError):
        trials.run_trials(spark, log, "s", space, [0, 1, 2], score, trials=6, parallel=1)
    written = {(r.trial, r.fold): r.score for r in trials.read_log(spark, log).collect()}
    assert len(written) == 6  # two whole trials
    again = []
    ran = trials.run_trials(spark, log, "s", space, [0, 1, 2], lambda p, f: again.append(f) or p["x"] + f / 100, trials=6, parallel=2)
    assert ran == len(again) == 12
    assert trials.run_trials(spark, log, "s", space, [0, 1, 2], score, trials=6) == 0
    assert trials.run_trials(spark, log, "other search", space, [0], lambda p, f: 1.0, trials=2) == 2
    # a row written twice counts once
    spark.read.parquet(log).where("trial = 0 AND search = 's'").write.mode("append").parquet(log)
    means = {r.trial: r for r in trials.trial_means(trials.read_log(spark, log)).where("search = 's'").collect()}
    assert len(means) == 6 and all(m.folds == 3 for m in means.values())
    drawn = {t: trials.draw(space, t)["x"] for t in range(6)}
    assert all(means[t].mean_score == pytest.approx(x + 0.01) for t, x in drawn.items())
    assert [t for t, m in means.items() if m.best] == [max(drawn, key=drawn.get)]
