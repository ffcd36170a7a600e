import re

import pytest
from pyspark.sql import functions as F

from textlake.functions.labels import LABEL_NAMES
from textlake.operators import evaluation, features, models, profile
from textlake.plans import jobs


@pytest.fixture(scope="module")
def toy(spark):
    rows = [
        (i, "alpha beta gamma" if i % 2 else "delta epsilon zeta", i % 2,
         "Some LOUD text!" if i % 2 else "calm text", "a title")
        for i in range(40)
    ]
    return spark.createDataFrame(
        rows, "id long, content_processed string, type int, content string, title string",
    ).cache()


def test_tfidf_drops_rare_terms(spark):
    texts = [("shared token text",)] * 10 + [("rare one",), ("rare two",)]
    df = spark.createDataFrame(texts, "content_processed string")
    terms = {row["term"] for row in features.tfidf_vocabulary(df).collect()}
    assert terms == {"shared", "token", "text", "shared token", "token text"}


def test_tfidf_rows_do_not_depend_on_partitions(spark):
    texts = ["alpha beta gamma"] * 10 + ["delta epsilon zeta"] * 10
    df = spark.createDataFrame(list(enumerate(texts)), "id int, content_processed string")
    words = features.tfidf_vocabulary(df)
    stages = features.tfidf_transformer(words)
    one = stages.transform(df.coalesce(1)).orderBy("id").collect()
    many = stages.transform(df.repartition(7)).orderBy("id").collect()
    assert [r["text_features"] for r in one] == [r["text_features"] for r in many]
    assert one[0]["text_features"].norm(2) == pytest.approx(1.0)


def test_vector_form_equals_long_form(spark, toy):
    words = features.bow_vocabulary(toy, max_features=4).cache()
    assert [r["term"] for r in words.collect()] == ["alpha", "beta", "delta", "epsilon"]
    counted = features.bow_transformer(words).transform(toy)
    entries = features.vector_entries(counted, words, ["id"], value="n")
    assert {(r["id"], r["term"], r["n"]) for r in entries.collect()} == {
        (i, term, 1.0) for i in range(40)
        for term in (("alpha", "beta") if i % 2 else ("delta", "epsilon"))}


def test_empty_vocabulary_is_an_error(spark):
    df = spark.createDataFrame([("a b",)], "content_processed string")
    with pytest.raises(ValueError, match="empty"):
        features.tfidf_transformer(features.tfidf_vocabulary(df))


def test_metadata_falls_back_to_the_other_text(spark):
    df = spark.createDataFrame([("see www.x.y 12",)], "content_processed string")
    row = features.metadata_features(df).first()
    assert (row["url_count"], row["number_count"], row["article_length"]) == (1, 1, 3)


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,), (None,)], "type int")
    weights = {r["type"]: r["weight"] for r in profile.class_weights(df).collect()}
    assert weights == {0: pytest.approx(4 / 6), 1: 2.0}
    assert profile.class_ratio(df).first()["ratio"] == 3.0
    with pytest.raises(Exception, match="no positive rows"):
        profile.class_ratio(df.filter("type = 0")).collect()


def test_evaluation_on_known_counts(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3
    df = spark.createDataFrame(pairs, "label int, prediction int")
    tables = evaluation.evaluate(df, LABEL_NAMES)
    report = {r["class"]: r for r in tables["classification_report"].collect()}
    assert report["reliable"]["recall"] == pytest.approx(5 / 7)
    assert report["fake"]["precision"] == pytest.approx(3 / 5)
    assert report["macro avg"]["f1"] == pytest.approx((10 / 12 + 6 / 8) / 2)
    assert report["weighted avg"]["support"] == 10
    assert tables["accuracy"].first()[0] == pytest.approx(0.8)
    assert tables["f1_scores"].first()["binary_f1"] == pytest.approx(0.75)


def test_evaluation_keeps_absent_classes(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    confusion = evaluation.confusion_matrix(df)
    assert sorted(map(tuple, confusion.collect())) == [
        (0, 0, 2), (0, 1, 0), (1, 0, 0), (1, 1, 0)]
    assert evaluation.f1_scores(confusion).first()["binary_f1"] == 0.0


def test_logistic_regression_learns_saves_and_explains(spark, toy, tmp_path):
    model, tables = jobs.train_logreg_job(toy, toy, max_iter=50)
    assert tables["f1_scores"].first()["macro_f1"] == 1.0
    path = models.save_model(model, str(tmp_path / "model"))
    again = models.load_model(path)
    before = models.predict(model, toy).orderBy("id").select("prediction").collect()
    assert models.predict(again, toy).orderBy("id").select("prediction").collect() == before
    assert jobs.evaluate_job(path, toy)["accuracy"].first()[0] == 1.0
    terms = model.stages[1].vocabulary
    top = models.top_terms_by_class(models.coefficient_table(spark, terms, model), 3)
    assert {r["term"] for r in top.filter("towards = 1").collect()} == {"alpha", "beta", "gamma"}
    why = models.term_contributions(toy.filter("id = 1"), model, terms, ["id"], 2)
    rows = why.orderBy("rank").collect()
    assert [r["rank"] for r in rows] == [1, 2]
    assert all(r["contribution"] > 0 for r in rows)


def test_penalty_follows_the_summed_loss():
    estimator = models.logistic_regression(200.0, C=2.0)
    assert estimator.getRegParam() == pytest.approx(1 / 400)
    assert not estimator.getStandardization()


def test_feature_sets_add_columns(spark, toy):
    model, tables = jobs.train_logreg_job(toy, toy, "metadata", max_iter=20)
    assert tables["accuracy"].first()[0] == 1.0
    assert model.stages[-1].numFeatures == 6 + 3
    with pytest.raises(ValueError, match="Unsupported feature set"):
        features.feature_stages(features.bow_transformer(features.bow_vocabulary(toy)), "images")


def test_feature_sets_compared_equal_those_trained_alone(spark, toy, monkeypatch):
    made, make = [], features.bow_vocabulary
    monkeypatch.setattr(
        jobs.features, "bow_vocabulary", lambda *args: made.append(args) or make(*args))
    rows = toy.unionByName(toy.limit(3).withColumn("type", F.lit(None).cast("int"))).unionByName(
        toy.limit(3).withColumn("content_processed", F.lit(None).cast("string")))
    compared = jobs.compare_logreg_job(rows, rows, max_iter=20)
    assert list(compared) == ["text", "metadata"] and len(made) == 1
    for name, (model, tables) in compared.items():
        alone, own = jobs.train_logreg_job(rows, rows, name, max_iter=20)
        assert model.stages[-1].coefficients.toArray() == pytest.approx(
            alone.stages[-1].coefficients.toArray(), abs=1e-9)
        assert sorted(tables["confusion_matrix"].collect()) == sorted(
            own["confusion_matrix"].collect())
        assert tables["f1_scores"].collect() == own["f1_scores"].collect()
        assert tables["predictions"].count() == 40


def test_tasks_of_a_fit_follow_the_entries(spark, toy):
    stages = features.feature_stages(
        features.bow_transformer(features.bow_vocabulary(toy)), "text")
    for parts in (1, 16):
        vectors = toy.repartition(parts)
        for stage in stages:
            vectors = stage.transform(vectors)
        assert models._in_sized_tasks(vectors).rdd.getNumPartitions() == 1
        dealt = models._in_sized_tasks(vectors, 100)
        assert dealt.rdd.getNumPartitions() == 3  # of 40 dense rows of six entries
        assert dealt.count() == 40
    assert models._in_sized_tasks(vectors.limit(0)).count() == 0


def test_boosted_trees_learn(spark, toy):
    model, tables = jobs.train_gbt_job(toy, toy, trees=2, depth=2)
    assert tables["accuracy"].first()[0] == 1.0
    assert models.predict(model, toy).count() == 40


def test_tuning_scores_every_setting(spark, toy):
    grid = {"trees": [1, 2], "depth": [1], "learning_rate": [0.1], "row_share": [1.0],
            "column_share": [0.9]}
    scores, best = jobs.tune_job(toy, grid, n_settings=2, folds=2, n_samples=60)
    assert scores.count() == 2 and scores.agg(F.min("f1")).first()[0] == 1.0
    assert best.stages[-1].numFeatures == 10 + 6
    names = models.feature_names(best, "style")
    assert len(names) == 16 and names[-6:] == features.STYLE_FEATURES


def test_wide_rows_are_not_shuffled_to_draw_them(spark, toy, monkeypatch):
    plans, store = {}, jobs._stored

    def stored(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return store(df, name)

    monkeypatch.setattr(jobs, "_stored", stored)
    monkeypatch.setattr(jobs.models, "tune_gbt", lambda drawn, *_: drawn.collect())
    drawn, threshold = {}, "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, -1)
    for most in (60, 59):
        monkeypatch.setattr(jobs, "BROADCAST_DRAWS", most)
        drawn[most] = sorted((r["id"], r["fold"], r["copies"]) for r in jobs.tune_job(
            toy, n_samples=60))
        last_join = re.search(r"(BroadcastHash|SortMerge)Join", plans["drawn"]).group(1)
        assert last_join == ("BroadcastHash" if most == 60 else "SortMerge")
    spark.conf.set(threshold, before)
    assert drawn[60] == drawn[59] and sum(n for _, _, n in drawn[60]) == 60


def test_evaluation_counts_every_class_and_refuses_nulls(spark):
    rows = [(0, 0), (1, 1), (2, 0), (2, 2), (0, 3)]
    tables = evaluation.evaluate(spark.createDataFrame(rows, "label int, prediction int"))
    assert tables["confusion_matrix"].count() == 16
    assert tables["accuracy"].first()[0] == pytest.approx(0.6)
    assert tables["predictions"].count() == 5
    assert len(tables) == 5 and set(tables) >= {"f1_scores", "predictions"}
    for bad in ([(None, 1)], [(1, None)]):
        with pytest.raises(Exception, match="contains nulls"):
            evaluation.confusion_matrix(
                spark.createDataFrame(bad, "label int, prediction int")).collect()


def test_predictions_are_made_once_for_all_tables(spark):
    seen = spark.sparkContext.accumulator(0)

    def predicted(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1)], "label int, prediction int")
    tables = evaluation.evaluate(df.mapInPandas(predicted, df.schema), LABEL_NAMES)
    assert sorted(map(tuple, tables["confusion_matrix"].collect())) == [
        (0, 0, 1), (0, 1, 1), (1, 0, 0), (1, 1, 1)]
    assert tables["classification_report"].count() == 4
    assert seen.value == 3


def test_dense_and_sparse_entries_agree(spark):
    from pyspark.ml.linalg import Vectors
    df = spark.createDataFrame(
        [(1, Vectors.dense([0.0, 2.0, 0.0])), (2, Vectors.sparse(3, [1], [2.0]))], ["id", "v"])
    rows = df.select("id", features.nonzero_entries(F.col("v")).alias("e")).collect()
    assert [[tuple(e) for e in r["e"]] for r in rows] == [[(1, 2.0)], [(1, 2.0)]]


def test_empty_articles_are_trained_on_and_models_saved(spark, toy, tmp_path):
    rows = toy.withColumn("content_processed", F.when(F.col("id") >= 2, F.col("content_processed")))
    path = str(tmp_path / "trees")
    model, tables = jobs.train_gbt_job(rows, rows, trees=1, depth=1, model_path=path)
    assert tables["predictions"].count() == 40
    assert models.load_model(path).stages[-1].getNumTrees == model.stages[-1].getNumTrees
