"""Cross-checks: relational Naive Bayes vs Spark ML NaiveBayes, relational SVM vs MLlib
SVMWithSGD, accuracy vs MulticlassClassificationEvaluator."""

import random

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from revlens.operators.bayes import nb_fit, nb_scores
from revlens.operators.features import EXACT
from revlens.operators.metrics import accuracy
from revlens.operators.svm import svm_fit, svm_predict

VOCAB = [f"w{i}" for i in range(12)]


def _docs(spark, n=80, seed=7, classes=(0, 1)):
    rnd = random.Random(seed)
    rows = []
    for d in range(n):
        lab = classes[d % len(classes)]
        words = [rnd.choice(VOCAB[: 6 + 3 * (lab % 2)]) for _ in range(rnd.randint(1, 9))]
        rows.append((d, lab, words))
    return spark.createDataFrame(rows, "doc_id long, label int, words array<string>")


def _long(df):
    return (df.select("doc_id", F.explode("words").alias("term")).groupBy("doc_id", "term")
            .agg(F.count(F.lit(1)).cast("double").alias("tfidf")))


@pytest.mark.parametrize("classes", [(0, 1), (1, 2, 3, 5)])
def test_naive_bayes_matches_spark_ml(spark, classes):
    df = _docs(spark, classes=classes)
    cv = CountVectorizer(inputCol="words", outputCol="features").fit(df)
    vocab = cv.vocabulary
    ml_in = cv.transform(df).withColumn("lab", F.col("label").cast("double"))
    idx = {c: i for i, c in enumerate(sorted(classes))}
    # Spark ML wants 0..K-1 labels; map through the sorted class list
    mapping = F.create_map(*[x for c in classes for x in (F.lit(c), F.lit(float(idx[c])))])
    ml_in = ml_in.withColumn("lab", mapping[F.col("label")])
    ml = NaiveBayes(smoothing=1.0, labelCol="lab").fit(ml_in)
    model = nb_fit(_long(df), df.select("doc_id", "label"), list(classes), 1.0, EXACT)
    pri = {r.label: r.pi for r in model.priors.collect()}
    for c in classes:
        assert abs(pri[c] - ml.pi[idx[c]]) < 1e-9
    theta = {(r.label, r.term): r.theta for r in model.weights.collect()}
    for (c, t), v in theta.items():
        assert abs(v - ml.theta[idx[c], vocab.index(t)]) < 1e-9
    sc = nb_scores(model, _long(df), df.select("doc_id"))
    ours = {r.doc_id: r.prediction for r in sc.collect()}
    theirs = {r.doc_id: sorted(classes)[int(r.prediction)] for r in ml.transform(ml_in).collect()}
    assert ours == theirs


def test_accuracy_equals_evaluator(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0), (2, 0.0, 1.0), (3, 0.0, 0.0), (4, 1.0, 1.0)],
                               "doc_id long, label double, prediction double")
    a = accuracy(df).first()
    ev = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(df)
    assert a.n_test == 4 and a.n_correct == 3 and abs(a.accuracy - ev) < 1e-15


@pytest.mark.parametrize("iterations", [3, 25])
def test_svm_matches_mllib(spark, iterations):
    from pyspark.mllib.classification import SVMWithSGD
    from pyspark.mllib.regression import LabeledPoint
    from pyspark.mllib.linalg import SparseVector
    rnd = random.Random(3)
    n_feat = 8
    rows = []
    for d in range(60):
        lab = d % 2
        feats = {j: round(rnd.random() * (2 if (j % 2) == lab else 1), 3)
                 for j in rnd.sample(range(n_feat), 4)}
        rows.append((d, lab, feats))
    pts = spark.sparkContext.parallelize(
        [LabeledPoint(lab, SparseVector(n_feat, dict(sorted(f.items())))) for _, lab, f in rows], 3)
    ref = SVMWithSGD.train(pts, iterations=iterations)
    long_df = spark.createDataFrame([(d, j, v) for d, _, f in rows for j, v in f.items()],
                                    "doc_id long, term int, tfidf double")
    labels = spark.createDataFrame([(d, lab) for d, lab, _ in rows], "doc_id long, label int")
    m = svm_fit(long_df, labels, iterations=iterations)
    w = {r.term: r.w for r in m.weights.collect()}
    for j in range(n_feat):
        assert abs(w.get(j, 0.0) - ref.weights[j]) < 1e-9
    pred = {r.doc_id: r.prediction for r in svm_predict(m, long_df, labels).collect()}
    for d, lab, f in rows:
        margin = sum(ref.weights[j] * v for j, v in f.items())
        assert pred[d] == (1 if margin > 0 else 0)


def test_ml_pipeline_save_load_and_score_one(spark, tmp_dir):
    import os
    from revlens.operators.ml import dense_features, fit_review_model, load_model, save_model, score, score_one
    train = spark.createDataFrame(
        [("great tasty food", 1), ("awful cold food", 0), ("tasty great service", 1),
         ("cold awful service", 0)] * 5, "document string, label int")
    model = fit_review_model(train)
    path = os.path.join(tmp_dir, "model")
    save_model(model, path)
    again = load_model(path)
    a = [r.predicted for r in score(model, train).collect()]
    b = [r.predicted for r in score(again, train).collect()]
    assert a == b == [str(x) for x in [1, 0, 1, 0] * 5]
    assert score_one(again, "great tasty").first().predicted == "1"
    assert len(dense_features(score(again, train)).first().dense) == 6


def test_ml_pipeline_takes_any_labels(spark):
    from revlens.operators.ml import fit_review_model, score
    rows = [(f"word{c} other{c} word{c}", c) for c in (1, 2, 3, 5) for _ in range(6)]
    train = spark.createDataFrame(rows, "document string, label int")
    assert [int(r.predicted) for r in score(fit_review_model(train), train).collect()] == [c for _, c in rows]


def test_missing_predictions_count_as_wrong(spark):
    df = spark.createDataFrame([(1, 1), (0, None)], "label int, prediction int")
    a = accuracy(df).first()
    assert (a.n_test, a.n_correct, a.accuracy) == (2, 1, 0.5)
    assert accuracy(df.limit(0)).first().accuracy is None


def test_evaluator_and_correct_rows(spark):
    from revlens.operators.metrics import correct_predictions, evaluate_accuracy
    df = spark.createDataFrame([(1, 1), (0, 1), (3, 3), (5, None)], "label int, prediction int")
    assert abs(evaluate_accuracy(df) - 2 / 3) < 1e-12
    assert sorted(r.label for r in correct_predictions(df).collect()) == [1, 3]


@pytest.mark.parametrize("entries", [1_000_000, 7])
def test_svm_on_row_blocks_equals_the_relational_loop(spark, monkeypatch, entries):
    """Hashed features run on row blocks; with a smaller bound on the driver's array they run as tables."""
    from revlens.operators import svm
    from revlens.operators.features import Hashing
    rnd = random.Random(11)
    rows = [(d, d % 2, {j: rnd.random() * (3 if (j % 2) == d % 2 else 1) for j in rnd.sample(range(200), rnd.randint(1, 9))})
            for d in range(90)]
    x = spark.createDataFrame([(d, j, v) for d, _, f in rows for j, v in f.items()], "doc_id long, term int, tfidf double")
    y = spark.createDataFrame([*((d, c) for d, c, _ in rows), (900, 1)], "doc_id long, label int")  # a document without features
    monkeypatch.setattr(svm, "BLOCK_ENTRIES", entries)
    packed = svm_fit(x, y, iterations=15, hashing=Hashing("md5", 256))
    monkeypatch.setattr(svm, "DENSE_TERMS", 0)
    plain = svm_fit(x, y, iterations=15, hashing=Hashing("md5", 256))
    got, want = ({r.term: r.w for r in m.weights.collect()} for m in (packed, plain))
    assert packed.iterations == plain.iterations and set(got) == set(want)
    assert max(abs(got[t] - want[t]) for t in want) < 1e-9
    assert packed.weights.schema["term"].dataType == plain.weights.schema["term"].dataType


def test_row_blocks_keep_documents_whole(monkeypatch):
    import numpy as np
    import pyarrow as pa
    from revlens.operators import svm
    monkeypatch.setattr(svm, "BLOCK_ENTRIES", 10)
    keys = np.repeat([5, 7, 9, 11, 13], [3, 12, 1, 9, 2])
    table = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.arange(27), pa.int32()), pa.array(np.arange(27.0)),
                                        pa.array(np.where(keys % 3, 1.0, -1.0))], names=["k", "term", "x", "ys"])
    batches = [table.slice(0, 2), table.slice(2, 9), table.slice(11, 0), table.slice(11, 16)]
    docs = []
    for block in svm._pack(iter(batches)):
        begins, terms, values, signs = (np.frombuffer(c[0].as_py(), t) for c, t in zip(block.columns, ("<i8", "<i4", "<f8", "<f8")))
        assert (terms == values).all() and len(signs) == len(begins)
        docs += [p.tolist() for p in np.split(terms, begins[1:])]
    assert docs == [np.flatnonzero(keys == k).tolist() for k in (5, 7, 9, 11, 13)]


def test_linear_svc_agrees_with_the_parity_loop(spark):
    from conftest import SF_MID
    from revlens.plans.queries import QUERIES
    svc = {r.doc_id: r for r in QUERIES["linear_svc_predictions"](spark, SF_MID).collect()}
    sgd = {r.doc_id: r for r in QUERIES["svm_predict"](spark, SF_MID).collect()}
    assert set(svc) == set(sgd) and all(svc[k].label == sgd[k].label for k in sgd)
    right = [sum(r.label == r.prediction for r in rows.values()) for rows in (svc, sgd)]
    assert abs(right[0] - right[1]) <= max(3, len(sgd) // 5)
    from revlens.operators.ml import fit_review_model
    with pytest.raises(ValueError, match="classifier"):
        fit_review_model(spark.createDataFrame([("a", 1)], "document string, label int"), classifier="x")


def test_svm_early_stop_matches_mllib(spark):
    """Few separable rows: the weights settle long before the last iteration."""
    from pyspark.mllib.classification import SVMWithSGD
    from pyspark.mllib.linalg import Vectors
    from pyspark.mllib.regression import LabeledPoint
    rows = [(d, d % 2, [1.0 + d % 3, 0.5] if d % 2 else [-1.0 - d % 3, 0.25]) for d in range(8)]
    ref = SVMWithSGD.train(spark.sparkContext.parallelize([LabeledPoint(y, Vectors.dense(v)) for _, y, v in rows], 2),
                           iterations=400)
    x = spark.createDataFrame([(d, j, v[j]) for d, _, v in rows for j in (0, 1)], "doc_id long, term int, tfidf double")
    y = spark.createDataFrame([(d, c) for d, c, _ in rows], "doc_id long, label int")
    conf = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    m = svm_fit(x, y, iterations=400)
    assert m.iterations < 400
    w = {r.term: r.w for r in m.weights.collect()}
    assert all(abs(w[j] - ref.weights[j]) < 1e-9 for j in (0, 1))
    assert conf == {k: spark.conf.get(k) for k in conf}


def test_smoothing_must_be_positive(spark):
    with pytest.raises(ValueError, match="positive"):
        nb_fit(_long(_docs(spark)), _docs(spark).select("doc_id", "label"), [0, 1], 0.0)


@pytest.mark.parametrize("kind", ["bayes", "svm"])
def test_saved_models_score_alike(spark, tmp_dir, kind):
    import os
    from conftest import SF_SMALL
    from revlens.plans.pipeline import Scorer, experiment, fit_naive_bayes, fit_svm, score_texts, scorer
    e = experiment(spark, SF_SMALL)
    s = scorer(e, fit_naive_bayes(e) if kind == "bayes" else fit_svm(e, iterations=5))
    path = os.path.join(tmp_dir, kind)
    s.save(path)
    texts = spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet")).select("doc_id", "text", "source")
    rows = [sorted(map(tuple, score_texts(x, texts, "doc_id").collect())) for x in (s, Scorer.load(spark, path))]
    assert rows[0] == rows[1] and len(rows[0]) == texts.count()


def test_distinct_multi_policy(spark):
    from revlens.operators.label import labelled_reviews
    from revlens.plans.pipeline import with_distinct_lines
    lines = spark.createDataFrame([(1, "5\ta"), (2, "5\ta"), (3, "2\tb"), (4, "4\tc")], "doc_id long, line string")
    got = labelled_reviews(lines, with_distinct_lines("multi")).collect()
    assert sorted((r.doc_id, r.label) for r in got) == [(1, 5), (3, 2)]


def test_svm_by_terms_equals_the_loop_by_rows_and_sends_bits(spark, monkeypatch):
    """The driver reads one bit a row and iteration, not one number a term."""
    from pyspark.sql.classic.dataframe import DataFrame
    from revlens.operators import svm
    from revlens.operators.features import Hashing
    rnd = random.Random(4)
    rows = [(d, d % 2, {j: rnd.random() for j in rnd.sample(range(4000), 60)}) for d in range(300)]
    x = spark.createDataFrame([(d, j, v) for d, _, f in rows for j, v in f.items()], "doc_id long, term int, tfidf double")
    y = spark.createDataFrame([(d, c) for d, c, _ in rows], "doc_id long, label int")
    read, to_arrow = [], DataFrame.toArrow

    def counted(df):
        table = to_arrow(df)
        read.append(table.nbytes)
        return table

    monkeypatch.setattr(DataFrame, "toArrow", counted)
    by_terms = svm_fit(x, y, iterations=5, hashing=Hashing("md5", 4096))
    assert 0 < max(read) < 500  # 300 rows; 4000 terms
    monkeypatch.setattr(svm, "DENSE_ROWS", 0)
    by_rows = svm_fit(x, y, iterations=5, hashing=Hashing("md5", 4096))
    got, want = ({r.term: r.w for r in m.weights.collect()} for m in (by_terms, by_rows))
    assert set(got) == set(want) and max(abs(got[t] - want[t]) for t in want) < 1e-12


def test_svm_search_by_terms_is_that_of_linear_svc(spark, monkeypatch):
    """The same model as LinearSVC's, and no evaluation sends the driver a number a term."""
    import pickle

    import numpy as np
    from pyspark import RDD
    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.linalg import Vectors
    from revlens.operators import svc, svm
    from revlens.session import materialize
    n_terms, rng = 4000, np.random.default_rng(3)
    rows = [(float(rng.random() < 0.5), {int(j): float(rng.random() + 0.1) for j in rng.choice(n_terms, 60, False)})
            for _ in range(90)] + [(1.0, {})]  # a document without terms
    vectors = spark.createDataFrame([(y, Vectors.sparse(n_terms, f)) for y, f in rows], ["label", "features"])
    library = LinearSVC(maxIter=12, regParam=0.01, fitIntercept=False, standardization=False).fit(vectors)
    src = materialize(spark.createDataFrame([(d, j, x, 2 * y - 1) for d, (y, f) in enumerate(rows) for j, x in f.items()],
                                            "key long, term int, x double, ys double"))
    read, collect = [], RDD.collect

    def counted(rdd):
        told = collect(rdd)
        read.append(len(pickle.dumps(told)))
        return told

    monkeypatch.setattr(RDD, "collect", counted)
    monkeypatch.setattr(svm, "BLOCK_ENTRIES", 500)
    monkeypatch.setattr(svc, "TASK_ENTRIES", 2000)
    w = svc.svc_fit(src, n_terms, len(rows), 12, 0.01)
    want = library.coefficients.toArray()
    assert abs(want).max() > 1e-3 and abs(w - want).max() < 1e-9
    assert len(read) > 24 and max(read[:-1]) < 16_000 < 8 * n_terms  # at the end the weights, once


def test_wide_svm_is_fitted_by_terms(spark, monkeypatch, tmp_dir):
    import os
    from pyspark.ml.classification import LinearSVC
    from revlens.operators import ml
    train = spark.createDataFrame([(t, y) for t, y in (("good fine tea", 1), ("bad sour milk", 0), ("good sweet tea", 1),
                                                       ("bad old bread", 0), ("", 0))], "document string, label int")
    library = ml.fit_review_model(train, classifier="svm", iterations=3)
    want = {r.document: r.predicted for r in ml.score(library, train).collect()}
    monkeypatch.setattr(ml, "LIBRARY_TERMS", 0)
    monkeypatch.setattr(LinearSVC, "_fit", lambda *_: pytest.fail("LinearSVC sends a gradient an evaluation"))
    model = ml.fit_review_model(train, classifier="svm", iterations=3)
    path = os.path.join(tmp_dir, "svm")
    ml.save_model(model, path)
    for m in (model, ml.load_model(path)):
        assert {r.document: r.predicted for r in ml.score(m, train).collect()} == want


@pytest.mark.parametrize("entries", [1_000_000, 500])
def test_svm_matrix_takes_four_bytes_an_entry(monkeypatch, entries):
    """Chunks and blocks hold every entry once, whole terms to a block; values stand once a run."""
    import numpy as np
    import pyarrow as pa
    from revlens.operators import svm
    monkeypatch.setattr(svm, "BLOCK_ENTRIES", entries)
    rng = np.random.default_rng(5)
    idf = rng.random(40)
    pairs = np.unique(rng.integers(0, 40 * 900, 20_000))
    term, doc = pairs % 40, pairs // 40
    order = np.argsort(doc, kind="stable")
    term, doc = term[order].astype(np.int32), doc[order].astype(np.int32)
    x = idf[term] * rng.integers(1, 4, len(term)) * np.where(doc % 2, 1.0, -1.0)
    table = pa.RecordBatch.from_arrays([pa.array(term), pa.array(x), pa.array(doc)], names=["term", "x", "doc"])
    batches = [table.slice(i, 300) for i in range(0, len(term), 300)] + [table.slice(0, 0)]
    chunks = sorted(svm._deal_runs(3)(iter(batches)), key=lambda c: c.column(0)[0].as_py())
    got, size = [], 0
    for block in svm._blocks_of_runs(svm._pack_slices(iter(chunks))):
        begins, terms, heads, values, docs = block
        size += sum(c.nbytes for c in block)
        run_of_entry = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(docs))))
        term_of_run = np.repeat(terms, np.diff(np.append(begins, len(heads))))
        got += zip(term_of_run[run_of_entry].tolist(), docs.tolist(), values[run_of_entry].tolist())
        assert len(set(zip(term_of_run.tolist(), values.tolist()))) == len(heads)  # a run a value
    assert sorted(got) == sorted(zip(term.tolist(), doc.tolist(), x.tolist()))
    assert entries == 500 or size < 5 * len(term)
    blocks = [set(b[1].tolist()) for b in svm._blocks_of_runs(svm._pack_slices(iter(chunks)))]
    assert sum(map(len, blocks)) == 40 == len(set().union(*blocks)) and (entries > 500) == (len(blocks) == 3)


def test_chain_writes_counts_not_tokens(spark, monkeypatch):
    """What the segmented chain writes: no token as text, no value twice."""
    from conftest import SF_SMALL
    from revlens.operators import segment, svm
    from revlens.plans import pipeline, queries
    from revlens.session import materialize
    written = []

    def named(df, name="table"):
        written.append(name)
        return materialize(df, name)

    for module in (pipeline, svm, segment, queries):
        monkeypatch.setattr(module, "materialize", named)
    assert queries.QUERIES["chain_4neg_full_svm"](spark, SF_SMALL).count() == 1
    assert "term-counts" in written and not {"words", "tfidf", "svm-matrix", "svm-blocks"} & set(written)
