"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables (whole tables, whole texts). The plain queries return a
lazy plan; segmentation, models and chains write their shared tables (lexicon, words, TF-IDF,
weights) while the plan is built.
Doubles are rounded to 6 digits so another engine's sums compare equal; counts are bigint.
The matching DuckDB SQL lives in ``revlens.plans.oracle`` under the same names.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revlens.functions import text as T
from revlens.operators import features as feat
from revlens.operators.clean import distinct_lines, extract_reviews, parse_lines
from revlens.operators.label import POLICIES, labelled_reviews, negatives_isin, negatives_union
from revlens.operators.metrics import (accuracy, rating_histogram, top_words, word_cloud_weights, word_counts,
                                        words_by_count)
from revlens.operators.sample import first_rows, hash_split, zip_by_key
from revlens.operators import segment as seg
from revlens.operators import stopwords
from revlens.operators.wordfind import find_words
from revlens.plans.pipeline import (Scorer, balanced, experiment, fit_naive_bayes, fit_svm, predict_test, scorer,
                                    score_texts, segmented, svm_predict_test, with_distinct_lines)
from revlens.session import ensure_checkpoint_dir, materialize
from revlens.sources.checked import checked_lines
from revlens.sources.position import first_rows_of_files, with_position, zip_by_position
from revlens.sources.tables import review_csv_rows, review_lines, table

Query = Callable[[SparkSession, str], DataFrame]
ROUND = 6
FIRST_ROWS = 100  # rows of the preview extract


def _r(c) -> F.Column:
    return F.round(c, ROUND)


def _doc_words(spark: SparkSession, sf_dir: str, tokenizer=T.words) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", tokenizer("text").alias("words"))


# -- words and counts ---------------------------------------------------------------------

def q_top_words(spark, sf_dir):
    return top_words(word_counts(_doc_words(spark, sf_dir)), 100)


def q_words_by_count(spark, sf_dir):
    return words_by_count(word_counts(_doc_words(spark, sf_dir)))


def q_word_cloud_weights(spark, sf_dir):
    w = word_cloud_weights(materialize(word_counts(_doc_words(spark, sf_dir)), "word-counts"))
    return w.select("word", "n", _r("size").alias("size"))


# -- parsing and labels -------------------------------------------------------------------

def q_extract_reviews(spark, sf_dir):
    return extract_reviews(review_csv_rows(spark, sf_dir), keep=["doc_id"])


def q_parse_reviews_jvm(spark, sf_dir):
    return parse_lines(review_lines(spark, sf_dir), reading="jvm")


def q_parse_reviews_python(spark, sf_dir):
    return parse_lines(review_lines(spark, sf_dir), reading="python")


def q_rating_histogram(spark, sf_dir):
    return rating_histogram(parse_lines(review_lines(spark, sf_dir), reading="jvm"))


def q_distinct_reviews(spark, sf_dir):
    d = distinct_lines(review_lines(spark, sf_dir))
    return parse_lines(d, reading="python").select("doc_id", "rating_txt", "document")


def q_negatives_union(spark, sf_dir):
    # one scan of the text: the filters of the union read the written parse
    r = materialize(parse_lines(review_lines(spark, sf_dir), reading="jvm"), "parsed")
    return negatives_union(r).select("doc_id", "rating", "document")


def q_negatives_isin(spark, sf_dir):
    r = parse_lines(review_lines(spark, sf_dir), reading="jvm")
    return negatives_isin(r).select("doc_id", "rating", "document")


def _label_query(policy: str) -> Query:
    def q(spark, sf_dir):
        return labelled_reviews(review_lines(spark, sf_dir), POLICIES[policy])
    q.__name__ = f"q_label_{policy}"
    return q


def _balanced_query(policy: str) -> Query:
    def q(spark, sf_dir):
        return balanced(spark, sf_dir, policy)
    q.__name__ = f"q_balanced_{policy}"
    return q


def q_first_rows(spark, sf_dir):
    r = parse_lines(review_lines(spark, sf_dir), reading="jvm")
    return first_rows(r.select("doc_id", "rating_txt", "document"), FIRST_ROWS, "doc_id")


def q_rejected_reviews(spark, sf_dir):
    """The review lines that the checked reading puts aside, with the reason."""
    lines = checked_lines(review_lines(spark, sf_dir), reading="jvm")
    return lines.filter(F.col("reason").isNotNull()).select("doc_id", "reason", "line")


def q_first_rows_of_files(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return first_rows_of_files(docs, FIRST_ROWS)


def q_zip_file_order(spark, sf_dir):
    """Ids and text lengths, read apart and zipped by their place in the files."""
    docs = table(spark, sf_dir, "documents")
    ids = with_position(docs.select("doc_id"))
    sizes = with_position(docs.select(F.length("text").cast("long").alias("size")))
    return zip_by_position(ids, sizes)


def q_train_test_split(spark, sf_dir):
    return hash_split(balanced(spark, sf_dir, "binary_drop4")).select("doc_id", "label", "split")


def q_zip_labels_features(spark, sf_dir):
    b = materialize(balanced(spark, sf_dir, "binary_drop4").select(
        "doc_id", "label", F.size(T.words("document")).cast("long").alias("n_words")), "balanced")
    lab, n_words = b.select("doc_id", "label"), b.select("doc_id", "n_words")
    return zip_by_key(lab, n_words, "doc_id")


# -- text operators -----------------------------------------------------------------------

def q_stop_words_removed(spark, sf_dir):
    d = _doc_words(spark, sf_dir, T.words_and_marks)
    kept = T.remove_stop_words("words")
    return d.select("doc_id", F.size("words").cast("long").alias("n_before"),
                    F.size(kept).cast("long").alias("n_after"),
                    F.array_join(kept, " ").alias("kept"))


COMMON_WORDS = 500  # the stop list of the next query: words seen so often, and words seen once


def q_stop_words_by_table(spark, sf_dir):
    docs = _doc_words(spark, sf_dir)
    stop = word_counts(docs).filter((F.col("n") == 1) | (F.col("n") >= COMMON_WORDS)).select("word")
    kept = stopwords.remove_stop_words(docs.withColumn("n_before", F.size("words").cast("long")), stop)
    return kept.select("doc_id", "n_before", F.size("words").cast("long").alias("n_after"),
                       F.array_join("words", " ").alias("kept"))


def q_tokens_keep_marks(spark, sf_dir):
    """Tokens that hold one of the kept marks, counted per document."""
    d = _doc_words(spark, sf_dir, T.words_keep_marks)
    t = (d.select("doc_id", *T.explode_elements("words", "token"))
         .filter(F.col("token").rlike("[@#%.&+]")))
    return t.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


def q_slash_rejoin(spark, sf_dir):
    d = _doc_words(spark, sf_dir, T.words_and_marks)
    return d.select("doc_id", F.size("words").cast("long").alias("n_before"),
                    F.size(T.slash_rejoin("words")).cast("long").alias("n_after"))


# -- features -----------------------------------------------------------------------------

def q_term_counts(spark, sf_dir):
    return feat.term_counts(_doc_words(spark, sf_dir))


def q_term_counts_hashed(spark, sf_dir):
    return feat.term_counts(_doc_words(spark, sf_dir), hashing=feat.MD5_16)


def q_idf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    i = feat.idf(feat.term_counts(_doc_words(spark, sf_dir)), docs)
    return i.select("term", "df", _r("idf").alias("idf"))


def q_tfidf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    tc = materialize(feat.term_counts(_doc_words(spark, sf_dir)), "term-counts")
    x = feat.tfidf(tc, materialize(feat.idf(tc, docs), "idf"))
    return x.select("doc_id", "term", "tf", _r("tfidf").alias("tfidf"))


# -- Naive Bayes --------------------------------------------------------------------------

def q_nb_model(spark, sf_dir):
    m = fit_naive_bayes(experiment(spark, sf_dir, "binary_drop4"))
    return m.weights.select("label", "term", _r("s").alias("s"), _r("theta").alias("theta"))


def q_nb_priors(spark, sf_dir):
    m = fit_naive_bayes(experiment(spark, sf_dir, "binary_drop4"))
    return m.priors.select("label", "n_docs", _r("pi").alias("pi"),
                           _r("log_norm").alias("log_norm"))


def q_nb_predict(spark, sf_dir):
    e = experiment(spark, sf_dir, "binary_drop4")
    return predict_test(e, fit_naive_bayes(e))


def q_nb_accuracy(spark, sf_dir):
    e = experiment(spark, sf_dir, "binary_drop4")
    a = accuracy(predict_test(e, fit_naive_bayes(e)))
    return a.select("n_test", "n_correct", _r("accuracy").alias("accuracy"))


def q_nb_accuracy_4neg(spark, sf_dir):
    e = experiment(spark, sf_dir, "binary_4neg")
    a = accuracy(predict_test(e, fit_naive_bayes(e)))
    return a.select("n_test", "n_correct", _r("accuracy").alias("accuracy"))


def q_nb_accuracy_idf_all(spark, sf_dir):
    """As the reference ran it: IDF fitted on train and test rows together."""
    e = experiment(spark, sf_dir, "binary_drop4", fit_on="all")
    a = accuracy(predict_test(e, fit_naive_bayes(e)))
    return a.select("n_test", "n_correct", _r("accuracy").alias("accuracy"))


def q_nb_multiclass_accuracy(spark, sf_dir):
    e = experiment(spark, sf_dir, "multi")
    a = accuracy(predict_test(e, fit_naive_bayes(e)))
    return a.select("n_test", "n_correct", _r("accuracy").alias("accuracy"))


def q_score_new_reviews(spark, sf_dir):
    e = experiment(spark, sf_dir, "binary_drop4")
    path = f"{ensure_checkpoint_dir(spark)}/revlens-model-{uuid.uuid4().hex}"
    scorer(e, fit_naive_bayes(e)).save(path)
    conv = table(spark, sf_dir, "conversations").select(
        F.concat_ws(":", "conv_id", "turn").alias("rid"), "conv_id", "turn", "text")
    pred = score_texts(Scorer.load(spark, path), conv, key="rid")
    return pred.select("conv_id", "turn", "prediction")


def _ml_predictions(spark, sf_dir, classifier):
    from revlens.operators.ml import fit_review_model, score
    sp = materialize(hash_split(balanced(spark, sf_dir, "binary_drop4")), "balanced")
    train = sp.filter(F.col("split") == "train").select("document", "label")
    test = sp.filter(F.col("split") == "test").select("doc_id", "document", "label")
    out = score(fit_review_model(train, classifier=classifier), test)
    return out.select("doc_id", "label", F.col("predicted").cast("int").alias("prediction"))


def q_ml_pipeline_predictions(spark, sf_dir):
    """Spark ML PipelineModel fitted on the training rows, applied to the test rows."""
    return _ml_predictions(spark, sf_dir, "bayes")


def q_linear_svc_predictions(spark, sf_dir):
    """The same pipeline with a linear SVM: the scalable route beside ``svm_predict``."""
    return _ml_predictions(spark, sf_dir, "svm")


# -- linear SVM ---------------------------------------------------------------------------

def q_svm_weights(spark, sf_dir):
    m = fit_svm(experiment(spark, sf_dir, "binary_drop4"))
    return m.weights.select("term", _r("w").alias("w"))


def q_svm_predict(spark, sf_dir):
    e = experiment(spark, sf_dir, "binary_drop4")
    return svm_predict_test(e, fit_svm(e))


def q_svm_accuracy(spark, sf_dir):
    e = experiment(spark, sf_dir, "binary_drop4")
    a = accuracy(svm_predict_test(e, fit_svm(e)))
    return a.select("n_test", "n_correct", _r("accuracy").alias("accuracy"))


# -- segmentation -------------------------------------------------------------------------

LEXICON_MIN_COUNT = 25  # lexicon of the segmentation queries: words seen so often


def _lexicon(spark, sf_dir):
    return seg.lexicon_by_count(_doc_words(spark, sf_dir), LEXICON_MIN_COUNT)


def _unsegmented(spark, sf_dir):
    return seg.unsegmented(table(spark, sf_dir, "documents"))


def q_segment_full(spark, sf_dir):
    """Every dictionary word, and the characters that none covers."""
    return seg.segment(_unsegmented(spark, sf_dir), _lexicon(spark, sf_dir), "full", uncovered=True)


def q_segment_max_match(spark, sf_dir):
    return seg.segment(_unsegmented(spark, sf_dir), _lexicon(spark, sf_dir), "max_match")


def q_segment_search(spark, sf_dir):
    return seg.segment(_unsegmented(spark, sf_dir), _lexicon(spark, sf_dir), "search")


def q_segment_mmseg(spark, sf_dir):
    """All four chunk rules; the characters' frequencies are those of the texts."""
    texts = _unsegmented(spark, sf_dir)
    return seg.segment(texts, _lexicon(spark, sf_dir), "mmseg", chars=seg.char_counts(texts))


CN_DIGITS = "零一二三四五六七八九"


def q_segment_numerals(spark, sf_dir):
    """The documents' numbers written in Chinese, read back as numerals while segmenting."""
    texts = _unsegmented(spark, sf_dir).withColumn("text", F.translate("text", "0123456789", CN_DIGITS))
    return seg.segment(texts, _lexicon(spark, sf_dir), "max_match", numerals=True)


def q_segment_best_path(spark, sf_dir):
    return seg.segment(_unsegmented(spark, sf_dir), _lexicon(spark, sf_dir), "best_path")


# An alphabet has few letters, so its words hold together little more than chance has it; the
# letters beside them decide. (The defaults are for scripts of thousands of characters.)
FOUND_COHESION, FOUND_ENTROPY = 1.0, 2.0


def _found_words(spark, sf_dir):
    found = find_words(_unsegmented(spark, sf_dir), min_count=LEXICON_MIN_COUNT, min_cohesion=FOUND_COHESION,
                       min_entropy=FOUND_ENTROPY)
    return found.select("word", "n", *(_r(c).alias(c) for c in ("cohesion", "left_entropy", "right_entropy")))


def q_lexicon_from_text(spark, sf_dir):
    """Words of the despaced documents, found without their spaces."""
    return _found_words(spark, sf_dir)


def q_lexicon_from_text_quality(spark, sf_dir):
    """The same words against the spaced documents: the share of them that are words there
    (precision), and the share of the words seen as often that were found (recall)."""
    found, known = _found_words(spark, sf_dir).select("word"), word_counts(_doc_words(spark, sf_dir))
    wanted = (F.col("n") >= LEXICON_MIN_COUNT) & F.length("word").between(seg.MIN_LEN, seg.MAX_LEN)
    j = found.withColumn("found", F.lit(True)).join(known, "word", "full")
    is_found, is_word = F.col("found").isNotNull(), F.col("n").isNotNull()
    a = j.agg(F.count_if(is_found).alias("n_found"), F.count_if(is_found & is_word).alias("n_right"),
              F.count_if(wanted).alias("n_wanted"), F.count_if(is_found & wanted).alias("n_both"))
    return a.select("n_found", "n_right", "n_wanted", "n_both", _r(F.try_divide("n_right", "n_found")).alias("precision"),
                    _r(F.try_divide("n_both", "n_wanted")).alias("recall"))


# -- the reference's chains, end to end -----------------------------------------------------

def _chain_accuracy(predictions):
    a = accuracy(predictions)
    return a.select("n_test", "n_correct", _r("accuracy").alias("accuracy"))


def q_chain_multi_search_nb(spark, sf_dir):
    """Distinct lines -> rating classes -> search-mode words -> 2**20 buckets -> Naive Bayes."""
    tok = segmented("search", _lexicon(spark, sf_dir), despaced=True)
    e = experiment(spark, sf_dir, with_distinct_lines("multi"), fit_on="all", tokenizer=tok)
    return _chain_accuracy(predict_test(e, fit_naive_bayes(e)))


def q_chain_binary_max_match_nb(spark, sf_dir):
    """Binary labels -> longest dictionary words -> TF-IDF -> Naive Bayes -> accuracy."""
    tok = segmented("max_match", _lexicon(spark, sf_dir), despaced=True)
    e = experiment(spark, sf_dir, "binary_drop4", fit_on="all", tokenizer=tok)
    return _chain_accuracy(predict_test(e, fit_naive_bayes(e)))


def q_chain_4neg_full_svm(spark, sf_dir):
    """Distinct lines -> 4 stars negative -> every dictionary word, no stop words -> 2**20
    buckets -> IDF on all rows -> linear SVM -> accuracy."""
    tok = segmented("full", _lexicon(spark, sf_dir), despaced=True, stop_words=True)
    e = experiment(spark, sf_dir, "binary_4neg", fit_on="all", tokenizer=tok, write_tfidf=False)
    return _chain_accuracy(svm_predict_test(e, fit_svm(e)))


def q_chinese_numerals(spark, sf_dir):
    """``n_chars`` written as a Chinese numeral (digits, then 万 for four more) and read back."""
    by_digit = F.translate(F.col("n_chars").cast("string"), "0123456789", CN_DIGITS)
    hundreds = F.concat(F.translate((F.col("n_chars") % 9 + 1).cast("string"), "0123456789", CN_DIGITS), F.lit("百万"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", by_digit.alias("numeral"), T.cn_numeral_to_arabic(by_digit).alias("value"),
        T.cn_numeral_to_arabic(hundreds).alias("millions"))


def q_latin_second_split(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(F.split(F.lower("text"), r"\s+", -1)).alias("token"))
    mixed = d.filter(F.col("token").rlike("[a-z]") & F.col("token").rlike("[0-9]"))
    return mixed.select("doc_id", "token", F.explode(T.latin_parts("token")).alias("part"))


QUERIES: dict[str, Query] = {
    "top_words": q_top_words,
    "words_by_count": q_words_by_count,
    "word_cloud_weights": q_word_cloud_weights,
    "extract_reviews": q_extract_reviews,
    "parse_reviews_jvm": q_parse_reviews_jvm,
    "parse_reviews_python": q_parse_reviews_python,
    "rating_histogram": q_rating_histogram,
    "distinct_reviews": q_distinct_reviews,
    "negatives_union": q_negatives_union,
    "negatives_isin": q_negatives_isin,
    "label_multi": _label_query("multi"),
    "label_binary_drop4": _label_query("binary_drop4"),
    "label_binary_4neg": _label_query("binary_4neg"),
    "balanced_binary_drop4": _balanced_query("binary_drop4"),
    "balanced_binary_4neg": _balanced_query("binary_4neg"),
    "balanced_multi": _balanced_query("multi"),
    "first_rows": q_first_rows,
    "first_rows_of_files": q_first_rows_of_files,
    "zip_file_order": q_zip_file_order,
    "rejected_reviews": q_rejected_reviews,
    "train_test_split": q_train_test_split,
    "zip_labels_features": q_zip_labels_features,
    "stop_words_removed": q_stop_words_removed,
    "stop_words_by_table": q_stop_words_by_table,
    "slash_rejoin": q_slash_rejoin,
    "tokens_keep_marks": q_tokens_keep_marks,
    "term_counts": q_term_counts,
    "term_counts_hashed": q_term_counts_hashed,
    "idf": q_idf,
    "tfidf": q_tfidf,
    "nb_model": q_nb_model,
    "nb_priors": q_nb_priors,
    "nb_predict": q_nb_predict,
    "nb_accuracy": q_nb_accuracy,
    "nb_accuracy_4neg": q_nb_accuracy_4neg,
    "nb_accuracy_idf_all": q_nb_accuracy_idf_all,
    "nb_multiclass_accuracy": q_nb_multiclass_accuracy,
    "score_new_reviews": q_score_new_reviews,
    "ml_pipeline_predictions": q_ml_pipeline_predictions,
    "linear_svc_predictions": q_linear_svc_predictions,
    "svm_weights": q_svm_weights,
    "svm_predict": q_svm_predict,
    "svm_accuracy": q_svm_accuracy,
    "segment_full": q_segment_full,
    "segment_max_match": q_segment_max_match,
    "segment_search": q_segment_search,
    "segment_mmseg": q_segment_mmseg,
    "segment_numerals": q_segment_numerals,
    "segment_best_path": q_segment_best_path,
    "lexicon_from_text": q_lexicon_from_text,
    "lexicon_from_text_quality": q_lexicon_from_text_quality,
    "chain_multi_search_nb": q_chain_multi_search_nb,
    "chain_binary_max_match_nb": q_chain_binary_max_match_nb,
    "chain_4neg_full_svm": q_chain_4neg_full_svm,
    "chinese_numerals": q_chinese_numerals,
    "latin_second_split": q_latin_second_split,
}
