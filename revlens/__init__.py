"""revlens: review-text analytics written as Spark DataFrame plans.

Layout
------
sources/    readers and writers (text, GBK text, word-count TSV, driver tables, review view)
functions/  column expressions (tokenising, stop words, hashing, numerals)
operators/  DataFrame -> DataFrame building blocks (parse, label, sample, features,
            segmentation, Naive Bayes, linear SVM, metrics)
plans/      the registered queries and their DuckDB oracle SQL
streaming/  scoring a stream of review lines with a fitted model
"""

__version__ = "0.1.0"
