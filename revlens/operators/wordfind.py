"""Words of unsegmented text: a lexicon found without spaces or a dictionary.

Every run of 1..``max_len`` characters is a candidate. It is a word when it occurs often, when its
parts stand together far more often than chance has them (cohesion), and when many different
characters stand before and after it (neighbour entropy):

* ``cohesion``: the smallest, over all cuts into two parts, of n(run) * total / (n(left) * n(right));
* ``left_entropy``, ``right_entropy``: of the characters next to it, in nats, the edge of a text
  being one more character.

A text is cut into windows at each place; equal windows are counted first (combined before they are
shuffled). Runs of each size are counted from the distinct runs of one character more, never from
the places, so frequent passages cost once, not once an occurrence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlens.operators.joins import salted_join
from revlens.session import drop_table, materialize, spread

MAX_LEN = 7
MIN_COUNT = 25
MIN_COHESION = 100.0
MIN_ENTROPY = 1.0
#: Stands for the edge of a text: texts are taken without blanks and line breaks.
EDGE = "\n"


def windows(texts: DataFrame, text_col: str = "text", max_len: int = MAX_LEN) -> DataFrame:
    """``(window, n)``: distinct windows (a character or edge, then ``max_len`` + 1 characters or
    edges) and how often they occur, one for each character of the texts."""
    padded = F.concat(F.lit(EDGE), F.regexp_replace(text_col, r"\s+", ""), F.lit(EDGE * max_len))
    found = F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.{{{max_len + 2}}}))."), 1)
    return (texts.select(F.explode_outer(found).alias("window")).filter(F.col("window").isNotNull())
            .groupBy("window").agg(F.count("*").alias("n")))


def _ends(seen: DataFrame, size: int) -> DataFrame:
    """``(window, n)`` that begin at the last character of a text, where ``windows`` has none."""
    last = seen.filter(F.substring("window", 3, 1) == EDGE)
    return last.select(F.rpad(F.substring("window", 2, 1), size, EDGE).alias("window"), "n").groupBy(
        "window").agg(F.sum("n").alias("n"))


def _cut(seen: DataFrame, size: int) -> DataFrame:
    return seen.groupBy(F.substring("window", 1, size).alias("window")).agg(F.sum("n").alias("n"))


def _levels(top: DataFrame, max_len: int) -> list[DataFrame]:
    """Written tables ``(gram, n, weight)`` for grams of ``max_len`` + 1 down to one character from
    counted grams of the first size: a gram's count and, from the second size on, the sum of n * ln(n)
    over the characters after it. Each table is made from the distinct grams of the one before."""
    weight = F.col("n") * F.log(F.col("n").cast("double"))
    tables = [materialize(top.select(F.col("window").alias("gram"), "n", F.lit(0.0).alias("weight")), "grams")]
    for size in range(max_len, 0, -1):
        shorter = tables[-1].groupBy(F.substring("gram", 1, size).alias("gram"))
        tables.append(materialize(shorter.agg(F.sum("n").alias("n"), F.sum(weight).alias("weight")), "grams"))
    return tables


def _runs(tables: list[DataFrame], min_count: int) -> DataFrame:
    """``runs`` from the levels: characters after a run are summed up in its own row, those before it
    are the rows of the next level that end with it."""
    weight = F.col("n") * F.log(F.col("n").cast("double"))
    sides = [t.filter(~F.contains("gram", F.lit(EDGE)) & (F.col("n") >= min_count)).select(
        F.col("gram").alias("word"), F.lit(0.0).alias("_left"), F.col("weight").alias("_right"), "n") for t in tables[1:]]
    for longer in tables[:-1]:
        word = F.substring("gram", 2, 1 << 20)
        sides.append(longer.select(word.alias("word"), weight.alias("_left"), F.lit(0.0).alias("_right"),
                                   F.lit(0).cast("long").alias("n")).filter(~F.contains("word", F.lit(EDGE))))
    every = sides[0]
    for side in sides[1:]:
        every = every.unionByName(side)
    counted = every.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("n", "_left", "_right")))
    size = F.col("n").cast("double")
    return counted.filter((F.col("n") >= min_count) & (F.col("n") > 0)).select(
        "word", "n", (F.log(size) - F.col("_left") / size).alias("left_entropy"),
        (F.log(size) - F.col("_right") / size).alias("right_entropy"))


def runs(seen: DataFrame, max_len: int = MAX_LEN, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n, left_entropy, right_entropy)`` of the runs that occur ``min_count`` times or more,
    from ``windows``."""
    return _runs(_levels(_cut(seen.unionByName(_ends(seen, max_len + 2)), max_len + 1), max_len), min_count)


def with_cohesion(counted: DataFrame) -> DataFrame:
    """The runs of two characters or more with their ``cohesion``. Parts of a run occur at least as
    often as the run, so all of them are rows of ``counted`` too."""
    total = counted.filter(F.length("word") == 1).agg(F.sum("n").cast("double").alias("_total")).scalar()
    cuts = counted.filter(F.length("word") > 1).select(
        "word", F.col("n").alias("_n"), F.explode(F.expr("sequence(1, length(word) - 1)")).alias("_cut"))
    cuts = cuts.select("word", "_n", F.expr("substring(word, 1, _cut)").alias("_a"),
                       F.expr("substring(word, _cut + 1)").alias("_b"))
    for part, size in (("_a", "_na"), ("_b", "_nb")):
        # one character begins or ends a great many runs: salted by how many
        parts = counted.select(F.col("word").alias(part), F.col("n").alias(size))
        cuts = salted_join(cuts, parts, part, cuts.groupBy(part).agg(F.count("*").alias("_w")), "_w")
    ratio = F.col("_n").cast("double") * total / (F.col("_na").cast("double") * F.col("_nb"))
    return counted.join(cuts.groupBy("word").agg(F.min(ratio).alias("cohesion")), "word")


def find_words(texts: DataFrame, text_col: str = "text", max_len: int = MAX_LEN, min_count: int = MIN_COUNT,
               min_cohesion: float = MIN_COHESION, min_entropy: float = MIN_ENTROPY) -> DataFrame:
    """``(word, n, cohesion, left_entropy, right_entropy)`` of the words found: a lexicon that
    ``segment`` takes as it is.

    Characters are code points, blanks and line breaks are taken out first, case is kept. Null and
    empty texts have no runs; an empty table finds no words; a repeated row counts again; other
    columns are passed over. The total is that of the characters that occur ``min_count`` times or
    more. The counted windows and runs are written once under the shared folder.
    """
    # a run and one character beside it: max_len + 1 characters are enough
    size = max(max_len, 2) + 1
    seen = materialize(windows(spread(texts.select(text_col)), text_col, size - 2), "windows")
    every = seen.unionByName(_ends(seen, size))
    tables = _levels(every if size == max_len + 1 else _cut(every, max_len + 1), max_len)
    counted = materialize(_runs(tables, min_count), "runs")
    for table in (seen, *tables):
        drop_table(table)
    return with_cohesion(counted).filter(
        (F.col("cohesion") >= min_cohesion) & (F.col("left_entropy") >= min_entropy)
        & (F.col("right_entropy") >= min_entropy)).select("word", "n", "cohesion", "left_entropy", "right_entropy")
