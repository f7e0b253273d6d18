"""Column expressions on text and word arrays.

Everything here returns a ``Column`` built from Spark's own functions, so it runs inside
whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token patterns (Java regular expressions; RE2 reads them the same way).
#   words:           runs of letters or runs of digits (space-separated languages)
#   words and marks: the same, plus every other non-blank character as a token of its own,
#                    the way a segmenter keeps punctuation as words
#   latin parts:     second split of a mixed token, parts of at least two letters or digits
WORD_PATTERN = r"\p{L}+|\p{N}+"
WORD_AND_MARK_PATTERN = r"\p{L}+|\p{N}+|[^\p{L}\p{N}\s]"
LATIN_PART_PATTERN = r"[a-z]{2,}|[0-9]{2,}"
#   words keeping marks: letter/digit runs joined by the segmenter's kept marks @ # % . & +
#                    (marks only between letters or digits, so a full stop still ends a word)
WORD_KEEP_MARKS_PATTERN = r"[\p{L}\p{N}]+(?:[@#%.&+]+[\p{L}\p{N}]+)*"
LINE_BREAKS = r"[\r\n\t]+"

# The stop-word set of the reference's third Python script, 19 entries:
# the empty string, the blank, then 17 words and marks, in the order written there.
STOP_WORDS = ["", " ", "，", "的", "。", "了", "！", "是", "就", "吧", "?", "…", "、", "～", "~",
              "很", "都", "也", "还"]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def explode_elements(arr: str | Column, name: str, with_pos: bool = False,
                     pos_name: str = "pos") -> list[Column]:
    """Generator column(s) for the elements of an array column.

    ``explode`` makes the optimizer add ``size(arr) > 0`` as a filter below the generator,
    which evaluates the array expression (a tokenizing regex, say) a second time per row;
    ``explode_outer`` does not, so it is used here and its one null row for an empty array
    is dropped by the caller with a not-null filter.
    """
    a = _col(arr)
    if with_pos:
        return [F.posexplode_outer(a).alias(pos_name, name)]
    return [F.explode_outer(a).alias(name)]


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row: a lambda over a one-element array
    binds it, so the optimizer cannot copy the expression to every place that uses it."""
    return F.transform(F.array(value), body)[0]


def code_points(text: str | Column) -> Column:
    """The characters of a text, one element per code point, line breaks included."""
    return F.filter(F.split(_col(text), ""), lambda c: c != "")


def flatten_breaks(text: str | Column) -> Column:
    """Replace every run of line breaks and tabs by one blank (keeps a review on one line)."""
    return F.regexp_replace(_col(text), LINE_BREAKS, " ")


def words(text: str | Column) -> Column:
    """Lower-cased word tokens of a text (letters runs and digit runs)."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD_PATTERN), 0)


def words_and_marks(text: str | Column) -> Column:
    """Word tokens plus punctuation marks as tokens of their own."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD_AND_MARK_PATTERN), 0)


def words_keep_marks(text: str | Column) -> Column:
    """Lower-cased tokens that keep the marks @ # % . & + inside them (3.14, a@b.com)."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(WORD_KEEP_MARKS_PATTERN), 0)


def remove_stop_words(arr: str | Column, stop_words: list[str] | None = None) -> Column:
    """Drop every stop word from a word array, keeping order and repeats of the other words.

    ``array_except`` would also collapse repeats, so this is an element filter.
    """
    stop = STOP_WORDS if stop_words is None else list(stop_words)
    return F.filter(_col(arr), lambda w: ~w.isin(stop))


def slash_rejoin(arr: str | Column) -> Column:
    """Join words with '/' and split again: identity unless a word holds a '/'."""
    return F.split(F.array_join(_col(arr), "/"), "/", -1)


def latin_parts(token: str | Column) -> Column:
    """Second split of a mixed token into letter parts and digit parts of length >= 2."""
    return F.regexp_extract_all(_col(token), F.lit(LATIN_PART_PATTERN), 0)


def with_latin_parts(arr: str | Column) -> Column:
    """Tokens followed by the second-split parts of those tokens that mix letters and digits."""
    a = _col(arr)
    mixed = F.filter(a, lambda t: t.rlike("[a-z]") & t.rlike("[0-9]"))
    return F.concat(a, F.flatten(F.transform(mixed, lambda t: latin_parts(t))))


def despace(text: str | Column) -> Column:
    """Text with its blanks and line breaks removed (stand-in for unsegmented writing)."""
    return F.regexp_replace(F.lower(_col(text)), r"\s+", "")


# Chinese numerals. Digits 零..九 (两 = 2), small units 十 百 千, large units 万 亿.
CN_DIGITS = {"零": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7,
             "八": 8, "九": 9}
CN_SMALL_UNITS = {"十": 10, "百": 100, "千": 1000}
CN_LARGE_UNITS = {"万": 10_000, "亿": 100_000_000}


def cn_numeral_to_arabic(token: str | Column) -> Column:
    """Value of a Chinese numeral token as a bigint (三万 -> 30000), null for other tokens.

    A fold over the characters keeps (total, section, digit): a digit is remembered, a small
    unit adds digit*unit to the section (a bare 十 counts as 一十), a large unit closes the
    section. Tokens without units (二零二三) read digit by digit. A value beyond 64 bits is null.
    """
    t = _col(token)
    all_chars = "".join(list(CN_DIGITS) + list(CN_SMALL_UNITS) + list(CN_LARGE_UNITS))
    is_numeral = t.rlike(f"^[{all_chars}]+$")
    has_unit = t.rlike(f"[{''.join(list(CN_SMALL_UNITS) + list(CN_LARGE_UNITS))}]")

    def digit_of(ch: Column) -> Column:
        e = F.lit(None).cast("long")
        for k, v in CN_DIGITS.items():
            e = F.when(ch == k, F.lit(v).cast("long")).otherwise(e)
        return e

    def small_of(ch: Column) -> Column:
        e = F.lit(None).cast("long")
        for k, v in CN_SMALL_UNITS.items():
            e = F.when(ch == k, F.lit(v).cast("long")).otherwise(e)
        return e

    def step(acc: Column, ch: Column) -> Column:
        total, section, digit = acc["total"], acc["section"], acc["digit"]
        d, s = digit_of(ch), small_of(ch)
        wan = ch == "万"
        yi = ch == "亿"
        new_total = (F.when(wan, F.try_add(total, F.try_multiply(F.try_add(section, digit), big(10_000))))
                     .when(yi, F.try_multiply(F.try_add(F.try_add(total, section), digit), big(100_000_000)))
                     .otherwise(total))
        new_section = (F.when(s.isNotNull(), F.try_add(
            section, F.try_multiply(F.when(digit == 0, big(1)).otherwise(digit), s)))
                       .when(wan | yi, F.lit(0).cast("long"))
                       .otherwise(section))
        new_digit = F.when(d.isNotNull(), d).otherwise(F.lit(0).cast("long"))
        return F.struct(new_total.alias("total"), new_section.alias("section"),
                        new_digit.alias("digit"))

    def big(n: int) -> Column:
        return F.lit(n).cast("long")

    zero = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("section"),
                    F.lit(0).cast("long").alias("digit"))
    chars = F.split(t, "")
    folded = F.aggregate(chars, zero, step, lambda a: F.try_add(F.try_add(a["total"], a["section"]), a["digit"]))
    digitwise = F.aggregate(chars, F.lit(0).cast("long"), lambda acc, ch: F.try_add(
        F.try_multiply(acc, big(10)), digit_of(ch)))
    return F.when(is_numeral & has_unit, folded).when(is_numeral, digitwise)


def cn_numerals_in_text(text: str | Column) -> Column:
    """Running text with its Chinese numerals written as Arabic ones (花了三百二十元 -> 花了320元).

    A numeral is a run of two numeral characters or more with a digit in it, or one that begins with
    十. Single characters stay (一起, 十分), so do units alone (千万) and runs beyond 64 bits.
    Null stays null.
    """
    digits, units = "".join(CN_DIGITS), "".join([*CN_SMALL_UNITS, *CN_LARGE_UNITS])
    runs = F.regexp_extract_all(_col(text), F.lit(f"[{digits}{units}]+|[^{digits}{units}]+"), 0)

    def read(run: Column) -> Column:
        numeral = run.rlike(f"^[{digits}{units}]{{2,}}$") & run.rlike(f"[{digits}]|^十")
        return F.when(numeral, F.coalesce(cn_numeral_to_arabic(run).cast("string"), run)).otherwise(run)

    return F.array_join(F.transform(runs, read), "")
