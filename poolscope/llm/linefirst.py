"""Line-first cleaning of documents, in column expressions only.

Every line that has a word is judged on its own, by these rules in this order:

``boilerplate``  it has a phrase of consent, copyright, licence or script notices
``navigation``   it is a list of links: separators (``|``, ``>``) are at least a quarter of its words, three at least
``punctuation``  it does not end with a closing mark, or exclamation marks outnumber half of its words,
                 or symbols are over a tenth of its characters

Failing lines go. A document is rejected if the kept lines have under half of its word characters. Base measures of
the whole text are made beside. All of it stays inside the row: arrays of words and lines, no shuffle, no Python.
Repeated three-word windows are found by sorting the windows of a text that has any, so a long text costs n log n.

Results by case: null or empty text, or white space only: all measures 0, not kept. Repeated rows and rows without an
id are judged like others. Extra columns are ignored by ``measure``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPLIT = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"
BOILERPLATE = (
    "cookie", "privacy policy", "terms of use", "terms of service", "all rights reserved", "copyright", "licensed under",
    "enable javascript", "subscribe to our", "newsletter", "click here", "read more", "sign up", "sign in", "share this",
)
CLOSING = r"[.!?:;)\"'\]…»”’。！？][\x20\x09-\x0D]*$"


def _without(text: Column, characters: str) -> Column:
    return F.regexp_replace(text, characters, "")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value made once, however often it is referred to."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _windows(hashes: Column) -> Column:
    """A hash of every three-word window."""
    return F.transform(
        F.slice(hashes, 1, F.greatest(F.size(hashes) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(hashes, i + 1), F.get(hashes, i + 2)),
    )


def _repeated_words(windows: Column) -> Column:
    """Words that lie in a three-word window which the text has at least twice."""

    def marked(ordered: Column) -> Column:
        twice = F.filter(
            ordered,
            lambda x, i: (x["h"] == F.get(ordered, i + 1)["h"]) | (x["h"] == F.get(ordered, i - 1)["h"]),
        )
        return F.sort_array(F.transform(twice, lambda x: x["at"]))

    def covered(places: Column) -> Column:
        steps = F.transform(places, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(places, i + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)

    def places(twice: Column) -> Column:
        """Where the windows are that occur twice: looked up if they are few, else by sorting all with their places."""
        few = F.filter(F.transform(windows, lambda h, i: F.when(F.array_contains(twice, h), i)), lambda i: i.isNotNull())
        many = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return F.when(F.size(twice) <= 24, few).otherwise(_bound(many, marked))

    def equal_neighbours(ordered: Column) -> Column:
        return F.array_distinct(F.filter(ordered, lambda h, i: (i > 0) & (h == F.get(ordered, i - 1))))

    return F.coalesce(_bound(_bound(_bound(F.sort_array(windows), equal_neighbours), places), covered), F.lit(0).cast("long"))


def _failing(line: Column, lowered: Column) -> Column:
    """The rule that a line fails, or null. Words are counted only where a line has links or exclamations."""
    words = F.regexp_count(line, F.lit(WORD + "+"))
    length = F.length(line)
    links = length - F.length(F.replace(F.replace(line, F.lit("|"), F.lit("")), F.lit(">"), F.lit("")))
    exclaimed = length - F.length(F.replace(line, F.lit("!"), F.lit("")))
    notice = F.lit(False)
    for phrase in BOILERPLATE:
        notice = notice | lowered.contains(phrase)
    return (
        F.when(notice, "boilerplate")
        .when((links >= 3) & (links * 4 >= words), "navigation")
        .when(~line.rlike(CLOSING) | ((exclaimed > 0) & (exclaimed * 2 > words)) | (F.regexp_count(line, F.lit(SYMBOLS)) * 10 > length), "punctuation")
    )


def measure(docs: DataFrame, most_lost: float = 0.5) -> DataFrame:
    """``doc_id``, base measures, verdicts and the cleaned text of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, SPLIT), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    rows = docs.select(F.col("doc_id"), text.alias("_text"), words.alias("_words"), lines.alias("_lines"))
    rows = rows.select(
        "doc_id", "_text", "_lines",
        F.size("_words").cast("long").alias("n_words"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
        F.transform("_lines", lambda x: F.struct(x.alias("line"), F.lower(x).alias("lowered"))).alias("_lowered"),
    )
    judged = F.transform("_lowered", lambda x: F.struct(x["line"].alias("line"), _failing(x["line"], x["lowered"]).alias("rule")))
    rows = rows.withColumns({"_judged": judged, "_windows": _windows(F.col("_hashes"))}).drop("_lowered", "_hashes")
    kept = F.transform(F.filter("_judged", lambda x: x["rule"].isNull()), lambda x: x["line"])
    rows = rows.select(
        "doc_id", "n_words",
        F.length(_without(F.col("_text"), SPLIT)).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("_windows")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.transform("_judged", lambda x: x["rule"]).alias("line_rules"),
        F.array_join(kept, "\n").alias("cleaned"),
    )
    rows = rows.withColumns({
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "kept_chars": F.length(_without(F.col("cleaned"), SPLIT)).cast("long"),
        "n_kept_lines": F.size(F.filter("line_rules", lambda r: r.isNull())).cast("long"),
    })
    enough = F.col("kept_chars") >= (1 - most_lost) * F.col("word_chars")
    return rows.withColumn("kept", ~F.col("base_failed") & enough)
