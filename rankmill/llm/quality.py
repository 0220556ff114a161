"""Line-first cleaning: rules judge each line, failing lines go, then documents that lost too much go.

A line fails by one of three rules (an empty line never fails):

* navigation - three or more separators, or at most four words of which one is a menu word;
* punctuation - more than a tenth of its characters are symbols, a quarter of its words end in
  `!!`, or it has fewer than four words and no closing punctuation;
* boilerplate - at most thirty words and a stock phrase of page templates.

A document is rejected when it fails the base rules (fewer than 20 words, or more than 30 % of its
words in repeated 8-word windows) or when less than half of its word characters is left.

Null and empty texts have no words, so they fail. Repeated rows and ties are judged row by row.
Everything is a narrow projection: no shuffle, no state across rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmill.llm.common import ROW, SPACE_CLASS, SPACES, opened, packed, text_of, unpacked, words

MIN_WORDS = 20
REPEAT_WINDOW = 8
REPEAT_PERCENT = 30
LEAST_LEFT_PERCENT = 50

SYMBOLS = r"[#*$%&|<>]"
SEPARATORS = r"[|»›•·]"
CLOSING = r"[.!?…。！？:;][\"'”’»)\]]*$"
MENU_WORDS = r"(?i)\b(home|login|log in|sign in|sign up|menu|sitemap|next|previous|back to top|share|subscribe)\b"
STOCK_PHRASES = (
    r"(?i)(all rights reserved|accept (all )?cookies|we use cookies|privacy policy|terms of (use|service)"
    r"|enable javascript|click here|subscribe to our newsletter|lorem ipsum|follow us on|powered by)"
)


def line_fails(line: Column) -> Column:
    """Whether one line, stripped at both ends, is removed."""
    n_words = F.regexp_count(line, F.lit(f"[^ \\x09-\\x0D]+"))
    navigation = (F.regexp_count(line, F.lit(SEPARATORS)) >= 3) | ((n_words <= 4) & line.rlike(MENU_WORDS))
    punctuation = (
        (F.regexp_count(line, F.lit(SYMBOLS)) * 10 > F.char_length(line))
        | (F.contains(line, F.lit("!!")) & (F.regexp_count(line, F.lit("!!")) * 4 >= n_words))
        | ((n_words < 4) & ~line.rlike(CLOSING))
    )
    boilerplate = (n_words <= 30) & line.rlike(STOCK_PHRASES)
    return (line != "") & (navigation | punctuation | boilerplate)


def _word_chars(text: Column) -> Column:
    return F.char_length(text) - F.regexp_count(text, F.lit(SPACE_CLASS))


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds `n_repeat_words` for the word list `_words`.

    Windows are hashed from word hashes. A document whose windows all differ is done then; in the
    others the windows are sorted by hash, equal neighbours give the positions, and the union of
    the windows at those positions is counted.
    """
    n = REPEAT_WINDOW
    df = opened(df, _hashes=F.transform("_words", lambda w: F.xxhash64(w)))
    count = F.size("_hashes") - (n - 1)
    windows = F.when(
        count > 0,
        F.transform(
            F.sequence(F.lit(0), count - 1),
            lambda i: F.struct(F.xxhash64(*[F.get(F.col("_hashes"), i + j) for j in range(n)]).alias("h"), i.alias("i")),
        ),
    ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    df = opened(df, _windows=windows)
    hashes = F.col("_windows.h")
    some = F.size(F.array_distinct(hashes)) < F.size("_windows")
    df = opened(df, _sorted=F.when(some, F.sort_array("_windows")).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")))
    edge = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    size = F.size("_sorted")
    before = F.when(size > 0, F.concat(edge, F.slice("_sorted", F.lit(1), size - 1))).otherwise(F.col("_sorted"))
    after = F.when(size > 0, F.concat(F.slice("_sorted", F.lit(2), size - 1), edge)).otherwise(F.col("_sorted"))
    zipped = F.arrays_zip(F.col("_sorted").alias("now"), before.alias("before"), after.alias("after"))
    repeated = F.filter(
        zipped,
        lambda z: F.coalesce(z["now"]["h"] == z["before"]["h"], F.lit(False))
        | F.coalesce(z["now"]["h"] == z["after"]["h"], F.lit(False)),
    )
    starts = F.sort_array(F.transform(repeated, lambda z: z["now"]["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("total")),
        lambda a, p: F.struct(
            (p + n).alias("end"), (a["total"] + (p + n) - F.greatest(p, a["end"])).alias("total")
        ),
        lambda a: a["total"],
    )
    return df.withColumn("n_repeat_words", covered.cast("long")).drop("_hashes", "_windows", "_sorted")


def judge_quality(docs: DataFrame) -> DataFrame:
    """Per row of `docs` (any columns, `text` among them): the row as `_row`, the base figures,
    `n_lines_removed`, `cleaned` (the text without failing lines), `base_failed` and `kept`."""
    df = packed(docs, text_of().alias("_text"))
    df = opened(df, _lines=F.split("_text", "\n", -1), _words=words(F.col("_text")))
    df = _repeat_words(df)
    filled = F.filter("_lines", lambda l: F.btrim(l, F.lit(SPACES)) != "")
    good = F.filter("_lines", lambda l: ~line_fails(F.btrim(l, F.lit(SPACES))))
    df = opened(df, _filled=filled, _good=good)
    df = opened(df, cleaned=F.array_join("_good", "\n"), word_chars=_word_chars(F.col("_text")).cast("long"))
    n_words = F.size("_words").cast("long")
    df = df.select(
        ROW,
        n_words.alias("n_words"),
        "word_chars",
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("_filled") - F.size(F.array_distinct("_filled"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        (F.size("_lines") - F.size("_good")).cast("long").alias("n_lines_removed"),
        "cleaned",
        _word_chars(F.col("cleaned")).cast("long").alias("chars_left"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    enough = F.col("chars_left") * 100 >= F.col("word_chars") * LEAST_LEFT_PERCENT
    return df.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & enough)


def clean_documents(docs: DataFrame) -> DataFrame:
    """The documents that pass, without their failing lines; columns as in `docs`."""
    return unpacked(judge_quality(docs).filter("kept"), F.col("cleaned"))
