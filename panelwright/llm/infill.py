"""Fill-in-the-middle: a text is cut at two units and its parts are put in another order between marks.

``regexp_count`` gives the number n of units. Two cuts a <= b follow from a hash of the id, and one match of a pattern made
for the row, ``(unit{a})(unit{b-a})(rest)``, captures prefix, middle and suffix; the replacement puts them into the
output. The quantifiers are possessive: matching goes on in a loop and never gives a unit back, so that a text of
millions of units needs no stack and no second try. Everything is a built-in expression, row by row, without a shuffle.

Forms: ``plain`` (the text as it is), ``psm`` (prefix, suffix, middle) and ``spm`` (suffix, prefix, middle). A text that is
empty or holds a mark stays plain, so the marks in an output say exactly where its parts are: ``restored`` splits there.

Defined cases: a null text is the empty text; a null id is hashed as no digits; repeated rows and ids give the same cuts
row by row; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A run of letters, or one other character.
UNIT = "[A-Za-z]+|[^A-Za-z]"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = f"{PREFIX}|{SUFFIX}|{MIDDLE}"
PLAIN, PSM, SPM = "plain", "psm", "spm"


def draws(seed: int, id_col: Column, n: int = 4) -> list[Column]:
    """``n`` unsigned 32-bit numbers, at most 8, from the hash of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def transform(
    docs: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, id_col: str = "doc_id",
    text_col: str = "text", unit: str = UNIT,
) -> DataFrame:
    """``(id, n, form, prefix_chars, middle_chars, output)`` of every row; the lengths are null where the form is plain.

    ``plain_percent`` of the other rows stay plain too, ``spm_percent`` of the cut ones have the suffix first. ``unit`` has
    to match everywhere in a text and must not capture.
    """
    h1, h2, h3, h4 = draws(seed, F.col("id"))
    text, n, a, b = F.col("text"), F.col("n"), F.col("a"), F.col("b")
    counted = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    ).select("id", "text", F.regexp_count(text, F.lit(unit)).cast("long").alias("n"))
    cut = counted.select(
        "id", "text", "n", F.least(h1 % (n + 1), h2 % (n + 1)).alias("a"), F.greatest(h1 % (n + 1), h2 % (n + 1)).alias("b"),
        F.when((text == "") | text.rlike(MARKS) | (h3 % 100 >= 100 - plain_percent), PLAIN)
        .when(h4 % 100 < spm_percent, SPM).otherwise(PSM).alias("form"))
    units = lambda k: F.concat(F.lit(f"((?:{unit}){{"), k.cast("string"), F.lit("}+)"))
    pattern = F.concat(F.lit(r"\A"), units(a), units(b - a), F.lit(r"((?s:.*))\z"))
    order = F.when(F.col("form") == SPM, f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2").otherwise(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2")
    made = cut.select("id", "n", "form", F.when(F.col("form") == PLAIN, text)
                      .otherwise(F.regexp_replace(text, pattern, order)).alias("output"))
    prefix, _, middle = parts(F.col("output"), F.col("form"))
    length = lambda part: F.when(F.col("form") != PLAIN, F.length(part).cast("long"))
    return made.select("id", "n", "form", length(prefix).alias("prefix_chars"), length(middle).alias("middle_chars"), "output")


def parts(output: Column, form: Column) -> tuple[Column, Column, Column]:
    """Prefix, suffix and middle of an output that is not plain."""
    found = F.split(output, MARKS, -1)
    spm = form == SPM
    return (F.when(spm, found[2]).otherwise(found[1]), F.when(spm, found[1]).otherwise(found[2]), found[3])


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from."""
    prefix, suffix, middle = parts(output, form)
    return F.when(form == PLAIN, output).otherwise(F.concat(prefix, middle, suffix))
