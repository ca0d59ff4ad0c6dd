"""How data files spell "no value", and CSV options that read back what they wrote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgermill.names import col

# Text that a data file may use for "no value".
NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def null_words_to_null(c: Column) -> Column:
    """Text that spells "no value" as null."""
    return F.when(~c.isin(NULL_WORDS), c)


def clean_text(df: DataFrame) -> DataFrame:
    """Every (text) column with the null words read as null."""
    return df.select(*[null_words_to_null(col(c)).alias(c) for c in df.columns])


#: How own CSV tables spell a null and, after a backslash, what would break a line. No text is spelled like the null: a
#: backslash of its own is doubled. A mark that stands for nothing keeps lines of blanks from being skipped.
CSV_NULL = "\\N"
_CSV_ESCAPES = {"\n": "n", "\r": "r", "\0": "0"}
_CSV_NOTHING = "\\e"


def spell_text(c: Column) -> Column:
    """Text on one line, reversibly; null stays null."""
    for raw, spelled in {"\\": "\\", **_CSV_ESCAPES}.items():
        c = F.replace(c, F.lit(raw), F.lit("\\" + spelled))
    return F.when(c.rlike(r"\A[\x01-\x20]+\z"), F.concat(F.lit(_CSV_NOTHING), c)).otherwise(c)


def unspell_text(c: Column) -> Column:
    """What :func:`spell_text` was given."""

    def plain(part: Column) -> Column:
        for raw, spelled in _CSV_ESCAPES.items():
            part = F.replace(part, F.lit("\\" + spelled), F.lit(raw))
        return F.replace(part, F.lit(_CSV_NOTHING), F.lit(""))

    # doubled backslashes stand for themselves, so the text is taken apart at them first
    parts = F.transform(F.split(c, r"\\\\", -1), plain)
    return F.when(F.contains(c, F.lit("\\")), F.array_join(parts, "\\")).otherwise(c)


def csv_options(sep: str = ",", multiline: bool = False) -> dict[str, str]:
    """Options for reading and writing CSV alike: header, doubled quotes, no hidden null word, blanks kept."""
    return {
        "header": "true",
        "sep": sep,
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "multiLine": str(multiline).lower(),
        "encoding": "UTF-8",
    }
