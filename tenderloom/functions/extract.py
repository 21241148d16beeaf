"""Fields from free text: lot codes, amounts, dates, entities, discounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rules as R
from .scalars import clean_text, date_of, italian_number

DISCOUNT_PATTERNS = R.DISCOUNT_PATTERNS


def _found(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def _behind(c: Column, word: str, pattern: str) -> Column:
    """``_found`` where the text has the word, in any case: a search for a word is far cheaper than a pattern's."""
    return F.when(F.lower(c).contains(word), _found(c, pattern))


def lot_code_in(c: Column) -> Column:
    """The code after its label, else the first token of ten capitals and digits that begins like a code."""
    tokens = F.filter(F.regexp_extract_all(c, F.lit(R.LOT_CODE_TOKEN), 1), lambda x: x.rlike(R.LOT_CODE_BEGINS))
    return F.coalesce(_behind(c, "cig", R.LOT_CODE_LABELLED), F.try_element_at(tokens, F.lit(1)))


def amount_in(c: Column) -> Column:
    """The first amount by five patterns in order, in Italian notation."""
    return F.coalesce(*[italian_number(F.regexp_replace(_behind(c, w, p), r"[.,]+$", "")) for w, p in R.AMOUNT_PATTERNS])


def date_in(c: Column) -> Column:
    """The first numeric date, else the first with an Italian month, as yyyy-MM-dd."""
    numeric = _found(c, R.NUMERIC_DATE)
    worded = _found(c, rf"(?i)(\d{{1,2}}\s+(?:{'|'.join(R.MONTHS)})\s+\d{{4}})")
    return F.date_format(F.coalesce(date_of(numeric), date_of(worded)), "yyyy-MM-dd")


def entity_in(c: Column) -> Column:
    """What follows the first of: comune di, provincia di, regione, ministero, azienda."""
    return F.coalesce(*[F.nullif(clean_text(_behind(c, w, "(?i)" + p + r"([^,\n]+)")), F.lit("")) for w, p in R.ENTITY_PATTERNS])


def discount_in(c: Column) -> Column:
    """A discount of 0 to 100 by four patterns in order."""
    values = [F.replace(_found(c, p), F.lit(","), F.lit(".")).try_cast("double") for p in DISCOUNT_PATTERNS]
    return F.coalesce(*[F.when(v.between(0, 100), v) for v in values])


def numbers_in(c: Column) -> Column:
    """All numbers in Italian notation."""
    return F.filter(F.transform(F.regexp_extract_all(c, F.lit(f"({R.NUMBER})"), 1), italian_number), lambda x: x.isNotNull())


def first_number_in(c: Column) -> Column:
    return F.try_element_at(numbers_in(c), F.lit(1))


def highest_number_in(c: Column, above: float = 100) -> Column:
    return F.array_max(F.filter(numbers_in(c), lambda x: x > above))


def digits_of(c: Column) -> Column:
    return F.regexp_replace(c, r"\D", "")


def winner_in(c: Column) -> Column:
    """One to seven capitalised words after ``aggiudicat``."""
    return F.trim(_found(c, R.WINNER))


def notice_fields(df: DataFrame, text: str, head: int = 500) -> DataFrame:
    """The batch row: head of the text, its hash and length, and the extracted fields."""
    c = F.col(text)
    return df.withColumns({"head": F.substring(c, 1, head), "hash": F.sha2(c, 256), "length": F.char_length(c), "code": lot_code_in(c), "amount": amount_in(c), "date": date_in(c), "entity": entity_in(c)})


def lot_rows(df: DataFrame, text: str, separator: str = r"(?i)\blotto\s+\d+[:\s]") -> DataFrame:
    """One row per lot of a text: group hash, lot number, number of lots, lot text; a text without lots is one lot."""
    parts = F.filter(F.split(F.col(text), separator), lambda x: F.trim(x) != "")
    df = df.withColumns({"group_hash": F.sha2(F.col(text), 256), "_parts": F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("")))})
    df = df.select("*", F.posexplode("_parts").alias("_i", "lot_text"), F.size("_parts").alias("n_lots"))
    return df.withColumn("lot_no", F.col("_i") + 1).withColumn("lot_text", F.trim("lot_text")).drop("_parts", "_i")
