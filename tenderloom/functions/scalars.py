"""Scalar column functions: text, numbers, dates, validation.  All JVM-side; raw values that don't parse give NULL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R

# ---------------------------------------------------------------- text


def title_case(c: Column) -> Column:
    """Every letter after a non-letter is a capital, all others small (``L'AQUILA`` -> ``L'Aquila``), unlike initcap."""
    return F.array_join(F.transform(F.split(F.lower(c), r"(?<=[^\p{L}])"), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), "")


def clean_text(c: Column) -> Column:
    r"""Literal ``\n``, line breaks, no-break blanks and runs of blanks become one blank; trimmed; NULL is empty."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"\\n", " "), r"[\s ]+", " "))


def strip_tags(c: Column) -> Column:
    return clean_text(F.regexp_replace(c, r"<[^>]*>", " "))


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def row_hash(*cols: Column) -> Column:
    """SHA-256 over the columns joined by ``|``; NULL counts as empty."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols]), 256)


def truncate(c: Column, most: int, suffix: str = "...") -> Column:
    return F.when(F.char_length(c) > most, F.concat(F.substring(c, 1, most - len(suffix)), F.lit(suffix))).otherwise(c)


def normal_upper(c: Column) -> Column:
    """Upper case, trimmed, blanks collapsed; NULL stays NULL."""
    return F.upper(F.trim(F.regexp_replace(c, r"\s+", " ")))


def sentinel_null(c: Column) -> Column:
    """Trimmed; empty and the words that stand for nothing become NULL."""
    t = F.trim(c)
    return F.when(~F.lower(t).isin(R.SENTINELS), t)


def strip_prefixes(c: Column, prefixes: tuple[str, ...] = ("COMUNE DI ", "SEZIONE REGIONALE ")) -> Column:
    """Without the prefix; first letter a capital, the rest small."""
    t = F.regexp_replace(F.trim(c), "(?i)^(?:" + "|".join(p.strip().replace(" ", r"\s+") for p in prefixes) + r")\s+", "")
    return F.concat(F.upper(F.substring(t, 1, 1)), F.lower(F.substring(t, 2, 1 << 30)))


def town_name(c: Column) -> Column:
    """Title case with small particles but for the first word; blanks collapsed; sentinels NULL."""
    words = F.split(title_case(F.regexp_replace(sentinel_null(c), r"\s+", " ")), " ")
    return F.array_join(F.transform(words, lambda w, i: F.when((i > 0) & w.isin(R.PARTICLES), F.lower(w)).otherwise(w)), " ")


def entity_name(c: Column) -> Column:
    """Blanks collapsed; title case if all capitals or all small; company forms in one spelling."""
    t = F.regexp_replace(sentinel_null(c), r"\s+", " ")
    t = F.when((t == F.upper(t)) | (t == F.lower(t)), title_case(t)).otherwise(t)
    return reduce(lambda x, f: F.regexp_replace(x, "(?i)" + f[0], f[1].replace("$", r"\$")), R.COMPANY_FORMS, t)


def code_label(c: Column, labels: dict[str, str]) -> Column:
    """The label of a code, else the code with blanks for underscores in title case; NULL stays NULL."""
    key = F.lower(F.trim(c))
    table = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return F.coalesce(table[key], underscored(c))


def underscored(c: Column) -> Column:
    return title_case(F.translate(F.trim(c), "_", " "))


def first_key(c: Column) -> Column:
    """The first code of a ``;`` list, trimmed, upper-cased; sentinels NULL."""
    return F.upper(sentinel_null(F.split(c, ";")[0]))


def portal_url(key: Column, base: str) -> Column:
    return F.when(sentinel_null(key).isNotNull(), F.concat(F.lit(base), F.trim(key)))


def procedure_label(c: Column, most: int = 35) -> Column:
    """What follows ``TITLE:``, shortened."""
    t = F.trim(F.when(c.contains("TITLE:"), F.substring_index(c, "TITLE:", -1)).otherwise(c))
    return F.when(F.char_length(t) > most, F.concat(F.substring(t, 1, most), F.lit("..."))).otherwise(t)


# ---------------------------------------------------------------- numbers


def number(c: Column) -> Column:
    """A double, or NULL."""
    return c.try_cast("double")


def percent(c: Column) -> Column:
    """``26,5 %`` as 26.5."""
    return F.replace(F.regexp_replace(c, r"[%\s]", ""), F.lit(","), F.lit(".")).try_cast("double")


def fraction(c: Column) -> Column:
    """A percent value as a fraction, always divided by 100."""
    return c / 100


def discount_from_amounts(base: Column, award: Column) -> Column:
    """Percent below the base; NULL unless 0 < award <= base."""
    return F.when((base > 0) & (award > 0) & (award <= base), (base - award) / base * 100)


def discount_from_reduction(award: Column, reduction: Column) -> Column:
    """Percent of an absolute reduction on award + reduction, two digits."""
    return F.round(F.try_divide(reduction * 100, award + reduction), 2)


def within(c: Column, lo: float, hi: float) -> Column:
    return F.when(c.between(lo, hi), c)


def clipped(c: Column, lo: float, hi: float) -> Column:
    return F.when(c.isNotNull(), F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), c)))


def amount(c: Column) -> Column:
    """An amount in Italian or international notation, decided by the last separator; negative or unreadable: NULL."""
    t = F.regexp_replace(c, r"[€$£¥\s]", "")
    comma, dot = F.instr(F.reverse(t), ","), F.instr(F.reverse(t), ".")
    italian = F.replace(F.replace(t, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    value = F.when((comma > 0) & (dot > 0) & (comma < dot), italian).when((comma > 0) & (dot > 0), F.replace(t, F.lit(","), F.lit(""))).when(comma > 0, F.replace(t, F.lit(","), F.lit("."))).otherwise(t)
    value = value.try_cast("double")
    return F.when(value >= 0, value)


def italian_number(c: Column) -> Column:
    """Digits with dots for thousands and a decimal comma."""
    return F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def band(c: Column, edges: list[tuple[float, str]], top: str) -> Column:
    """Right-closed bands above 0; NULL at or below 0."""
    out = F.when(c <= 0, F.lit(None).cast("string"))
    for hi, name in edges:
        out = out.when(c <= hi, F.lit(name))
    return out.when(c.isNotNull(), F.lit(top))


def cast_or(c: Column, kind: str, default) -> Column:
    return F.coalesce(c.try_cast(kind), F.lit(default).cast(kind))


# ---------------------------------------------------------------- dates


def date_of(c: Column) -> Column:
    """The first of the fixed formats that fits, Italian month names allowed; ``non specificat...`` and others NULL."""
    plain = F.lower(F.trim(c))
    t = plain
    for i, m in enumerate(R.MONTHS, 1):
        t = F.regexp_replace(t, rf"\s*\b{m}\b\s*", f"/{i:02d}/")
    t = F.when(plain.rlike("[a-z]"), t).otherwise(plain)
    shapes = {"d": r"\d{1,2}", "M": r"\d{1,2}", "yyyy": r"\d{4}", "yy": r"\d{2}"}

    def shaped(fmt: str) -> str:
        if fmt == "yyyyMMdd":
            return r"^\d{8}$"
        sep = next(x for x in fmt if x in "/-.")
        return "^" + ("\\" + sep).join(shapes[p] for p in fmt.split(sep)) + "$"

    # as an array of one, so that all formats look at one evaluation of the text
    first = F.transform(F.array(t), lambda x: F.coalesce(*[F.when(x.rlike(shaped(f)), F.try_to_timestamp(x, F.lit(f)).cast("date")) for f in R.DATE_FORMATS]))
    return F.get(first, F.lit(0))


def safe_date(c: Column) -> Column:
    """The first ten characters of a timestamp that may be malformed; NULL if shorter."""
    return F.when(F.char_length(c) >= 10, F.substring(c, 1, 10))


def valid_date(c: Column, first: int = 2000, last: int = 2030) -> Column:
    return F.when(F.year(c).between(first, last), c)


def duration_days(start: Column, end: Column, most: int = 10_949) -> Column:
    """Days between, 1 to ``most``, else NULL."""
    d = F.datediff(end, start)
    return F.when(d.between(1, most), d)


def duration_from_text(c: Column) -> Column:
    """Days of a duration in words: a count of days, months (30), years (365), a fixed word, or two dates."""
    t = F.lower(F.trim(c))
    n = F.nullif(F.regexp_extract(t, r"(\d+)", 1), F.lit("")).try_cast("int")
    numeric = F.when(t.contains("giorn"), n).when(t.contains("mes"), n * 30).when(t.contains("anni") | t.contains("anno"), n * 365)
    out = F.when(t.contains("non specificat"), F.lit(None).cast("int")).when(n.isNotNull() & numeric.isNotNull() & ~t.rlike(r"\d{2}[./-]\d{2}[./-]\d{4}"), numeric)
    for word, days in R.DURATION_WORDS:
        out = out.when(t.contains(word), F.lit(days))
    found = F.regexp_extract_all(t, F.lit(r"(\d{2}[./-]\d{2}[./-]\d{4})"), 1)
    span = F.datediff(date_of(F.get(found, 1)), date_of(F.get(found, 0)))
    return out.when(F.size(found) == 2, span)


def period(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def contract_years(category: Column) -> Column:
    """Usual years of a contract by words of its category."""
    t, out = F.lower(category), None
    for word, years in R.CONTRACT_YEARS:
        out = F.when(t.contains(word), years) if out is None else out.when(t.contains(word), years)
    return out.otherwise(R.DEFAULT_YEARS)


def display_year(c: Column, first: int = 2015) -> Column:
    return F.when(c.isNull(), "N/D").when(F.year(c) < first, f"<{first}").otherwise(F.year(c).cast("string"))


# ---------------------------------------------------------------- validation


def _code(c: Column, pattern: str) -> Column:
    t = F.upper(F.trim(c))
    return F.when(~t.isin(R.PLACEHOLDERS) & t.rlike(pattern), t)


def lot_code(c: Column) -> Column:
    return _code(c, R.LOT_CODE)


def project_code(c: Column) -> Column:
    return _code(c, R.PROJECT_CODE)


def vat_number(c: Column) -> Column:
    """Eleven digits whose last is the check digit (mod 10, every second digit doubled)."""
    d = F.regexp_replace(c, r"\D", "")
    return F.when((F.char_length(d) == 11) & F.call_function("luhn_check", d), d)


def tax_code(c: Column) -> Column:
    t = F.upper(F.trim(c))
    return F.when(t.rlike(R.PERSON_CODE), t).when(t.rlike(r"^[0-9]{11}$"), vat_number(t))


def email(c: Column) -> Column:
    t = F.lower(F.trim(c))
    return F.when(t.rlike(R.EMAIL), t)


def alnum_code(c: Column) -> Column:
    """Upper-cased if letters and digits only, else empty."""
    t = F.upper(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(t.rlike("^[A-Z0-9]+$"), t).otherwise("")


def single_number(c: Column) -> Column:
    """The number of a text that holds exactly one."""
    return F.when(F.regexp_count(c, F.lit(r"\d+(?:[.,]\d+)?")) == 1, F.replace(F.regexp_extract(c, r"(\d+(?:[.,]\d+)?)", 1), F.lit(","), F.lit(".")).try_cast("double"))


def reasons(checks: dict[str, Column]) -> Column:
    """Names of the checks that don't hold (NULL counts as failed)."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]))
