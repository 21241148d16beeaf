"""Text classification: rule sets compiled to Columns, and to SQL where a query is checked in SQL."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules as R

FLAGS = "(?iU)"  # accents and word borders as in Unicode
LITERAL = 3  # characters from which on a literal is worth a look of its own


def matches(c: Column, pattern: str) -> Column:
    return c.rlike(FLAGS + pattern)


def folded(c: Column) -> Column:
    """Lower case, once for all patterns; the long s is an s."""
    return F.replace(F.lower(c), F.lit("ſ"), F.lit("s"))


def literals(pattern: str) -> list[str]:
    """Runs of characters that every match of the pattern contains; none if it has alternatives at its top."""
    runs, own, i = [], "", 0
    while i < len(pattern):
        ch, optional = pattern[i], False
        if ch == "|":
            return []
        if ch in "([":
            depth, i = 1, i + 1
            while depth:
                if pattern[i] == "\\":
                    i += 1
                elif ch == "[":
                    depth -= pattern[i] == "]"
                else:
                    depth += (pattern[i] == "(") - (pattern[i] == ")")
                i += 1
            runs.append(own)
            own = ""
            continue
        if ch == "\\":
            i += 1
            if pattern[i].isalnum():
                runs.append(own)
                own = ""
            else:
                own += pattern[i]
        elif ch in "?*{":
            runs.append(own[:-1] if own else "")
            own = ""
            if ch == "{":
                i = pattern.index("}", i)
        elif ch in "+.^$":
            runs.append(own)
            own = ""
        else:
            own += ch
        i += 1
    return [r for r in [*runs, own] if r]


def hit(t: Column, pattern: str) -> Column:
    """Whether the pattern matches a folded text: first a look for what every match contains, then the pattern."""
    need = literals(pattern)
    if need == [pattern]:
        return t.contains(pattern)
    look = [t.contains(n) for n in sorted(need, key=len, reverse=True)[:2] if len(n) >= LITERAL]
    return reduce(lambda a, b: a & b, [*look, t.rlike("(?U)" + pattern)])


def any_match(t: Column, patterns: list[str]) -> Column:
    return reduce(or_, [hit(t, p) for p in patterns])


def vetoed(t: Column, negatives: list[str] = R.NEGATIVES, categories: dict = R.CATEGORIES, rescue: list[str] = R.RESCUE) -> Column:
    """Of a folded text: a negative pattern matches and no rescue category's first pattern does; also texts of less than five characters."""
    return (F.char_length(F.trim(t)) < 5) | (any_match(t, negatives) & ~any_match(t, [categories[r][0][0] for r in rescue]))


def labels(t: Column, categories: dict[str, list[tuple[str, float]]] = R.CATEGORIES) -> Column:
    """array<struct<category, confidence>> of a folded text, best first, ties in the order of the rule set; empty for NULL or vetoed texts.

    Confidence: the highest weight of a category's matching patterns plus 0.05
    for each further match, 0.15 at most; 1 at most; three digits.
    """
    # one array of all matches; what follows works on its few elements
    hits = F.array_compact(F.array(*[F.when(hit(t, p), F.struct(F.lit(place).alias("place"), F.lit(float(w)).alias("w"))) for place, patterns in enumerate(categories.values()) for p, w in patterns]))
    names = F.array(*map(F.lit, categories))

    def ranked(h: Column) -> Column:
        def label(place: Column) -> Column:
            weights = F.transform(F.filter(h, lambda x: x["place"] == place), lambda x: x["w"])
            extra = F.least(F.lit(0.15), (F.size(weights) - 1) * 0.05)
            confidence = F.round(F.least(F.lit(1.0), F.array_max(weights) + extra), 3)
            return F.struct((-confidence).alias("order"), place.alias("place"), confidence.alias("confidence"))

        found = F.array_sort(F.transform(F.array_distinct(F.transform(h, lambda x: x["place"])), label))
        return F.transform(found, lambda x: F.struct(F.get(names, x["place"]).alias("category"), x["confidence"].alias("confidence")))

    out = F.get(F.transform(F.array(hits), ranked), F.lit(0))
    return F.when(t.isNotNull() & ~vetoed(t, categories=categories), out).otherwise(F.array().cast("array<struct<category:string,confidence:double>>"))


def label_names(found: Column) -> Column:
    return F.transform(found, lambda x: x["category"])


def primary(found: Column) -> Column:
    return F.try_element_at(found, F.lit(1))["category"]


def framework(c: Column) -> Column:
    """struct<agreement, edition, confidence> of the first pattern that matches, behind a hint and a veto; else NULL."""
    out = None
    for pattern, agreement, edition, confidence in R.FRAMEWORKS:
        value = F.struct(F.lit(agreement).alias("agreement"), F.lit(edition).alias("edition"), F.lit(confidence).alias("confidence"))
        out = F.when(matches(c, pattern), value) if out is None else out.when(matches(c, pattern), value)
    return F.when(matches(c, R.FRAMEWORK_HINT) & ~matches(c, R.FRAMEWORK_VETO), out)


def passes(c: Column, clauses: list[R.Clause]) -> Column:
    """Whether any clause holds: all of its first patterns, none of its second; NULL never passes."""
    t = F.lower(F.coalesce(c, F.lit("")))

    def holds(clause: R.Clause) -> Column:
        need, forbid = clause
        out = reduce(lambda a, p: a & t.rlike("(?U)" + p), need[1:], t.rlike("(?U)" + need[0]))
        return reduce(lambda a, p: a & ~t.rlike("(?U)" + p), forbid, out)

    return reduce(or_, [holds(x) for x in clauses])


def strategy(name: str):
    """A filter by name: original, balanced, comprehensive or strict."""
    return lambda c: passes(c, R.STRATEGIES[name])


def any_keyword(cols: list[Column], keywords: list[str]) -> Column:
    t = F.lower(F.concat_ws(" ", *cols))
    return reduce(or_, [t.contains(k) for k in keywords])


def edition(c: Column) -> Column:
    """1 to 4 after the name of the lighting service."""
    return F.nullif(F.regexp_extract(F.lower(c), r"servizio luce ([1-4])", 1), F.lit("")).try_cast("int")


def procedure(c: Column) -> Column:
    """One of the canonical procedure labels; NULL stays NULL."""
    t, out = F.lower(F.trim(c)), None
    for label, need, forbid in R.PROCEDURES:
        ok = reduce(lambda a, p: a & t.rlike(p), need[1:], t.rlike(need[0]))
        ok = reduce(lambda a, p: a & ~t.rlike(p), forbid, ok)
        out = F.when(ok, label) if out is None else out.when(ok, label)
    return F.when(t.isNotNull(), out.otherwise(R.OTHER_PROCEDURE))


def criterion(*candidates: Column, fallback: Column | None = None) -> Column:
    """Award criterion from the first that applies; else the text itself, upper-cased; empty without any."""
    t = F.upper(F.trim(F.concat_ws(" ", *candidates)))
    if fallback is not None:
        t = F.when(t == "", F.upper(F.coalesce(fallback, F.lit("")))).otherwise(t)
    out = None
    for name, pattern in R.CRITERIA:
        out = F.when(t.rlike(pattern), name) if out is None else out.when(t.rlike(pattern), name)
    return out.otherwise(t)


def minor_price(*cols: Column) -> Column:
    return F.upper(F.concat_ws(" ", *cols)).rlike("MINOR|PREZZO")


# ---------------------------------------------------------------- the same rule sets as SQL


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_match(expr: str, pattern: str, flags: str = "i") -> str:
    return f"regexp_matches({expr}, {quoted(pattern)}, {quoted(flags)})"


def sql_passes(expr: str, clauses: list[R.Clause]) -> str:
    t = f"lower(coalesce({expr}, ''))"
    return "(" + " OR ".join("(" + " AND ".join([*(sql_match(t, p, "c") for p in need), *(f"NOT {sql_match(t, p, 'c')}" for p in forbid)]) + ")" for need, forbid in clauses) + ")"


def sql_confidence(expr: str, patterns: list[tuple[str, float]]) -> str:
    """NULL if no pattern of the category matches."""
    weights = "list_filter([" + ", ".join(f"CASE WHEN {sql_match(expr, p)} THEN {float(w)}e0 END" for p, w in patterns) + "], lambda x: x IS NOT NULL)"
    return f"(SELECT CASE WHEN len(w) > 0 THEN round(least(1.0e0, list_max(w) + least(0.15e0, (len(w) - 1) * 0.05e0)), 3) END FROM (SELECT {weights} AS w))"


def sql_vetoed(expr: str) -> str:
    bad = " OR ".join(sql_match(expr, p) for p in R.NEGATIVES)
    good = " OR ".join(sql_match(expr, R.CATEGORIES[r][0][0]) for r in R.RESCUE)
    return f"(length(trim({expr})) < 5 OR (({bad}) AND NOT ({good})))"


def sql_first(rows: list[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN {value}" for cond, value in rows) + f" ELSE {otherwise} END"


def sql_procedure(expr: str) -> str:
    t = f"lower(trim({expr}))"
    rows = [(" AND ".join([*(sql_match(t, p, "c") for p in need), *(f"NOT {sql_match(t, p, 'c')}" for p in forbid)]), quoted(label)) for label, need, forbid in R.PROCEDURES]
    return f"CASE WHEN {expr} IS NULL THEN NULL ELSE {sql_first(rows, quoted(R.OTHER_PROCEDURE))} END"
