"""Golden vectors for scalar functions, classification and extraction."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from tenderloom.functions import classify as K
from tenderloom.functions import extract as X
from tenderloom.functions import rules as R
from tenderloom.functions import scalars as S
from tenderloom.plans.bindings import SUBJECTS


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("r")).first()["r"]


CASES = [
    (S.clean_text, "  test  ", "test"),
    (S.clean_text, "test\\ntest", "test test"),
    (S.clean_text, "test\ntest", "test test"),
    (S.clean_text, "test test", "test test"),
    (S.clean_text, None, ""),
    (S.title_case, "L'AQUILA S.P.A. reggio-emilia", "L'Aquila S.P.A. Reggio-Emilia"),
    (lambda c: S.truncate(c, 10), "Testo molto lungo", "Testo m..."),
    (S.date_of, "15/03/2024", datetime.date(2024, 3, 15)),
    (S.date_of, "15-03-2024", datetime.date(2024, 3, 15)),
    (S.date_of, "15.03.2024", datetime.date(2024, 3, 15)),
    (S.date_of, "2024-03-15", datetime.date(2024, 3, 15)),
    (S.date_of, "15 marzo 2024", datetime.date(2024, 3, 15)),
    (S.date_of, "non specificata", None),
    (S.date_of, "invalid", None),
    (S.safe_date, "2024-02-10 17:35:30.228T12:00:00Z", "2024-02-10"),
    (S.safe_date, "2024", None),
    (S.duration_from_text, "3 anni", 1095),
    (S.duration_from_text, "6 mesi", 180),
    (S.duration_from_text, "30 giorni", 30),
    (S.duration_from_text, "ventennale", 7300),
    (S.duration_from_text, "non specificata", None),
    (S.lot_code, "1234567890", "1234567890"),
    (S.lot_code, "ZB12345678", "ZB12345678"),
    (S.lot_code, "X123456789", "X123456789"),
    (S.lot_code, "invalid", None),
    (S.lot_code, "NON SPECIFICATO", None),
    (S.project_code, "B12F11000370004", "B12F11000370004"),
    (S.vat_number, "12345678903", "12345678903"),
    (S.vat_number, "12345678901", None),
    (S.vat_number, "123", None),
    (S.tax_code, "RSSMRA80A01H501U", "RSSMRA80A01H501U"),
    (S.amount, "1.234,56", 1234.56),
    (S.amount, "€ 1.000,00", 1000.0),
    (S.amount, "1,234.56", 1234.56),
    (S.amount, "$1000", 1000.0),
    (S.amount, "-100", None),
    (S.first_key, ";X", None),
    (S.first_key, "nan", None),
    (S.first_key, "a1;b2", "A1"),
    (S.town_name, "ACQUAVIVA DELLE FONTI", "Acquaviva delle Fonti"),
    (S.town_name, "reggio  emilia", "Reggio Emilia"),
    (S.entity_name, "ENEL S.P.A.", "Enel S.p.A."),
    (S.entity_name, "nan", None),
    (X.discount_in, "26,300%", 26.3),
    (X.discount_in, "Ribasso economico 19,678%...", 19.678),
    (X.discount_in, "- 32,919 %", 32.919),
    (X.discount_in, "43.0", 43.0),
    (X.discount_in, "150%", None),
    (X.first_number_in, "prezzo 1.234,56 euro", 1234.56),
    (X.first_number_in, "nessuno", None),
    (X.date_in, "il 5/3/2024 a Roma", "2024-03-05"),
    (X.date_in, "il 5 marzo 2024", "2024-03-05"),
    (X.entity_in, "Comune di Roma, ufficio", "Roma"),
    (X.lot_code_in, "CIG: AB12345678 e altro", "AB12345678"),
    (X.lot_code_in, "codice 1234567890", "1234567890"),
    (K.edition, "Servizio Luce 3", 3),
]


@pytest.mark.parametrize("f,value,want", CASES)
def test_scalar(spark, f, value, want):
    assert one(spark, value, f) == want


LABELS = [
    ("abcd", []),
    ("museo civico", []),
    ("museo con illuminazione pubblica", [("ILLUMINAZIONE", 1.0)]),
    ("telecamere", [("VIDEOSORVEGLIANZA", 0.8)]),
    ("CITTÀ INTELLIGENTE", [("SMART_CITY", 0.9)]),
    ("acquedotto e discarica", [("ACQUA_FOGNATURE", 0.8), ("RIFIUTI", 0.8)]),
    ("parcometri intelligenti", [("SMART_PARKING", 0.9)]),
    (None, []),
]


@pytest.mark.parametrize("text,want", LABELS)
def test_labels(spark, text, want):
    got = one(spark, text, lambda c: K.labels(K.folded(c)))
    assert [(x["category"], x["confidence"]) for x in got] == want


def test_labels_equal_plain_patterns(spark):
    """Looking for literals first changes nothing: each pattern's answer, and the labels, by Python's patterns."""
    every = [(name, p, w) for name, ps in R.CATEGORIES.items() for p, w in ps]
    pieces = [re.sub(r"\\[sb]\+?\*?", " ", re.sub(r"\(\?:([^|)]*)[^)]*\)\??", r"\1", re.sub(r"\[(.)[^\]]*\]", r"\1", p.replace(".*", " e ").replace("?", "")))) for _, p, _ in every]
    rng = random.Random(1)
    texts = SUBJECTS + pieces + [" ".join(rng.choice(pieces + SUBJECTS) for _ in range(3)).upper() for _ in range(200)]
    assert all(lit in re.sub(r"\\", "", p) for _, p, _ in every for lit in K.literals(p))
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string").select("i", K.labels(K.folded(F.col("v"))).alias("r")).collect()
    found = 0
    for i, labels in got:
        t = texts[i]
        m = lambda p: re.search(p, t, re.I)
        want = []
        if len(t.strip(" ")) >= 5 and not (any(map(m, R.NEGATIVES)) and not any(m(R.CATEGORIES[r][0][0]) for r in R.RESCUE)):
            for place, (name, ps) in enumerate(R.CATEGORIES.items()):
                w = [w for p, w in ps if m(p)]
                if w:
                    want.append((-round(min(1.0, max(w) + min(0.15, 0.05 * (len(w) - 1))), 3), place, name))
        assert [(x["category"], x["confidence"]) for x in labels] == [(n, -c) for c, _, n in sorted(want)]
        found += len(want)
    assert found > 300


def test_framework_veto_and_order(spark):
    assert one(spark, "SIE4 energia", K.framework)["edition"] == "4"
    assert one(spark, "servizio luce 3", K.framework)["agreement"] == "SL"
    assert one(spark, "siemens SIE 4", K.framework) is None
    assert one(spark, "codice 1615", K.framework)["confidence"] == 0.95
    assert one(spark, "altro", K.framework) is None


@pytest.mark.parametrize("text,label", [("open", "Procedura Aperta"), ("Affidamento diretto", "Affidamento Diretto"), ("negoziata senza bando", "Procedura Negoziata senza Bando"), ("art. 63", "Procedura Negoziata"), ("boh", R.OTHER_PROCEDURE), (None, None)])
def test_procedure(spark, text, label):
    assert one(spark, text, K.procedure) == label


def test_strategies(spark):
    text = "Pubblica illuminazione a led"
    assert all(one(spark, text, K.strategy(s)) for s in ("original", "balanced", "comprehensive", "strict"))
    assert not any(one(spark, None, K.strategy(s)) for s in R.STRATEGIES)


def test_rule_tables():
    assert len(R.PREFIX_REGION) == 93 - 0 or len(R.PREFIX_REGION) > 85
    assert len(R.UNIFIED_COLUMNS) == 43
    assert {*R.PREFIX_REGION.values(), *R.TOWN_REGION.values(), *R.SECTIONS.values()} <= {*R.REGIONS}
