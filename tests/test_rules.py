"""Rule scores, composite and decision at their boundaries."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tallywatch.functions import rules
from tallywatch.operators import contracts, scoring

BASE = {
    "TransactionID": 1,
    "TransactionAmt": 10.0,
    "ProductCD": "W",
    "P_emaildomain": "gmail.com",
    "C13": 0.0,
    "V258": 0.0,
    "V257": 0.0,
    "spend_1hr": 0.0,
    "spend_24hr": 0.0,
    "txn_count_1hr": 0,
    "velocity_flag": False,
    "p_email_is_anonymous": False,
    "p_email_risk_score": 0.0,
    "hour_risk_level": "LOW",
}
TYPES = {f.name: cleaned for f in contracts.ENRICHED.fields for cleaned in [{"long": "bigint"}.get(f.kind, f.kind)]}
NAN = float("nan")


def rows(spark, changes):
    full = [{**BASE, **c, "row": i} for i, c in enumerate(changes)]
    schema = ", ".join(f"`{n}` {TYPES[n]}" for n in BASE) + ", row int"
    return spark.createDataFrame([tuple(r[n] for n in BASE) + (r["row"],) for r in full], schema)


CASES = {
    "high_amount_new_uid": [
        ({"TransactionAmt": 500.0, "txn_count_1hr": 1}, 30.0),
        ({"TransactionAmt": 500.01, "txn_count_1hr": 1}, 500.01 / 500 * 60),
        ({"TransactionAmt": 5000.0, "txn_count_1hr": None}, 100.0),
        ({"TransactionAmt": 501.0, "txn_count_1hr": 2}, 30.0),
        ({"TransactionAmt": 501.0, "txn_count_1hr": 3}, 0.0),
        ({"TransactionAmt": 200.0}, 0.0),
        ({"TransactionAmt": 200.01, "txn_count_1hr": 2}, 30.0),
        ({"TransactionAmt": None}, 0.0),
        ({"TransactionAmt": NAN}, 0.0),
    ],
    "anonymous_email_amount": [
        ({"p_email_is_anonymous": True, "p_email_risk_score": 60.0, "TransactionAmt": 100.0}, 60.0),
        ({"p_email_is_anonymous": True, "p_email_risk_score": 60.0, "TransactionAmt": 200.0}, 80.0),
        ({"p_email_is_anonymous": True, "p_email_risk_score": 95.0, "TransactionAmt": 200.0}, 100.0),
        ({"p_email_is_anonymous": True, "p_email_risk_score": None}, 0.0),
        ({"p_email_is_anonymous": None, "p_email_risk_score": 60.0}, 0.0),
    ],
    "product_h_cnp": [({"ProductCD": "H"}, 75.0), ({"ProductCD": "C"}, 60.0), ({"ProductCD": "W"}, 0.0), ({"ProductCD": None}, 0.0)],
    "velocity_breach": [
        ({"velocity_flag": True, "spend_1hr": 10.0, "spend_24hr": 24.0}, 100.0),
        ({"velocity_flag": True, "spend_1hr": 3.5, "spend_24hr": 24.0}, 87.5),
        ({"velocity_flag": True, "spend_1hr": 3.5, "spend_24hr": 0.0}, 50.0),
        ({"velocity_flag": False, "spend_1hr": 10.0, "spend_24hr": 24.0}, 0.0),
        ({"velocity_flag": None}, 0.0),
    ],
    "night_foreign_email": [
        ({"hour_risk_level": "HIGH"}, 40.0),
        ({"hour_risk_level": "high"}, 40.0),
        ({"hour_risk_level": "HIGH", "P_emaildomain": "proton.me"}, 80.0),
        ({"hour_risk_level": "HIGH", "P_emaildomain": " OUTLOOK.com "}, 40.0),
        ({"hour_risk_level": "HIGH", "P_emaildomain": None}, 40.0),
        ({"hour_risk_level": "HIGH", "P_emaildomain": ""}, 40.0),
        ({"hour_risk_level": "HIGH", "p_email_is_anonymous": True}, 80.0),
        ({"hour_risk_level": None, "P_emaildomain": "proton.me"}, 0.0),
        ({"hour_risk_level": "", "P_emaildomain": "proton.me"}, 0.0),
    ],
    "m_mismatch": [({}, 0.0)],
    "c13_spike": [
        ({"C13": 500.0}, 0.0),
        ({"C13": 500.5}, 25.0),
        ({"C13": 1500.0}, 25.0),
        ({"C13": 1501.0}, 60.0),
        ({"C13": 2500.0}, 60.0),
        ({"C13": 2501.0}, 100.0),
        ({"C13": None}, 0.0),
        ({"C13": NAN}, 0.0),
    ],
    "v258_v257_threshold": [
        ({"V258": 2.0, "V257": 3.0}, 50.0),
        ({"V258": 20.0, "V257": 3.0}, 100.0),
        ({"V258": 2.0, "V257": 0.0}, 30.0),
        ({"V258": None, "V257": 1.0}, 30.0),
        ({"V258": NAN, "V257": 5.0}, 30.0),
        ({"V258": -1.0, "V257": 0.0}, 0.0),
        ({"V258": None, "V257": None}, 0.0),
    ],
}


@pytest.mark.parametrize("name", list(CASES))
def test_rule(spark, name):
    rule = next(r for r in rules.RULES if r.name == name)
    df = rows(spark, [c for c, _ in CASES[name]]).select("row", rule.score().alias("s"))
    got = [r.s for r in sorted(df.collect())]
    assert got == pytest.approx([want for _, want in CASES[name]])


def test_weights_sum_to_one():
    assert sum(r.weight for r in rules.RULES) == pytest.approx(1.0)


def test_decision_boundaries_and_confidence(spark):
    scores = [0.0, 34.99, 35.0, 50.0, 64.99, 65.0, 95.0]
    df = spark.createDataFrame([(s,) for s in scores], "s double").select(
        "s", scoring.decision(F.col("s")).alias("d"), scoring.confidence(F.col("s")).alias("c")
    )
    got = {r.s: (r.d, r.c) for r in df.collect()}
    assert [got[s][0] for s in scores] == ["APPROVE", "APPROVE", "REVIEW", "REVIEW", "REVIEW", "BLOCK", "BLOCK"]
    assert [got[s][1] for s in scores] == [0.5, 0.5, 0.5, 0.5, 0.65, 0.65, 0.95]


def test_score_lists_triggered_rules_in_order(spark):
    df = rows(spark, [{"ProductCD": "H", "C13": 3000.0, "TransactionAmt": 600.0}])
    got = scoring.score(df, F.lit("2024-01-01")).collect()[0]
    assert got.rules_triggered == ["rule_high_amount_new_uid", "rule_product_h_cnp", "rule_c13_spike"]
    assert got.fraud_score == pytest.approx(0.2 * 72 + 0.15 * 75 + 0.1 * 100, abs=0.005)
    assert got.model_version == "rules-v1.0"
    enum = scoring.decide(scoring.score(df, F.lit("x")), F.lit("x")).filter(~contracts.in_enum("decision"))
    assert enum.count() == 0
