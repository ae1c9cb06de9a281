from __future__ import annotations

import random

import pytest
from checks import plan_text

from txnsieve.operators import rule_pieces
from txnsieve.operators.conditions import Condition, conditions
from txnsieve.operators.predicates import RuleError, predicate
from txnsieve.operators.rule_index import with_indexed_rules, with_rule_totals
from txnsieve.operators.rules import RuleSet, StoredRules, list_rules, load_rules, render_rules, rule_errors, rule_hits, with_rules
from txnsieve.plans import fixtures
from txnsieve.schemas import FIELD_COLUMNS, RULES

AMOUNT = ("amount > 500", 20, None, None)
COUNTRY = ("ipCountry != billingCountry", 15, None, None)
ALL_GROUP = [
    ("amount > 500", 0, "fraud", "ALL"), ("ipCountry != billingCountry", 0, "fraud", "ALL"), ("true", 60, "fraud", "ALL"),
]
ANY_GROUP = [
    ("merchantCategoryCode == '7995'", 0, "risky", "ANY"), ("merchantCategoryCode == '5912'", 0, "risky", "ANY"),
    ("true", 25, "risky", "ANY"),
]


def table(spark, rules, enabled=True):
    rows = [(i, f"r{i}", x, s, enabled, g, m) for i, (x, s, g, m) in enumerate(rules, 1)]
    return spark.createDataFrame(rows, RULES)


def events(spark, *rows):
    defaults = {c: "" for c in FIELD_COLUMNS.values()}
    full = [{**defaults, "transaction_id": f"t{i}", **row} for i, row in enumerate(rows)]
    types = ", ".join(f"{c} {'double' if c == 'amount' else 'string'}" for c in FIELD_COLUMNS.values())
    return spark.createDataFrame([tuple(r[c] for c in FIELD_COLUMNS.values()) for r in full], types)


def event(amount, mcc="5412", ip="US", billing="US"):
    return {"amount": float(amount), "merchant_category_code": mcc, "ip_country": ip, "billing_country": billing}


def score(spark, rules, row):
    return with_rules(events(spark, row), load_rules(table(spark, rules))).first().rule_score


@pytest.mark.parametrize(
    ("rules", "row", "expected"),
    [
        ([AMOUNT], event(600), 20),
        ([AMOUNT], event(100), 0),
        ([AMOUNT, COUNTRY], event(600, ip="RU"), 35),
        ([AMOUNT, COUNTRY], event(100), 0),
        ([("amount is ?? large", 50, None, None)], event(600), 0),
        ([], event(600), 0),
        (ALL_GROUP, event(800, ip="RU"), 60),
        (ALL_GROUP, event(100, ip="RU"), 0),
        (ALL_GROUP, event(100), 0),
        (ANY_GROUP, event(100, "7995"), 25),
        (ANY_GROUP, event(100), 0),
        ([*ANY_GROUP[:1], *ANY_GROUP], event(100, "7995"), 25),
        ([AMOUNT, *ANY_GROUP], event(600, "7995"), 45),
        # No score carrier, no signal, no mode, a broken member, the first of two carriers
        (ALL_GROUP[:2], event(800, ip="RU"), 0),
        (ALL_GROUP[2:], event(800, ip="RU"), 0),
        ([("amount > 500", 0, "g", None), ("true", 7, "g", None)], event(600), 7),
        ([("amount >", 0, "g", "ALL"), ("true", 7, "g", "ALL")], event(600), 0),
        ([("amount >", 0, "g", "ANY"), ("true", 0, "g", "ANY"), ("true", 7, "g", "ANY"), ("true", 9, "g", "ANY")], event(1), 7),
    ],
)
def test_scores(spark, rules, row, expected):
    assert score(spark, rules, row) == expected


@pytest.mark.parametrize(
    ("text", "row", "matches"),
    [
        ("amount > 500 && ipCountry == 'US'", event(600), True),
        ("amount > 500 || ipCountry == 'US'", event(1), True),
        ("!(amount > 500)", event(1), True),
        ("not (amount gt 500) and ipCountry eq 'US'", event(1), True),
        ("merchantId == 'a && b || !c == d'", {**event(1), "merchant_id": "a && b || !c == d"}, True),
        ("merchantId == 'it''s'", {**event(1), "merchant_id": "it's"}, True),
        (r"merchantId == 'a\n'", {**event(1), "merchant_id": r"a\n"}, True),
        ('ipCountry == "US"', event(1), True),
        ("merchantCategoryCode == 5412", event(1), False),
        ("merchantCategoryCode != 5412", event(1), True),
        ("amount * 2 > 500", event(251), True),
        ("1 / (amount - amount) > 0", event(1), False),
        ("amount > 500", event("nan"), False),
        ("amount < 500", event("nan"), False),
        ("startswith(ipAddress, '10.')", {**event(1), "ip_address": "10.1"}, True),
        ("merchantRiskTier == null", {**event(1), "merchant_risk_tier": None}, True),
    ],
)
def test_predicates(spark, text, row, matches):
    assert score(spark, [(text, 1, None, None)], row) == int(matches)


@pytest.mark.parametrize(
    ("text", "row", "matches"),
    [
        # Text against number, and NaN, in whatever form
        ("(merchantCategoryCode) == 5412", event(1), False),
        ("lower(merchantCategoryCode) == 5412", event(1), False),
        ("!(merchantCategoryCode == 5412)", event(1), True),
        ("(amount) > 500", event("nan"), False),
        ("amount * 2 > 500", event("nan"), False),
        ("amount == amount", event("nan"), False),
        ("amount != amount", event("nan"), True),
        ("-amount < 0", event("nan"), False),
        ("!(amount > 500)", event("nan"), True),
        # Binding
        ("!true == false", event(1), True),
        ("!(ipCountry == 'US') || amount - 1 - 1 == 8", event(10), True),
        ("amount + 2 * 3 == 16", event(10), True),
        ("amount % 4 == 2 and not false", event(10), True),
        ("- 3 + amount == 7", event(10), True),
        # Built-ins
        ("merchantCategoryCode matches '5[0-9]{3}'", event(1), True),
        ("merchantCategoryCode matches '541'", event(1), False),
        ("amount between {10, 20}", event(20), True),
        ("amount between {10, 20}", event("nan"), False),
        ("ipCountry between {'UA', 'UZ'}", event(1), True),
        ("ipCountry.startsWith('U') and ipCountry.toLowerCase().contains('s')", event(1), True),
        ("ipCountry.length() == 2 && !ipCountry.isEmpty()", event(1), True),
        ("ipCountry.equalsIgnoreCase('us') && 'x' + ipCountry == 'xUS'", event(1), True),
        ("amount > 5 ? ipCountry == 'US' : false", event(1), False),
        ("(merchantRiskTier ?: 'none') == 'none'", event(1), True),
        ("merchantRiskTier.length() > 0", {**event(1), "merchant_risk_tier": None}, False),
        ("amount / 0 > 1", event(1), False),
    ],
)
def test_typed_predicates(spark, text, row, matches):
    assert score(spark, [(text, 1, None, None)], row) == int(matches)


@pytest.mark.parametrize(
    "text",
    [
        "merchantCategoryCode > 5", "(merchantCategoryCode) > 100", "lower(merchantCategoryCode) < 7", "nosuchfield == 1", "(select 1)",
        "amount ; 1", "T(x)", "!merchantRiskTier == 'high'", "amount", "amount + ipCountry > 1", "ipCountry.getBytes()", "amount > 1 > 2",
        "length(amount) > 1", "ipCountry.contains()", "ipCountry matches '('", "amount between {1}", "true ? 1 : 'a'", "", "amount >", "(amount > 1",
    ],
)
def test_texts_that_are_no_rules(spark, text):
    with pytest.raises(RuleError):
        predicate(text)


def test_broken_rules_are_listed(spark):
    rules = table(spark, [AMOUNT, ("amount +", 1, None, None), ("amount + 1", 1, None, None)])
    loaded = load_rules(rules)
    assert [r.id for r in rule_errors(spark, loaded).orderBy("id").collect()] == [2, 3]


def test_reload_replaces_the_snapshot(spark):
    first, second = load_rules(table(spark, [("amount > 1000", 30, None, None)])), load_rules(
        table(spark, [("amount > 2000", 50, None, None)])
    )
    rows = events(spark, event(1500), event(2500))
    assert [r.rule_score for r in with_rules(rows, first).orderBy("transaction_id").collect()] == [30, 30]
    assert [r.rule_score for r in with_rules(rows, second).orderBy("transaction_id").collect()] == [0, 50]
    assert first.version != second.version


def test_disabled_rules_do_not_score(spark):
    assert load_rules(table(spark, [AMOUNT], enabled=False)).rules == ()


def test_hits_name_rules_and_groups(spark):
    rows = with_rules(events(spark, event(600, "7995")), load_rules(table(spark, [AMOUNT, *ANY_GROUP])))
    assert [(r.name, r.group_name, r.score) for r in rule_hits(rows).orderBy("name").collect()] == [
        ("r1", None, 20), ("risky", "risky", 25),
    ]


def test_many_rules(spark):
    rules = [(f"amount > {i}", 1, None, None) for i in range(300)]
    assert score(spark, rules, event(150.5)) == 151


def test_list_order_and_text(spark):
    listed = render_rules(list_rules(table(spark, [*ALL_GROUP[:1], AMOUNT]))).collect()
    assert [r.name for r in listed] == ["r2", "r1"]
    assert listed[0].text == "Rule: r2 | Score: 20 | Enabled: true\nExpression: amount > 500\nGroup: none"
    assert listed[1].text.endswith("Group: fraud (ALL)")


def random_rules(rng, count):
    """Conjunctions of every kind, groups of them, and other forms."""
    tiers, mccs, countries = ["high", "low", "it''s"], ["7995", "5411"], ["US", "RU", "CA"]

    def part():
        return rng.choice([
            f"merchantRiskTier == '{rng.choice(tiers)}'", f"merchantCategoryCode eq '{rng.choice(mccs)}'", f"ipCountry != '{rng.choice(countries)}'",
            f"amount > {rng.randint(0, 900)}", f"amount <= {rng.randint(0, 900)}.5", f"{rng.randint(0, 900)} < amount", f"amount == {rng.choice([5, 250])}",
            f"amount != {rng.choice([5, 250])}", f"billingCountry >= '{rng.choice(countries)}'", "amount >= -5",
        ])

    rows = []
    for i in range(count):
        text = rng.choice([" and ", " && "]).join(part() for _ in range(rng.randint(1, 4)))
        if rng.random() < 0.15:
            text = rng.choice([f"({text})", f"!({text})", f"{text} || amount > 880", "amount is ?? broken", "merchantId == 5", "true", "ipCountry == null"])
        group = rng.choice([None, None, None, f"g{rng.randrange(8)}"])
        score = rng.choice([0, 0, 10]) if group else rng.randint(1, 9)
        rows.append((i, f"rule {i}", text, score, rng.random() < 0.95, group, rng.choice(["ALL", "ANY"]) if group else None))
    return rows


def test_indexed_rules_equal_columns(spark):
    rng = random.Random(21)
    loaded = load_rules(spark.createDataFrame(random_rules(rng, 160), RULES))
    names = list(FIELD_COLUMNS.values())
    values = {
        "amount": [5.0, 250.0, 600.5, 899.0, float("nan"), None, -7.0], "merchant_risk_tier": ["high", "low", "it's", None],
        "merchant_category_code": ["7995", "5411", None], "ip_country": ["US", "RU", "", None], "billing_country": ["US", "CA", None],
    }
    data = [(f"t{i}", *[rng.choice(values.get(c, ["x"])) for c in names if c != "transaction_id"]) for i in range(300)]
    schema = ", ".join(f"{c} {'double' if c == 'amount' else 'string'}" for c in ["transaction_id", *[c for c in names if c != "transaction_id"]])
    df = spark.createDataFrame(data, schema)
    indexed, columns = with_indexed_rules(df, loaded), with_rules(df, loaded)
    assert indexed.columns == columns.columns and indexed.dtypes == columns.dtypes
    got = {r.transaction_id: (r.rule_hits, r.rule_score) for r in indexed.collect()}
    want = {r.transaction_id: (r.rule_hits, r.rule_score) for r in columns.collect()}
    assert got == want and any(len(h) > 5 for h, _ in want.values())
    none = with_indexed_rules(df, RuleSet())
    assert none.dtypes == columns.dtypes and {r.rule_score for r in none.collect()} == {0}


def test_conditions_of_a_conjunction():
    assert conditions("amount > 5 and merchantId == 'a'") == [Condition("amount", ">", None, 5.0), Condition("merchantId", "==", "a")]
    assert conditions("-5 <= amount && 'x' != ipCountry") == [Condition("amount", ">=", None, -5.0), Condition("ipCountry", "!=", "x")]
    for other in ("a || b", "(amount > 5)", "amount > 5 || true", "true", "merchantId == 5", "amount == 'x'", "amount between {1, 2}", "amount > currency"):
        assert conditions(other) is None


def test_five_thousand_rules(spark, sf_dir):
    """One join, since all give access by one field, and nothing shuffled."""
    rng = random.Random(3)
    rows = [(i, f"r{i}", f"merchantId == 'mch_{rng.randrange(120)}' and amount > {rng.randint(0, 6000)}" + (" and ipCountry == 'RU'" if i % 4 == 0 else ""), 1 + i % 5, True, None, None) for i in range(5000)]
    loaded = load_rules(spark.createDataFrame(rows, RULES))
    events = fixtures.transactions(spark, sf_dir)
    found = with_indexed_rules(events, loaded)
    plan = plan_text(found)
    assert plan.count("BroadcastHashJoin") == 1 and "Exchange hash" not in plan and "NestedLoop" not in plan
    got = {r.transaction_id: ([h.name for h in r.rule_hits], r.rule_score) for r in found.collect()}
    read = [(name, score, *text.replace(" and ipCountry == 'RU'", "").replace("merchantId == ", "").replace("'", "").split(" and amount > "), "RU" in text) for _, name, text, score, *_ in rows]
    for e in events.collect():
        hits = [(n, s) for n, s, m, least, abroad in read if e.merchant_id == m and e.amount > float(least) and (not abroad or e.ip_country == "RU")]
        assert got[e.transaction_id] == ([n for n, _ in hits], sum(s for _, s in hits))


def test_totals_equal_listed_hits(spark):
    """Without a list of hits, also where rules share all but the bound of the amount."""
    rng = random.Random(8)
    texts = [f"merchantRiskTier == '{rng.choice(['high', 'low'])}' and amount {rng.choice(['>', '>='])} {rng.choice([5, 250, 600.5, 899])}" for _ in range(200)]
    rows = [(1000 + i, f"bound {i}", text + rng.choice(["", " and ipCountry != 'US'"]), 1 + i % 7, True, None, None) for i, text in enumerate(texts)]
    grouped = random_rules(rng, 120)
    values = {
        "amount": [5.0, 250.0, 600.5, 899.0, float("nan"), None, -7.0], "merchant_risk_tier": ["high", "low", "it's", None],
        "merchant_category_code": ["7995", "5411", None], "ip_country": ["US", "RU", "", None], "billing_country": ["US", "CA", None],
    }
    names = ["transaction_id", *[c for c in FIELD_COLUMNS.values() if c != "transaction_id"]]
    data = [(f"t{i}", *[rng.choice(values.get(c, ["x"])) for c in names[1:]]) for i in range(200)]
    df = spark.createDataFrame(data, ", ".join(f"{c} {'double' if c == 'amount' else 'string'}" for c in names))
    for given in ([*[r for r in grouped if r[5] is None], *rows], [*grouped, *rows], rows[:0]):
        loaded = load_rules(spark.createDataFrame(given, RULES))
        listed, totals = with_indexed_rules(df, loaded), with_rule_totals(df, loaded)
        assert {r.transaction_id: (r.hits, r.rule_score) for r in totals.collect()} == {r.transaction_id: (len(r.rule_hits), r.rule_score) for r in listed.collect()}
    few = plan_text(with_rule_totals(df, load_rules(spark.createDataFrame(rows, RULES))))
    assert few.count("BroadcastHashJoin") == 1 and "bound 7" not in few


def test_stored_rules_total_as_held_ones(spark, monkeypatch):
    """Rules that the driver does not hold: all forms, ids of which one rule is broken, null and repeated rows, many pieces."""
    rng = random.Random(34)
    names = ["transaction_id", *[c for c in FIELD_COLUMNS.values() if c != "transaction_id"]]
    values = {
        "amount": [*range(0, 900, 7), 5.0, 600.5, float("nan"), None, -7.0, -0.0], "merchant_risk_tier": ["high", "low", "it's", None],
        "merchant_category_code": ["7995", "5411", None], "ip_country": ["US", "RU", "", None], "billing_country": ["US", "CA", None],
    }
    data = [(f"t{i}" if i % 9 else None, *[rng.choice(values.get(c, ["x"])) for c in names[1:]]) for i in range(150)]
    data = [tuple(float(v) if isinstance(v, int) else v for v in row) for row in [*data, *data[:20]]]
    df = spark.createDataFrame(data, ", ".join(f"{c} {'double' if c == 'amount' else 'string'}" for c in names))
    tier = [f"merchantRiskTier == 'high' and amount {rng.choice(['>', '>='])} {rng.randint(0, 1800) / 2}" for _ in range(700)]
    single = [(1000 + i, f"bound {i}", x, 1 + i % 7, True, None, None) for i, x in enumerate(tier)]
    many = [(3000 + i, f"other {i}", f"ipCountry != 'x{i}' and merchantCategoryCode eq '7995'", 1, True, None, None) for i in range(300)]
    odd = [(1003, "same id", "amount >", 1, True, None, None), (1004, "same id", "amount ? 1", 1, True, None, None), (1005, "no text", " ", 1, True, None, None)]
    mixed = random_rules(rng, 150)
    for given in (single, [r for r in mixed if r[5] is None] + many, [*mixed, *single, *odd], odd):
        monkeypatch.setattr(rule_pieces, "fits_broadcast", lambda pieces, fits=given is not single: fits)
        rules = spark.createDataFrame(given, RULES)
        held, stored = load_rules(rules), load_rules(rules, most=2)
        assert isinstance(held, RuleSet) and isinstance(stored, StoredRules)
        want, got = with_rule_totals(df, held), with_rule_totals(df, stored)
        assert got.dtypes == want.dtypes
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        assert "held" not in vars(stored)  # nothing asked for all rules on the driver
        assert len(stored.errors) == len(held.errors)
        if len({r[0] for r in given}) == len(given):  # else the order is open
            assert stored.version == held.version


def test_query_of_many_rules_keeps_them_off_the_driver(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(load_rules, "__defaults__", (100,))
    stored = load_rules(fixtures.customer_rules(spark, sf_dir))
    totals = with_rule_totals(fixtures.transactions(spark, sf_dir), stored)
    plan = plan_text(totals)
    assert "held" not in vars(stored) and "LocalTableScan" not in plan and "NestedLoop" not in plan
    held = with_rule_totals(fixtures.transactions(spark, sf_dir), load_rules(fixtures.customer_rules(spark, sf_dir), most=10_000))
    assert sorted(totals.select("transaction_id", "hits", "rule_score").collect()) == sorted(held.select("transaction_id", "hits", "rule_score").collect())
