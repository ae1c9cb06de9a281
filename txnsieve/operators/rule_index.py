"""Thousands of rules: an inverted index over their conditions instead of one column per rule.

A rule that is a conjunction of comparisons of one field with one value is indexed. One of its conditions gives
access: of its equalities on a text field the one that fewest rules share, else a bound of the amount, else
nothing. A row finds the rules of its own values by one equi-join per access field (a value and the numbers
of its rules, broadcast), and those of a bound as the first entries of the rules sorted by their bounds. The other
conditions of the rules found are then checked one by one in place: nothing is shuffled, and a row costs what it
finds, not what there is. The number of joins follows the fields, and the size of the plan does not follow
the rules, which travel as one literal.

Rules of any other form are evaluated as columns, in blocks. Results equal those of ``with_rules``, the order of hits
included. Rules are configuration that the driver holds, as it does for ``with_rules``; ``rule_pieces`` adds up those
that are too many for it.
"""

from __future__ import annotations

import json
from collections import Counter, defaultdict
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnsieve.functions.search import count_at_most, listed
from txnsieve.operators.conditions import AMOUNT, Condition, conditions
from txnsieve.operators.predicates import predicate
from txnsieve.operators.rule_pieces import holds, once, passed, with_stored_totals
from txnsieve.operators.rules import HITS, SCORE, Rule, RuleSet, StoredRules, group_score, matches
from txnsieve.schemas import FIELD_COLUMNS

#: Rules that are no conjunction become columns, so many to a projection.
BLOCK = 50
_CONDITION = "struct<f: int, s: string, t: string, n: double>"


@dataclass(frozen=True)
class RuleIndex:
    """Numbers of rules by what gives access to them."""

    by_value: dict[str, dict[str, list[int]]]
    from_bound: list[tuple[float, int]]
    to_bound: list[tuple[float, int]]
    always: list[int]
    columns: list[int]
    conditions: list[list[Condition]]


def rule_index(rules: list[Rule]) -> RuleIndex:
    read = [conditions(r.expression) if r.valid else None for r in rules]
    shared = Counter((c.field, c.text) for found in read for c in found or [] if c.sign == "==" and c.text is not None)
    by_value: dict[str, dict[str, list[int]]] = defaultdict(lambda: defaultdict(list))
    from_bound, to_bound, always, columns = [], [], [], []
    for number, found in enumerate(read):
        if found is None:
            columns.append(number)
            continue
        equal = [c for c in found if c.sign == "==" and c.text is not None]
        low = [c.number for c in found if c.field == AMOUNT and c.sign in (">", ">=", "==")]
        high = [c.number for c in found if c.field == AMOUNT and c.sign in ("<", "<=")]
        if equal:
            best = min(equal, key=lambda c: shared[c.field, c.text])
            by_value[best.field][best.text].append(number)
        elif low:
            from_bound.append((max(low), number))
        elif high:
            to_bound.append((-min(high), number))
        else:
            always.append(number)
    return RuleIndex(by_value, sorted(from_bound), sorted(to_bound), always, columns, [f or [] for f in read])


def _up_to(bounds: list[tuple[float, int]], value: Column) -> Column:
    """The rules whose bound is at most ``value``."""
    numbers = listed([n for _, n in bounds])
    return F.slice(numbers, F.lit(1), count_at_most([b for b, _ in bounds], value))


def _matched(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``_matched``, the ascending numbers of the rules that match."""
    index, spark = rule_index(rules), rows.sparkSession
    fields = sorted({c.field for each in index.conditions for c in each if c.field != AMOUNT})
    texts = F.array(*[F.col(FIELD_COLUMNS[f]) for f in fields]).cast("array<string>")
    found = once(rows, _amount=F.col(AMOUNT).cast("double"), _texts=texts)
    candidates = [listed(index.always).cast("array<bigint>")] if index.always else []
    for field, values in sorted(index.by_value.items()):
        table = pa.table({f"_v_{field}": list(values), f"_r_{field}": pa.array(list(values.values()), pa.list_(pa.int64()))})
        side = F.broadcast(spark.createDataFrame(table))
        found = found.join(side, F.col(FIELD_COLUMNS[field]) == F.col(f"_v_{field}"), "left")
        candidates.append(F.coalesce(f"_r_{field}", F.array().cast("array<bigint>")))
    amount = F.when(~F.isnan("_amount"), F.col("_amount"))
    candidates += [_up_to(bounds, value) for bounds, value in ((index.from_bound, amount), (index.to_bound, -amount)) if bounds]
    held = json.dumps(
        [
            [{"f": -1 if c.field == AMOUNT else fields.index(c.field), "s": c.sign, "t": c.text, "n": c.number} for c in each]
            for each in index.conditions
        ]
    )
    conditions_of = F.from_json(F.lit(held), f"array<array<{_CONDITION}>>")
    none = F.array().cast("array<bigint>")
    found = once(found, _candidates=F.concat(none, *candidates))
    met = F.filter("_candidates", lambda n: F.forall(F.get(conditions_of, n.cast("int")), holds))
    found = once(found, _met=met)
    parts = ["_met"]
    for at in range(0, len(index.columns), BLOCK):
        name = f"_block_{at}"
        hits = [F.when(matches(rules[n]), F.lit(n).cast("long")) for n in index.columns[at : at + BLOCK]]
        found = once(found, **{name: F.filter(F.array(*hits), lambda n: n.isNotNull())})
        parts.append(name)
    kept = [F.col(c) for c in rows.columns]
    return found.select(*kept, F.array_sort(F.concat(*parts)).alias("_matched"))


def with_indexed_rules(rows: DataFrame, rule_set: RuleSet | StoredRules) -> DataFrame:
    """Add ``rule_hits`` and ``rule_score`` as ``with_rules`` does, for any number of rules."""
    single, groups = rule_set.ungrouped(), rule_set.groups()
    rules = [*single, *[r for members in groups.values() for r in members if r.score <= 0]]
    owner = [i for i, members in enumerate(groups.values()) for r in members if r.score <= 0]
    signals = Counter(owner)
    wanted = [signals[i] if members[0].match_mode == "ALL" else 1 for i, members in enumerate(groups.values())]
    hits = [{"name": r.name, "group_name": None, "score": r.score} for r in single]
    hits += [{"name": g, "group_name": g, "score": group_score(m)} for g, m in groups.items()]
    shape = "struct<name: string, group_name: string, score: bigint>"
    literal = F.from_json(F.lit(json.dumps(hits)), f"array<{shape}>")
    found = _matched(rows, rules)
    alone = F.filter("_matched", lambda n: n < len(single))
    of_groups = F.transform(F.filter("_matched", lambda n: n >= len(single)), lambda n: F.get(listed(owner), (n - len(single)).cast("int")))
    found = once(found, _alone=alone, _groups=of_groups)
    needed = listed(wanted)
    fired = F.filter(
        F.array_sort(F.array_distinct("_groups")),
        lambda g: F.size(F.filter("_groups", lambda x: x == g)) >= F.get(needed, g.cast("int")),
    )
    numbers = F.concat("_alone", F.transform(fired, lambda g: g + len(single)))
    found = once(found, **{HITS: F.transform(numbers, lambda n: F.get(literal, n.cast("int")))})
    total = F.aggregate(HITS, F.lit(0).cast("long"), lambda sum_, hit: sum_ + hit["score"])
    return found.select(*[F.col(c) for c in rows.columns], HITS, total.alias(SCORE))


def _stored_totals(rows: DataFrame, rule_set: StoredRules, hits: str) -> DataFrame:
    """Stored conjunctions without a group by their pieces; the driver holds members of groups and texts of other forms."""
    found, number, score = rows, F.lit(0).cast("long"), F.lit(0).cast("long")
    grouped = rule_set.grouped()
    if grouped.rules:
        found = with_indexed_rules(rows, grouped).withColumnsRenamed({HITS: "_hits", SCORE: "_score"})
        number, score = F.size("_hits").cast("long"), F.col("_score")
    others = rule_set.others()
    for at in range(0, len(others), BLOCK):
        name = f"_block_{at}"
        fired = [
            F.when(predicate(text), F.struct(F.lit(n).cast("long").alias("n"), F.lit(t).cast("long").alias("t")))
            for text, n, t in others[at : at + BLOCK]
        ]
        found = once(found, **{name: F.filter(F.array(*fired), lambda o: o.isNotNull())})
        number, score = (
            total + F.aggregate(F.col(name)[n], F.lit(0).cast("long"), lambda a, b: a + b) for total, n in ((number, "n"), (score, "t"))
        )
    if not grouped.rules and not others:
        return with_stored_totals(rows, rule_set, hits)
    own = with_stored_totals(found.select(*rows.columns, number.alias("_number"), score.alias("_sum")), rule_set, hits)
    totals = {hits: F.col(hits) + F.col("_number"), SCORE: F.col(SCORE) + F.col("_sum")}
    names = [SCORE, hits] if grouped.rules else [hits, SCORE]  # as without a store
    return own.select(*rows.columns, *[totals[n].alias(n) for n in names])


def with_rule_totals(rows: DataFrame, rule_set: RuleSet | StoredRules, hits: str = "hits") -> DataFrame:
    """Add the number of ``rule_hits`` and ``rule_score`` as of ``with_indexed_rules``, without listing the hits.

    Conjunctions that differ only in the bound from which the amount counts form one group of a value, with its
    bounds sorted and its scores added up. A row checks the other conditions once per group and finds its place among the
    bounds by halving, so it costs the groups of its values, not the rules it hits. Groups of rules count as a whole
    and take the listed form.
    """
    if isinstance(rule_set, StoredRules):
        return _stored_totals(rows, rule_set, hits)
    if rule_set.groups():
        listed_hits = with_indexed_rules(rows, rule_set)
        return listed_hits.withColumn(hits, F.size(HITS).cast("long")).drop(HITS)
    rules, spark = rule_set.ungrouped(), rows.sparkSession
    index = rule_index(rules)
    access = {n: (field, text) for field, values in index.by_value.items() for text, numbers in values.items() for n in numbers}
    groups: dict[tuple, list[tuple[float, int]]] = defaultdict(list)
    for number in sorted(set(range(len(rules))) - set(index.columns)):
        own = index.conditions[number]
        bound = next((c for c in own if c.field == AMOUNT and c.sign in (">", ">=")), None)
        rest = tuple(c for c in own if c is not bound)
        sign, at = (bound.sign, bound.number) if bound else ("", 0.0)
        groups[access.get(number, (None, None)), rest, sign].append((at, rules[number].score))
    fields = sorted({c.field for _, rest, _ in groups for c in rest if c.field != AMOUNT})
    texts = F.array(*[F.col(FIELD_COLUMNS[f]) for f in fields]).cast("array<string>")
    held: dict[tuple, list[dict]] = defaultdict(list)
    for (value, rest, sign), members in groups.items():
        members.sort()
        checks = [{"f": -1 if c.field == AMOUNT else fields.index(c.field), "s": c.sign, "t": c.text, "n": c.number} for c in rest]
        held[value].append({"c": checks, "s": sign, "b": [b for b, _ in members], "t": list(accumulate((s for _, s in members), initial=0))})
    condition = pa.struct([("f", pa.int32()), ("s", pa.string()), ("t", pa.string()), ("n", pa.float64())])
    kind = pa.list_(pa.struct([("c", pa.list_(condition)), ("s", pa.string()), ("b", pa.list_(pa.float64())), ("t", pa.list_(pa.int64()))]))
    found = once(rows, _amount=F.col(AMOUNT).cast("double"), _texts=texts)
    sides = []
    for field in sorted(index.by_value):
        values = [v for v in held if v[0] == field]
        table = pa.table({f"_v_{field}": [t for _, t in values], f"_g_{field}": pa.array([held[v] for v in values], kind)})
        side = F.broadcast(spark.createDataFrame(table))
        found = found.join(side, F.col(FIELD_COLUMNS[field]) == F.col(f"_v_{field}"), "left")
        sides.append(F.col(f"_g_{field}"))
    if (None, None) in held:
        shape = f"array<struct<c: array<{_CONDITION}>, s: string, b: array<double>, t: array<bigint>>>"
        sides.append(F.from_json(F.lit(json.dumps(held[None, None])), shape))
    number, score = F.lit(0).cast("long"), F.lit(0).cast("long")
    for at, side in enumerate(sides):
        met = F.filter(side, lambda g: F.forall(g["c"], holds))
        places = F.transform(met, lambda g: F.struct(passed(g).alias("n"), g["t"].alias("t")))
        totals = F.transform(places, lambda p: F.struct(p["n"].cast("long").alias("n"), F.get(p["t"], p["n"]).alias("t")))
        found = once(found, **{f"_totals_{at}": totals})
        for name in ("n", "t"):
            total = F.aggregate(F.coalesce(F.col(f"_totals_{at}")[name], F.array().cast("array<bigint>")), F.lit(0).cast("long"), lambda a, b: a + b)
            number, score = (number + total, score) if name == "n" else (number, score + total)
    for at in range(0, len(index.columns), BLOCK):
        name = f"_block_{at}"
        fired = [F.when(matches(rules[n]), F.lit(rules[n].score).cast("long")) for n in index.columns[at : at + BLOCK]]
        found = once(found, **{name: F.filter(F.array(*fired), lambda s: s.isNotNull())})
        number = number + F.size(name)
        score = score + F.aggregate(name, F.lit(0).cast("long"), lambda a, b: a + b)
    return found.select(*[F.col(c) for c in rows.columns], number.alias(hits), score.alias(SCORE))
