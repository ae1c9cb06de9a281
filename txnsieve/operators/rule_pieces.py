"""Totals of stored rules: what ``rule_index`` does for rules of the driver, for any number of them.

Conjunctions that differ only in the bound from which the amount counts form one group, with its bounds sorted and
numbers and scores added up along them. A group of n bounds is cut into pieces of about the root of n. A row finds the groups of
its own values by one join, in place the piece of each group whose other conditions it meets, and by a second join
its place in the piece. Its totals are then added up again. So neither the driver nor a row ever holds the bounds of a group, and
nothing but the beginnings of few pieces is broadcast; a hot group is spread by its pieces, a hot piece by adaptive
execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnsieve.operators.conditions import AMOUNT
from txnsieve.operators.lookups import fits_broadcast, lookup_join, shuffled
from txnsieve.operators.rules import HITS, SCORE, StoredRules
from txnsieve.schemas import FIELD_COLUMNS
from txnsieve.session import staged

#: Groups of one value to a row of the index.
GROUPS = 256
#: Bounds that are not worth cutting.
SHORT = 64
#: Rows that find nothing are dealt by so many keys that no rule has.
NOWHERE = 997
_KEY = ["_field", "_value"]


def holds(condition: Column) -> Column:
    """Whether a row meets a condition; the kinds agree, and null or NaN meets only ``!=``."""
    sign, text, number = condition["s"], F.get(F.col("_texts"), condition["f"]), F.col("_amount")
    same = F.when(condition["f"] < 0, number.eqNullSafe(condition["n"]) & ~F.isnan(F.coalesce(number, F.lit(0.0)))).otherwise(
        text.eqNullSafe(condition["t"])
    )

    def ordered(a: Column, b: Column) -> Column:
        return F.when(sign == "<", a < b).when(sign == "<=", a <= b).when(sign == ">", a > b).otherwise(a >= b)

    real = F.when(F.isnan(number), F.lit(False)).otherwise(ordered(number, condition["n"]))
    other = F.when(condition["f"] < 0, real).otherwise(ordered(text, condition["t"]))
    return F.coalesce(F.when(sign == "==", same).when(sign == "!=", ~same).otherwise(other), F.lit(False))


def once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are worked out once per row, however often later expressions name them."""
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def passed(group: Column) -> Column:
    """How many of the sorted bounds of a group the amount of the row passes, by halving."""
    bounds, amount = group["b"], F.col("_amount")
    real = amount.isNotNull() & ~F.isnan(F.coalesce(amount, F.lit(0.0)))

    def step(range_: Column, _: Column) -> Column:
        middle = F.floor((range_["low"] + range_["high"]) / 2).cast("int")
        bound = F.get(bounds, middle)
        beyond = F.when(group["s"] == ">", amount > bound).otherwise(amount >= bound)
        open_ = range_["low"] < range_["high"]
        return F.struct(
            F.when(open_ & beyond, middle + 1).otherwise(range_["low"]).alias("low"),
            F.when(open_ & ~beyond, middle).otherwise(range_["high"]).alias("high"),
        )

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(bounds) + 1)).cast("int"))
    start = F.struct(F.lit(0).alias("low"), F.size(bounds).alias("high"))
    place = F.aggregate(steps, start, step, lambda s: s["low"])
    return F.when(group["s"] == "", F.size(bounds)).when(real, place).otherwise(F.lit(0))


def _accessed(conjunctions: DataFrame) -> DataFrame:
    """Adds ``_access``: of the equalities on a text field the one that fewest rules share, else null."""
    equal = F.filter("_conditions", lambda c: (c["sign"] == "==") & c["text"].isNotNull())
    read = conjunctions.withColumn("_equal", equal)
    several = read.where(F.size("_equal") > 1)
    first = read.withColumn("_access", F.get("_equal", F.lit(0)))
    if several.isEmpty():
        return first.drop("_equal")
    each = F.posexplode("_equal").alias("_at", "_c")
    named = [F.col("_c.field").alias("_field"), F.col("_c.text").alias("_value")]
    shared = read.select(each).groupBy(*named).agg(F.count("*").alias("_rules"))
    asked = several.select("_number", each).select("_number", "_at", "_c", *named)
    best = asked.join(shuffled(shared), _KEY).groupBy("_number").agg(F.min_by("_c", F.struct("_rules", "_at")).alias("_best"))
    chosen = first.join(shuffled(best), "_number", "left")
    return chosen.withColumn("_access", F.coalesce("_best", "_access")).drop("_equal", "_best")


def _pieces(conjunctions: DataFrame, fields: list[str]) -> DataFrame:
    """Stored pieces of groups: their bounds, with number and scores of the rules of the group up to each."""
    bounded = F.transform("_conditions", lambda c: (c["field"] == AMOUNT) & c["sign"].isin(">", ">="))
    read = _accessed(conjunctions).withColumn("_at", F.array_position(bounded, F.lit(True)).cast("int") - 1)
    bound = F.when(F.col("_at") >= 0, F.get("_conditions", F.col("_at")))
    access = F.col("_access")

    def rest(c: Column, i: Column) -> Column:
        entry = (c["field"] == access["field"]) & (c["sign"] == "==") & (c["text"] == access["text"])
        return (i != F.col("_at")) & ~F.coalesce(entry, F.lit(False))

    def check(c: Column) -> Column:
        at = F.array_position(F.array(*map(F.lit, fields)).cast("array<string>"), c["field"]).cast("int") - 1
        return F.struct(at.alias("f"), c["sign"].alias("s"), c["text"].alias("t"), c["number"].alias("n"))

    key = [*_KEY, "c", "s"]
    single = read.select(
        F.coalesce(access["field"], F.lit("")).alias("_field"), F.coalesce(access["text"], F.lit("")).alias("_value"),
        F.transform(F.filter("_conditions", rest), check).alias("c"), F.coalesce(bound["sign"], F.lit("")).alias("s"),
        bound["number"].alias("bound"), "score",
    )
    summed = single.groupBy(*key, "bound").agg(F.count("*").alias("_n"), F.sum("score").alias("_t"))
    whole = Window.partitionBy(*key)
    along = whole.orderBy("bound").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = summed.select(
        *key, "bound", F.sum("_n").over(along).alias("n"), F.sum("_t").over(along).alias("t"),
        F.row_number().over(whole.orderBy("bound")).alias("_place"), F.count("*").over(whole).alias("_size"),
    )
    length = F.greatest(F.lit(SHORT), F.ceil(F.sqrt("_size")))
    cut = placed.withColumn("_piece", F.floor((F.col("_place") - 1) / length))
    pieces = cut.groupBy(*key, "_piece").agg(F.sort_array(F.collect_list(F.struct("bound", "n", "t"))).alias("m"))
    listed = pieces.select(*key, F.col("m.bound").alias("_b"), F.col("m.n").alias("_n"), F.col("m.t").alias("_t"))
    return staged(listed.withColumn("_piece", F.monotonically_increasing_id()), "rule-pieces")


def _groups(pieces: DataFrame) -> DataFrame:
    """By value its groups: their other conditions, and the beginnings and numbers of their pieces."""
    starts = F.sort_array(F.collect_list(F.struct(F.get("_b", F.lit(0)).alias("b"), F.col("_piece").alias("p")))).alias("_starts")
    groups = pieces.groupBy(*_KEY, "c", "s").agg(starts)
    group = F.struct("c", "s", F.col("_starts.b").alias("b"), F.col("_starts.p").alias("p"))
    numbered = groups.select(*_KEY, group.alias("_g"), F.row_number().over(Window.partitionBy(*_KEY).orderBy(F.get("_starts.p", F.lit(0)))).alias("_at"))
    blocks = numbered.groupBy(*_KEY, F.floor((F.col("_at") - 1) / GROUPS).alias("_block")).agg(F.collect_list("_g").alias("_groups"))
    return blocks.drop("_block")


def with_stored_totals(rows: DataFrame, rule_set: StoredRules, hits: str) -> DataFrame:
    """Number and sum of the hits, as of ``with_rule_totals``.

    Rows are numbered as they come, for a row may find several groups: their source must give a part that is read again
    in the same order, as stored tables do.
    """
    conjunctions = rule_set.conjunctions()
    used = conjunctions.select(F.explode("_conditions.field").alias("field")).distinct().collect()
    fields = sorted(r.field for r in used if r.field != AMOUNT)
    pieces = _pieces(conjunctions, fields)
    entries = sorted(r[0] for r in pieces.select("_field").distinct().collect())
    texts = F.array(*[F.col(FIELD_COLUMNS[f]) for f in fields]).cast("array<string>")
    found = once(rows.withColumn("_row", F.monotonically_increasing_id()), _amount=F.col(AMOUNT).cast("double"), _texts=texts)
    nowhere = F.pmod(F.col("_row"), F.lit(NOWHERE))
    values = [F.struct(F.lit(e).alias("f"), (F.col(FIELD_COLUMNS[e]).cast("string") if e else F.lit("")).alias("v")) for e in entries]
    known = F.filter(F.array(*values), lambda k: k["v"].isNotNull()) if values else F.array()
    stray = F.array(F.struct(F.lit("none").alias("f"), nowhere.cast("string").alias("v")))
    keyed = found.withColumn("_key", F.explode(F.when(F.size(known) > 0, known).otherwise(stray) if values else stray))
    keyed = keyed.withColumns({"_field": F.col("_key.f"), "_value": F.col("_key.v")}).drop("_key")
    by_value = lookup_join(keyed, _groups(pieces), _KEY, fits=fits_broadcast(pieces))
    met = F.filter("_groups", lambda g: F.forall(g["c"], holds))
    places = F.filter(F.transform(met, lambda g: F.get(g["p"], passed(g) - 1)), lambda p: p.isNotNull())
    kept = [F.col(c) for c in rows.columns]
    probes = by_value.select(*kept, "_row", "_amount", F.explode_outer(places).alias("_found"))
    probes = probes.withColumn("_piece", F.coalesce("_found", -1 - nowhere)).drop("_found")
    joined = probes.join(shuffled(pieces.select("_piece", F.col("s").alias("_s"), "_b", "_n", "_t")), "_piece", "left")
    place = passed({"b": F.col("_b"), "s": F.col("_s")}) - 1
    joined = once(joined, _at=place).select(*kept, "_row", F.get("_n", F.col("_at")).alias("_n"), F.get("_t", F.col("_at")).alias("_t"))
    firsts = [F.first(c).alias(c) for c in rows.columns]
    totals = joined.repartition("_row").groupBy("_row").agg(*firsts, F.sum("_n").alias("_n"), F.sum("_t").alias("_t"))
    return totals.select(*kept, *[F.coalesce(c, F.lit(0)).cast("long").alias(n) for c, n in (("_n", hits), ("_t", SCORE))])
