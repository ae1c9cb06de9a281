"""Rules held as data: predicate text in a table becomes columns of the plan.

Rules are configuration, a few hundred short rows. They are read once per run or micro-batch and
become literals of the plan, so every event row is scored in place without a join or a shuffle.

More than ``MAX_DRIVER_RULES`` of them are ``StoredRules`` instead: a snapshot in the shared folder, whose texts the
executors read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnsieve.config import MAX_DRIVER_RULES
from txnsieve.operators.conditions import Condition, conditions
from txnsieve.operators.lookups import fits_broadcast, shuffled
from txnsieve.operators.predicates import RuleError, predicate
from txnsieve.session import ship_package, staged

HITS = "rule_hits"
SCORE = "rule_score"

@dataclass(frozen=True)
class Rule:
    id: int
    name: str
    expression: str
    score: int
    group_name: str | None
    match_mode: str | None
    valid: bool


@dataclass(frozen=True)
class RuleSet:
    """A snapshot of the enabled rules."""

    rules: tuple[Rule, ...] = ()
    errors: tuple[tuple[int, str, str, str], ...] = ()
    version: str = field(default="")

    def ungrouped(self) -> list[Rule]:
        return [r for r in self.rules if r.group_name is None]

    def groups(self) -> dict[str, list[Rule]]:
        groups: dict[str, list[Rule]] = {}
        for r in self.rules:
            if r.group_name is not None:
                groups.setdefault(r.group_name, []).append(r)
        return groups


def load_rules(rules: DataFrame, most: int = MAX_DRIVER_RULES) -> RuleSet | StoredRules:
    """Snapshot of the enabled rules in id order; broken rules are kept with their error.

    The driver holds at most ``most`` rules; more of them are stored.
    """
    enabled = rules.where("enabled")
    return held_rules(enabled) if fits_broadcast(enabled, most) else stored_rules(enabled)


def held_rules(enabled: DataFrame) -> RuleSet:
    rows = enabled.orderBy("id").collect()
    errors = {}
    for row in rows:
        try:
            if conditions(row["expression"] or "") is None:  # a conjunction needs no column to be known as valid
                predicate(row["expression"] or "")
        except RuleError as error:
            errors[row["id"]] = str(error)
    loaded = [_rule(r, r["id"] not in errors) for r in rows]
    broken = [(r["id"], r["name"], r["expression"], errors[r["id"]]) for r in rows if r["id"] in errors]
    text = "\n".join(repr(tuple(r)) for r in rows)
    return RuleSet(tuple(loaded), tuple(broken), hashlib.sha256(text.encode()).hexdigest()[:16])


def _rule(row: T.Row, valid: bool) -> Rule:
    return Rule(row["id"], row["name"], row["expression"], row["score"], row["group_name"], row["match_mode"], valid)


#: What the executors add to a rule: a number, the comparisons of a conjunction, and why its text is no rule.
_READ = T.StructType(
    [
        T.StructField(
            "_conditions",
            T.ArrayType(
                T.StructType(
                    [T.StructField(n, T.StringType()) for n in ("field", "sign", "text")] + [T.StructField("number", T.DoubleType())]
                )
            ),
        ),
        T.StructField("_error", T.StringType()),
    ]
)
_NUMBER = "_number"


def _read_text(text: str) -> tuple[list[Condition] | None, str | None]:
    """The comparisons of a conjunction, or an error that shows without a column."""
    try:
        found = conditions(text)
        if found is None and not text.strip():
            predicate(text)  # raises: nothing is no rule
    except RuleError as error:
        return None, str(error)
    return found, None


def _reader(at: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_read_text(text or "") for text in batch.column(at).to_pylist()]
            ends, flat = [0], []
            for each, _ in found:
                flat += each or []
                ends.append(len(flat))
            columns = [pa.array([getattr(c, n) for c in flat], pa.string()) for n in ("field", "sign", "text")]
            columns.append(pa.array([c.number for c in flat], pa.float64()))
            comparisons = pa.StructArray.from_arrays(columns, names=["field", "sign", "text", "number"])
            starts = [None if each is None else start for (each, _), start in zip(found, ends)]
            lists = pa.ListArray.from_arrays(pa.array([*starts, ends[-1]], pa.int32()), comparisons)
            errors = pa.array([error for _, error in found], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, lists, errors], names=[*batch.schema.names, *_READ.names])

    return read


def stored_rules(enabled: DataFrame) -> StoredRules:
    spark = enabled.sparkSession
    ship_package(spark)
    spread = enabled.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = T.StructType([*enabled.schema.fields, *_READ.fields])
    read = spread.mapInArrow(_reader(enabled.columns.index("expression")), schema)
    return StoredRules(staged(read.withColumn(_NUMBER, F.monotonically_increasing_id()), "rules"))


class StoredRules:
    """A snapshot of enabled rules that are too many for the driver, in the shared folder, read by the executors.

    ``rules`` and ``errors`` take all of them to the driver, as does whatever needs a column or a literal per rule;
    ``rule_index.with_rule_totals`` does not.
    """

    def __init__(self, table: DataFrame) -> None:
        self.table = table

    @cached_property
    def held(self) -> RuleSet:
        return held_rules(self.table.drop(*_READ.names, _NUMBER))

    @property
    def rules(self) -> tuple[Rule, ...]:
        return self.held.rules

    @property
    def errors(self) -> tuple[tuple[int, str, str, str], ...]:
        return self.held.errors

    @cached_property
    def version(self) -> str:
        """As of a ``RuleSet``; the rows pass through the driver one partition at a time."""
        digest, between = hashlib.sha256(), ""
        for row in self.table.drop(*_READ.names, _NUMBER).orderBy("id").toLocalIterator():
            digest.update(f"{between}{tuple(row)!r}".encode())
            between = "\n"
        return digest.hexdigest()[:16]

    def ungrouped(self) -> list[Rule]:
        return self.held.ungrouped()

    def groups(self) -> dict[str, list[Rule]]:
        return self.held.groups()

    @cached_property
    def marked(self) -> DataFrame:
        """The table with ``_valid``: a rule is broken where any rule of its id is.

        Texts of another form than a conjunction are read here, each different one once.
        """
        spark, table = self.table.sparkSession, self.table
        others = table.where("_conditions is null and _error is null").select("expression").distinct()
        wrong = []
        for (text,) in others.collect():
            try:
                predicate(text)
            except RuleError:
                wrong.append((text,))
        ids = table.where("_error is not null").select("id")
        if wrong:
            ids = ids.union(table.join(F.broadcast(spark.createDataFrame(wrong, "expression string")), "expression", "left_semi").select("id"))
        if ids.isEmpty():
            return table.withColumn("_valid", F.lit(True))
        broken = ids.distinct().select(F.col("id").alias("_broken"), F.lit(False).alias("_kept"))
        found = table.join(shuffled(broken), F.col("id").eqNullSafe(F.col("_broken")), "left")
        return found.withColumn("_valid", F.coalesce("_kept", F.lit(True))).drop("_broken", "_kept")

    def conjunctions(self) -> DataFrame:
        """Valid rules without a group that are conjunctions: ``_number``, ``score`` and ``_conditions``."""
        own = self.marked.where("_valid and group_name is null and _conditions is not null")
        return own.select(_NUMBER, "score", "_conditions")

    def others(self) -> list[tuple[str, int, int]]:
        """Texts of the other valid rules without a group, with the number of their rules and the sum of their scores."""
        own = self.marked.where("_valid and group_name is null and _conditions is null")
        return [tuple(r) for r in own.groupBy("expression").agg(F.count("*"), F.sum("score")).collect()]

    def grouped(self) -> RuleSet:
        """The rules that are members of groups."""
        rows = self.marked.where("group_name is not null").orderBy("id").collect()
        return RuleSet(tuple(_rule(r, r["_valid"]) for r in rows))


def rule_errors(spark: SparkSession, rule_set: RuleSet | StoredRules) -> DataFrame:
    return spark.createDataFrame(
        list(rule_set.errors), "id long, name string, expression string, error string"
    )


def matches(rule: Rule) -> Column:
    """A broken rule and a null result count as no match."""
    return F.coalesce(predicate(rule.expression), F.lit(False)) if rule.valid else F.lit(False)


def group_score(members: list[Rule]) -> int:
    """Score of the first member that carries one."""
    return next((r.score for r in members if r.score > 0), 0)


def group_fires(members: list[Rule]) -> Column:
    """ALL needs every signal, any other mode one of them; score carriers are no signals."""
    signals = [matches(r) for r in members if r.score <= 0]
    if not signals:
        return F.lit(False)
    if members[0].match_mode == "ALL":
        return reduce(lambda a, b: a & b, signals)
    return reduce(lambda a, b: a | b, signals)


def _hit(name: str, group: str | None, score: int, fired: Column) -> Column:
    return F.when(
        fired,
        F.struct(
            F.lit(name).alias("name"),
            F.lit(group).cast("string").alias("group_name"),
            F.lit(score).cast("long").alias("score"),
        ),
    )


def with_rules(rows: DataFrame, rule_set: RuleSet | StoredRules) -> DataFrame:
    """Add ``rule_hits`` (the rules and groups that fired) and ``rule_score`` (their sum)."""
    hits = [_hit(r.name, None, r.score, matches(r)) for r in rule_set.ungrouped()]
    hits += [_hit(g, g, group_score(m), group_fires(m)) for g, m in rule_set.groups().items()]
    if not hits:
        none = F.array().cast("array<struct<name:string,group_name:string,score:bigint>>")
        return rows.withColumn(HITS, none).withColumn(SCORE, F.lit(0).cast("long"))
    fired = rows.withColumn(HITS, F.filter(F.array(*hits), lambda h: h.isNotNull()))
    total = F.aggregate(HITS, F.lit(0).cast("long"), lambda sum_, hit: sum_ + hit["score"])
    return fired.withColumn(SCORE, total)


def rule_hits(rows: DataFrame) -> DataFrame:
    """One row per transaction and fired rule or group."""
    return rows.select("transaction_id", F.inline(HITS))


def list_rules(rules: DataFrame, include_disabled: bool = False) -> DataFrame:
    """Rules ordered by group, ungrouped first, then by name."""
    shown = rules if include_disabled else rules.where("enabled")
    return shown.select(
        "id", "name", "expression", "score", "enabled", "group_name", "match_mode"
    ).orderBy(F.col("group_name").asc_nulls_first(), "name")


def render_rules(listed: DataFrame) -> DataFrame:
    """Add the text form of each listed rule."""
    group = F.when(F.coalesce(F.col("group_name"), F.lit("")) == "", F.lit("Group: none")).otherwise(
        F.format_string("Group: %s (%s)", "group_name", F.coalesce("match_mode", F.lit("null")))
    )
    head = F.format_string("Rule: %s | Score: %d | Enabled: %s", "name", "score", F.col("enabled").cast("string"))
    return listed.withColumn(
        "text", F.concat_ws("\n", head, F.concat(F.lit("Expression: "), "expression"), group)
    )
