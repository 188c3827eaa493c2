"""Data-quality rules, contract checks, key-value checks and column profiles."""

from __future__ import annotations

import operator
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aislewise.functions.numbers import pass_fraction, ratio
from aislewise.functions.time import reversed_micros
from aislewise.operators.governance import field_rows

# The comparisons a rule may name.
COMPARE = {">=": operator.ge, "<=": operator.le, "==": operator.eq, ">": operator.gt, "<": operator.lt}
RESULT = ("contract", "rule_id", "dimension", "value", "operator", "threshold", "ok")


@dataclass(frozen=True)
class Rule:
    """One number per rule, compared with a threshold.

    ``value`` is an aggregate column over the rule's table. ``unique`` instead names key columns, whose
    value is distinct keys over keys present. A rule over a row condition keeps it as ``predicate``; its value is the
    share of rows that meet it, or their number if it ``counts``.
    """

    id: str
    dimension: str
    value: Column | None = None
    operator: str = ">="
    threshold: float = 1.0
    unique: tuple[str, ...] = ()
    predicate: Column | None = None
    counts: bool = False


def holds(rule_id: str, dimension: str, predicate: Column, threshold: float = 1.0) -> Rule:
    """Row condition: the fraction of rows that meet it."""
    return Rule(rule_id, dimension, pass_fraction(predicate), ">=", threshold, predicate=predicate)


def counted(rule_id: str, dimension: str, predicate: Column, at_least: float = 1.0) -> Rule:
    """Number of rows that meet a condition, such as a window that must not be empty."""
    return Rule(rule_id, dimension, F.count_if(predicate), ">=", at_least, predicate=predicate, counts=True)


def unique_ratio(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys over keys, by grouping: copies of a key are added up before the shuffle."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    per_key = df.filter(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(ratio(F.count(F.lit(1)), F.nullif(F.sum("n"), F.lit(0))).alias("value"))


def judged(values: DataFrame) -> DataFrame:
    """Compare values with thresholds; no value is a failure."""
    verdict = reduce(
        lambda rest, op: F.when(F.col("operator") == op, COMPARE[op](F.col("value"), F.col("threshold"))).otherwise(rest),
        COMPARE,
        F.lit(False),
    )
    return values.withColumn("ok", F.coalesce(verdict, F.lit(False))).select(*RESULT)


def _described(contract: str, rule: Rule, value: Column) -> Column:
    return F.struct(
        F.lit(contract).alias("contract"),
        F.lit(rule.id).alias("rule_id"),
        F.lit(rule.dimension).alias("dimension"),
        value.cast("double").alias("value"),
        F.lit(rule.operator).alias("operator"),
        F.lit(float(rule.threshold)).alias("threshold"),
    )


def _in_one_pass(df: DataFrame, key: tuple[str, ...], rules: Sequence[Rule]) -> DataFrame:
    """One row of all values from one grouping by the key: rows and met conditions are counted per key and added up."""
    tests = [F.count_if(r.predicate).alias(f"met{i}") for i, r in enumerate(rules) if not r.unique]
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), *tests)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    values = []
    for i, r in enumerate(rules):
        if r.unique:
            values.append(ratio(F.count_if(known), F.nullif(F.sum(F.when(known, F.col("n"))), F.lit(0))))
        elif r.counts:
            values.append(F.coalesce(F.sum(f"met{i}"), F.lit(0)))
        else:
            values.append(ratio(F.sum(f"met{i}"), F.sum("n")))
    return per_key.agg(*[v.cast("double").alias(f"v{i}") for i, v in enumerate(values)])


def evaluate_all(parts: Sequence[tuple[str, DataFrame, Sequence[Rule]]]) -> DataFrame:
    """Every rule of every (contract, table, rules). Contracts over one table (the same DataFrame) share its pass: conditions
    and the uniqueness of one key are counted together; without a key, or with several, conditions take one aggregation and
    each key its own."""
    tables: dict[int, tuple[DataFrame, list[tuple[str, Rule]]]] = {}
    for contract, df, rules in parts:
        tables.setdefault(id(df), (df, []))[1].extend((contract, r) for r in rules)
    values = []
    for df, named in tables.values():
        rules = [r for _, r in named]
        keys = {r.unique for r in rules if r.unique}
        if len(keys) == 1 and all(r.unique or r.predicate is not None for r in rules):
            rows = [(_in_one_pass(df, keys.pop(), rules), list(enumerate(named)))]
        else:
            plain = [(i, n) for i, n in enumerate(named) if not n[1].unique]
            rows = [(df.agg(*[n[1].value.cast("double").alias(f"v{i}") for i, n in plain]), plain)] if plain else []
            for key in sorted(keys):
                own = [(i, n) for i, n in enumerate(named) if n[1].unique == key]
                ratio_row = unique_ratio(df, key)
                rows.append((ratio_row.select(*[F.col("value").alias(f"v{i}") for i, _ in own]), own))
        for row, own in rows:
            values.append(row.select(F.inline(F.array(*[_described(c, r, F.col(f"v{i}")) for i, (c, r) in own]))))
    return judged(reduce(DataFrame.unionByName, values))


def evaluate(df: DataFrame, contract: str, rules: Sequence[Rule]) -> DataFrame:
    """All rules of one contract over its table."""
    return evaluate_all([(contract, df, rules)])


def value_rule(contract: str, rule: Rule, one_row: DataFrame) -> DataFrame:
    """A rule whose number comes from its own query, such as one over two tables."""
    return judged(one_row.select(F.inline(F.array(_described(contract, rule, F.col("value"))))))


def referenced_ratio(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """Share of rows whose value occurs in another table."""
    known = other.select(F.col(other_column).alias("_known")).distinct()
    # Values are counted before the join, so a value held by a third of the rows joins as one row.
    held = df.groupBy(F.col(column).alias("_value")).agg(F.count(F.lit(1)).alias("n"))
    matched = held.join(known, F.col("_value") == F.col("_known"), "left")
    found = F.sum(F.when(F.col("_known").isNotNull(), F.col("n")).otherwise(0))
    return matched.agg(ratio(found, F.nullif(F.sum("n"), F.lit(0))).alias("value"))


def same_count(left: DataFrame, right: DataFrame) -> DataFrame:
    """One when both tables have the same number of rows."""
    n = F.count(F.lit(1)).alias("n")
    other = right.agg(n).scalar()
    return left.agg(n).select((F.col("n") == other).cast("int").alias("value"))


# Contracts: schema, linkage and summary.

# Warehouse type names and the Spark types they stand for.
TYPE_NAMES = {
    "STRING": "string", "INT64": "bigint", "INTEGER": "bigint", "FLOAT64": "double", "FLOAT": "double",
    "NUMERIC": "decimal(38,9)", "BOOL": "boolean", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp",
    "BYTES": "binary",
}


def _fields(spark: SparkSession, schema: T.StructType) -> DataFrame:
    def kind(t: str) -> str:
        """Records by their mode: a repeated one differs from a plain one, its fields have rows of their own."""
        return re.sub(r"struct<.*>(?=>|$)", "record", t, flags=re.S) if "struct<" in t else TYPE_NAMES.get(t.upper(), t)

    rows = [(p, kind(t), n) for p, t, n, _ in field_rows(schema)]
    return spark.createDataFrame(rows, "path string, type string, nullable boolean")


def schema_diff(spark: SparkSession, contracted: T.StructType, live: T.StructType) -> DataFrame:
    """Columns missing, extra, of another type or mode; nested fields by path."""
    a = _fields(spark, contracted).select("path", F.col("type").alias("contract_type"), F.col("nullable").alias("contract_nullable"))
    b = _fields(spark, live).select("path", F.col("type").alias("live_type"), F.col("nullable").alias("live_nullable"))
    issue = (
        F.when(F.col("live_type").isNull(), "MISSING")
        .when(F.col("contract_type").isNull(), "EXTRA")
        .when(F.col("contract_type") != F.col("live_type"), "TYPE")
        .when(F.col("contract_nullable") != F.col("live_nullable"), "MODE")
        .otherwise("OK")
    )
    return a.join(b, "path", "full").withColumn("issue", issue).orderBy("path")


def linkage(rules: DataFrame, assertions: DataFrame) -> DataFrame:
    """Rules without an assertion, assertions without a rule, repeats, and dimensions that disagree.

    ``rules`` has contract, rule_id, dimension, enforced_by; ``assertions`` contract, rule_id, dimension.
    """
    key = ["contract", "rule_id"]
    required = rules.filter(F.col("enforced_by") == "eval-fixture")

    def as_issue(df, name):
        return df.select(*key, F.lit(name).alias("issue"))

    a, r = assertions.alias("a"), rules.alias("r")
    return reduce(
        DataFrame.unionByName,
        [
            as_issue(required.join(assertions, key, "left_anti"), "RULE_WITHOUT_ASSERTION"),
            as_issue(assertions.join(rules, key, "left_anti"), "ASSERTION_WITHOUT_RULE"),
            as_issue(assertions.groupBy(*key).count().filter("count > 1"), "REPEATED_ASSERTION"),
            as_issue(a.join(r, key).filter("a.dimension <> r.dimension"), "DIMENSION_DIFFERS"),
        ],
    )


def summary(results: DataFrame, by: Sequence[str] = ("contract",)) -> DataFrame:
    """Checks passed and failed per contract, and whether all passed."""
    return results.groupBy(*by).agg(
        F.count_if("ok").alias("passed"), F.count_if(~F.col("ok")).alias("failed"), F.every("ok").alias("all_ok")
    )


# Key-value serving table, read as flat columns.

ROW_KEY = r"^STORE_[0-9]{3}#CASH_[0-9]+#[0-9]+$"


def _outside(column: str, low: float | None, high: float | None) -> Column:
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return bad


def kv_checks(rows: DataFrame, prefix: str, contract: str = "cashier_realtime_alerts") -> DataFrame:
    """The serving table's checks in one pass over all of its rows.

    The value of a check is its number of violations. Rows sort newest first exactly when every key ends in
    the reversed time of its own row, so that check compares each suffix with its row and needs no sort.
    ``prefix`` ends at a key separator.
    """
    under = F.startswith("row_key", F.lit(prefix))
    found = F.count_if(under)

    def violations(*conditions: Column) -> Column:
        return reduce(lambda a, b: a + b, [F.count_if(c) for c in conditions])

    required = ("risk_score", "cashier_1h_txn_count", "audit_status")
    none = {"operator": "==", "threshold": 0.0}
    checks = [
        Rule("row_key_prefix_exists", "completeness", found),
        Rule("row_key_format_valid", "validity", violations(~F.col("row_key").rlike(ROW_KEY)), **none),
        Rule("risk_score_in_unit_range", "validity", violations(_outside("risk_score", 0.0, 1.0)), **none),
        Rule("audit_status_allowed_values", "validity", violations(~F.col("audit_status").isin("clear", "review")), **none),
        Rule(
            "counters_non_negative",
            "validity",
            violations(
                _outside("cashier_1h_txn_count", 0, None), _outside("cashier_1h_manual_override_count", 0, None)
            ),
            **none,
        ),
        Rule("promo_rate_in_unit_range", "validity", violations(_outside("cashier_1h_promo_rate", 0.0, 1.0)), **none),
        Rule("core_qualifiers_present", "completeness", violations(*[F.col(c).isNull() for c in required]), **none),
        Rule(
            "newest_row_first_on_prefix_scan",
            "timeliness",
            F.when((found >= 1) & (F.count_if(under & ~in_time_order()) == 0), 1).otherwise(0),
        ),
        Rule(
            "override_count_not_exceeding_txn_count",
            "consistency",
            violations(F.col("cashier_1h_manual_override_count") > F.col("cashier_1h_txn_count")),
            **none,
        ),
    ]
    present = F.count(F.lit(1)) > 0
    checks = [Rule(c.id, c.dimension, F.when(present, c.value), c.operator, c.threshold) for c in checks]
    return evaluate(rows, contract, checks)


def newest_first(rows: DataFrame) -> DataFrame:
    """The same test for every store and cashier."""
    prefix = F.regexp_extract("row_key", r"^([^#]+#[^#]+)#", 1).alias("prefix")
    return rows.groupBy(prefix).agg(F.count(F.lit(1)).alias("rows"), F.every(in_time_order()).alias("newest_first"))


def in_time_order() -> Column:
    """The key ends in the reversed time of its row; a key or time that is NULL does not."""
    return F.substring_index("row_key", "#", -1).eqNullSafe(reversed_micros(F.col("last_event_ts")))


# Profiles.


def profile(df: DataFrame, columns: Sequence[str] | None = None, sample: float | None = None) -> DataFrame:
    """Exact profile: rows, NULLs, distinct values, the count of the most frequent one, numeric range.

    Values are counted per column first and reduced per column after, so the shuffle carries each value
    once per map task however often it occurs.
    """
    names = list(columns or [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))])
    source = df if sample is None else df.sample(sample, seed=7)

    def cell(name):
        numeric = isinstance(df.schema[name].dataType, T.NumericType)
        number = F.col(name).cast("double") if numeric else F.lit(None).cast("double")
        return F.struct(
            F.lit(name).alias("column_name"), F.col(name).cast("string").alias("text"), number.alias("number")
        )

    cells = source.select(F.inline(F.array(*[cell(n) for n in names])))
    values = cells.groupBy("column_name", "text", "number").agg(F.count(F.lit(1)).alias("n"))
    present = F.col("text").isNotNull()
    nulls = F.sum(F.when(present, 0).otherwise(F.col("n")))
    return values.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"),
        nulls.alias("n_nulls"),
        F.round(ratio(nulls, F.sum("n")), 6).alias("null_ratio"),
        F.count_if(present).alias("n_distinct"),
        F.max(F.when(present, F.col("n"))).alias("top_count"),
        F.min("number").alias("min_number"),
        F.max("number").alias("max_number"),
    )


def quick_profile(df: DataFrame, columns: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One pass with sketches: NULL ratio, approximate distinct count and quantiles of numeric columns."""
    cells = []
    for c in columns:
        numeric = isinstance(df.schema[c].dataType, T.NumericType)
        marks = F.percentile_approx(F.col(c).cast("double"), list(quantiles)) if numeric else F.lit(None).cast("array<double>")
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                pass_fraction(F.col(c).isNull()).alias("null_ratio"),
                F.approx_count_distinct(c).alias("approx_distinct"),
                marks.alias("quantiles"),
            )
        )
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def export_results(results: DataFrame, path: str, scanned_at: str) -> None:
    """Append a scan's results to its table."""
    results.withColumn("scanned_at", F.lit(scanned_at).cast("timestamp")).write.mode("append").parquet(path)


def tables_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)
