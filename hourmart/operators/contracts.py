"""NOT NULL, length and key rules: as a report and as guards on a write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourmart.schemas import TableSpec

NOT_NULL = "not_null"
MAX_LENGTH = "max_length"
UNIQUE = "unique"


def _rules(spec: TableSpec) -> list[tuple[str, str, Column]]:
    rules = [(NOT_NULL, name, F.col(name).isNull()) for name in spec.required]
    rules += [(MAX_LENGTH, name, F.length(name) > size) for name, size in spec.lengths]
    return rules


def duplicate_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter("row_count > 1")


def violations(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Broken rows per rule: (table_name, rule, column_name, violations).

    All column rules are counted in one pass; a key rule adds one aggregate and
    counts the keys that occur more than once.
    """
    parts = []
    rules = _rules(spec)
    if rules:
        counts = rows.agg(
            *[F.count_if(broken).alias(f"r{i}") for i, (_, _, broken) in enumerate(rules)]
        )
        report = F.array(
            *[
                F.struct(
                    F.lit(rule).alias("rule"),
                    F.lit(name).alias("column_name"),
                    F.col(f"r{i}").alias("violations"),
                )
                for i, (rule, name, _) in enumerate(rules)
            ]
        )
        parts.append(counts.select(F.inline(report)))
    if spec.key:
        doubled = duplicate_keys(rows, list(spec.key)).agg(
            F.count(F.lit(1)).alias("violations")
        )
        parts.append(
            doubled.select(
                F.lit(UNIQUE).alias("rule"),
                F.lit(", ".join(spec.key)).alias("column_name"),
                "violations",
            )
        )
    if not parts:
        raise ValueError(f"table {spec.name} has no rules")
    report = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return report.select(F.lit(spec.name).alias("table_name"), "rule", "column_name", "violations")


def _guard(value: Column, broken: Column, message: str) -> Column:
    return F.when(broken, F.raise_error(F.lit(message))).otherwise(value)


def enforce(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that stop the job on the first broken column rule.

    The guards ride along in the write itself, so checking costs no extra pass
    and a failed write commits nothing.
    """
    guarded: dict[str, Column] = {}
    for rule, name, broken in _rules(spec):
        value = guarded.get(name, F.col(name))
        guarded[name] = _guard(value, broken, f"{spec.name}.{name}: {rule} rule broken")
    return rows.withColumns(guarded) if guarded else rows


def enforce_unique(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that stop the job if a key occurs twice; for small mart updates."""
    if not spec.key:
        return rows
    first = spec.key[0]
    copies = F.count(F.lit(1)).over(Window.partitionBy(*spec.key))
    counted = rows.withColumn("_copies", copies)
    message = f"{spec.name}: unique rule broken on {', '.join(spec.key)}"
    return counted.withColumn(first, _guard(F.col(first), F.col("_copies") > 1, message)).drop(
        "_copies"
    )
