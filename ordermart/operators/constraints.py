"""Table constraints (PRIMARY KEY, FOREIGN KEY, NOT NULL, CHECK) as
violation counts.

Spark enforces no constraints, so each declared constraint becomes a count of
violating rows, and the pipeline refuses to publish when any is non-zero. The
counts are measures of a ``Ledger``, shared with the quality checks of the same
gate: NOT NULL and CHECK counts join the table's one aggregate (a CHECK passes
on NULL, as in SQL), primary and foreign keys join the one shuffle of their key
domain. Which keys are at fault is asked only of constraints found broken
(``constraint_evidence``), so a gate that passes pays nothing for it.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordermart.operators.ledger import Ledger, Measure, key_text
from ordermart.operators.quality import layered
from ordermart.schemas import ORDER_STATUSES, STATE_PATTERN, TABLE_KEYS, ZIP_PATTERN


def _patterns(zip_column: str, state_column: str) -> list[tuple[str, Column]]:
    return [(f"{zip_column} ~ zip", F.col(zip_column).rlike(ZIP_PATTERN)),
            (f"{state_column} ~ state", F.col(state_column).rlike(STATE_PATTERN))]


def _at_least_zero(column: str) -> tuple[str, Column]:
    return f"{column} >= 0", F.col(column) >= 0


def checks_of(table: str) -> list[tuple[str, Column]]:
    """(name, predicate) of the CHECK constraints of a table."""
    return {
        "staging.customers": lambda: _patterns("customer_zip_code_prefix", "customer_state"),
        "staging.sellers": lambda: _patterns("seller_zip_code_prefix", "seller_state"),
        "staging.geolocation": lambda: _patterns("geolocation_zip_code_prefix", "geolocation_state"),
        "staging.orders": lambda: [("order_status accepted", F.col("order_status").isin(*ORDER_STATUSES))],
        "staging.order_items": lambda: [_at_least_zero("price"), _at_least_zero("freight_value")],
        "staging.order_payments": lambda: [_at_least_zero("payment_installments"), _at_least_zero("payment_value")],
        "staging.order_reviews": lambda: [("review_score between 1 and 5", F.col("review_score").between(1, 5))],
        "analytics.dim_customers": lambda: [("lifetime_order_count > 0", F.col("lifetime_order_count") > 0)],
    }.get(table, list)()


def _domain(table: str, key: tuple[str, ...]) -> str:
    """Tables that carry the same key meet in one domain: the staging suite
    names ZIPs that, and facts and dimensions are kept apart from staging."""
    if key == ("geolocation_zip_code_prefix",):
        return "zip"
    prefix = "" if table.startswith("staging.") else "analytics "
    return prefix + (key[0] if len(key) == 1 else f"{table} key")


def row_rules(table: str) -> list[tuple[str, Column]]:
    """(constraint, violated) of the constraints a row breaks on its own."""
    out = [(f"NOT NULL ({c})", F.col(c).isNull()) for c in TABLE_KEYS[table][1]]
    return out + [(f"CHECK ({n})", ~F.coalesce(p, F.lit(True))) for n, p in checks_of(table)]


def key_rules(table: str) -> list[tuple[str, str, Callable[[Ledger], Measure]]]:
    """(constraint, key domain, registration with a ledger) of the primary key
    and the foreign keys; a NULL foreign key satisfies the constraint."""
    key, _, foreign = TABLE_KEYS[table]
    own = _domain(table, key)
    out = [(f"PRIMARY KEY ({', '.join(key)})", own, lambda ledger: ledger.surplus(own, table, *key))]
    for c, parent, pc in foreign:
        out.append((f"FOREIGN KEY ({c}) -> {parent}", _domain(table, (c,)),
                    lambda ledger, c=c, parent=parent, pc=pc: ledger.orphans(_domain(table, (c,)), table, c, parent, pc, nulls=False)))
    return out


def measures(ledger: Ledger, layers: Iterable[str]) -> list[tuple[str, str, Measure]]:
    """(table, constraint, violations) of every declared constraint of the
    layers."""
    out = []
    for table in TABLE_KEYS:
        if table.split(".")[0] not in layers:
            continue
        (primary, _, surplus), *foreign = key_rules(table)
        out.append((table, primary, surplus(ledger)))
        out += [(table, n, ledger.where(table, violated)) for n, violated in row_rules(table)]
        out += [(table, n, orphans(ledger)) for n, _, orphans in foreign]
    return out


def violating_keys(tables: Mapping[str, DataFrame], layers: Iterable[str],
                   only: Collection[tuple[str, str]] | None = None) -> DataFrame:
    """(table_name, constraint_name, key, violations): every key at fault and
    its rows. One pass over a table for all its row rules, one shuffle per key
    domain; ``only`` names the (table, constraint) that are looked into.

    The key is the row's primary key, or the value no parent row has."""
    ledger, labels, parts = Ledger(tables), {}, []
    for table in TABLE_KEYS:
        if table.split(".")[0] not in layers:
            continue
        rules = [(n, violated) for n, violated in row_rules(table) if only is None or (table, n) in only]
        if rules:
            # sound rules go after the array is taken apart: a lambda over it would be interpreted for every row
            broken = F.array(*[F.when(violated, F.lit(n)) for n, violated in rules])
            parts.append(tables[table].select(key_text(*TABLE_KEYS[table][0]).alias("key"), F.explode(broken).alias("constraint_name"))
                         .where(F.col("constraint_name").isNotNull())
                         .select(F.lit(table).alias("table_name"), "constraint_name", "key", F.lit(1).cast("bigint").alias("violations")))
        for n, domain, register in key_rules(table):
            if only is None or (table, n) in only:
                register(ledger)
                labels.setdefault(domain, []).append((table, n))
    parts += [ledger.violating_keys(domain, own) for domain, own in labels.items()]
    return reduce(DataFrame.union, parts).groupBy("table_name", "constraint_name", "key").agg(F.sum("violations").alias("violations"))


def constraint_evidence(tables: Mapping[str, DataFrame], layers: Iterable[str],
                        only: Collection[tuple[str, str]] | None = None, least: int = 3) -> DataFrame:
    """The ``least`` smallest keys that break each constraint: (table_name,
    constraint_name, key_rank, key, violations); none for one that holds.

    Keys are counted map side, and Spark limits the ranking inside the tasks, so
    a constraint that a third of all rows break sends ``least`` rows a task."""
    by_key = Window.partitionBy("table_name", "constraint_name").orderBy("key")
    return (violating_keys(tables, layers, only).withColumn("key_rank", F.row_number().over(by_key))
            .where(F.col("key_rank") <= least).select("table_name", "constraint_name", "key_rank", "key", "violations"))


def constraint_violations(spark: SparkSession, **layers) -> DataFrame:
    """(table_name, constraint_name, violations), one row per constraint."""
    ledger = Ledger(layered(**layers))
    rows = [F.struct(F.lit(t).alias("table_name"), F.lit(n).alias("constraint_name"), m().cast("bigint").alias("violations"))
            for t, n, m in measures(ledger, layers)]
    return ledger.frame(spark).select(F.inline(F.array(*rows)))
