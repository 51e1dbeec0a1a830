"""Measures of many tables in few passes.

Checks and constraints register what they count; the ledger then plans

* one aggregate per table for all its row predicates and sums;
* one aggregate over the union of all tables whose rows are only counted;
* per key domain (say ``order_id``) one union of (key, table) from all tables
  that carry the key, grouped once: the counts per key and table give repeated
  keys, surplus rows and orphans of every relation in a single shuffle, with
  the counting done map side.

Each of these is one scalar subquery, projected once; the checks read its
fields.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Measure = Callable[[], Column]


def key_text(*columns: str) -> Column:
    """A key as text: its parts with a comma between them, NULL as such."""
    return F.concat_ws(", ", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns])


class Ledger:
    def __init__(self, tables: Mapping[str, DataFrame]):
        self.tables = tables
        self.plain: dict[str, list[Column]] = {}
        self.counted: list[str] = []
        self.carriers: dict[str, dict[str, tuple[str, ...]]] = {}
        self.facts: dict[str, list[tuple]] = {}

    # --- what can be measured -------------------------------------------------

    def aggregate(self, table: str, value: Column) -> Measure:
        """Any aggregate without DISTINCT over one table."""
        own = self.plain.setdefault(table, [])
        own.append(value)
        return self._field(f"plain:{table}", len(own) - 1)

    def where(self, table: str, predicate: Column) -> Measure:
        return self.aggregate(table, F.count_if(predicate))

    def rows(self, table: str) -> Measure:
        if table not in self.counted:
            self.counted.append(table)
        return self._field("rows", self.counted.index(table))

    def _key(self, domain: str, table: str, columns: tuple[str, ...]) -> None:
        known = self.carriers.setdefault(domain, {}).setdefault(table, columns)
        if known != columns:
            raise ValueError(f"{table} carries {domain} as {known}")

    def _fact(self, domain: str, *fact) -> Measure:
        own = self.facts.setdefault(domain, [])
        own.append(fact)
        return self._field(f"keys:{domain}", len(own) - 1)

    def repeated(self, domain: str, table: str, *columns: str) -> Measure:
        """Keys that occur more than once."""
        self._key(domain, table, columns)
        return self._fact(domain, "repeated", table)

    def surplus(self, domain: str, table: str, *columns: str) -> Measure:
        """Rows beyond the first of each key, and all rows with a NULL in it."""
        self._key(domain, table, columns)
        return self._fact(domain, "surplus", table)

    def distinct(self, domain: str, table: str, *columns: str) -> Measure:
        self._key(domain, table, columns)
        return self._fact(domain, "distinct", table)

    def orphans(self, domain: str, child: str, child_key: str, parent: str, parent_key: str, nulls: bool = True) -> Measure:
        """Rows of child whose key no row of parent has; NULL keys with ``nulls``."""
        self._key(domain, child, (child_key,))
        self._key(domain, parent, (parent_key,))
        return self._fact(domain, "orphans" if nulls else "orphans but NULL", child, parent)

    @staticmethod
    def _field(source: str, i: int) -> Measure:
        return lambda: F.col(f"`{source}`.m{i}")

    # --- how it is measured -----------------------------------------------------

    def _row_counts(self) -> Column:
        tagged = [self.tables[t].select(F.lit(i).alias("t")) for i, t in enumerate(self.counted)]
        counts = [F.count_if(F.col("t") == i).alias(f"m{i}") for i in range(len(tagged))]
        return reduce(DataFrame.union, tagged).agg(F.struct(*counts)).scalar()

    def _counts(self, domain: str) -> tuple[DataFrame, list[str], dict[str, int]]:
        """A row per key of the domain (columns k0, k1, ...) with the rows each
        carrier has of it (n0, n1, ... in the order of the carriers)."""
        carriers = self.carriers[domain]
        at = {t: i for i, t in enumerate(carriers)}
        width = len(next(iter(carriers.values())))
        keys = [f"k{j}" for j in range(width)]
        tagged = [self.tables[t].select(*[F.col(c).alias(k) for c, k in zip(columns, keys, strict=True)], F.lit(at[t]).alias("t"))
                  for t, columns in carriers.items()]
        each = reduce(DataFrame.union, tagged).groupBy(*keys).agg(
            *[F.count_if(F.col("t") == i).alias(f"n{i}") for i in at.values()])
        return each, keys, at

    @staticmethod
    def _violating(fact: tuple, keys: list[str], at: Mapping[str, int]) -> Column:
        """Rows of one key that a surplus or orphans fact counts."""
        kind, n = fact[0], F.col(f"n{at[fact[1]]}")
        whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
        if kind == "surplus":
            return F.when(~whole, n).otherwise(F.greatest(n - 1, F.lit(0)))
        lost = F.col(f"n{at[fact[2]]}") == 0
        return F.when(~whole | lost if kind == "orphans" else whole & lost, n).otherwise(0)

    def _domain(self, domain: str) -> Column:
        each, keys, at = self._counts(domain)
        whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])

        def total(fact: tuple) -> Column:
            kind, n = fact[0], F.col(f"n{at[fact[1]]}")
            if kind == "repeated":
                return F.count_if(n > 1)
            if kind == "distinct":
                return F.count_if(whole & (n > 0))
            return F.sum(self._violating(fact, keys, at))

        # an empty union has no keys: the sums over nothing are zero
        facts = [F.coalesce(total(f), F.lit(0)).alias(f"m{i}") for i, f in enumerate(self.facts[domain])]
        return each.agg(F.struct(*facts)).scalar()

    def violating_keys(self, domain: str, labels: list[tuple[str, str]]) -> DataFrame:
        """(table_name, constraint_name, key, violations): the keys that the
        domain's facts, all of them surplus or orphans, find at fault. ``labels``
        name the facts, in the order they were registered."""
        each, keys, at = self._counts(domain)
        counts = [self._violating(fact, keys, at).cast("bigint") for fact in self.facts[domain]]
        found = [F.struct(F.lit(t).alias("table_name"), F.lit(n).alias("constraint_name"), key_text(*keys).alias("key"),
                          count.alias("violations")) for (t, n), count in zip(labels, counts, strict=True)]
        # sound keys end here, in compiled code; a lambda over the facts would be interpreted
        return (each.where(reduce(Column.__or__, [count > 0 for count in counts]))
                .select(F.inline(F.array(*found))).where("violations > 0"))

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row, a struct column per pass; measures are columns of it."""
        columns = [self.tables[t].agg(F.struct(*[v.alias(f"m{i}") for i, v in enumerate(values)])).scalar().alias(f"plain:{t}")
                   for t, values in self.plain.items()]
        columns += [self._domain(d).alias(f"keys:{d}") for d in self.facts]
        if self.counted:
            columns.append(self._row_counts().alias("rows"))
        return spark.range(1).select(*columns)
