"""Data checks.  Each finds violations; none changes data."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartwheel.functions.scalars import flag


@dataclass(frozen=True, eq=False)
class RowCheck:
    """A rule one row can break on its own."""

    table: str
    column: str
    rule: str
    violated: Column


@dataclass(frozen=True)
class UniqueCheck:
    table: str
    columns: tuple[str, ...]
    where: str | None = None

    rule = "unique"

    @property
    def column(self) -> str:
        return ",".join(self.columns)


@dataclass(frozen=True)
class ReferenceCheck:
    table: str
    column: str
    to_table: str
    to_column: str

    rule = "relationships"


Check = RowCheck | UniqueCheck | ReferenceCheck


def not_null(table: str, column: str) -> RowCheck:
    return RowCheck(table, column, "not_null", F.col(column).isNull())


def accepted_values(table: str, column: str, values: Sequence) -> RowCheck:
    """NULL passes."""
    return RowCheck(table, column, "accepted_values", ~F.col(column).isin(*values))


def accepted_range(table: str, column: str, low=None, high=None, inclusive: bool = True) -> RowCheck:
    """NULL passes; a missing bound is open."""
    value, outside = F.col(column), []
    if low is not None:
        outside.append(value < low if inclusive else value <= low)
    if high is not None:
        outside.append(value > high if inclusive else value >= high)
    return RowCheck(table, column, "accepted_range", reduce(Column.__or__, outside, F.lit(False)))


def not_after(table: str, column: str, as_of: dt.date | str) -> RowCheck:
    return RowCheck(table, column, "not_after", F.col(column) > F.lit(as_of).cast("date"))


def starts_before_end(table: str, start: str, end: str) -> RowCheck:
    """An open end passes."""
    return RowCheck(table, start, "valid_interval", F.col(start) >= F.col(end))


def unique(table: str, *columns: str, where: str | None = None) -> UniqueCheck:
    """Combination of columns occurs once; rows with a NULL among them pass."""
    return UniqueCheck(table, columns, where)


def one_current_row(table: str, key: str, current: str = "is_current") -> UniqueCheck:
    return unique(table, key, where=current)


def relationships(table: str, column: str, to_table: str, to_column: str) -> ReferenceCheck:
    """Every non-NULL value exists in the other table."""
    return ReferenceCheck(table, column, to_table, to_column)


def violations(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    """The offending rows, or the offending key values for keys."""
    rows = tables[check.table]
    if isinstance(check, RowCheck):
        return rows.where(check.violated)
    if isinstance(check, UniqueCheck):
        if check.where:
            rows = rows.where(check.where)
        return (
            rows.select(*check.columns)
            .na.drop("any")
            .groupBy(*check.columns)
            .agg(F.count(F.lit(1)).alias("rows"))
            .where("rows > 1")
        )
    known = tables[check.to_table].select(F.col(check.to_column).alias(check.column))
    return rows.where(F.col(check.column).isNotNull()).join(known, check.column, "left_anti")


def _as_text(columns: Sequence[Column], kinds: Sequence[T.DataType]) -> Column:
    """One text per value, the same for equal values of one domain."""
    if len(columns) == 1:
        return columns[0].cast(kinds[0]).cast("string")
    return F.to_json(F.struct(*[c.cast(k).alias(f"k{i}") for i, (c, k) in enumerate(zip(columns, kinds))]))


def _common(kinds: Sequence[T.DataType]) -> T.DataType:
    """A type in which keys of these types can be compared."""
    if len(set(kinds)) == 1:
        return kinds[0]
    if all(isinstance(k, T.IntegralType) for k in kinds):
        return T.LongType()
    return T.DoubleType() if all(isinstance(k, T.NumericType) for k in kinds) else T.StringType()


class _OnePass:
    """Every check of a set of tables as counts over (domain, value) groups.

    A domain is what a unique check compares, what references point to, or a
    row rule.  A table gives, in one pass, a row for each of its key values and
    each rule a row breaks; role 0 is the domain's owner, others its users.
    """

    def __init__(self, checks: Sequence[Check], tables: Mapping[str, DataFrame]):
        self.checks, self.tables = list(checks), tables
        self.domains: dict[tuple, int] = {}
        self.roles: dict[int, list[int]] = {}
        self.rows: dict[str, list[Column]] = {}
        kinds: dict[tuple, list[T.DataType]] = {}
        for check in checks:
            if isinstance(check, ReferenceCheck):
                key = (check.to_table, (check.to_column,), None)
                known = kinds.setdefault(key, [self._kind(check.to_table, check.to_column)])
                known.append(self._kind(check.table, check.column))
        self.kinds = {key: _common(found) for key, found in kinds.items()}
        for number, check in enumerate(self.checks):
            self._add(number, check)

    def _kind(self, table: str, column: str) -> T.DataType:
        return self.tables[table].schema[column].dataType

    def _emit(self, table: str, domain: int, role: int, value: Column, when: Column) -> None:
        line = F.struct(F.lit(domain).alias("domain"), F.lit(role).alias("role"), value.alias("value"))
        self.rows.setdefault(table, []).append(F.when(when, line))

    def _domain(self, table: str, columns: tuple[str, ...], where: str | None = None) -> int:
        key = (table, columns, where)
        if key not in self.domains:
            self.domains[key] = len(self.domains)
            kinds = [self.kinds.get(key, self._kind(table, c)) for c in columns]
            present = F.lit(True) if where is None else F.expr(where)
            for column in columns:
                present = present & F.col(column).isNotNull()
            self._emit(table, self.domains[key], 0, _as_text([F.col(c) for c in columns], kinds), present)
        return self.domains[key]

    def _add(self, number: int, check: Check) -> None:
        if isinstance(check, RowCheck):
            self.domains[("rule", number)] = domain = len(self.domains)
            self._emit(check.table, domain, 0, F.lit(None).cast("string"), check.violated)
        elif isinstance(check, UniqueCheck):
            self._domain(check.table, check.columns, check.where)
        else:
            domain = self._domain(check.to_table, (check.to_column,))
            users = self.roles.setdefault(domain, [])
            users.append(number)
            kind = self.kinds[(check.to_table, (check.to_column,), None)]
            value = F.col(check.column)
            self._emit(check.table, domain, len(users), _as_text([value], [kind]), value.isNotNull())

    def _failures(self, number: int, check: Check) -> Column:
        if isinstance(check, RowCheck):
            return F.sum(F.when(F.col("domain") == self.domains[("rule", number)], F.col("role0")))
        if isinstance(check, UniqueCheck):
            domain = self.domains[(check.table, check.columns, check.where)]
            return F.sum(flag((F.col("domain") == domain) & (F.col("role0") > 1)).cast("bigint"))
        domain = self.domains[(check.to_table, (check.to_column,), None)]
        role = self.roles[domain].index(number) + 1
        return F.sum(F.when((F.col("domain") == domain) & (F.col("role0") == 0), F.col(f"role{role}")))

    def summary(self) -> DataFrame:
        lines = [self.tables[table].select(F.inline(F.array(*rows))).where("domain IS NOT NULL") for table, rows in self.rows.items()]
        last_role = max((len(users) for users in self.roles.values()), default=0)
        groups = reduce(DataFrame.unionByName, lines).groupBy("domain", "value").agg(
            *[F.count_if(F.col("role") == r).alias(f"role{r}") for r in range(last_role + 1)]
        )
        counts = groups.agg(*[F.coalesce(self._failures(i, c), F.lit(0)).alias(f"n{i}") for i, c in enumerate(self.checks)])
        shown = [
            F.struct(
                F.lit(c.table).alias("table_name"), F.lit(c.column).alias("column_name"), F.lit(c.rule).alias("rule"),
                F.col(f"n{i}").cast("bigint").alias("failures"),
            )
            for i, c in enumerate(self.checks)
        ]
        return counts.select(F.inline(F.array(*shown)))


def check_summary(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Failures per check: table, column, rule, failures.

    Each table is read once, for its row rules and keys alike, and all keys and
    references of all tables share one shuffle.  A value that very many rows hold is counted before it.
    """
    return _OnePass(checks, tables).summary()


class CheckFailure(RuntimeError):
    """Raised by ``run_checks``; the message lists the failed checks."""


def failing(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> list[tuple[str, str, str, int]]:
    """Table, column, rule and failures of the checks that do not hold.

    Only one row per check reaches the driver.
    """
    return [tuple(r) for r in check_summary(checks, tables).where("failures > 0").collect()]


def run_checks(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> None:
    """Gate between two layers: raises when any check has failures."""
    failed = failing(checks, tables)
    if failed:
        raise CheckFailure("; ".join(f"{table}.{column} {rule}: {n}" for table, column, rule, n in failed))


def equal_rowcount(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row when the counts differ, none when they agree."""
    n_left = left.agg(F.count(F.lit(1)).alias("left_rows"))
    right_rows = right.agg(F.count(F.lit(1))).scalar()
    return n_left.select("left_rows", right_rows.alias("right_rows")).where("left_rows <> right_rows")


# The checks of the shop's layers.  Functions, since columns need a session.


def oltp_checks() -> list[Check]:
    return [
        unique("orders", "order_id"), not_null("orders", "order_id"),
        not_null("orders", "customer_id"), relationships("orders", "customer_id", "customers", "customer_id"),
        not_null("orders", "total_amount"), accepted_range("orders", "total_amount", low=0),
        not_null("orders", "payment_method_id"),
        relationships("orders", "payment_method_id", "payment_method", "payment_method_id"),
        unique("orders_items", "order_item_id"), not_null("orders_items", "order_item_id"),
        not_null("orders_items", "order_id"), relationships("orders_items", "order_id", "orders", "order_id"),
        not_null("orders_items", "product_id"),
        relationships("orders_items", "product_id", "products", "product_id"),
        unique("customers", "customer_id"), not_null("customers", "customer_id"),
        unique("products", "product_id"), not_null("products", "product_id"),
        not_null("products", "category_id"),
        relationships("products", "category_id", "categories", "category_id"),
        relationships("products", "brand_id", "brands", "brand_id"),
        unique("categories", "category_id"), not_null("categories", "category_id"),
        unique("brands", "brand_id"), not_null("brands", "brand_id"),
        unique("payment_method", "payment_method_id"), not_null("payment_method", "payment_method_id"),
    ]


def activity_checks() -> list[Check]:
    from cartwheel.operators.activity import ACTION_TYPES

    sessions, actions = "user_sessions", "session_actions"
    return [
        unique(sessions, "session_id"), not_null(sessions, "session_id"), not_null(sessions, "timestamp"),
        not_null(sessions, "duration_seconds"), accepted_range(sessions, "duration_seconds", 0, 86400),
        not_null(sessions, "page_views"), accepted_range(sessions, "page_views", low=0),
        not_null(sessions, "actions_count"), accepted_range(sessions, "actions_count", low=0),
        accepted_values(sessions, "device_type", ["mobile", "desktop", "tablet"]),
        unique(actions, "action_id"), not_null(actions, "action_id"), not_null(actions, "session_id"),
        relationships(actions, "session_id", sessions, "session_id"),
        not_null(actions, "action_timestamp"), not_null(actions, "action_type"),
        accepted_values(actions, "action_type", ACTION_TYPES),
        *[accepted_values(actions, name, [0, 1]) for name in ("is_view", "is_add_to_cart", "is_purchase")],
        not_null(actions, "year"),
        not_null(actions, "month"), accepted_range(actions, "month", 1, 12),
        not_null(actions, "day"), accepted_range(actions, "day", 1, 31),
    ]


def campaign_checks() -> list[Check]:
    """One row per customer and day is the key of the stored list."""
    name = "high_value_purchase_campaign"
    return [
        not_null(name, "customer_id"), unique(name, "customer_id", "campaign_date"),
        not_null(name, "campaign_date"), not_null(name, "purchase_probability"),
        accepted_range(name, "purchase_probability", 0.0, 1.0),
        accepted_values(name, "customer_segment", ["Hot Lead", "Warm Lead", "Cold Lead", "Low Priority"]),
        not_null(name, "campaign_action"), not_null(name, "created_at"),
    ]


def sales_checks(as_of: dt.date | str) -> list[Check]:
    """Contract of the sales mart: keys exist, amounts are not negative."""
    return [
        relationships("fact_sales", "product_key", "dim_products", "product_id"),
        relationships("fact_sales", "customer_key", "dim_customers", "customer_id"),
        relationships("fact_sales", "date_key", "dim_date", "date_key"),
        not_null("fact_sales", "order_id"),
        accepted_range("fact_sales", "quantity", low=0),
        accepted_range("fact_sales", "sub_total", low=0),
        not_after("orders", "order_date", as_of),
    ]
