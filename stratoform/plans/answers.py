"""A question about sales, answered from the smallest stored summary that holds the answer.

A question names groups, measures and conditions. A summary has a grain, the
columns that name its rows, and additive measures. Attributes follow from the
grain: a month from its day, a region from its customer. A summary can answer
when all groups and conditions follow from its grain, its measures give the
ones asked for, and members to be told apart are part of its grain. Among
those the one with the fewest rows is taken; the sales themselves always fit.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratoform.functions.amounts import mean
from stratoform.plans.summaries import SummaryStore, left_over, signed_totals

#: What follows from a day.
_CALENDAR: dict[str, Callable[[Column], Column]] = {
    "year": lambda day: F.year(day).cast("bigint"),
    "month": lambda day: F.month(day).cast("bigint"),
    "quarter": lambda day: F.quarter(day).cast("bigint"),
}

#: Additive parts that a measure is made of, and how.
_MEASURES: dict[str, tuple[tuple[str, ...], Callable[..., Column]]] = {
    "total_sales": (("lines",), lambda n: n),
    "total_quantity": (("pieces",), lambda n: n),
    "total_revenue": (("net",), lambda n: n),
    "avg_sale_amount": (("net", "lines"), mean),
    "avg_price": (("price_sum", "lines"), mean),
}

#: Members that can be counted, and the column of the grain that tells them apart.
_MEMBERS = {"unique_customers": "customer_id", "unique_products": "product_id", "active_days": "sale_date"}

#: Ends of what is in the grain.
_ENDS: dict[str, tuple[str, Callable[[str], Column]]] = {
    "first_day": ("sale_date", F.min),
    "last_day": ("sale_date", F.max),
}


@dataclass(frozen=True)
class Condition:
    """``column`` between ``low`` and ``high``, where given, and one of ``values``, where given."""

    column: str
    low: object = None
    high: object = None
    values: tuple = ()

    def test(self) -> Column:
        column = F.col(self.column)
        tests = [column >= F.lit(self.low)] if self.low is not None else []
        tests += [column <= F.lit(self.high)] if self.high is not None else []
        tests += [column.isin(*self.values)] if self.values else []
        return reduce(Column.__and__, tests, F.lit(True))


@dataclass(frozen=True)
class Question:
    """Measures by groups under conditions; a total without groups is one row."""

    measures: tuple[str, ...]
    groups: tuple[str, ...] = ()
    where: tuple[Condition, ...] = ()

    def __post_init__(self) -> None:
        unknown = set(self.measures) - set(_MEASURES) - set(_MEMBERS) - set(_ENDS)
        if unknown:
            raise ValueError(f"unknown measures {sorted(unknown)}")

    def columns(self) -> set[str]:
        return {*self.groups, *(c.column for c in self.where)}

    def parts(self) -> set[str]:
        return {p for m in self.measures if m in _MEASURES for p in _MEASURES[m][0]}

    def members(self) -> set[str]:
        return {_MEMBERS[m] for m in self.measures if m in _MEMBERS} | {_ENDS[m][0] for m in self.measures if m in _ENDS}


@dataclass(frozen=True)
class Cuboid:
    """Stored rows: the columns of their grain, their additive parts, and how many they are."""

    name: str
    rows: DataFrame
    grain: tuple[str, ...]
    parts: tuple[str, ...]
    size: int


@dataclass
class Answers:
    """Summaries to answer from, and the sales for what they do not hold.

    ``attributes`` has, by key, the dimension whose other columns follow from it.
    """

    sales: DataFrame
    attributes: Mapping[str, DataFrame] = field(default_factory=dict)
    cuboids: list[Cuboid] = field(default_factory=list)

    def _follows(self, column: str, grain: tuple[str, ...]) -> bool:
        if column in grain:
            return True
        if column in _CALENDAR:
            return "sale_date" in grain
        return any(key in grain and column in dimension.columns for key, dimension in self.attributes.items())

    def fitting(self, question: Question) -> list[Cuboid]:
        """The summaries that hold the answer, the smallest first."""
        fit = [
            c
            for c in self.cuboids
            if all(self._follows(name, c.grain) for name in question.columns())
            and question.parts() <= set(c.parts)
            and question.members() <= set(c.grain)
        ]
        return sorted(fit, key=lambda c: (c.size, c.name))

    def chosen(self, question: Question) -> str:
        fit = self.fitting(question)
        return fit[0].name if fit else "sales"

    def answer(self, question: Question, by: str | None = None) -> DataFrame:
        """The answer, from the smallest summary that has it, or from the one named ``by`` ("sales" for the base)."""
        fit = {c.name: c for c in self.fitting(question)}
        by = by or self.chosen(question)
        if by != "sales":
            if by not in fit:
                raise ValueError(f"{by} does not hold the answer")
            return self._rolled_up(fit[by].rows, fit[by].grain, question)
        needed = {*question.members(), *question.columns()}
        grain = [c for c in ("sale_date", "customer_id", "product_id") if c in needed or self._implied(c, question)]
        if not all(self._follows(name, tuple(grain)) for name in question.columns()):
            raise ValueError(f"nothing has {sorted(question.columns())}")
        return self._rolled_up(left_over(signed_totals(self.sales, *grain)), tuple(grain), question)

    def _implied(self, key: str, question: Question) -> bool:
        """Whether an attribute asked for follows from the key."""
        wanted = question.columns()
        if key == "sale_date":
            return any(c in _CALENDAR for c in wanted)
        return key in self.attributes and any(c in self.attributes[key].columns for c in wanted if c not in _CALENDAR)

    def _rolled_up(self, rows: DataFrame, grain: tuple[str, ...], question: Question) -> DataFrame:
        wanted = question.columns()
        if "sale_date" in grain:
            rows = rows.withColumns({n: of(F.col("sale_date")) for n, of in _CALENDAR.items() if n in wanted})
        # What cuts rows goes before what adds columns.
        early = [c for c in question.where if c.column in rows.columns]
        for condition in early:
            rows = rows.where(condition.test())
        for key, dimension in self.attributes.items():
            extra = [c for c in dimension.columns if c in wanted and c != key and c not in rows.columns]
            if key in grain and extra:
                attributes = dimension.select(key, *extra)
                for condition in question.where:
                    if condition.column in extra:
                        attributes = attributes.where(condition.test())
                rows = rows.join(attributes, key)
        measures = [
            *[F.sum(p).alias(f"_{p}") for p in sorted(question.parts())],
            *[F.count_distinct(_MEMBERS[m]).alias(m) for m in question.measures if m in _MEMBERS],
            *[_ENDS[m][1](_ENDS[m][0]).alias(m) for m in question.measures if m in _ENDS],
        ]
        added = rows.groupBy(*question.groups).agg(*measures)
        if "_lines" in added.columns and not question.groups:
            added = added.withColumn("_lines", F.coalesce("_lines", F.lit(0).cast("bigint")))
        made = [
            _MEASURES[m][1](*(F.col(f"_{p}") for p in _MEASURES[m][0])).alias(m) if m in _MEASURES else F.col(m)
            for m in question.measures
        ]
        return added.select(*question.groups, *made)


#: By summary: the rows of its state that make a cuboid, their grain, and the additive parts.
_STATES: dict[str, list[tuple[str, str | None, dict[str, str], tuple[str, ...]]]] = {
    "mv_daily_sales": [("days", None, {"sale_date": "sale_date"}, ("lines", "pieces", "net", "price_sum"))],
    "mv_customer_sales": [("customers", None, {"customer_id": "customer_id"}, ("lines", "pieces", "net", "price_sum"))],
    "mv_product_performance": [("products", None, {"product_id": "product_id"}, ("lines", "pieces", "net", "price_sum"))],
    "mv_daily_enhanced": [
        ("days of customers", "customer", {"sale_date": "sale_date", "member": "customer_id"}, ("lines", "net")),
        ("days of products", "product", {"sale_date": "sale_date", "member": "product_id"}, ("lines", "net")),
    ],
    "mv_customer_enhanced": [
        ("products of customers", "product", {"customer_id": "customer_id", "product_id": "product_id"}, ("lines", "net")),
        ("customers by day", "day", {"customer_id": "customer_id", "sale_date": "sale_date"}, ("lines", "net")),
    ],
    "mv_product_enhanced": [
        ("pairs", None, {"customer_id": "customer_id", "product_id": "product_id"}, ("lines", "pieces", "net", "price_sum"))
    ],
}


def cuboids_of(store: SummaryStore, stored: Mapping[str, str]) -> list[Cuboid]:
    """The cuboids in the states of stored summaries; ``stored`` has the name of each in the store.

    Sizes are counted from file footers, or by the one column that tells kinds apart.
    """
    found = []
    for summary, parts in _STATES.items():
        if summary not in stored:
            continue
        state = store.state(stored[summary])
        for name, kind, grain, additive in parts:
            rows = state if kind is None else state.where(F.col("kind") == kind)
            size = rows.count()
            shown = left_over(rows).select(*[F.col(c).alias(n) for c, n in grain.items()], *additive)
            found.append(Cuboid(f"{summary}: {name}", shown, tuple(grain.values()), additive, size))
    return found
