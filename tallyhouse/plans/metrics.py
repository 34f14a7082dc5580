"""Metric views: measures defined once, computed correctly at any grain.

A metric view is a source with named dimensions and named measures. A query aggregates the source
rows at the asked grain; a ratio is taken after both of its sums. An average or a ratio is never
aggregated a second time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tallyhouse.functions import line_cost, month_of, safe_ratio


@dataclass(frozen=True)
class Ratio:
    """A measure that divides two other measures."""

    numerator: str
    denominator: str
    scale: int = 1


@dataclass(frozen=True)
class Total:
    """A sum, which may be added up further where it is stored."""

    of: Column


@dataclass(frozen=True)
class Mean:
    """An average, which is stored as a sum and a count."""

    of: Column


@dataclass(frozen=True)
class _StoredMean:
    total: Column
    count: Column
    kind: DataType


@dataclass(frozen=True)
class MetricView:
    """Measures are sums, averages, ratios of other measures, or any aggregate, which then is not stored."""

    source: DataFrame
    dimensions: Mapping[str, Column]
    measures: Mapping[str, Column | Total | Mean | Ratio]
    formats: Mapping[str, str] = field(default_factory=dict)

    def _base_measures(self, wanted: Sequence[str]) -> list[str]:
        """The wanted aggregates and those that a wanted ratio needs, each once."""
        names: dict[str, None] = {}
        for name in wanted:
            measure = self.measures[name]
            parts = (measure.numerator, measure.denominator) if isinstance(measure, Ratio) else (name,)
            names.update(dict.fromkeys(parts))
        return list(names)

    def _aggregate(self, name: str) -> Column:
        measure = self.measures[name]
        if isinstance(measure, Total):
            return F.sum(measure.of)
        if isinstance(measure, Mean):
            return F.avg(measure.of)
        if isinstance(measure, _StoredMean):
            return F.try_divide(F.sum(measure.total), F.sum(measure.count)).cast(measure.kind)
        return measure

    def _value(self, name: str) -> Column:
        measure = self.measures[name]
        if isinstance(measure, Ratio):
            return F.lit(float(measure.scale)) * safe_ratio(
                F.col(f"`{measure.numerator}`"), F.col(f"`{measure.denominator}`"))
        return F.col(f"`{name}`")

    def _shown(self, name: str) -> Column:
        value = F.col(f"`{name}`")
        if self.formats.get(name) == "USD":
            value = F.concat(F.lit("$"), F.format_number(value, 2))
        return value.alias(name)

    def query(self, measures: Sequence[str], by: Sequence[str] = (),
              where: Mapping[str, object] | Column | None = None,
              order: Sequence[Column] = (), limit: int | None = None,
              formatted: bool = False) -> DataFrame:
        """Measures by dimensions, always from the source rows.

        ``where`` is a condition on source columns, or a mapping from dimension to a value, a list
        of values, or a (first, last) tuple. Sorting and the limit use the numbers, also when the
        result is formatted for display.
        """
        rows = self.source
        if isinstance(where, Mapping):
            for name, wanted in where.items():
                rows = rows.filter(_matches(self.dimensions[name], wanted))
        elif where is not None:
            rows = rows.filter(where)
        groups = [self.dimensions[name].alias(name) for name in by]
        sums = [self._aggregate(name).alias(name) for name in self._base_measures(measures)]
        keys = [F.col(f"`{name}`") for name in by]
        result = rows.groupBy(*groups).agg(*sums).select(
            *keys, *[self._value(name).alias(name) for name in measures])
        if order:
            result = result.orderBy(*order)
        if limit is not None:
            result = result.limit(limit)
        return result.select(*keys, *[self._shown(name) for name in measures]) if formatted else result

    def to_flat_view(self) -> DataFrame:
        """All measures at the grain of all dimensions, with underscores in the names.

        Sums in it can be added up further; ratios and averages cannot, use ``query`` for those.
        """
        flat = self.query(list(self.measures), by=list(self.dimensions))
        return flat.toDF(*[name.replace(" ", "_") for name in flat.columns])


    def stored_grain(self, by: Sequence[str]) -> DataFrame:
        """Sums and counts at the grain of some dimensions, from which ``answered_from`` makes coarser answers.

        Names have underscores, as in the flat view. Measures that cannot be aggregated again are left out.
        """
        parts = []
        for name, measure in self.measures.items():
            if isinstance(measure, Total):
                parts.append(F.sum(measure.of).alias(_stored(name)))
            elif isinstance(measure, Mean):
                parts += [F.sum(measure.of).alias(_stored(name, "sum")), F.count(measure.of).alias(_stored(name, "count"))]
        return self.source.groupBy(*[self.dimensions[d].alias(_stored(d)) for d in by]).agg(*parts)

    def answered_from(self, stored: DataFrame) -> MetricView:
        """The same view over a frame that ``stored_grain`` made, with the dimensions and measures it has."""
        def again(name: str, measure):
            if isinstance(measure, Total) and _stored(name) in stored.columns:
                return Total(F.col(_stored(name)))
            if isinstance(measure, Mean) and _stored(name, "sum") in stored.columns:
                kind = self.source.agg(F.avg(measure.of).alias("m")).schema["m"].dataType
                return _StoredMean(F.col(_stored(name, "sum")), F.col(_stored(name, "count")), kind)
            return measure if isinstance(measure, Ratio) else None

        kept = {name: m for name, measure in self.measures.items() if (m := again(name, measure)) is not None}
        whole = {name: m for name, m in kept.items()
                 if not isinstance(m, Ratio) or (m.numerator in kept and m.denominator in kept)}
        return MetricView(stored, {d: F.col(_stored(d)) for d in self.dimensions if _stored(d) in stored.columns},
                          whole, self.formats)


def _stored(name: str, part: str = "") -> str:
    return "_".join([name, part] if part else [name]).replace(" ", "_")


@dataclass(frozen=True)
class RoutedView:
    """A metric view with stored grains of it; a query goes to the first that can answer it, else to the source.

    The grains are given from the smallest up. One can answer if it has all dimensions of the groups and of the
    condition, and all measures, in a form that may be aggregated again; a condition on source columns goes to
    the source.
    """

    view: MetricView
    grains: Sequence[MetricView]

    def route(self, measures: Sequence[str], by: Sequence[str] = (),
              where: Mapping[str, object] | Column | None = None) -> MetricView:
        if where is not None and not isinstance(where, Mapping):
            return self.view
        dimensions = {*by, *(where or ())}
        return next((g for g in self.grains if dimensions <= set(g.dimensions) and set(measures) <= set(g.measures)),
                    self.view)

    def query(self, measures: Sequence[str], by: Sequence[str] = (),
              where: Mapping[str, object] | Column | None = None, **options) -> DataFrame:
        return self.route(measures, by, where).query(measures, by, where, **options)


def _matches(dimension: Column, wanted: object) -> Column:
    if isinstance(wanted, tuple):
        return dimension.between(F.lit(wanted[0]), F.lit(wanted[1]))
    if isinstance(wanted, list):
        return dimension.isin(wanted)
    return dimension == F.lit(wanted)


def drill_across(frames: Sequence[DataFrame], on: Sequence[str], how: str = "left") -> DataFrame:
    """Join metric queries on shared dimensions; each is one row per key, so nothing fans out."""
    return reduce(lambda left, right: left.join(right, list(on), how), frames)


# Names of the published dimensions and measures.
def sales_metrics(sales: DataFrame) -> MetricView:
    return MetricView(
        source=sales,
        dimensions={
            "Category": F.col("category"),
            "Channel": F.col("channel"),
            "Subcategory": F.col("subcategory"),
            "Product": F.col("product_name"),
            "Order Date": F.col("order_date"),
            "Order Month": month_of(F.col("order_date")),
        },
        measures={
            "Total Revenue": Total(F.col("line_revenue")),
            "Total Cost": Total(line_cost()),
            "Total Profit": Total(F.col("line_profit")),
            "Profit Margin Pct": Ratio("Total Profit", "Total Revenue", 100),
            "Units Sold": Total(F.col("quantity")),
            "Avg Order Line Value": Mean(F.col("line_revenue")),
        },
        formats={"Total Revenue": "USD", "Total Cost": "USD", "Total Profit": "USD"},
    )


def marketing_metrics(marketing: DataFrame) -> MetricView:
    return MetricView(
        source=marketing,
        dimensions={"Category": F.col("category"), "Marketing Channel": F.col("channel")},
        measures={
            "Marketing Spend": Total(F.col("spend_usd")),
            "Attributed Revenue": Total(F.col("attributed_revenue_usd")),
            "Marketing ROI": Ratio("Attributed Revenue", "Marketing Spend"),
            "Conversions": Total(F.col("conversions")),
        },
        formats={"Marketing Spend": "USD", "Attributed Revenue": "USD"},
    )
