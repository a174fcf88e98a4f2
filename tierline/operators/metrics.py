"""Metrics with one definition each, asked for by any dimensions: models of measures and dimensions, compiled to one plan.

A measure is a sum or count of an expression of its model's table. A metric is a measure or the ratio of two, and ratios are made
from sums at the grain that is asked for, never from ratios of parts. A dimension is a column of the model, or, as
entity__dimension, of another model that the entity leads to.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.columns import ratio

_SUM = "decimal(38,2)"


@dataclass(frozen=True)
class Measure:
    """count (rows where expr is not null) or sum; sums are exact decimals."""

    agg: str
    expr: str

    def column(self) -> Column:
        return F.count(F.expr(self.expr)).cast(_SUM) if self.agg == "count" else F.sum(F.expr(self.expr).cast(_SUM)).cast(_SUM)


@dataclass(frozen=True)
class Model:
    """A table with its entities (name to expression; primary is the one that its rows are unique by), dimensions and measures."""

    name: str
    table: Callable[[], DataFrame]
    primary: str
    entities: Mapping[str, str]
    dimensions: Mapping[str, str]
    measures: Mapping[str, Measure] = field(default_factory=dict)


@dataclass(frozen=True)
class Metric:
    """One measure, or numerator over denominator."""

    numerator: str
    denominator: str | None = None


class Catalogue:
    """Models and metrics, checked when they are put together."""

    def __init__(self, models: Sequence[Model], metrics: Mapping[str, Metric]):
        self.models, self.metrics = {m.name: m for m in models}, dict(metrics)
        self.owner: dict[str, Model] = {}
        for m in models:
            for name in m.measures:
                if name in self.owner:
                    raise ValueError(f"measure {name} is in {self.owner[name].name} and in {m.name}")
                self.owner[name] = m
            if m.primary not in m.entities:
                raise ValueError(f"{m.name}: its primary entity {m.primary} is not among its entities")
        unknown = {x for metric in metrics.values() for x in (metric.numerator, metric.denominator) if x and x not in self.owner}
        if unknown:
            raise ValueError(f"metrics of unknown measures: {sorted(unknown)}")

    def _path(self, model: Model, dimension: str) -> tuple[str, Model, str] | None:
        """The entity that leads to a dimension of another model, that model, and the dimension's expression there."""
        entity, _, name = dimension.partition("__")
        for other in self.models.values():
            if name and entity in model.entities and other is not model and other.primary == entity and name in other.dimensions:
                return entity, other, other.dimensions[name]
        return None

    def _rows(self, model: Model, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
        """Sums of measures by all dimensions at once: one scan of the model, joined to each other model that by asks for once."""
        rows, own, far = model.table(), {}, {}
        for d in by:
            if d in model.dimensions:
                own[d] = F.expr(model.dimensions[d])
            elif path := self._path(model, d):
                far.setdefault((path[0], path[1].name), {})[d] = path[2]
            else:
                raise ValueError(f"{model.name} has no dimension {d}, and none of its entities leads to one")
        rows = rows.withColumns({f"_d_{d}": e for d, e in own.items()} | {f"_e_{e}": F.expr(model.entities[e]) for e, _ in far})
        for (entity, name), dims in far.items():
            other = self.models[name]
            keyed = other.table().select(F.expr(other.entities[entity]).alias(f"_e_{entity}"), *[F.expr(e).alias(f"_d_{d}") for d, e in dims.items()])
            rows = rows.join(keyed, f"_e_{entity}", "left")
        return rows.groupBy(*[F.col(f"_d_{d}").alias(d) for d in by]).agg(*[model.measures[m].column().alias(f"m_{m}") for m in measures])

    def query(self, metrics: Sequence[str], by: Sequence[str] = (), sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
        """metric, grain (the dimensions of the row's set, comma-joined; '' for the total), the columns in by, and value.

        sets are the sets of dimensions to tell, by default the one of all; by is what they take together. Each model is
        read once, whatever the number of metrics and sets: sums at the finest grain are few rows, and the sets are made of these.
        A dimension that is null in a row's set is one that the set lacks, or a value that is null. A ratio over 0 is null.
        """
        unknown = [m for m in metrics if m not in self.metrics]
        sets = [tuple(by)] if sets is None else [tuple(s) for s in sets]
        if unknown or any(d not in by for s in sets for d in s):
            raise ValueError(f"unknown metrics {unknown}, or sets with dimensions that are not asked for")
        needed: dict[str, list[str]] = {}
        for m in metrics:
            for x in (self.metrics[m].numerator, self.metrics[m].denominator):
                if x and x not in needed.setdefault(self.owner[x].name, []):
                    needed[self.owner[x].name].append(x)
        parts = None
        for name, measures in needed.items():
            fine = self._rows(self.models[name], by, measures)
            sums = [F.sum(f"m_{x}").cast(_SUM).alias(f"m_{x}") for x in measures]
            mark = F.concat_ws(",", *[F.when(F.grouping(d) == 0, F.lit(d)) for d in by]) if by else F.lit("")
            told = fine.groupingSets([[F.col(d) for d in s] for s in sets], *[F.col(d) for d in by]).agg(mark.alias("grain"), *sums) if by else fine.agg(*sums).withColumn("grain", mark)
            parts = told if parts is None else parts.unionByName(told, allowMissingColumns=True)
        every = sorted({x for m in needed.values() for x in m})
        whole = parts.groupBy("grain", *by).agg(*[F.max(f"m_{x}").alias(f"m_{x}") for x in every]) if len(needed) > 1 else parts
        value = lambda m: ratio(F.col(f"m_{m.numerator}"), F.col(f"m_{m.denominator}")) if m.denominator else F.col(f"m_{m.numerator}").cast("double")
        rows = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), value(self.metrics[n]).alias("value")) for n in metrics]))
        return whole.select("grain", *by, rows.alias("_m")).select("_m.metric", "grain", *by, "_m.value")
