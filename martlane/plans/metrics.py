"""Metric views: named facts, dimensions and metrics over a mart, with synonyms."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Aggregate = Callable[[Column], Column]

# How a metric sums up its column.
AGGREGATES: dict[str, Aggregate] = {
    "sum": F.sum,
    "avg": F.avg,
    "count": F.count,
    "count_distinct": F.count_distinct,
    "count_true": F.count_if,
}


@dataclass(frozen=True)
class Metric:
    """An aggregate over one column. ``grain`` is the id its values belong to:
    a value repeats on every row of that id once joins have fanned out."""

    aggregate: str
    column: str
    grain: str
    synonyms: tuple[str, ...] = ()


@dataclass(frozen=True)
class MetricView:
    name: str
    mart: str
    key: str | None
    synonyms: tuple[str, ...]
    facts: dict[str, tuple[str, ...]]
    dimensions: dict[str, tuple[str, ...]]
    metrics: dict[str, Metric]


# --- Fixed values: the three views with their English and German synonyms.
FULFILLMENT = MetricView(
    name="fulfillment_analytics",
    mart="fulfillment_lifecycle",
    key="order_id",
    synonyms=("fulfillment", "orders", "deliveries", "Auftragsabwicklung"),
    facts={
        "order_total_chf": ("order amount", "order value", "Bestellwert"),
        "delivery_days": ("delivery time", "transit time", "Lieferzeit"),
        "payment_amount_chf": ("payment total", "Zahlungsbetrag"),
        "net_payment_chf": ("net amount", "Nettobetrag"),
    },
    dimensions={
        "order_id": ("order number", "Bestellnummer"),
        "customer_id": ("customer number", "Kundennummer"),
        "order_status": ("order state", "Bestellstatus"),
        "shipment_id": ("shipment number", "Sendungsnummer"),
        "shipment_status": ("shipment state", "Versandstatus"),
        "vehicle_id": ("truck id", "Fahrzeug-ID"),
        "origin_warehouse": ("warehouse", "origin", "Lager", "Abgangsort"),
        "destination_city": ("delivery city", "destination", "Zielort", "Lieferstadt"),
        "payment_id": ("payment number", "Zahlungs-ID"),
        "payment_method": ("payment type", "Zahlungsart"),
        "payment_status": ("payment state", "Zahlungsstatus"),
        "order_date": ("order placed date", "Bestelldatum"),
        "shipped_at": ("ship date", "dispatch date", "Versanddatum"),
        "delivered_at": ("delivery date", "Lieferdatum"),
    },
    metrics={
        "total_revenue": Metric(
            "sum", "order_total_chf", "order_id", ("revenue", "Gesamtumsatz")
        ),
        "avg_delivery_days": Metric(
            "avg",
            "delivery_days",
            "shipment_id",
            ("average delivery time", "durchschnittliche Lieferzeit"),
        ),
        "total_payments": Metric(
            "sum", "payment_amount_chf", "payment_id", ("payment volume", "Zahlungsvolumen")
        ),
        "order_count": Metric(
            "count_distinct", "order_id", "order_id", ("number of orders", "Anzahl Bestellungen")
        ),
        "shipment_count": Metric(
            "count_distinct",
            "shipment_id",
            "shipment_id",
            ("number of shipments", "Anzahl Sendungen"),
        ),
    },
)

REVENUE = MetricView(
    name="revenue_analytics",
    mart="revenue_by_route",
    key=None,
    synonyms=("routes", "revenue", "Umsatz", "Strecken"),
    facts={
        "total_shipments": ("shipment count", "Anzahl Sendungen"),
        "total_orders": ("order count", "Anzahl Bestellungen"),
        "total_revenue_chf": ("gross revenue", "Bruttoumsatz"),
        "total_payments_chf": ("payment volume", "Zahlungsvolumen"),
        "total_refunds_chf": ("refund volume", "Rueckerstattungen"),
        "net_revenue_chf": ("net income", "Nettoumsatz"),
        "avg_delivery_days": ("average delivery time", "durchschnittliche Lieferzeit"),
        "avg_order_value_chf": ("average order size", "durchschnittlicher Bestellwert"),
    },
    dimensions={
        "origin_warehouse": ("warehouse", "origin", "Lager", "Abgangsort"),
        "destination_city": ("delivery city", "destination", "Zielort", "Lieferstadt"),
    },
    metrics={
        "total_net_revenue": Metric(
            "sum", "net_revenue_chf", "", ("overall net revenue", "Gesamtnettoumsatz")
        ),
        "total_route_shipments": Metric(
            "sum", "total_shipments", "", ("overall shipments", "Gesamtsendungen")
        ),
        "avg_route_delivery_days": Metric(
            "avg", "avg_delivery_days", "", ("overall avg delivery time", "Gesamtlieferzeit")
        ),
    },
)

COMPLIANCE = MetricView(
    name="compliance_analytics",
    mart="transaction_report",
    key="payment_id",
    synonyms=("transactions", "compliance", "FINMA", "BAZG", "GwG", "Transaktionen"),
    facts={"amount_chf": ("transaction amount", "Betrag", "Transaktionsbetrag")},
    dimensions={
        "payment_id": ("transaction id", "Zahlungs-ID"),
        "order_id": ("order number", "Bestellnummer"),
        "customer_id": ("customer number", "Kundennummer"),
        "company_name": ("firm", "business name", "Firmenname"),
        "payment_method": ("payment type", "Zahlungsart"),
        "payment_status": ("payment state", "Zahlungsstatus"),
        "is_international": ("cross-border", "grenzueberschreitend"),
        "requires_aml_check": ("AML flag", "GwG check", "Geldwaeschereiproofung"),
        "shipment_id": ("shipment number", "Sendungsnummer"),
        "requires_customs": ("customs flag", "BAZG flag", "Zollpflichtig"),
        "customs_declaration_id": (
            "customs number",
            "Zolldeklarationsnummer",
            "BAZG reference",
        ),
        "created_at": ("creation date", "Erstelldatum"),
        "processed_at": ("processing date", "Verarbeitungsdatum"),
    },
    metrics={
        "total_amount": Metric("sum", "amount_chf", "payment_id", ("total volume", "Gesamtbetrag")),
        "transaction_count": Metric(
            "count",
            "payment_id",
            "payment_id",
            ("number of transactions", "Anzahl Transaktionen"),
        ),
        "aml_flagged_count": Metric(
            "count_true", "requires_aml_check", "payment_id", ("AML count", "GwG flagged")
        ),
        "customs_required_count": Metric(
            "count_true",
            "requires_customs",
            "payment_id",
            ("customs count", "Zollpflichtige Transaktionen"),
        ),
        "international_count": Metric(
            "count_true",
            "is_international",
            "payment_id",
            ("cross-border count", "internationale Transaktionen"),
        ),
    },
)

VIEWS = {view.name: view for view in (FULFILLMENT, REVENUE, COMPLIANCE)}


def _names(view: MetricView, kind: str) -> dict[str, tuple[str, ...]]:
    if kind == "metric":
        return {name: metric.synonyms for name, metric in view.metrics.items()}
    return {"fact": view.facts, "dimension": view.dimensions}[kind]


def resolve(view: MetricView, phrase: str, kind: str) -> str:
    """The name a phrase stands for among one kind; case does not matter.

    The kind is needed because a fact and a metric may share a synonym.
    """
    wanted = phrase.strip().casefold()
    for name, synonyms in _names(view, kind).items():
        if wanted in (name.casefold(), *[s.casefold() for s in synonyms]):
            return name
    raise KeyError(f"{view.name} has no {kind} called {phrase!r}")


def find_view(phrase: str) -> MetricView:
    """The view with this name or synonym."""
    wanted = phrase.strip().casefold()
    for view in VIEWS.values():
        if wanted in (view.name.casefold(), *[s.casefold() for s in view.synonyms]):
            return view
    raise KeyError(f"no view called {phrase!r}")


def describe(spark: SparkSession, view: MetricView) -> DataFrame:
    """The view's facts, dimensions and metrics as rows: kind, name, expression, synonyms."""
    rows = [
        (kind, name, name, list(synonyms))
        for kind in ("fact", "dimension")
        for name, synonyms in _names(view, kind).items()
    ]
    rows += [
        ("metric", name, f"{m.aggregate}({m.column})", list(m.synonyms))
        for name, m in view.metrics.items()
    ]
    return spark.createDataFrame(
        rows, "kind string, name string, expression string, synonyms array<string>"
    )


def _measure(metric: Metric, name: str) -> Column:
    return AGGREGATES[metric.aggregate](F.col(metric.column)).alias(name)


def _only_value(metric: Metric, name: str) -> Column:
    value = F.max(name)
    if metric.aggregate.startswith("count"):
        value = F.coalesce(value, F.lit(0))
    return value.alias(name)


def _counts_ids(metric: Metric) -> bool:
    """Whether a metric only counts the ids it belongs to."""
    return metric.column == metric.grain and metric.aggregate in ("count", "count_distinct")


def _once_per_id(df: DataFrame, measures: dict[str, Metric], dims: Sequence[str]) -> DataFrame:
    """Metrics over one row per id and dimension values, fan-out undone; one scan for all grains.

    Every row is expanded to one per grain, with that grain's id and facts only, and one
    without an id that keeps groups in which a metric has none. The first aggregation
    leaves a row per group, grain and id, the second one adds them up.
    """
    grains = list(dict.fromkeys(m.grain for m in measures.values()))
    tag = F.col("tag")
    ids = [F.when(tag == i, F.col(grain)).alias(f"id_{i}") for i, grain in enumerate(grains)]
    facts = {
        name: F.when(tag == grains.index(m.grain), F.col(m.column)).alias(f"value_of_{name}")
        for name, m in measures.items()
        if not _counts_ids(m)
    }
    tags = F.array(*[F.lit(i) for i in range(-1, len(grains))])
    expanded = df.withColumn("tag", F.explode(tags)).select(*dims, "tag", *ids, *facts.values())
    names = [f"id_{i}" for i in range(len(grains))]
    # An id is set under its own tag only.
    expanded = expanded.filter((tag == -1) | reduce(Column.__or__, [F.col(n).isNotNull() for n in names]))
    keys = [*dims, "tag", *names]
    values = [F.max(f"value_of_{name}").alias(f"value_of_{name}") for name in facts]
    per_id = expanded.groupBy(*keys).agg(*values) if values else expanded.select(*keys).distinct()

    def measure(name: str, m: Metric) -> Column:
        own = tag == grains.index(m.grain)
        if _counts_ids(m):
            return F.count(F.when(own, F.lit(1))).alias(name)
        return AGGREGATES[m.aggregate](F.col(f"value_of_{name}")).alias(name)

    return per_id.groupBy(*dims).agg(*[measure(name, m) for name, m in measures.items()])


def metric_query(
    view: MetricView,
    mart: DataFrame,
    metrics: Sequence[str],
    dimensions: Sequence[str] = (),
    where: Column | None = None,
    order_by: Sequence[Column] = (),
    limit: int | None = None,
    guard_fanout: bool = False,
) -> DataFrame:
    """Metrics by dimensions over the view's mart; names may be synonyms.

    By default rows count as they stand, so an order with two payments adds
    its total twice. ``guard_fanout`` counts every metric once per id it
    belongs to.
    """
    dims = [resolve(view, d, "dimension") for d in dimensions]
    names = [resolve(view, m, "metric") for m in metrics]
    rows = mart if where is None else mart.filter(where)
    if guard_fanout:
        # Metrics without a grain have nothing to guard.
        plain = [n for n in names if not view.metrics[n].grain]
        guarded = {n: view.metrics[n] for n in names if view.metrics[n].grain}
        parts = [_once_per_id(rows, guarded, dims)] if guarded else []
        if plain:
            parts.append(rows.groupBy(*dims).agg(*[_measure(view.metrics[n], n) for n in plain]))
        # Every part has one row per group: the only value per group lines them up.
        result = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        if len(parts) > 1:
            result = result.groupBy(*dims).agg(*[_only_value(view.metrics[n], n) for n in names])
        result = result.select(*dims, *names)
    else:
        result = rows.groupBy(*dims).agg(*[_measure(view.metrics[n], n) for n in names])
    if order_by:
        result = result.orderBy(*order_by)
    return result if limit is None else result.limit(limit)
