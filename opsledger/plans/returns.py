"""Product-return reporting: rule-driven KPIs in one pass, and the breakdown reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from opsledger.functions import cleaning, predicates as p
from opsledger.operators.dedup import first_per_key

DOCUMENT = "document_number"
REPORT_COLUMNS = ("category", "status", "display_name", "description", "quantity", "created_at")


@dataclass(frozen=True)
class Match:
    """One text test: ``column`` contains (or equals) any of ``texts``."""

    column: str
    texts: tuple[str, ...]
    exact: bool = False

    def column_test(self) -> Column:
        c = F.col(self.column)
        return c.isin(*self.texts) if self.exact else p.any_of([c.contains(t) for t in self.texts])


@dataclass(frozen=True)
class Rule:
    """A KPI: alternatives (OR) of tests that all hold (AND)."""

    alternatives: tuple[tuple[Match, ...], ...]

    def test(self) -> Column:
        options = []
        for tests in self.alternatives:
            option = F.lit(True)
            for m in tests:
                option = option & m.column_test()
            options.append(option)
        return p.any_of(options)


def _rule(*alternatives: tuple[Match, ...]) -> Rule:
    return Rule(tuple(alternatives))


def _cat(*texts: str) -> Match:
    return Match("category", texts)


def _disp(*texts: str) -> Match:
    return Match("display_name", texts)


# Category and product wordings of the returns export.
FAILED = "Failed Unit"
FAILED_ONLY = Match("category", (FAILED,), exact=True)
LOANER = _cat("Loaner", "Eval")
UNOPENED = _cat("Unopened")
SPEC = _cat("Preemptive", "Return for Upgrade", "Below Spec", "Retrofit")
ODU = _disp("ODU", "OS-1 Sensor")
SINBON = _disp("SINBON")
GEN2 = Match("description", ("GEN2",))

KPIS: dict[str, Rule] = {
    "total_returns": _rule(()),
    "total_failed": _rule((_cat(FAILED),)),
    "failed_odu": _rule((FAILED_ONLY, _disp("ODU")),
                        (FAILED_ONLY, Match("display_name", ("OS-1 Sensor",), exact=True))),
    "failed_sinbon": _rule((FAILED_ONLY, _disp("SINBON", "Sinbon", "OS1-64 No iBox"))),
    "failed_gen2": _rule((_cat(FAILED), GEN2)),
    "loaner_odu": _rule((LOANER, ODU)),
    "loaner_sinbon": _rule((LOANER, SINBON)),
    "loaner_gen2": _rule((LOANER, GEN2)),
    "unused_odu": _rule((UNOPENED, ODU)),
    "unused_sinbon": _rule((UNOPENED, SINBON)),
    "unused_gen2": _rule((UNOPENED, GEN2)),
    "spec_odu": _rule((SPEC, _disp("ODU")), (_cat("Preemptive"), _disp("OS-1 Sensor"))),
    "spec_sinbon": _rule((SPEC, SINBON)),
    "spec_gen2": _rule((SPEC, GEN2)),
    "recalibration": _rule((_cat("Recalibration"),)),
    "wrong_sent": _rule((_cat("wrong sensor"),)),
    "unlabelled": _rule((_cat("None"),)),
    "swap_program": _rule((_cat("Swap"),)),
    "expectation_not_met": _rule((_cat("meet customer req"),)),
    "cancelled": _rule((Match("status", ("Cancelled",)),), (_cat("Cancelled"),)),
}


def one_per_document(returns: DataFrame, order_by: Sequence[str],
                     keep: Sequence[str] | None = None) -> DataFrame:
    """The surviving line of every document; apply before any filter."""
    return first_per_key(returns, [DOCUMENT], order_by, keep)


def kpis(documents: DataFrame, rules: Mapping[str, Rule] = KPIS, start: datetime | None = None) -> DataFrame:
    """One row with the signed quantity total of every rule."""
    late = p.after(F.col("created_at"), start)
    return documents.agg(*[
        F.sum(F.when(rule.test() & late, F.col("quantity"))).alias(name) for name, rule in rules.items()
    ])


def _reason_totals(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy(cleaning.case_reason(F.col("case_text")).alias("reason"))
        .agg(F.sum(cleaning.unit_count(F.col("quantity"))).alias("quantity"))
        .orderBy(F.col("quantity").desc(), "reason")
    )


def failed_reasons(returns: DataFrame, start: datetime | None = None) -> DataFrame:
    """Failed units per reason over all lines."""
    return _reason_totals(returns.where(p.after(F.col("created_at"), start) & F.col("category").contains(FAILED)))


def pending_reasons(returns: DataFrame) -> DataFrame:
    """Pending units per reason over all lines."""
    status = F.col("status")
    return _reason_totals(returns.where(status.contains("Pending Receipt") | status.contains("Pending Approval")))


def _detail(documents: DataFrame) -> DataFrame:
    return documents.select(
        cleaning.report_text(F.col("case_text")).alias("reason"),
        "customer",
        F.abs("quantity").alias("quantity"),
        "internal_id", "created_at", DOCUMENT,
    )


def reason_customer(documents: DataFrame, start: datetime | None = None) -> DataFrame:
    """Who returned what and why, one row per document."""
    return _detail(documents.where(p.after(F.col("created_at"), start))).drop("created_at")


def customer_totals(documents: DataFrame, start: datetime | None = None) -> DataFrame:
    """Units per customer, largest first (signed totals ascending)."""
    return (
        documents.where(p.after(F.col("created_at"), start))
        .groupBy("customer").agg(F.sum("quantity").alias("signed"))
        .orderBy("signed", "customer")
        .select("customer", F.abs("signed").alias("quantity"))
    )


def _newest_first(detail: DataFrame) -> DataFrame:
    return detail.orderBy(F.col("created_at").desc(), DOCUMENT)


def pending_before(documents: DataFrame, end: datetime | None = None) -> DataFrame:
    """Returns still in the field: pending and created before ``end``."""
    status = F.col("status")
    pending = status.contains("Pending Receipt") | status.contains("Pending Approval")
    rows = documents.where(p.before(F.col("created_at"), end) & pending)
    return _newest_first(_detail(rows).drop("internal_id"))


def generation(documents: DataFrame, second: bool, start: datetime | None = None) -> DataFrame:
    """Detail rows of second-generation products, or of all others."""
    is_second = F.col("display_name").like("%GEN2%")
    rows = documents.where(p.after(F.col("created_at"), start) & (is_second if second else ~is_second))
    return _newest_first(_detail(rows).drop("internal_id"))


def pending_by_type(documents: DataFrame) -> DataFrame:
    """Failed units not yet received, as documents per product."""
    status = F.col("status")
    rows = documents.where(
        (status.contains("Pending Receipt") | status.contains("Pending Receive"))
        & (F.col("category") == FAILED)
    )
    return (
        rows.groupBy("display_name").agg(F.count("*").alias("documents"))
        .orderBy(F.col("documents").desc(), "display_name")
    )


def spec_breakdown(documents: DataFrame, start: datetime | None = None) -> DataFrame:
    """Second-generation units per product and category."""
    rows = documents.where(p.after(F.col("created_at"), start) & F.col("display_name").contains("GEN2"))
    return (
        rows.groupBy("display_name", "category").agg(F.sum("quantity").alias("signed"))
        .orderBy(F.col("signed").desc(), "display_name", "category")
        .select("display_name", "category", F.abs("signed").alias("quantity"))
    )
