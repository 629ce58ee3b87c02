"""Running the models layer by layer, and their tests."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions import utc_now
from ..operators.quality import DECLARED_TESTS, dq_report, store_failures
from ..sources.tables import ModelTables
from . import intermediate, marts, staging, warehouse
from .views import VIEWS

VIEW, TABLE = "view", "table"


@dataclass
class ModelRun:
    """One run of the models over given raw tables, as of one day."""

    spark: SparkSession
    sources: dict[str, DataFrame]
    tables: ModelTables
    as_of: dt.date
    strict_mask: bool = False
    #: The catalog's names of the raw tables, if they are stored; then the views are stored, too.
    stored: dict[str, str] = field(default_factory=dict)
    built: dict[str, DataFrame] = field(default_factory=dict)

    def source(self, name: str) -> DataFrame:
        return self.sources[name]

    def ref(self, name: str) -> DataFrame:
        """A model's rows: of this run, else a view's definition or a table's last build."""
        if name not in self.built:
            model = MODELS[name]
            if model.kind == VIEW:
                self.built[name] = model.rows(self)
            else:
                self.built[name] = self.tables.read_table(model.layer, name)
        return self.built[name]

    def build(self, name: str) -> DataFrame:
        model = MODELS[name]
        rows = model.rows(self)
        if model.kind == VIEW:
            self.built[name] = self.tables.materialize_view(rows, name)
            if self.stored:
                self.tables.store_view(model.layer, name, VIEWS[name](self.stored_name, self.as_of))
        else:
            self.built[name] = self.tables.materialize_table(rows, model.layer, name)
        return self.built[name]

    def stored_name(self, name: str) -> str:
        """The catalog's name of a raw table or model."""
        return self.stored[name] if name in self.stored else self.tables.table_name(MODELS[name].layer, name)

    def datasets(self) -> dict[str, DataFrame]:
        """Everything the declared tests look at."""
        names = {t.dataset for t in DECLARED_TESTS}
        return {n: self.source(n) if n in self.sources else self.ref(n) for n in names}


@dataclass(frozen=True)
class Model:
    layer: str
    kind: str
    rows: Callable[[ModelRun], DataFrame]


LAYERS = ["staging", "intermediate", "warehouse", "marts"]

# In dependency order. The customer metrics are kept as a table, so the mart and the
# tests read them without joining again; the warehouse tables have the rows they are made of.
MODELS = {
    "stg_crm_customers": Model("staging", VIEW, lambda run: staging.stg_crm_customers(
        run.source("raw.crm_customers"), run.as_of)),
    "stg_erp_orders": Model("staging", VIEW, lambda run: staging.stg_erp_orders(
        run.source("raw.erp_orders"))),
    "int_customer_cleaned": Model("intermediate", VIEW, lambda run: intermediate.int_customer_cleaned(
        run.ref("stg_crm_customers"))),
    "int_order_cleaned": Model("intermediate", VIEW, lambda run: intermediate.int_order_cleaned(
        run.ref("stg_erp_orders"))),
    "int_customer_metrics": Model("intermediate", TABLE, lambda run: intermediate.int_customer_metrics(
        run.ref("int_customer_cleaned"), run.ref("int_order_cleaned"))),
    "dim_customer": Model("warehouse", TABLE, lambda run: warehouse.dim_customer(
        run.ref("int_customer_cleaned"))),
    "fact_order": Model("warehouse", TABLE, lambda run: warehouse.fact_order(
        run.ref("int_order_cleaned"))),
    "executive_dashboard": Model("marts", TABLE, lambda run: marts.executive_dashboard(
        run.ref("int_customer_metrics"), run.as_of, run.strict_mask)),
}


def models_of(layer: str, select: list[str] | None = None) -> list[str]:
    """The layer's models, or those selected by their own or the layer's name."""
    return [
        name for name, model in MODELS.items()
        if model.layer == layer and (not select or name in select or layer in select)
    ]


def run_layer(run: ModelRun, layer: str, select: list[str] | None = None) -> dict:
    """Build one layer; the status is ``success`` or ``error``."""
    result = {"status": "success", "models": [], "error": None}
    try:
        for name in models_of(layer, select):
            run.build(name)
            result["models"].append(name)
    except Exception as error:  # the outcome of a stage is reported, not raised
        result.update(status="error", error=str(error))
    return result


def run_tests(run: ModelRun) -> dict:
    """All declared tests. Failing rows are kept below ``test_results``."""
    try:
        datasets = run.datasets()
        report = dq_report(datasets).collect()  # one row per declared test

        def keep(rows: DataFrame, test: str) -> None:
            rows.write.mode("overwrite").parquet(f"{run.tables.root}/test_results/{test}")

        failed = store_failures(datasets, report, keep)
    except Exception as error:
        return {"status": "error", "failed": [], "error": str(error)}
    return {"status": "error" if failed else "success", "failed": failed, "error": None}


def run_layers(run: ModelRun, select: list[str] | None = None, with_tests: bool = True) -> dict:
    """All layers in order, stopping after a failed one, then the tests if all passed."""
    started = utc_now()
    stages = {}
    for layer in LAYERS:
        if not models_of(layer, select):
            continue
        stages[layer] = run_layer(run, layer, select)
        if stages[layer]["status"] != "success":
            break
    if with_tests and all(s["status"] == "success" for s in stages.values()):
        stages["tests"] = run_tests(run)
    passed = all(s["status"] == "success" for s in stages.values())
    return {
        "status": "completed" if passed else "completed_with_errors",
        "stages": stages,
        "started_at": started.isoformat(),
        "completed_at": utc_now().isoformat(),
    }
