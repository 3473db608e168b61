"""A pipeline in layers: each layer is written once and checked before the next is built."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkbook.operators import rules as R
from sparkbook.operators.quality import Check, run_checks
from sparkbook.operators.sets import union_all
from sparkbook.session import discard, materialise

Tables = dict[str, DataFrame]


class LayerFailed(RuntimeError):
    """A fatal check of a layer found violations; later layers were not built."""

    def __init__(self, layer: str, report: DataFrame):
        super().__init__(f"layer {layer} failed its checks")
        self.layer, self.report = layer, report


@dataclass(frozen=True)
class Layer:
    """``build`` adds tables to those of the layers before it.

    On what it wrote, ``rules`` (by table, see ``rules.report``) and ``checks``
    (frames of violations) are run. ``reads`` names the earlier tables that the
    layer and its checks use; None stands for all of them.
    """

    name: str
    build: Callable[[Tables], Tables]
    checks: Callable[[Tables], Sequence[Check]] = field(default=lambda tables: [])
    rules: Mapping[str, Sequence[R.Rule]] = field(default_factory=dict)
    reads: Collection[str] | None = None


def _report(layer: Layer, tables: Tables) -> DataFrame | None:
    parts = []
    if layer.rules:
        found = R.report(tables, layer.rules)
        parts.append(found.select(F.col("table"), F.col("rule").alias("check"), "severity", "violations", "status", "sample"))
    checks = list(layer.checks(dict(tables)))
    if checks:
        parts.append(run_checks(checks).withColumn("table", F.lit("")).select("table", "check", "severity", "violations", "status", "sample"))
    return union_all(*parts).withColumn("layer", F.lit(layer.name)) if parts else None


def run_pipeline(layers: Sequence[Layer], sources: Tables, keep: Collection[str] | None = None) -> tuple[Tables, DataFrame | None]:
    """All tables by name and the report of all checks (table, check, severity, violations, status, sample, layer).

    A layer's tables are written under the shared folder before its checks run,
    so checks and later layers read them instead of the plan that made them; the
    report of a layer is one job and is written too. A failing check stops the
    run with the report so far. With ``keep``, a written table that is not in it
    is deleted, and leaves the result, once no later layer reads it.
    """
    tables, reports, written = dict(sources), [], set()
    for i, layer in enumerate(layers):
        made = {name: materialise(df, f"{layer.name}-{name}") for name, df in layer.build(dict(tables)).items()}
        tables |= made
        written |= made.keys()
        found = _report(layer, tables)
        if found is not None:
            reports.append(materialise(found, f"{layer.name}-report"))
            if not reports[-1].filter("status = 'fail'").isEmpty():
                raise LayerFailed(layer.name, union_all(*reports))
        if keep is not None:
            later = layers[i + 1:]
            needed = set(tables) if any(x.reads is None for x in later) else set().union(*[x.reads for x in later])
            for name in written - needed - set(keep):
                discard(tables.pop(name))
                written.discard(name)
    return tables, union_all(*reports) if reports else None
