"""Small looks at executed plans and stored files, shared by the tests."""

from pathlib import Path


def _children(plan):
    for group in (plan.children(), plan.subqueries()):
        for i in range(group.size()):
            yield group.apply(i)


def executed_nodes(df):
    """Run ``df`` and return (node name, metrics) of every operator of the final plan."""
    df.collect()
    found = []

    def visit(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return visit(plan.plan())
        found.append((name, plan.metrics()))
        for child in _children(plan):
            visit(child)

    visit(df._jdf.queryExecution().executedPlan())
    return found


def scanned_rows(df):
    """Rows each file scan of ``df`` handed on, after row groups were skipped."""
    return [
        metrics.apply("numOutputRows").value()
        for name, metrics in executed_nodes(df)
        if name in ("FileSourceScanExec", "BatchScanExec")
    ]


def plan_text(df):
    return df._jdf.queryExecution().toString()


def data_files(path, suffix=".parquet"):
    return sorted(p for p in Path(path).rglob(f"*{suffix}") if not p.name.startswith("."))
