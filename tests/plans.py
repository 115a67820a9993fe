"""Counting what a finished query really did, over its whole final plan."""

from pyspark.sql import DataFrame


def executed(df: DataFrame) -> list:
    """All nodes of the plan that ran, inside stages and subqueries too; a reused exchange stands for itself alone."""
    todo, nodes = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        nodes.append(node)
        if kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif kind != "ReusedExchangeExec":
            children, subqueries = node.children(), node.subqueries()
            todo += [children.apply(i) for i in range(children.size())]
            todo += [subqueries.apply(i) for i in range(subqueries.size())]
    return nodes


def scans(df: DataFrame) -> list:
    return [n for n in executed(df) if n.getClass().getSimpleName() in ("FileSourceScanExec", "BatchScanExec")]


def metric(node, name: str) -> int:
    return node.metrics().apply(name).value()
