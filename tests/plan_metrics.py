"""What a plan did when it ran, read from its own nodes."""


def nodes(plan):
    """All nodes of an executed plan, query stages opened."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from nodes(plan.executedPlan())
        return
    if kind.endswith("QueryStageExec"):
        yield from nodes(plan.plan())
        return
    yield kind, plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def ran(df):
    """Run ``df`` and return its executed plan."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    return plan


def total(plan, kind, metric):
    found = [p.metrics().apply(metric).value() for k, p in nodes(plan) if k == kind]
    return sum(found)


def shuffled_rows(df):
    return total(ran(df), "ShuffleExchangeExec", "shuffleRecordsWritten")
