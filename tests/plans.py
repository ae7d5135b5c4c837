"""Physical plans as text."""


def physical_plan(table):
    return table._jdf.queryExecution().executedPlan().toString()
