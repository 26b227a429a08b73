"""Plans as text. A module of its own, as there is more than one conftest."""

def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
