"""Names that several test modules share."""

SF_DIR = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
