"""Rows that every text operator has to take."""

LONG = "lorem ipsum dolor sit amet, consectetur adipiscing " * 6_000  # 300,000 characters
EDGE = [(None, None), (0, ""), (1, None), (2, "a"), (2, "a"), (3, LONG), (4, " \n\t "), (5, "Über  die Straße…"), (6, "one two")]


def frame(spark, rows, columns="doc_id long, text string"):
    """Rows with further columns whose names the operators use themselves."""
    df = spark.createDataFrame(rows, columns)
    for name in ("ids", "decoded", "n_tokens", "score", "sketch", "fingerprint", "component_id", "key", "range", "guest"):
        df = df.selectExpr("*", f"'mine' as {name}")
    return df


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
