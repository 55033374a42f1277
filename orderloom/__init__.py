"""Order-line analytics on PySpark: contract, star schema, checks, KPIs and reports."""
