"""leadlens: issue-tracker profiling and resolution-time modelling on Spark.

Layout:
  sources/    readers, writers, the derived ``issues`` table, JSON record helpers
  functions/  scalar Column expressions and driver-side distribution math
  operators/  profiling, binning, cleaning, encoding, tests, models, scoring
  plans/      the registered queries and their DuckDB oracle SQL
  streaming/  the fitted scoring pipeline applied to a stream of new issues
"""

__all__ = ["session", "sources", "functions", "operators", "plans", "streaming"]
