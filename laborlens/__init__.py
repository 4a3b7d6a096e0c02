"""Labour-market signal analytics on Spark.

Job postings, hiring/layoff news, payroll counts and a company register go
through declared-schema bronze reads, native (UDF-free) normalisation and
dedupe, and aggregate to company, city and sector tables with a rolling trend.
Every operator is a ``DataFrame -> DataFrame`` or ``Column -> Column`` function.
"""

__version__ = "0.1.0"
