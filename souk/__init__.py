"""souk — retail analytics on Spark.

Layers (all lazy DataFrames, planned by Catalyst):

* ``souk.sources``   — table catalog, CSV/Parquet readers and writers, fixture views
* ``souk.functions`` — reusable column expressions (dates, money, null-safe maths, names)
* ``souk.operators`` — cleaning steps, exact distributed rank/median, profiling operators
* ``souk.plans``     — cleaning pipelines, feature marts, KPIs, SQL-pack reports,
                       BI measures, dashboard data sets and EDA summaries
"""

__version__ = "0.1.0"
