"""tunestats: a Spark-native listening-data pipeline.

Landed JSON pages → raw tables (``sources``) → star schema (``plans.model``)
→ wide play table and aggregates (``plans.marts``) → report queries
(``plans.reports``, ``plans.report_sql``); ``plans.pipeline`` runs the
layers, ``sinks`` publishes tables, ``streaming`` ingests new pages
incrementally.
"""

__version__ = "0.1.0"
