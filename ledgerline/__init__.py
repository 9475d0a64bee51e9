"""ledgerline: Spark-native order analytics.

Extract relational tables to Parquet, stage them with explicit types, join
them into an enriched order fact, build revenue / category / customer /
product reports, derive analytics datasets, gate every layer with data-quality
checks and publish versioned tables.  Everything is expressed with the
DataFrame API so Catalyst and AQE plan the work.

Sub-packages
------------
``sources``    raw inputs: Parquet, CSV, JDBC, and the test-data adapter
``functions``  column expressions with the exact rounding contract
``operators``  staging, mart, reports, analytics, quality checks
``sinks``      Parquet/CSV writes and the versioned (snapshot) table store
``plans``      the composed jobs (extract, build, test, publish, analyse)
"""

from ledgerline.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
