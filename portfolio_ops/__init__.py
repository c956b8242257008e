"""Insurance data processing on Spark: operators, jobs and publishing.

Layout
------
functions/   Column expressions (no Python UDFs anywhere in the package)
operators/   DataFrame -> DataFrame building blocks
sources/     table registry, landing projections, snapshot publishing
plans/       whole jobs made of the operators
streaming/   continuous form of the rating-fact load
analogues/   the operators applied to the driver tables, with oracle SQL
"""

from portfolio_ops.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
