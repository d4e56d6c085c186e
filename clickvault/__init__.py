"""clickvault — Spark-native click-stream analytics.

Raw shop events (bronze) go through an audited cleaning step into a typed
Silver table; Gold tables (engagement, funnel, abandonment, category
performance, KPI summary) are plain DataFrame -> DataFrame functions built
from built-in Spark expressions only.
"""

from clickvault.session import ensure_session, get_spark, staging_dir

__all__ = ["ensure_session", "get_spark", "staging_dir"]
