"""portstar: a Spark-native star-schema warehouse for arrival records and city demographics.

Stages raw arrival records and city demographics, derives person, carrier, calendar and
population dimensions, joins trips to per-state demographic averages into a partitioned fact
table, answers BI questions on it, and checks the result (missing-value profile, key and
referential reports, schema contract). Everything is DataFrame / SQL work planned by Catalyst.
"""

from portstar.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
