"""salesnet: distribution-sales analytics as Spark DataFrame plans.

Data model: a zone -> distributor -> retailer -> order -> line -> product star
schema with optional promotions on lines.  ``sources`` builds the seven star
tables (typed Parquet, or a mapping of TPC-H style tables), ``operators`` holds
reusable DataFrame -> DataFrame building blocks, ``plans`` composes them into
the analytic jobs and the table work, ``functions`` holds Column helpers and
``streaming`` the incremental line ingest.
"""

from salesnet.params import Period, DEFAULT_PERIOD, DEFAULT_H2
from salesnet.session import get_session, ensure_checkpoint_dir

__all__ = ["Period", "DEFAULT_PERIOD", "DEFAULT_H2", "get_session", "ensure_checkpoint_dir"]
