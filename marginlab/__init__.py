"""marginlab: campaign-setting history and margin analytics as Spark plans.

Sub-packages
    functions   column expressions (time, JSON, arrays, buckets, money)
    sources     table catalogue, partition scans, the partitioned sink
    operators   reusable DataFrame-to-DataFrame operators
    plans       the reports and datasets composed from the operators
    streaming   the repeatable hourly run
"""

from marginlab.settings import Period, Settings
from marginlab.sources.warehouse import Warehouse

__all__ = ["Period", "Settings", "Warehouse"]
