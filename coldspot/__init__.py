"""coldspot: dataset popularity and unused-data reports on Spark.

From an access log and catalogue snapshots (dataset contents, dataset
metadata, replicas, storage endpoints) it builds access sessions, counts
accesses per dataset and reports data volume by number of accesses over
look-back periods, the never-used datasets, and unused volume by project,
datatype and creation time. Every report is one DataFrame plan.

Main entry points::

    from coldspot import reports, readers, writers, daily, sqlreports, Catalogue
"""

from coldspot.operators import sqlreports
from coldspot.plans import daily, reports
from coldspot.sources import readers, writers
from coldspot.sources.catalogue import Catalogue

__version__ = "0.1.0"
__all__ = ["Catalogue", "daily", "readers", "reports", "sqlreports", "writers", "__version__"]
