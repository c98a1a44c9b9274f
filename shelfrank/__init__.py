"""shelfrank: learning-to-rank analytics over e-commerce click logs, on Spark.

Every step is a function from DataFrame to DataFrame. The sub-packages are

* ``functions``  Column builders (no shuffles, JVM side)
* ``sources``    readers, writers and the adapter from the test tables
* ``operators``  click lists, catalog, click models, features, ranking, training
* ``plans``      the named queries and the end-to-end workflow
"""

from shelfrank.session import build_session, cut_lineage

__all__ = ["build_session", "cut_lineage"]
