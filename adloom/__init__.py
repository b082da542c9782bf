"""adloom: classified-ad and text analytics as Spark DataFrame operators.

One operator is one function that takes and returns DataFrames:

* ``sources`` / ``sinks``  - landing files, bronze partitions, relational tables
* ``functions``            - column expressions (text cleaning, URLs, time, codes)
* ``operators``            - flattening, dedupe, joins, ids, n-grams, dims, search
* ``streaming``            - incremental runs over landing folders
* ``plans``                - the bronze, gold and snapshot flows built from the above
"""

from adloom.session import build_session, configure

__all__ = ["build_session", "configure"]
