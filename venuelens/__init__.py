"""venuelens: venue, review and visit analytics as Spark DataFrame plans.

Subpackages:

* ``sources``   - declared schemas and readers (JSON lines, JDBC, document store, source switch)
* ``functions`` - column expressions (day part, year predicate, list split, key-hash sampling)
* ``operators`` - DataFrame -> DataFrame building blocks (curation, loads, ranking, reshaping,
  segmentation, reports)
* ``plans``     - the composite venue questions and their shared review / visit cubes, the chained
  curation, the loads, the named views with ``answer_all``, and the test-table bindings
* ``streaming`` - incremental curation of newly arriving JSON-lines files and a visit cube kept
  current in streaming state

No function here creates a session, fixes a path or collects an unbounded result.
"""

__version__ = "0.1.0"
