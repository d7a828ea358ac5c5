"""Composite plans.

* ``venue_queries`` - the ten venue questions and their chart aggregates, plus the shared
  review / visit cubes
* ``curate``        - the chained curation of raw entity files into layers
* ``load``          - the five loads of the curated layers
* ``views``         - the five named views from curated files, bucketed cubes or remote stores;
  ``answer_all``
* ``segmentation``  - venue segmentation
* ``bindings*``     - every operator bound to the driver's test tables, with DuckDB oracle SQL
"""
