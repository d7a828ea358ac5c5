"""DataFrame -> DataFrame building blocks.

* ``curation`` - column trimming, year windows, packed-stamp filter, key-hash samples,
  referential semi filter, packing / expanding visits
* ``loads``    - conform to a target, replace, replace-unique, insert-if-absent, reconcile
* ``ranking``  - top-k per group, histogram percent rank, top groups
* ``reshape``  - pivot matrix, bubble scale, group means
* ``joins``    - left join with defaults
* ``segments`` - standardisation and multi-start MLlib k-means
* ``reports``  - layer report, size delta, step summary
"""
