"""Job-posting analytics on Spark DataFrames.

Layers, from the bottom up:

* ``functions``  - column rules (``Column -> Column``), no data access
* ``operators``  - DataFrame transformations (``DataFrame -> DataFrame``)
* ``sources``    - readers, writers, published snapshots
* ``plans``      - the load steps that string operators and sources together
* ``streaming``  - the raw-zone-to-staging step as a file stream
* ``registry``   - named queries over the test tables and their SQL oracles
"""
