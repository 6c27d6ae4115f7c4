"""civicledger: a Spark-native warehouse for public officials' trade disclosures.

Layers (all plain DataFrame functions, optimised by Catalyst):

* ``functions``  column expressions (decoders, dollar-range parsing, hashes)
* ``operators``  keyed operators: latest-per-key, merges, SCD2, data-quality checks
* ``sources``    JSON landing files, seeds, versioned Parquet tables
* ``streaming``  exactly-once incremental file loading (Structured Streaming)
* ``plans``      the warehouse models and the daily / backfill runs
"""

__version__ = "0.1.0"
