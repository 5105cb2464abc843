"""Training-data operators: sharding, licence scans, near-duplicates,
repeated passages, quality rules, decontamination, packing, token files.

Nothing else in the library imports this subpackage; ``__spark_entry__``
registers its queries only where it can be imported.
"""
