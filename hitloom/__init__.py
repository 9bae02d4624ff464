"""Web- and app-analytics marts as PySpark DataFrame transforms.

``functions``  column expressions: parameter lookup, traffic channels, flags, text.
``operators``  DataFrame transforms: visit keys, hit numbering, metrics, first touch, items.
``plans``      the marts a user calls: hits, visits, products, promotions, quality summary.
``sources``    day scans, gzip-CSV export and tolerant load, partitioned mart writes.
"""
