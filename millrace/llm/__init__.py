"""Training-data operators: sharding, scans, token output, packing, quality, mixing and near-dedup.

Nothing outside this subpackage imports it.
"""
