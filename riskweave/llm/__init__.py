"""Training-data operators: packing, scans, filters, near duplicates, sharding, classifiers."""
