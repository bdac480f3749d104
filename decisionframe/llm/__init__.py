"""Training-data operators: dedup, packing, filters, classifiers, decontamination."""
