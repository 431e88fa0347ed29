"""Training-data operators: filters, de-duplication, scoring and packing of text corpora."""
