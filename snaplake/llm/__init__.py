"""Training-data operators: quality, de-duplication, filtering, packing, mixing and storage."""
