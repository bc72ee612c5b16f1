"""Training-data operators: de-duplication, filtering, mixing and token output."""
