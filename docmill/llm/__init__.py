"""Training-data operators: scoring, filtering, de-duplication, decontamination, packing and token output."""
