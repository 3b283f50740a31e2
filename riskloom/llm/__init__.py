"""Training-data operators (text scoring, de-duplication, mixing, packing) and their queries."""
