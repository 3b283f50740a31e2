"""Model graph, query registry and the layered batch job."""
