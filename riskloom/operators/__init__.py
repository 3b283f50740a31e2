"""DataFrame -> DataFrame operators for every layer of the pipeline."""
