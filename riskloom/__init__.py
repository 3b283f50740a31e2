"""riskloom: credit-portfolio risk analytics as Spark DataFrame jobs.

Layers: ``sources`` (schemas, landed-file readers, test-table derivations),
``functions`` (business rules as Column expressions), ``operators``
(staging, intermediate, marts, serving roll-ups, quality checks, reshapes),
``plans`` (lazy model graph, query registry, the batch pipeline).
"""
