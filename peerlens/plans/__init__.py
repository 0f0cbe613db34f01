"""Query plans: layer wiring, reports, the named-query registry, the pipeline run."""
