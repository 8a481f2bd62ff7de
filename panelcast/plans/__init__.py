"""Query plans over the driver tables: panels, registered queries, pipeline."""
