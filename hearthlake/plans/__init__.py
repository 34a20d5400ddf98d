"""The gold layer: dimensions, facts, measures, reports, ML, and the jobs that build them."""
