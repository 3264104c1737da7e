"""The jobs: raw, core and mart tables, readiness and catch-up."""
