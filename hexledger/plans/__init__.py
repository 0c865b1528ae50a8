"""End-to-end jobs: ingest, the published reports, regression and classification runs."""
