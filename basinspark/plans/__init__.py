"""End-to-end flows: ingest, forecast, verification and training."""
