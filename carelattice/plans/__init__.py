"""The clinical models: staging, enrichment, marts, checks and the whole refresh."""
