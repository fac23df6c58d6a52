"""Clinical record analytics expressed as PySpark DataFrame jobs.

The package flattens FHIR bundles into seven flat tables, lands and cleans
them, merges increments by key, joins them into enriched models and answers
four questions about readmissions, prevalence, length of stay and medication.
"""

__version__ = "0.1.0"
