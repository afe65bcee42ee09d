"""tidewater: incremental dimension loading on Spark.

Full and high-water-mark extraction, staging, enrichment into a customer dimension,
type-2 merge (literal and corrected), deletes, CSV ingest with a data-quality gate
(batch and file-arrival streaming), and small JSON / calendar transforms.
"""

__version__ = "0.1.0"
