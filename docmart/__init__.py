"""docmart: catalogue tables -> validated nested search documents, on Spark.

Everything is DataFrame composition: incremental change detection, fan-out of
changed dimension keys to film keys, M:N denormalisation with per-branch
pre-aggregation, versioned idempotent upserts, catalogue queries, data-quality
reports and text postings.
"""

__all__ = ["session", "schemas"]
