"""Medallion analytics for trending-content snapshots on Spark."""

from .operators.aggregates import category_analytics, channel_analytics, trending_analytics
from .operators.landing import ingestion_coverage, land_payloads
from .operators.lookup import category_lookup, with_category_names
from .operators.quality import quality_failures, quality_report, quality_verdict, require_quality
from .operators.reference import clean_reference
from .operators.sinks import write_partitioned
from .operators.statistics import clean_statistics
from .plans.pipeline import PipelineConfig, run_pipeline
from .plans.reports import category_momentum, channel_partners, publish_timing, region_targeting
from .session import build_session
from .sources.files import classify_files, list_files

__all__ = [
    "PipelineConfig", "build_session", "category_analytics", "category_lookup",
    "category_momentum", "channel_analytics", "channel_partners", "classify_files",
    "clean_reference", "clean_statistics", "ingestion_coverage", "land_payloads",
    "list_files", "publish_timing", "quality_failures", "quality_report",
    "quality_verdict", "region_targeting", "require_quality", "run_pipeline",
    "trending_analytics", "with_category_names", "write_partitioned",
]
