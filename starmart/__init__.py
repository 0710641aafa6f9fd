"""starmart: star-schema ELT on Spark.

Ingest CSV extracts into typed Parquet, profile and check them, stage and
enrich a star schema, publish marts and metric tables, gate publication on
declared checks and serve filtered, sorted and paged reads.  Everything is
DataFrame / Column code so Catalyst and whole-stage codegen do the work.
"""

from starmart.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]
