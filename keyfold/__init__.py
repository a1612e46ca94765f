"""keyfold: keyed-table ingestion, change application, data quality, audit and
fiscal-code derivation, written as Spark DataFrame plans."""

from keyfold.session import get_spark, scratch_path, shared_dir
from keyfold.spec import EntitySpec

__all__ = ["get_spark", "scratch_path", "shared_dir", "EntitySpec"]
