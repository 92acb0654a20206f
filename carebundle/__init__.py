"""Clinical table bundles on Spark: convert, check, grant access, audit, read and write."""

from carebundle.bundle import Bundle
from carebundle.plans.convert import convert
from carebundle.schema import SOURCE_TABLES, TARGET_TABLES, target_schemas

__all__ = ["SOURCE_TABLES", "TARGET_TABLES", "Bundle", "convert", "target_schemas"]
