"""The domain's tables derived from a star schema, to check the reports against SQL."""

from crosstally.testbed.star import star_catalog

__all__ = ["star_catalog"]
