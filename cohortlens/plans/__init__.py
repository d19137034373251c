"""Composite analyses and the registered queries with their SQL oracles."""

from cohortlens.plans import oracle, registry, registry_models, registry_storage
from cohortlens.plans.cohort import CohortAnalysis, from_landed, from_long, from_wide, land_wide

QUERIES = {**registry.QUERIES, **registry_models.QUERIES, **registry_storage.QUERIES}
ORACLE = {**oracle.ORACLE, **registry_models.ORACLE, **registry_storage.ORACLE}

__all__ = ["ORACLE", "QUERIES", "CohortAnalysis", "from_landed", "from_long", "from_wide",
           "land_wide"]
