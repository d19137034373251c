"""cohortlens — case/control cohort analytics on Spark DataFrames.

Reads delimited wide matrices, annotations and background text (or long
tables), scores many-to-many feature clusters per sample, computes cohort
statistics and Welch t, ranks the top-k clusters, assembles rank-ordered
feature vectors and cross-validates tree classifiers; plus thresholded
token and character counts.
"""

from cohortlens.plans.cohort import CohortAnalysis, from_landed, from_long, from_wide, land_wide

__all__ = ["CohortAnalysis", "from_landed", "from_long", "from_wide", "land_wide"]
