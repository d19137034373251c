"""DataFrame operators of the cohort engine.

``reshape``   explode / posexplode / unpivot / position map
``stats``     cohort sizes, cluster scores, cohort statistics, Welch t
``rank``      top-k, rank numbers, lookup
``features``  per-sample top-k feature vectors with background
``model``     folds, decision trees / random forests, confusion matrices
``textcount`` thresholded token and character counts, fixed-width groups
"""
