"""rebuy: repeat-purchase analytics on PySpark.

From order, order-line and product tables it samples train / holdout /
cross-validation splits, builds one row per (user, previously bought
product) with user, product, user-product and current-order features,
fits supervised category bins, trains Spark ML classifiers and computes
thresholded metrics, ROC / precision-recall tables, feature importance and
category frequency reports.  Every step is a lazy DataFrame plan.
"""

__version__ = "0.1.0"
