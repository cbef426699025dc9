"""Parameters of the registered queries, shared with their SQL oracles."""

# (min_support, min_confidence, max_len) per registered basket run.  The
# source's defaults (0.01 / 0.2) are registered too; on the test tables
# they give no rule, so lower confidences exercise the rule operators.
BASKET_PARAMS = {
    "pairs": (0.01, 0.05, 2),
    "all": (0.01, 0.05, None),
    "low": (0.001, 0.05, None),
    "default": (0.01, 0.2, None),
    # the part key as item code: thousands of items, thinly spread
    "wide": (0.00015, 0.05, 3),
    "len3": (0.001, 0.05, 3),
    "wide4": (0.00015, 0.05, 4),
}

# The fit that SQL can state: one tree of one split on two features of few
# distinct values is the cut of least squared error, and every cut can be tried.
# The full search (20 draws x 3 folds of up to 300 trees of depth 10) is the
# library's default and takes too long for a check.
STUMP = {"n_estimators": 1, "max_depth": 1, "learning_rate": 0.1, "min_samples_leaf": 5,
         "min_samples_split": 2, "subsample": 1.0}
STUMP_FEATURES = ["orders_band", "recency_band"]
# Draws of a search over such trees that differ in the rows a leaf needs.
STUMP_SPACE = {"n_estimators": [1], "max_depth": [1], "learning_rate": [0.1],
               "min_samples_leaf": [1, 60, 300, 450], "min_samples_split": [2], "subsample": [1.0]}
STUMP_FOLDS = 3

# One point of the search space on all features: the fits of c4 and c11, of which SQL states what
# holds for any such model; the tree of one split beside them is compared value by value.
FIT_POINT = {"n_estimators": 100, "max_depth": 3, "learning_rate": 0.1, "min_samples_leaf": 2,
             "min_samples_split": 5, "subsample": 0.8}
