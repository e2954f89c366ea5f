"""Thresholds and constants of the credit-risk workflow.

FIXED VALUES — these must equal the published workflow's settings for
results to agree; they are stated here plainly, in natural order.
"""

# Feature clipping ranges
UTILIZATION_CLIP = (0.0, 2.0)
PAYMENT_RATIO_CLIP = (0.0, 5.0)

# WoE / IV / scorecard
WOE_MAX_BINS = 10
WOE_PCT_FLOOR = 1e-9
IV_THRESHOLD_DROP = 0.02
IV_THRESHOLD_SUSPICIOUS = 0.5
IV_STRENGTH_BANDS = (  # (upper bound exclusive, label)
    (0.02, "Useless"),
    (0.1, "Weak"),
    (0.3, "Medium"),
    (0.5, "Strong"),
)
IV_STRENGTH_TOP = "Suspicious"
REGULARIZATION_C = 0.1

# Scorecard points scale: base 600 at odds 1:1, 20 points to double odds
SCORE_BASE = 600.0
SCORE_PDO = 20.0
SCORE_MIN = 300.0
SCORE_MAX = 850.0
PD_EPS = 1e-6

# Splits
TEST_SIZE = 0.20
OOT_FRACTION = 0.20
EARLY_STOP_FRACTION = 0.15
CV_FOLDS = 5
SEED = 42

# Feature selection
NEAR_ZERO_VARIANCE = 1e-6
CORR_THRESHOLD = 0.85
VIF_THRESHOLD = 10.0

# Risk tiers: name -> [low, high)
RISK_TIER_THRESHOLDS = (
    ("Low Risk", 0.00, 0.10),
    ("Medium Risk", 0.10, 0.25),
    ("High Risk", 0.25, 0.50),
    ("Very High Risk", 0.50, 1.00),
)
UNKNOWN_TIER = "Unknown"

# Segment names by ascending mean PD
SEGMENT_LABELS = ("Transactors", "Revolvers", "Stressed Revolvers", "Delinquency-Prone")
N_CLUSTERS = 4

# Business action matrix
ACTIONS = (
    ("Low Risk", "Stable/Improving", "Limit Increase / Upsell"),
    ("Low Risk", "Deteriorating", "Monitor / Early Warning"),
    ("High Risk", "Stable/Improving", "Hold / Maintain Limit"),
    ("High Risk", "Deteriorating", "Limit Decrease / Collections"),
)
DEFAULT_ACTION = "Review"
TREND_DETERIORATING = -0.1

# Governance
PSI_STABLE = 0.10
PSI_MODERATE = 0.25
PSI_PCT_FLOOR = 1e-6
PSI_STATUS = ("STABLE", "MODERATE - Monitor", "SIGNIFICANT - Review Model")
GINI_DEGRADATION_ALERT = 0.05
MIN_ACCEPTABLE_GINI = 0.40
GINI_MIN_PERIOD_ROWS = 50
BIAS_MIN_GROUP = 100
BIAS_AUC_DELTA_FLAG = 0.05
BIAS_SHARE_BANDS = (0.03, 0.05)
N_PERIODS = 5

# Boosted-tree preset (Spark GBT counterpart of the published learner settings)
GBT_TREES = 500  # upper bound; early stopping on a validation slice ends it sooner
GBT_MAX_DEPTH = 5
GBT_STEP_SIZE = 0.05
GBT_SUBSAMPLE = 0.8
GBT_FEATURE_SUBSET = "0.8"
GBT_MIN_LEAF = 50
