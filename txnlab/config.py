"""Fixed values the results depend on.

These equal the values of the job this library re-expresses; changing one
changes every downstream number, so they live together in one place.
"""

# --- fixed values: column names and the transaction contract --------------
LABEL = "isFraud"
RULE_FLAG = "isFlaggedFraud"
KEY = "txn_key"
TYPE = "type"

TRANSACTION_COLUMNS = (
    "step",
    "type",
    "amount",
    "nameOrig",
    "oldbalanceOrg",
    "newbalanceOrig",
    "nameDest",
    "oldbalanceDest",
    "newbalanceDest",
    "isFraud",
    "isFlaggedFraud",
)
ALL_TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")

# --- fixed values: selection and encoding -----------------------------------
KEPT_TYPES = ("TRANSFER", "CASH_OUT")
TYPE_CODES = {"TRANSFER": 1, "CASH_OUT": 0}
UNSEEN_TYPE_CODE = -1

# --- fixed values: features -------------------------------------------------
NUMERIC_COLUMNS = ("amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest")
SKEWED_COLUMNS = NUMERIC_COLUMNS
LOG1P_SUFFIX = "_log1p"
FEATURES = (
    "step",
    "amount_log1p",
    "oldbalanceOrg_log1p",
    "newbalanceOrig_log1p",
    "oldbalanceDest_log1p",
    "newbalanceDest_log1p",
    "type_encoded",
)
ID_COLUMNS = ("nameOrig", "nameDest")

# --- fixed values: checks ---------------------------------------------------
BALANCE_EPS = 1e-6
SUMMARY_PROBS = (0.5, 0.9, 0.99)
HIST_BINS = 60
CLIP_QUANTILE = 0.99
RULE_LIMIT = 200_000.0
PARITY_REL_TOL = 0.01

# --- fixed values: splits and sampling --------------------------------------
SEED = 42
SPLIT_NAMES = ("train", "validation", "test")
SPLIT_WEIGHTS = (0.7, 0.15, 0.15)
SAMPLE_FRACTIONS = {0: 0.1, 1: 1.0}
DOWNSAMPLE_RATIOS = (1, 5, 10)

# --- fixed values: model ----------------------------------------------------
REG_PARAM = 0.1
MAX_ITER = 100
ELASTIC_NET = 0.0

# --- fixed values: decision -------------------------------------------------
COST_FP = 1.0
COST_FN = 25.0
GRID_STEPS = 100  # thresholds 0.01, 0.02, ..., 0.99
ROBUSTNESS_WIDTH = 0.02
ROBUSTNESS_TOL = 0.05

# parity tolerances between two metric sets (absolute)
PARITY_TOLERANCES = {"roc_auc": 0.005, "pr_auc": 0.01, "recall": 0.02, "f1": 0.02}
# targets: metric -> minimum
TARGETS = {"roc_auc": 0.95, "recall": 0.85, "precision": 0.70}

# --- fixed values: the reference scorer used by evaluation oracles ----------
# score = round(least(1, 0.6 * amount / 105000 + 0.4 * [newbalanceOrig = 0]), 6)
FIXED_SCORER = {"amount_weight": 0.6, "amount_scale": 105000.0, "cleared_bonus": 0.4}
