"""Column lists, default parameters and texts shared by the operators.

Everything here is a fixed value: results only agree with the published ones
when these names, orders, thresholds and texts are exactly as written.
"""

from __future__ import annotations

# --- defaults of the job parameters ---------------------------------------
VALID_ORDER_STATUSES = ["delivered", "shipped", "invoiced"]
SNAPSHOT_DATE = "2018-10-17"
K_MIN = 3
K_MAX = 8
DEFAULT_CLUSTERS = 3
KMEANS_STARTS = 10
CONTAMINATION = 0.05
SEED = 42
DP_EPSILON = 2.0
DP_DELTA = 1e-5
DP_EPSILON_GRID = [0.5, 1.0, 2.0, 5.0, float("inf")]
BOOSTING_ROUNDS = 200
BOOSTING_STEP = 0.05
ANOMALY_THRESHOLD = 0.7
SUSPICIOUS_SHARE = 0.7
CHURN_RISK_THRESHOLD = 0.6
ANOMALY_ALERT_THRESHOLD = 0.8
CHURN_ALERT_THRESHOLD = 0.7
CHURN_DAYS = 180
TRAIN_SHARE = 0.8
DRIFT_THRESHOLD = 0.2
KS_THRESHOLD = 0.1
KS_SIGNIFICANCE = 0.05
CHURN_RATE_RANGE = (0.10, 0.60)
ANOMALY_RATE_RANGE = (0.01, 0.20)
PRECISION_AT_SHARE = 0.10

# --- column lists ----------------------------------------------------------
TRANSACTION_COLUMNS = [
    "order_id",
    "customer_id",
    "product_id",
    "seller_id",
    "price",
    "freight_value",
    "payment_value",
    "payment_installments",
    "order_status",
    "order_purchase_timestamp",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]

FEATURE_MATRIX_COLUMNS = [
    "customer_hash",
    "snapshot_date",
    "recency_days",
    "frequency",
    "monetary_total",
    "monetary_avg",
    "avg_review_score",
    "review_count",
    "payment_installments_avg",
    "unique_product_categories",
    "avg_delivery_days",
    "late_delivery_rate",
    "anomaly_score",
    "segment_label",
]

# Values a customer gets when a feature table has no row for them.
FEATURE_FILLS = {
    "avg_review_score": 3.0,
    "review_count": 0,
    "avg_delivery_days": 0.0,
    "late_delivery_rate": 0.0,
    "payment_installments_avg": 1.0,
    "unique_product_categories": 0,
}

ANOMALY_FEATURES = [
    "recency_days",
    "frequency",
    "monetary_total",
    "monetary_avg",
    "avg_review_score",
    "review_count",
    "payment_installments_avg",
    "avg_delivery_days",
    "late_delivery_rate",
]

SEGMENT_FEATURES = [
    "recency_days",
    "frequency",
    "monetary_total",
    "monetary_avg",
    "avg_review_score",
    "payment_installments_avg",
    "late_delivery_rate",
]

CHURN_FEATURES = [
    "recency_days",
    "frequency",
    "monetary_total",
    "monetary_avg",
    "avg_review_score",
    "review_count",
    "payment_installments_avg",
    "avg_delivery_days",
    "late_delivery_rate",
    "anomaly_score",
    "segment_encoded",
]

# --- labels ----------------------------------------------------------------
ANOMALY_FLAGS = ["normal", "suspicious", "anomalous"]

# The order decides ties in the segment rules and is the model encoding 0..5
# (the rules and the encoding happen to agree on it).
SEGMENT_LABELS = ["champions", "loyal", "at_risk", "new_customers", "hibernating", "lost"]
DEFAULT_SEGMENT = "hibernating"
DEFAULT_ANOMALY_SCORE = 0.5
CHURN_LABEL_SOURCE = "rule_based_recency"

# --- texts shown to business users -----------------------------------------
SEGMENT_DESCRIPTIONS = {
    "champions": (
        "Champions are your best customers. They buy frequently, spend the most, "
        "and purchased recently. Reward them with loyalty programs and early access."
    ),
    "loyal": (
        "Loyal customers buy regularly and have a good spending history. "
        "They respond well to upselling and membership offers."
    ),
    "at_risk": (
        "At-risk customers used to buy regularly but haven't purchased recently. "
        "They need re-engagement campaigns with personalized offers."
    ),
    "new_customers": (
        "New customers made their first purchase recently. "
        "Focus on onboarding, building trust, and encouraging a second purchase."
    ),
    "hibernating": (
        "Hibernating customers haven't purchased in a long time and buy infrequently. "
        "A win-back campaign with a strong discount may reactivate them."
    ),
    "lost": (
        "Lost customers show no recent activity and very low purchase history. "
        "Reactivation is costly — focus resources on higher-value segments."
    ),
}

MARKETING_SUGGESTIONS = {
    "champions": "Send a VIP early-access email for new products. Offer a referral bonus.",
    "loyal": "Introduce a points-based loyalty program. Offer bundle discounts.",
    "at_risk": "Send a 'We miss you' email with a 15% discount code. Limited time.",
    "new_customers": "Send a welcome series: onboarding tips + first repeat-purchase discount.",
    "hibernating": "Win-back campaign: bold subject line + 25% discount. One email only.",
    "lost": "Low priority. Include in quarterly bulk reactivation if budget allows.",
}

HIGH_RATE = 0.15
MODERATE_RATE = 0.05
RATE_TEXT_HIGH = (
    "High anomaly rate detected. This may indicate a data quality issue, "
    "a seasonal event, or unusual market activity. Review flagged customers."
)
RATE_TEXT_MODERATE = (
    "Moderate anomaly rate. Some customers show unusual behavior patterns. "
    "Review the top anomalous customers for potential action."
)
RATE_TEXT_LOW = (
    "Low anomaly rate. Customer behavior appears normal. "
    "Monitor flagged customers for any emerging patterns."
)
NOT_FOUND_TEXT = "No scores found for this customer hash."
NO_PROFILE_TEXT = "Detailed profile not available. Run training pipeline."
NO_SCORES_TEXT = "No anomaly scores found. Run the training pipeline first."

HIGH_RISK = 0.6
MEDIUM_RISK = 0.4
ADVICE_HIGH_RISK = "Immediate attention recommended. Consider a personalized retention offer."
ADVICE_UNUSUAL = "Unusual behavior detected. Review recent transactions for fraud or errors."
ADVICE_DISENGAGED = (
    "Customer shows signs of disengagement. A re-engagement campaign may help."
)
ADVICE_NONE = "No immediate action required. Continue monitoring."

ALERT_TEXT_ANOMALY = (
    "Customer %s... was flagged as anomalous with a score of %s (threshold: %s). "
    "This means their behavior is significantly different from the typical "
    "customer pattern. Possible causes: unusual purchase volume, abnormal "
    "payment patterns, or sudden change in buying frequency."
)
ALERT_TEXT_CHURN = (
    "Customer %s... has a churn probability of %s (threshold: %s). "
    "The model predicts this customer is likely to stop purchasing. "
    "Key drivers may include: long time since last purchase, declining "
    "order frequency, or low satisfaction scores."
)
ALERT_TEXT_OTHER = "Alert type '%s' triggered for customer %s... with score %s."
ALERT_OPEN_ACTION = "Mark as resolved once reviewed."
ALERT_CLOSED_ACTION = "This alert has already been resolved."
