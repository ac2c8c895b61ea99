"""Values the SQL expects, written out: a wrong constant in the package must not be right here too.

Fixed values, in natural order; the same as the published ones.
"""

from __future__ import annotations

ADVICE_DISENGAGED = "Customer shows signs of disengagement. A re-engagement campaign may help."
ADVICE_HIGH_RISK = "Immediate attention recommended. Consider a personalized retention offer."
ADVICE_NONE = "No immediate action required. Continue monitoring."
ADVICE_UNUSUAL = "Unusual behavior detected. Review recent transactions for fraud or errors."
ALERT_OPEN_ACTION = "Mark as resolved once reviewed."
ALERT_TEXT_ANOMALY = "Customer %s... was flagged as anomalous with a score of %s (threshold: %s). This means their behavior is significantly different from the typical customer pattern. Possible causes: unusual purchase volume, abnormal payment patterns, or sudden change in buying frequency."
ALERT_TEXT_CHURN = "Customer %s... has a churn probability of %s (threshold: %s). The model predicts this customer is likely to stop purchasing. Key drivers may include: long time since last purchase, declining order frequency, or low satisfaction scores."
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
CONTAMINATION = 0.05
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
K_MAX = 8
K_MIN = 3
NOT_FOUND_TEXT = "No scores found for this customer hash."
NO_PROFILE_TEXT = "Detailed profile not available. Run training pipeline."
MARKETING_SUGGESTIONS = {
    'champions': 'Send a VIP early-access email for new products. Offer a referral bonus.',
    'loyal': 'Introduce a points-based loyalty program. Offer bundle discounts.',
    'at_risk': "Send a 'We miss you' email with a 15% discount code. Limited time.",
    'new_customers': 'Send a welcome series: onboarding tips + first repeat-purchase discount.',
    'hibernating': 'Win-back campaign: bold subject line + 25% discount. One email only.',
    'lost': 'Low priority. Include in quarterly bulk reactivation if budget allows.',
}
RATE_TEXT_HIGH = "High anomaly rate detected. This may indicate a data quality issue, a seasonal event, or unusual market activity. Review flagged customers."
RATE_TEXT_LOW = "Low anomaly rate. Customer behavior appears normal. Monitor flagged customers for any emerging patterns."
RATE_TEXT_MODERATE = "Moderate anomaly rate. Some customers show unusual behavior patterns. Review the top anomalous customers for potential action."
SEGMENT_DESCRIPTIONS = {
    'champions': 'Champions are your best customers. They buy frequently, spend the most, and purchased recently. Reward them with loyalty programs and early access.',
    'loyal': 'Loyal customers buy regularly and have a good spending history. They respond well to upselling and membership offers.',
    'at_risk': "At-risk customers used to buy regularly but haven't purchased recently. They need re-engagement campaigns with personalized offers.",
    'new_customers': 'New customers made their first purchase recently. Focus on onboarding, building trust, and encouraging a second purchase.',
    'hibernating': "Hibernating customers haven't purchased in a long time and buy infrequently. A win-back campaign with a strong discount may reactivate them.",
    'lost': 'Lost customers show no recent activity and very low purchase history. Reactivation is costly — focus resources on higher-value segments.',
}
SEGMENT_FEATURES = [
    "recency_days",
    "frequency",
    "monetary_total",
    "monetary_avg",
    "avg_review_score",
    "payment_installments_avg",
    "late_delivery_rate",
]
SEGMENT_LABELS = [
    "champions",
    "loyal",
    "at_risk",
    "new_customers",
    "hibernating",
    "lost",
]

# Block size and pads of HMAC (RFC 2104).
BLOCK_BYTES = 64
INNER_PAD = 0x36
OUTER_PAD = 0x5C
