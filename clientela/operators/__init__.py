"""The analytics: cleaning, features, models, monitoring, serving views."""
