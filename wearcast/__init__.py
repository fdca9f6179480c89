"""wearcast: Spark-native predictive-maintenance analytics.

Sensor readings → validation and quality profiles → derived features →
exact stratified splits → scaling → MLlib classifiers → evaluation →
model-version decisions → batch/stream scoring, all as DataFrame, SQL,
MLlib or Structured Streaming work.
"""

__version__ = "0.1.0"
